"""Queries on observations and series."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridflux.functions.indices import to_indices, with_clear
from gridflux.functions.semantics import circular, doy_label
from gridflux.operators import joins, regularize, stats, windows
from gridflux.queries.inputs import (
    EVENT, EVENT_TYPES, OBS, PART, YEARS, event_series, observations, part_series, read, rounded,
)
from gridflux.sources.observations import in_years, operating, place_nearest, sensor_dimension, solar_day, solar_mosaic, unite_sensors

STEPS = 20


def index_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = to_indices(with_clear(observations(spark, sf_dir)))
    return rounded(rows.select("px", "tie", "sensor", "clear", "band_blue", "band_swir2", "ndvi", "evi", "kndvi", "nbr", "savi", "doy", "year"))


INDEX_SQL = f"""
WITH {OBS},
b AS (SELECT px, tie, sensor, clear, ts,
        CASE WHEN clear AND blue > 0 THEN blue * 0.0000275::DOUBLE + -0.2::DOUBLE END AS bb, CASE WHEN clear AND red > 0 THEN red * 0.0000275::DOUBLE + -0.2::DOUBLE END AS rr,
        CASE WHEN clear AND nir > 0 THEN nir * 0.0000275::DOUBLE + -0.2::DOUBLE END AS nn, CASE WHEN clear AND swir2 > 0 THEN swir2 * 0.0000275::DOUBLE + -0.2::DOUBLE END AS ss FROM clear),
d AS (SELECT *, nn + rr AS d1, nn + 6.0 * rr - 7.5 * bb + 1.0 AS d2, nn + ss AS d3, nn + rr + 0.5 AS d4 FROM b),
q AS (SELECT *,
        CASE WHEN d1 <> 0 THEN (nn - rr) / d1 WHEN nn - rr > 0 THEN 9e9 WHEN nn - rr < 0 THEN -9e9 END AS q1,
        CASE WHEN d2 <> 0 THEN 2.5 * (nn - rr) / d2 WHEN nn - rr > 0 THEN 9e9 WHEN nn - rr < 0 THEN -9e9 END AS q2,
        CASE WHEN d3 <> 0 THEN (nn - ss) / d3 WHEN nn - ss > 0 THEN 9e9 WHEN nn - ss < 0 THEN -9e9 END AS q3,
        CASE WHEN d4 <> 0 THEN 1.5 * (nn - rr) / d4 WHEN nn - rr > 0 THEN 9e9 WHEN nn - rr < 0 THEN -9e9 END AS q4 FROM d),
c AS (SELECT *, CASE WHEN q1 IS NOT NULL THEN greatest(-1.0, least(1.0, q1)) END AS n1 FROM q)
SELECT px, tie, sensor, clear, round(bb, 6) AS band_blue, round(ss, 6) AS band_swir2, round(n1, 6) AS ndvi,
       round(CASE WHEN q2 IS NOT NULL THEN greatest(-1.0, least(1.0, q2)) END, 6) AS evi, round(tanh(n1 * n1), 6) AS kndvi,
       round(CASE WHEN q3 IS NOT NULL THEN greatest(-1.0, least(1.0, q3)) END, 6) AS nbr,
       round(CASE WHEN q4 IS NOT NULL THEN greatest(-1.5, least(1.5, q4)) END, 6) AS savi,
       CAST(dayofyear(ts) AS INT) AS doy, CAST(year(ts) AS INT) AS year
FROM c"""


def qa_clear_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    obs = with_clear(observations(spark, sf_dir))
    return obs.groupBy("sensor", "qa").agg(F.count_if("clear").alias("n_clear"), F.count("*").alias("n"))


QA_SQL = f"WITH {OBS} SELECT sensor, qa, count(*) FILTER (clear) AS n_clear, count(*) AS n FROM clear GROUP BY sensor, qa"


def sensor_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products by event type, tagged and united again."""
    e = read(spark, sf_dir, "events")
    parts = {t: e.where(F.col("event_type") == t).select("event_id", "user_id", "value") for t in EVENT_TYPES}
    parts["view"] = parts["view"].drop("value")  # a product that lacks a band
    return unite_sensors(parts)


UNION_SQL = "SELECT event_id, user_id, CASE WHEN event_type <> 'view' THEN value END AS value, event_type AS sensor FROM events"


def sensor_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = operating(observations(spark, sf_dir), sensor_dimension(spark))
    return rows.groupBy("sensor", F.year("ts").alias("year")).agg(F.count("*").alias("n"))


SENSOR_SQL = f"""
WITH {OBS}, d(sensor, a, b) AS (VALUES ('L5', 1984, 2011), ('L7', 1999, 2022), ('L8', 2013, 2100), ('L9', 2021, 2100))
SELECT sensor, CAST(year(ts) AS INT) AS year, count(*) AS n FROM obs JOIN d USING (sensor) WHERE year(ts) BETWEEN a AND b GROUP BY ALL"""


def solar_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First event of each user, type and solar day at longitude -70.5."""
    e = read(spark, sf_dir, "events").select(F.col("user_id").alias("px"), F.col("event_type").alias("sensor"), "ts", "event_id", "value")
    return solar_day(e, ["px"], F.lit(-70.5)).select("px", "sensor", F.col("solar_day").cast("string").alias("solar_day"), "event_id", "value")


SOLAR_SQL = """
WITH e AS (SELECT user_id AS px, event_type AS sensor, event_id, value, ts, CAST(ts + to_seconds(-16920) AS DATE) AS solar_day FROM events)
SELECT px, sensor, CAST(solar_day AS VARCHAR) AS solar_day, event_id, value FROM e
QUALIFY row_number() OVER (PARTITION BY px, sensor, solar_day ORDER BY ts, event_id) = 1"""


def day_mosaics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scenes of one hour and type, each on its own shifted grid, placed on 8 x 8 cells and
    mosaicked by solar day; low values are clouds, which the day's next scene fills."""
    e = read(spark, sf_dir, "events").select(
        F.concat_ws(" ", "event_type", F.date_trunc("hour", "ts")).alias("scene"), F.date_trunc("hour", "ts").alias("ts"), F.col("event_type").alias("sensor"),
        F.floor(F.col("user_id") % 64 / 8).cast("int").alias("row"), (F.col("user_id") % 8).cast("int").alias("col"), "value",
    )
    pixels = e.groupBy("scene", "row", "col").agg(F.max("value").alias("top")).select("scene", "row", "col", F.when(F.col("top") >= CLOUD, F.col("top")).alias("v"))
    shift = F.hour("ts") % 3 * 0.4 - 0.4
    scenes = e.select("scene", F.lit(0).alias("tile_id"), "ts", "sensor", shift.alias("west"), (-shift).alias("north"), F.lit(1.0).alias("size")).distinct()
    cells = spark.range(64).select(F.lit(0).alias("tile_id"), F.col("id").alias("px"), (F.col("id") % 8 + 0.5).alias("x"), (-F.floor(F.col("id") / 8) - 0.5).alias("y"))
    days = solar_mosaic(place_nearest(cells, scenes, pixels), ["px"], F.lit(-70.5), ["v"], ["ts"])
    return rounded(days.select("px", "sensor", F.col("solar_day").cast("string").alias("solar_day"), F.date_format("ts", "yyyy-MM-dd HH").alias("first_hour"), "v"))


CLOUD = 20.0
MOSAIC_SQL = f"""
WITH e AS (SELECT event_type AS sensor, date_trunc('hour', ts) AS ts, CAST(user_id % 64 // 8 AS INT) AS row, CAST(user_id % 8 AS INT) AS col, max(value) AS top FROM events GROUP BY ALL),
s AS (SELECT DISTINCT sensor, ts, hour(ts) % 3 * 0.4::DOUBLE - 0.4::DOUBLE AS shift FROM e),
p AS (SELECT c AS px, sensor, ts, CAST(floor(-shift + c // 8 + 0.5) AS INT) AS row, CAST(floor(c % 8 + 0.5 - shift) AS INT) AS col FROM range(0, 64) r(c), s),
v AS (SELECT px, sensor, ts, CAST(ts + to_seconds(-16920) AS DATE) AS day, CASE WHEN top >= {CLOUD} THEN top END AS v FROM p JOIN e USING (sensor, ts, row, col))
SELECT px, sensor, CAST(day AS VARCHAR) AS solar_day, strftime(min(ts), '%Y-%m-%d %H') AS first_hour, round(arg_min(v, ts) FILTER (v IS NOT NULL), 6) AS v FROM v GROUP BY px, sensor, day"""


def _windowed(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = part_series(spark, sf_dir)
    return windows.explode_target_years(rows.where(in_years(F.col("ts"), min(YEARS) - windows.SPAN + 1, max(YEARS))), list(YEARS), name="year")


def causal_window_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _windowed(spark, sf_dir).withColumn("v", F.when(F.col("sensor") != 0, F.col("v")))
    rows = rows.withColumn("tile", F.floor(F.col("px") / 100).cast("int"))
    return windows.window_spans(rows, ["tile", "year"])


WINDOWED = f"""{PART},
windowed AS (SELECT p.*, y.year FROM part_series p JOIN (SELECT unnest([1997, 1998, 1999, 2000, 2001]) AS year) y
             ON year(p.ts) BETWEEN y.year - 2 AND y.year)"""

WINDOW_SQL = f"""
WITH {WINDOWED},
w AS (SELECT CAST(px // 100 AS INT) AS tile, CAST(year AS INT) AS year, t, (ts, sensor) AS slice, sensor <> 0 AS ok FROM windowed),
g AS (SELECT tile, year, count(DISTINCT slice) FILTER (ok) AS n_clear, count(DISTINCT slice) AS n_dates_window,
             min(t) FILTER (ok) AS lo, max(t) FILTER (ok) AS hi FROM w GROUP BY tile, year)
SELECT tile, year, n_clear, n_dates_window, CASE WHEN n_clear >= 2 THEN lo END AS lo, CASE WHEN n_clear >= 2 THEN hi END AS hi FROM g"""


def regularize_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    obs = event_series(spark, sf_dir)
    return rounded(regularize.regularize(obs, regularize.own_spans(obs, ["key"]), ["key"], STEPS).select("key", "i", "x", "raw", "value", "n_obs"))


def _regular_sql(source: str, key: str, spans: str, out: str, prelude: str) -> str:
    """The union of grid and neighbours in SQL, by lateral aggregates over the key."""
    on = " AND ".join(f"o.{k} = g.{k}" for k in key.split(", "))
    keys = ", ".join(f"g.{k}" for k in key.split(", "))
    bare = key
    return f"""
WITH {prelude},
o AS (SELECT * FROM {source} WHERE v IS NOT NULL),
spans AS ({spans}),
g AS (SELECT *, lo + (hi - lo) * i / {STEPS - 1} AS x FROM spans, (SELECT unnest(range(0, {STEPS})) AS i) WHERE lo < hi),
n AS (SELECT {keys}, g.i, g.x, max({{'t': o.t, 'tie': o.tie, 'v': o.v}}) FILTER (o.t <= g.x) AS a,
             min({{'t': o.t, 'tie': o.tie, 'v': o.v}}) FILTER (o.t >= g.x) AS b, count(*) AS n_obs
      FROM g JOIN o ON {on} GROUP BY {keys}, g.i, g.x),
r AS (SELECT *, CASE WHEN a IS NULL THEN b.v WHEN b IS NULL OR b.t <= a.t THEN a.v
                     ELSE a.v + (b.v - a.v) * (x - a.t) / (b.t - a.t) END AS raw FROM n),
s AS (SELECT *, CASE WHEN n_obs >= 5 THEN avg(raw) OVER (PARTITION BY {bare} ORDER BY i ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) END AS value FROM r)
{out}"""


REGULAR_SQL = _regular_sql(
    "event_series", "key", "SELECT key, min(t) AS lo, max(t) AS hi FROM o GROUP BY key",
    "SELECT key, CAST(i AS INT) AS i, round(x, 6) AS x, round(raw, 6) AS raw, round(value, 6) AS value, n_obs FROM s", EVENT,
)


def raw_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users pinned to the span of their block of ten, roll 3, with day labels."""
    obs = event_series(spark, sf_dir).withColumn("block", F.floor(F.col("key") / 10).cast("int"))
    rows = regularize.raw_series(obs, ["block", "key"], ["block"], STEPS)
    return rounded(rows.select("block", "key", "i", "value", "doy"))


RAW_SQL = _regular_sql(
    "b", "block, key", "SELECT k.block, k.key, w.lo, w.hi FROM (SELECT DISTINCT block, key FROM o) k JOIN (SELECT block, min(t) AS lo, max(t) AS hi FROM b GROUP BY block) w USING (block)",
    "SELECT block, key, CAST(i AS INT) AS i, round(value, 6) AS value, round((x - min(x) OVER (PARTITION BY block, key)) % 365.25::DOUBLE + 1, 6) AS doy FROM s",
    EVENT + ", b AS (SELECT *, CAST(key // 10 AS INT) AS block FROM event_series)",
).replace("ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING", "ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING")


def regularize_curves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The array form, unfolded for comparison."""
    obs = event_series(spark, sf_dir)
    rows = regularize.regularize_arrays(obs, regularize.own_spans(obs, ["key"]), ["key"], STEPS)
    return rounded(rows.select("key", "n_obs", F.posexplode("curve").alias("i", "value")))


CURVES_SQL = _regular_sql(
    "event_series", "key", "SELECT key, min(t) AS lo, max(t) AS hi FROM o GROUP BY key",
    "SELECT key, CAST(n_obs AS INT) AS n_obs, CAST(i AS INT) AS i, round(value, 6) AS value FROM s WHERE value IS NOT NULL", EVENT,
)


def causal_curve_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: a curve for each part and causal window, pinned to the window's
    first and last slice, and its statistics.  The archive is read and dealt once, as
    panes of a part and year; spans, keys and windows all come from these."""
    rows = part_series(spark, sf_dir).where(in_years(F.col("ts"), min(YEARS) - windows.SPAN + 1, max(YEARS)))
    dealt = rows.select("px", F.year("ts").alias("pane"), F.struct("t", "tie", "v", "sensor", "ts").alias("o")).repartition("px")
    panes = dealt.groupBy("px", "pane").agg(F.sort_array(F.collect_list("o")).alias("s"))
    slices = panes.select(F.explode("s").alias("o")).select("o.*")
    spans = windows.merge_panes(windows.slice_panes(slices, []), [], list(YEARS)).select("year", "lo", "hi")
    mine = F.filter(F.sequence(F.col("pane"), F.col("pane") + windows.SPAN - 1), lambda y: y.isin(*YEARS))
    held = panes.select("px", "s", F.explode(mine).alias("year"))
    keys = held.where(F.size("s") > 0).select("year", "px").distinct().join(spans, "year")  # of whole panes, whose exchange is reused
    obs = held.select("year", "px", F.explode("s").alias("o")).select("year", "px", "o.t", "o.tie", "o.v")
    grid = regularize.regularize(obs, keys, ["year", "px"], STEPS)
    return rounded(stats.curve_stats(grid.where("value IS NOT NULL"), ["year", "px"]), 6)


def _stats_sql(source: str, key: str, digits: int = 6, where: str = "value IS NOT NULL") -> str:
    q = {p: f"quantile_cont(value, {p / 100})" for p in (10, 25, 50, 75, 90)}
    r = lambda x, n: f"round({x}, {digits}) AS {n}"
    return (
        f"SELECT {key}, {r('avg(value)', 'mean')}, {r('stddev_samp(value)', 'sd')}, "
        + ", ".join(r(v, f"p{p}") for p, v in q.items())
        + f", {r('min(value)', 'min')}, {r('max(value)', 'max')}, {r('max(value) - min(value)', 'range')}, {r(q[75] + ' - ' + q[25], 'iqr')}, "
        + f"round(CASE WHEN abs(avg(value)) > 1e-9 THEN stddev_samp(value) / abs(avg(value)) END, {digits}) AS cv FROM {source} WHERE {where} GROUP BY {key}"
    )


CAUSAL_SQL = _regular_sql(
    "windowed", "year, px",
    "SELECT k.year, k.px, w.lo, w.hi FROM (SELECT DISTINCT year, px FROM windowed) k JOIN (SELECT year, min(t) AS lo, max(t) AS hi FROM windowed GROUP BY year) w USING (year)",
    ", f AS (SELECT CAST(year AS INT) AS year, px, value FROM s) " + _stats_sql("f", "year, px"), WINDOWED,
)


def causal_curve_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same curves by the array form: one aggregate has each series, the windows'
    spans come from it, and a window of two slices or more is a row."""
    rows = _windowed(spark, sf_dir)
    series = rows.groupBy("year", "px").agg(F.sort_array(F.collect_list(F.struct("t", "tie", "v", "sensor", "ts"))).alias("s"))
    slices = series.select("year", F.explode("s").alias("o")).select("year", "o.*")
    spans = windows.window_spans(slices, ["year"]).select("year", "lo", "hi")
    curves = regularize.interpolated(series.join(spans, "year"), ["year", "px"], STEPS).where("curve IS NOT NULL")
    return rounded(stats.array_stats(curves, ["year", "px"]), 6)


def shrinking_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An even width of 4 acts as 5."""
    e = read(spark, sf_dir, "events").select("user_id", "event_id", "value")
    return rounded(regularize.shrinking_mean(e, ["user_id"], "event_id", "value", 4).select("event_id", "smooth"))


SHRINK_SQL = "SELECT event_id, round(avg(value) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING), 6) AS smooth FROM events"


def fill_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return regularize.fill_missing(event_series(spark, sf_dir), ["key"], "tie", "v").select("key", "tie", "filled")


FILL_SQL = f"""
WITH {EVENT}
SELECT key, tie, coalesce(last_value(v IGNORE NULLS) OVER (PARTITION BY key ORDER BY tie ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
                          first_value(v IGNORE NULLS) OVER (PARTITION BY key ORDER BY tie ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS filled
FROM event_series"""


def observation_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = part_series(spark, sf_dir).withColumn("v", F.when(F.col("sensor") != 0, F.col("v")))
    out = stats.observation_stats(rows, ["px"])
    return rounded(out.select("px", "n_obs", "max_gap", "mean_gap", "frac_valid", F.coalesce(F.size("n_per_year"), F.lit(0)).alias("n_years"), F.coalesce(F.array_max(F.map_values("n_per_year")), F.lit(0).cast("long")).alias("most_in_year")))


GAPS_SQL = f"""
WITH {PART},
share AS (SELECT px, avg(CASE WHEN sensor <> 0 THEN 1.0 ELSE 0.0 END) AS frac_valid FROM part_series GROUP BY px),
d AS (SELECT px, year(ts) AS y, CAST(dayofyear(ts) AS INT) AS doy FROM (SELECT DISTINCT px, ts FROM part_series WHERE sensor <> 0)),
g AS (SELECT px, doy - lag(doy) OVER (PARTITION BY px ORDER BY doy) AS gap FROM d),
a AS (SELECT px, count(*) AS n_obs, CAST(max(gap) AS INT) AS max_gap, avg(gap) AS mean_gap FROM g GROUP BY px),
y AS (SELECT px, CAST(count(*) AS INT) AS n_years, max(n) AS most_in_year FROM (SELECT px, y, count(*) AS n FROM d GROUP BY px, y) GROUP BY px)
SELECT px, coalesce(n_obs, 0) AS n_obs, max_gap, round(mean_gap, 6) AS mean_gap, round(frac_valid, 6) AS frac_valid,
       coalesce(n_years, 0) AS n_years, coalesce(most_in_year, 0) AS most_in_year
FROM share LEFT JOIN a USING (px) LEFT JOIN y USING (px)"""


def contrast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contrasts of five series for each user, whose means have both signs."""
    e = read(spark, sf_dir, "events").select(F.col("user_id").alias("id"), F.col("event_type").alias("index"), (F.col("value") - 50).alias("value"))
    return rounded(stats.contrast_block(stats.curve_stats(e, ["id", "index"]), ["id"], "index", EVENT_TYPES), 8)


def _contrast_sql() -> str:
    cols = []
    for k, a in enumerate(EVENT_TYPES):
        for b in EVENT_TYPES[k + 1 :]:
            ma, mb, ca, cb = (f"max({c}) FILTER (event_type = '{n}')" for c, n in (("m", a), ("m", b), ("c", a), ("c", b)))
            cols += [f"round({ma} - {mb}, 8) AS ctr_{a}_{b}_diff", f"round(CASE WHEN abs({mb}) > 1e-6 THEN {ma} / {mb} END, 8) AS ctr_{a}_{b}_ratio", f"round({ca} - {cb}, 8) AS ctr_{a}_{b}_cvdiff"]
    return (
        "WITH e AS (SELECT user_id, event_type, value - 50 AS value FROM events), s AS (SELECT user_id, event_type, avg(value) AS m, CASE WHEN abs(avg(value)) > 1e-9 THEN stddev_samp(value) / abs(avg(value)) END AS c FROM e GROUP BY ALL) "
        f"SELECT user_id AS id, {', '.join(cols)} FROM s GROUP BY user_id"
    )


def circular_doy(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders")
    s, c = circular(F.dayofyear("o_orderdate").cast("double"))
    label = doy_label(F.datediff(F.to_date("o_orderdate"), F.lit("1992-01-01").cast("date")).cast("double"), F.lit(0.0))
    return rounded(o.select("o_orderkey", s.alias("doy_sin"), c.alias("doy_cos"), label.alias("label")))


DOY_SQL = """
SELECT o_orderkey, round(sin(2 * pi() * dayofyear(o_orderdate) / 365.0::DOUBLE), 6) AS doy_sin, round(cos(2 * pi() * dayofyear(o_orderdate) / 365.0::DOUBLE), 6) AS doy_cos,
       round(CAST(datediff('day', DATE '1992-01-01', CAST(o_orderdate AS DATE)) AS DOUBLE) % 365.25::DOUBLE + 1, 6) AS label FROM orders"""


def json_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers of a JSON column, by type; and tags back to JSON."""
    e = read(spark, sf_dir, "events").select("event_type", F.get_json_object("props", "$.k").cast("int").alias("k"))
    return e.groupBy("event_type").agg(F.sum("k").alias("sum_k"), F.count("k").alias("n_k"), F.to_json(F.struct(F.min("k").alias("lo"), F.max("k").alias("hi"))).alias("span"))


JSON_SQL = """
WITH e AS (SELECT event_type, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events)
SELECT event_type, CAST(sum(k) AS BIGINT) AS sum_k, count(k) AS n_k, '{"lo":' || min(k) || ',"hi":' || max(k) || '}' AS span FROM e GROUP BY event_type"""


def chunk_assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tiles dealt in turn to 7 jobs and in 5 runs, inside each brand."""
    p = read(spark, sf_dir, "part").select("p_brand", "p_partkey")
    turn = joins.round_robin(p, ["p_partkey"], 7, ["p_brand"])
    return joins.contiguous_chunks(turn, ["p_partkey"], 5, 500, ["p_brand"])


CHUNK_SQL = """
SELECT p_brand, p_partkey, CAST((row_number() OVER w - 1) % 7 AS INT) AS job, CAST((row_number() OVER w - 1) // 100 AS INT) AS chunk
FROM part WINDOW w AS (PARTITION BY p_brand ORDER BY p_partkey)"""

QUERIES = {
    "index_projection": index_projection, "qa_clear_filter": qa_clear_filter, "sensor_union": sensor_union, "sensor_years": sensor_years,
    "solar_days": solar_days, "day_mosaics": day_mosaics, "causal_window_counts": causal_window_counts, "regularize_series": regularize_series, "regularize_curves": regularize_curves, "raw_series": raw_series,
    "causal_curve_stats": causal_curve_stats, "causal_curve_arrays": causal_curve_arrays, "shrinking_mean": shrinking_mean, "fill_series": fill_series,
    "observation_gaps": observation_gaps, "contrast_block": contrast, "circular_doy": circular_doy, "json_props": json_props, "chunk_assignment": chunk_assignment,
}
ORACLE_SQL = {
    "index_projection": INDEX_SQL, "qa_clear_filter": QA_SQL, "sensor_union": UNION_SQL, "sensor_years": SENSOR_SQL, "solar_days": SOLAR_SQL, "day_mosaics": MOSAIC_SQL,
    "causal_window_counts": WINDOW_SQL, "regularize_series": REGULAR_SQL, "regularize_curves": CURVES_SQL, "raw_series": RAW_SQL, "causal_curve_stats": CAUSAL_SQL,
    "causal_curve_arrays": CAUSAL_SQL, "shrinking_mean": SHRINK_SQL, "fill_series": FILL_SQL, "observation_gaps": GAPS_SQL, "contrast_block": _contrast_sql(),
    "circular_doy": DOY_SQL, "json_props": JSON_SQL, "chunk_assignment": CHUNK_SQL,
}
