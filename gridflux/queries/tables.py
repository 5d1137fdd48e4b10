"""Queries on keyed tables: lookups, backlogs, designs, targets, checks."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridflux.functions import geo
from gridflux.functions.power import Power
from gridflux.operators import design, joins, landcover, preprocess, stats, targets, terrain, verify
from gridflux.operators.staging import shared_folder
from gridflux.queries.inputs import TILE_PARTS, YEARS, curves, read, rounded
from gridflux.sources import blocks

NATIVE_SQL = "(3, 59, 60, 61, 11, 12, 63, 66)"


def nearest_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = read(spark, sf_dir, "lineitem").select(F.year("l_shipdate").alias("year"))
    have = read(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("map_year")).where("map_year % 3 = 0")
    return joins.nearest_year(wanted, have)


NEAREST_SQL = """
WITH w AS (SELECT DISTINCT CAST(year(l_shipdate) AS INT) AS year FROM lineitem),
a AS (SELECT DISTINCT CAST(year(o_orderdate) AS INT) AS map_year FROM orders WHERE year(o_orderdate) % 3 = 0)
SELECT year, map_year, map_year - year AS delta FROM w, a QUALIFY row_number() OVER (PARTITION BY year ORDER BY abs(map_year - year), map_year) = 1"""


def _cover(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(year, row, col, class): the largest code of a customer's orders in a year."""
    o = read(spark, sf_dir, "orders")
    code = F.floor(F.col("o_totalprice") % 70).cast("int")
    rows = o.select(F.year("o_orderdate").alias("year"), F.floor(F.col("o_custkey") / 50).cast("int").alias("row"), (F.col("o_custkey") % 50).cast("int").alias("col"), code.alias("class"))
    return rows.groupBy("year", "row", "col").agg(F.max("class").alias("class"))


COVER = """cover AS (
  SELECT CAST(year(o_orderdate) AS INT) AS year, CAST(o_custkey // 50 AS INT) AS row, CAST(o_custkey % 50 AS INT) AS col,
         max(CAST(floor(o_totalprice % 70) AS INT)) AS class FROM orders GROUP BY ALL)"""


def _stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same raster as a block store in the shared folder."""
    path = f"{shared_folder(spark)}/blocks-{uuid.uuid4().hex}"
    blocks.write_blocks(blocks.encode_blocks(_cover(spark, sf_dir)), path)
    return blocks.read_blocks(spark, path)


def window_and_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landcover.window_native(_cover(spark, sf_dir), 1999)


MASK_SQL = f"WITH {COVER} SELECT row, col, bool_and(class IN {NATIVE_SQL}) AS native FROM cover WHERE year BETWEEN 1997 AND 1999 GROUP BY row, col"


def cover_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rectangle that reaches beyond the raster, with names."""
    legend = read(spark, sf_dir, "nation").select((F.col("n_nationkey") * 2).cast("int").alias("code"), F.col("n_name").alias("name"))
    return landcover.class_names(blocks.read_rectangle(_stored(spark, sf_dir), 1999, -2, 12, 40, 55), legend)


COVER_SQL = f"""
WITH {COVER}, cells AS (SELECT CAST(r AS INT) AS row, CAST(c AS INT) AS col FROM range(-2, 13) a(r), range(40, 56) b(c)),
w AS (SELECT cells.row, cells.col, coalesce(class, 0) AS class FROM cells LEFT JOIN cover ON cover.row = cells.row AND cover.col = cells.col AND year = 1999)
SELECT row, col, class, coalesce(n_name, 'UNKNOWN_' || class) AS name FROM w LEFT JOIN nation ON n_nationkey * 2 = class"""


def cover_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class under each customer's point."""
    c = read(spark, sf_dir, "customer")
    points = c.select("c_custkey", F.lit(1998).alias("year"), (F.col("c_custkey") % 53 + 0.25).alias("lon"), (F.lit(-0.25) - F.floor(F.col("c_custkey") / 50)).alias("lat"))
    return blocks.sample_blocks(points, _stored(spark, sf_dir), 0.0, 0.0, 1.0).select("c_custkey", "row", "col", "class")


SAMPLE_SQL = f"""
WITH {COVER}, p AS (SELECT c_custkey, CAST(floor(0.25 + c_custkey // 50) AS INT) AS row, CAST(floor(c_custkey % 53 + 0.25) AS INT) AS col FROM customer)
SELECT c_custkey, p.row, p.col, coalesce(class, 0) AS class FROM p LEFT JOIN cover ON cover.row = p.row AND cover.col = p.col AND year = 1998"""


def _places(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read(spark, sf_dir, "customer")
    return c.select("c_custkey", (F.lit(-72.0) + F.col("c_custkey") % 400 / 100).alias("lon"), (F.lit(-38.0) + F.col("c_custkey") % 777 / 100).alias("lat"))


def utm_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Projected customers, their tile, and the way back."""
    p = _places(spark, sf_dir)
    x, y = geo.to_utm(F.col("lon"), F.col("lat"))
    p = p.select("c_custkey", x.alias("x"), y.alias("y"))
    lon, lat = geo.to_lonlat(F.col("x"), F.col("y"))
    return rounded(p.select("c_custkey", "x", "y", lon.alias("lon"), lat.alias("lat"), geo.tile_id(F.col("x"), F.col("y")).alias("tile_id")), 4)


def _utm_sql() -> str:
    n = geo.FLATTENING / (2 - geo.FLATTENING)
    e = 2 * n**0.5 / (1 + n)
    xs = " + ".join(f"{a!r}::DOUBLE * cos({2 * j} * xi) * sinh({2 * j} * eta)" for j, a in enumerate(geo.ALPHA, 1))
    ys = " + ".join(f"{a!r}::DOUBLE * sin({2 * j} * xi) * cosh({2 * j} * eta)" for j, a in enumerate(geo.ALPHA, 1))
    k = repr(geo.SCALE * geo.RADIUS) + "::DOUBLE"
    return f"""
WITH p AS (SELECT c_custkey, -72.0::DOUBLE + c_custkey % 400 / 100 AS lon, -38.0::DOUBLE + c_custkey % 777 / 100 AS lat FROM customer),
a AS (SELECT *, sinh(atanh(sin(radians(lat))) - {e!r}::DOUBLE * atanh({e!r}::DOUBLE * sin(radians(lat)))) AS t, radians(lon + 69) AS l FROM p),
b AS (SELECT *, atan2(t, cos(l)) AS xi, atanh(sin(l) / sqrt(1 + t * t)) AS eta FROM a),
c AS (SELECT c_custkey, lon, lat, 500000 + {k} * (eta + {xs}) AS x, 10000000 + {k} * (xi + {ys}) AS y FROM b)
SELECT c_custkey, round(x, 4) AS x, round(y, 4) AS y, round(lon, 4) AS lon, round(lat, 4) AS lat,
       't' || CAST(floor(x / 9990) AS BIGINT) || '_' || CAST(floor(y / 9990) AS BIGINT) AS tile_id FROM c"""


def tile_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tiles of the customers' extent in whole units (an edge on a boundary included)."""
    r = read(spark, sf_dir, "customer").agg(F.min("c_acctbal"), F.max("c_acctbal")).first()
    return geo.tile_grid(spark, r[0], 0.0, r[1], 1980.0, 1000.0)


TILE_SQL = """
WITH e AS (SELECT min(c_acctbal) AS lo, max(c_acctbal) AS hi FROM customer),
g AS (SELECT ix, iy FROM e, range(-1000, 1000) a(ix), range(0, 3) b(iy) WHERE ix BETWEEN floor(lo / 990) AND floor(hi / 990))
SELECT 't' || ix || '_' || iy AS tile_id, ix * 990.0::DOUBLE AS xmin, iy * 990.0::DOUBLE AS ymin, (ix + 1) * 990.0::DOUBLE AS xmax, (iy + 1) * 990.0::DOUBLE AS ymax FROM g"""


def tile_backlog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts by year without any order line; a tile misses a year at least."""
    tiles = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("tile_id"))
    done = read(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("tile_id"), F.year("l_shipdate").alias("year"))
    return joins.backlog(tiles, list(YEARS), done)


BACKLOG_SQL = """
SELECT p_partkey AS tile_id, CAST(y AS INT) AS year FROM part, (SELECT unnest([1997, 1998, 1999, 2000, 2001]) AS y)
WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_partkey = p_partkey AND year(l_shipdate) = y)"""


def _manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders")
    status = F.when(F.col("o_orderstatus") == "F", "ok").when(F.col("o_orderstatus") == "O", "error").otherwise("no_data")
    return o.select((F.col("o_custkey") % 300).alias("tile_id"), F.year("o_orderdate").alias("year"), status.alias("status"), F.concat(F.lit("order "), F.repeat("o_orderpriority", 40)).alias("error"))


MANIFEST = """manifest AS (
  SELECT o_custkey % 300 AS tile_id, CAST(year(o_orderdate) AS INT) AS year,
         CASE o_orderstatus WHEN 'F' THEN 'ok' WHEN 'O' THEN 'error' ELSE 'no_data' END AS status, 'order ' || repeat(o_orderpriority, 40) AS error FROM orders)"""


def resume_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of a manifest that have no ok row yet."""
    m = _manifest(spark, sf_dir)
    return m.select("tile_id", "year").distinct().join(joins.done_pairs(m), ["tile_id", "year"], "left_anti")


RESUME_SQL = f"WITH {MANIFEST} SELECT tile_id, year FROM manifest GROUP BY tile_id, year HAVING count(*) FILTER (status = 'ok') = 0"


def manifest_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    objects = read(spark, sf_dir, "lineitem").select((F.col("l_partkey") % 311).alias("tile_id"), (F.year("l_shipdate") + 1).alias("year"))
    return joins.reconcile(_manifest(spark, sf_dir), objects)


RECONCILE_SQL = f"""
WITH {MANIFEST}, ok AS (SELECT DISTINCT tile_id, year FROM manifest WHERE status = 'ok'),
obj AS (SELECT DISTINCT l_partkey % 311 AS tile_id, CAST(year(l_shipdate) + 1 AS INT) AS year FROM lineitem)
SELECT tile_id, year, 'ok without object' AS problem FROM (FROM ok EXCEPT FROM obj)
UNION ALL SELECT tile_id, year, 'object without ok' FROM (FROM obj EXCEPT FROM ok)"""


def status_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = _manifest(spark, sf_dir)
    planned = m.select("tile_id").distinct().select("tile_id", F.explode(F.array(*map(F.lit, (1994, 1995, 1996, 1997)))).alias("year"))
    return joins.status_rows(planned, joins.done_pairs(m), m.where("status = 'error'").select("tile_id", "year", "error"))


STATUS_SQL = f"""
WITH {MANIFEST}, p AS (SELECT DISTINCT tile_id, CAST(y AS INT) AS year FROM manifest, (SELECT unnest([1994, 1995, 1996, 1997]) AS y)),
s AS (SELECT tile_id, year, max(error) FILTER (status = 'error') AS error, bool_or(status = 'ok') AS made FROM manifest GROUP BY ALL)
SELECT p.tile_id, p.year, left(error, 200) AS error, CASE WHEN error IS NOT NULL THEN 'error' WHEN made THEN 'ok' ELSE 'no_data' END AS status
FROM p LEFT JOIN s ON s.tile_id = p.tile_id AND s.year = p.year"""


def manifest_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(joins.progress(_manifest(spark, sf_dir), 3000))


PROGRESS_SQL = f"WITH {MANIFEST} SELECT status, count(*) AS n, round(count(DISTINCT (tile_id, year)) * 100.0::DOUBLE / 3000, 6) AS pct FROM manifest GROUP BY status"


def _tables(spark: SparkSession, sf_dir: str) -> design.Tables:
    """Customers as plots, with topography from two thirds of them."""
    c = read(spark, sf_dir, "customer")
    stratum = F.element_at(F.create_map(*[F.lit(x) for pair in zip(("BUILDING", "MACHINERY", "FURNITURE", "HOUSEHOLD"), design.STRATA, strict=True) for x in pair]), F.col("c_mktsegment"))
    plots = c.select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("area_m2"), stratum.alias("stratum"), (F.col("c_custkey") % 90 * -1.0).alias("lon"), (F.col("c_nationkey") * -1.5).alias("lat"), (F.col("c_custkey") % 30 + 1990).alias("year"))
    high = lambda k: F.col("c_acctbal") / k
    load = F.when(F.col("c_custkey") % 5 != 0, high(7.0))
    topo = c.where("c_custkey % 3 <> 0").select(
        F.col("c_custkey").alias("id"),
        *(x for i, v in enumerate(design.TOPO_VARS, 2) for x in ((load if v == "heat_load" else high(float(i))).alias(f"{v}_mean"), high(i * 10.0).alias(f"{v}_std"))),
    )
    return design.Tables(plots=plots, topo=topo)


def design_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An id without topography is flat, as one without a heat load."""
    return rounded(design.build_design(_tables(spark, sf_dir), "topo+area+coords+year"))


def _design_sql() -> str:
    cols = []
    for i, v in enumerate(design.TOPO_VARS, 2):
        mean = "CASE WHEN c_custkey % 5 <> 0 THEN c_acctbal / 7.0 END" if v == "heat_load" else f"c_acctbal / {i}.0"
        cols += [f"round(CASE WHEN t THEN {mean} END, 6) AS topo_{v}_mean", f"round(CASE WHEN t THEN c_acctbal / {i * 10}.0 END, 6) AS topo_{v}_std"]
    segments = dict(zip(design.STRATA[1:], ("MACHINERY", "FURNITURE", "HOUSEHOLD"), strict=True))
    cols += [f"CASE WHEN c_mktsegment = '{seg}' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS area_stratum_{s}" for s, seg in segments.items()]
    return f"""
WITH c AS (SELECT *, c_custkey % 3 <> 0 AS t FROM customer)
SELECT c_custkey AS id, {', '.join(cols)}, CASE WHEN t AND c_custkey % 5 <> 0 THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END AS topo_topo_flat,
       round(CASE WHEN c_acctbal > 0 THEN log10(c_acctbal) END, 6) AS area_log10, CAST(c_custkey % 90 * -1.0 AS DOUBLE) AS geo_lon, CAST(c_nationkey * -1.5 AS DOUBLE) AS geo_lat,
       round(CASE WHEN t THEN c_acctbal / 2.0 END, 6) AS geo_elevation, CAST(c_custkey % 30 + 1990 AS DOUBLE) AS year FROM c"""


def composite_block(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Curve and composite blocks of embeddings for their label's index."""
    rows = curves(spark, sf_dir).select("id", F.concat(F.lit("i"), F.col("label").cast("string")).alias("index"), F.lit("mean5x5").alias("px"), "curve")
    rows = rows.unionByName(rows.withColumn("px", F.lit("center")).withColumn("curve", F.transform("curve", lambda v: v + 100)))
    t = design.Tables(plots=read(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id")), curves=rows, options={"steps": 4})
    return rounded(design.build_design(t, "curve+composite", "i3"))


def _composite_sql() -> str:
    q = {10: 0.1, 25: 0.25, 50: 0.5, 75: 0.75, 90: 0.9}
    stats_sql = {"mean": "avg(v)", "sd": "stddev_samp(v)", **{f"p{p}": f"quantile_cont(v, {x})" for p, x in q.items()}, "min": "min(v)", "max": "max(v)", "range": "max(v) - min(v)"}
    stats_sql |= {"iqr": "quantile_cont(v, 0.75) - quantile_cont(v, 0.25)", "cv": "CASE WHEN abs(avg(v)) > 1e-9 THEN stddev_samp(v) / abs(avg(v)) END"}
    steps = ", ".join(f"round(max(v) FILTER (i = {k}), 6) AS curve_s{k:02d}" for k in range(4))
    return f"""
WITH c AS (SELECT vec_id AS id, unnest(range(0, len(embedding))) AS i, CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings WHERE label = 3),
s AS (SELECT id, {steps}, {', '.join(f'round({x}, 6) AS comp_{n}' for n, x in stats_sql.items())} FROM c GROUP BY id)
SELECT vec_id AS id, s.* EXCLUDE (id) FROM embeddings LEFT JOIN s ON s.id = vec_id"""


def _measured(spark: SparkSession, sf_dir: str) -> design.Tables:
    """Customers with phenology for two indices, cube predictors and climate; a fourth lacks each."""
    c = read(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "id")
    x = F.col("c_acctbal")
    one = [(F.pmod(x * (k + 1), F.lit(365.0)).alias(f"{m}_mean5x5"), F.pmod(x * (k + 2), F.lit(365.0)).alias(m)) for k, m in enumerate(design.LSP_METRICS)]
    kinds = F.element_at(F.array(*map(F.lit, ("winter_peaking", "summer_peaking", "winter"))), (F.col("id") % 3 + 1).cast("int"))
    qc = [(x / (k + 3)).alias(q) for k, q in enumerate(design.QC_METRICS)] + [(F.col("id") % 2 == 0).alias("order_coherent"), F.when(F.col("id") % 7 > 0, kinds).alias("phase_group")]
    lsp = c.where("id % 4 <> 0").select("id", F.explode(F.array(F.lit("ndvi"), F.lit("evi"))).alias("index"), "c_acctbal")
    lsp = lsp.withColumn("c_acctbal", F.when(F.col("index") == "evi", x + 17).otherwise(x))
    lsp = lsp.select("id", "index", *(col for pair in one for col in pair), *qc)
    cube = [f"{n}_{a}" for n in ("gm_red", "obs_ndvi_p50", "obs_evi_p50", "seas_ndvi_amp", "seas_evi_amp") for a in ("median", "mean", "sd", "cv")]
    climate = c.where("id % 4 <> 2").select("id", (x / 100).alias("bio01"), (x / 10).alias("bio12"))
    return design.Tables(
        plots=c.select("id"), lsp=lsp, climate=climate,
        cube=c.where("id % 4 <> 1").select("id", *((x / (k + 2)).alias(n) for k, n in enumerate(cube))), options={"circular": True},
    )


def feature_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Phenology, quality flags, cube families, their spread, and climate."""
    return rounded(design.build_design(_measured(spark, sf_dir), "lsp+qc+gm+obscomp+seas_all+clim+svh", "evi"))


def centre_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Centre-pixel phenology, and all indices side by side (three have no rows)."""
    out = design.build_design(_measured(spark, sf_dir), "lsp_ctr+lsp_all", "ndvi")
    return rounded(out.select("id", *(c for c in out.columns if c.startswith(("lsp_sos", "lsp_mos", "ndvi_lsp_pos", "evi_lsp_los", "savi_lsp_eos")))))


def _feature_sql() -> str:
    y = "CASE WHEN l THEN c_acctbal + 17 END"
    wrap = lambda v, k: f"(({v} * {k} % 365 + 365) % 365)"
    cols = [f"round({wrap(y, k + 1)}, 6) AS lsp_{m}_mean5x5" for k, m in enumerate(design.LSP_METRICS)]
    for k, m in enumerate(design.LSP_METRICS):
        if m in design.DOY_METRICS:
            cols += [f"round({f}(2 * pi() * {wrap(y, k + 1)} / 365), 6) AS lsp_{m}_{f}" for f in ("sin", "cos")]
    cols += [f"round({y} / {k + 3}, 6) AS qc_{q}" for k, q in enumerate(design.QC_METRICS)]
    cols += ["CASE WHEN l THEN CAST(id % 2 = 0 AS DOUBLE) END AS qc_order_coherent", "CASE WHEN l AND id % 7 > 0 AND id % 3 = 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS qc_is_winter_peaking"]
    names = [(n, a) for n in ("gm_red", "obs_ndvi_p50", "obs_evi_p50", "seas_ndvi_amp", "seas_evi_amp") for a in ("median", "mean", "sd", "cv")]
    value = {(n, a): f"round(CASE WHEN u THEN c_acctbal / {k + 2} END, 6)" for k, (n, a) in enumerate(names)}
    cols += [f"{value[n, 'median']} AS {p}{n}" for n, p in (("gm_red", "gmA_"), ("obs_evi_p50", "oc_"), ("seas_ndvi_amp", "sea_"), ("seas_evi_amp", "sea_"))]
    cols += [f"{v} AS svh_{n}_{a}" for (n, a), v in value.items() if a in ("sd", "cv")]
    cols += ["round(CASE WHEN id % 4 <> 2 THEN c_acctbal / 100 END, 6) AS bio01", "round(CASE WHEN id % 4 <> 2 THEN c_acctbal / 10 END, 6) AS bio12"]
    return f"WITH c AS (SELECT *, c_custkey AS id, c_custkey % 4 <> 0 AS l, c_custkey % 4 <> 1 AS u FROM customer) SELECT id, {', '.join(cols)} FROM c"


def _centre_sql() -> str:
    place = {m: k for k, m in enumerate(design.LSP_METRICS)}
    wrap = lambda v, k: f"((({v}) * {k} % 365 + 365) % 365)"
    out = []
    for prefix, shift, end, plus, names in (("", "0", "", 2, ("sos", "mos")), ("ndvi_", "0", "_mean5x5", 1, ("pos",)), ("evi_", "17", "_mean5x5", 1, ("los",)), ("savi_", None, "_mean5x5", 1, ("eos",))):
        for m in names:
            v = wrap(f"CASE WHEN l THEN c_acctbal + {shift} END" if shift else "CAST(NULL AS DOUBLE)", place[m] + plus)
            out.append(f"round({v}, 6) AS {prefix}lsp_{m}{end}")
            if m in design.DOY_METRICS:
                out += [f"round({f}(2 * pi() * {v} / 365), 6) AS {prefix}lsp_{m}_{f}" for f in ("sin", "cos")]
    return f"WITH c AS (SELECT *, c_custkey AS id, c_custkey % 4 <> 0 AS l FROM customer) SELECT id, {', '.join(out)} FROM c"


def context_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Context of each customer's terrain in the order that a model expects."""
    layers = _tables(spark, sf_dir).need("topo").select(F.col("id").alias("site"), *(F.col(f"{v}_mean").alias(v) for v in design.TOPO_VARS))
    columns = ["topo_topo_flat", *(f"topo_{v}" for v in design.TOPO_VARS), "area_log10", *(f"area_stratum_{s}" for s in design.STRATA[1:])]
    return rounded(terrain.context_frame(layers, columns, 250.0, "presence", design.STRATA, ["site"]))


def _context_sql() -> str:
    cols = [f"round({'CASE WHEN c_custkey % 5 <> 0 THEN c_acctbal / 7.0 END' if v == 'heat_load' else f'c_acctbal / {i}.0'}, 6) AS topo_{v}" for i, v in enumerate(design.TOPO_VARS, 2)]
    cols += [f"{1.0 if s == 'presence' else 0.0}::DOUBLE AS area_stratum_{s}" for s in design.STRATA[1:]]
    return f"SELECT c_custkey AS site, {', '.join(cols)}, round(log10(250.0::DOUBLE), 6) AS area_log10, CAST(c_custkey % 5 = 0 AS DOUBLE) AS topo_topo_flat FROM customer WHERE c_custkey % 3 <> 0"


def median_predicted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Median of predicted pixels over the ok years of each tile."""
    o = read(spark, sf_dir, "orders")
    status = F.when(F.col("o_orderstatus") == "F", "ok").otherwise("error")
    return joins.median_predicted(o.select((F.col("o_custkey") % 300).alias("tile_id"), status.alias("status"), F.floor("o_totalprice").alias("n_pred")))


MEDIAN_SQL = "SELECT o_custkey % 300 AS tile_id, count(*) AS n_years, CAST(trunc(median(CAST(floor(o_totalprice) AS BIGINT))) AS BIGINT) AS n_pred FROM orders WHERE o_orderstatus = 'F' GROUP BY 1"


def first_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first ten parts of the tile list, by size and key (a trial run)."""
    return joins.first_tiles(read(spark, sf_dir, "part").select("p_size", "p_partkey"), 10, ["p_size", "p_partkey"])


FIRST_SQL = "SELECT p_size, p_partkey FROM part ORDER BY p_size, p_partkey LIMIT 10"


def target_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sparse targets of two tables for all documents, and their masks."""
    docs = read(spark, sf_dir, "documents")
    labels = read(spark, sf_dir, "labels")
    sizes = docs.select("doc_id", F.when(F.col("lang") == "en", F.col("n_chars").cast("double")).alias("size"))
    y = targets.load_targets(docs, [(labels, ["quality", "toxic"]), (sizes, ["size"])], "doc_id")
    mask = targets.observed_mask(y, ["quality", "toxic", "size"], ["doc_id"])
    return y.join(mask.select("doc_id", *(F.col(c).cast("double").alias(f"has_{c}") for c in ("quality", "toxic", "size"))), "doc_id")


TARGET_SQL = """
WITH y AS (SELECT doc_id, quality, toxic, CASE WHEN lang = 'en' THEN CAST(n_chars AS DOUBLE) END AS size FROM documents LEFT JOIN labels USING (doc_id))
SELECT *, CASE WHEN quality IS NULL THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END AS has_quality, CASE WHEN toxic IS NULL THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END AS has_toxic,
       CASE WHEN size IS NULL THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END AS has_size FROM y"""


def impute_standardise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gaps in two columns, a constant one, fitted on four of five folds."""
    c = read(spark, sf_dir, "customer").select(
        "c_custkey", F.when(F.col("c_acctbal") > 0, F.log("c_acctbal")).alias("a"), F.when(F.col("c_nationkey") % 4 != 0, F.sqrt(F.col("c_nationkey").cast("double"))).alias("b"), F.lit(2.5).alias("k")
    )
    fits = preprocess.fit(c, F.col("c_custkey") % 5 != 0, ["a", "b", "k"])
    return rounded(preprocess.transform(c, fits, ["c_custkey"], "double"))


IMPUTE_SQL = """
WITH c AS (SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN ln(c_acctbal) END AS a, CASE WHEN c_nationkey % 4 <> 0 THEN sqrt(CAST(c_nationkey AS DOUBLE)) END AS b FROM customer),
m AS (SELECT median(a) AS ma, median(b) AS mb FROM c WHERE c_custkey % 5 <> 0),
f AS (SELECT c_custkey, coalesce(a, ma) AS fa, coalesce(b, mb) AS fb, a IS NULL AS na, b IS NULL AS nb FROM c, m),
u AS (SELECT avg(fa) AS ua, stddev_pop(fa) AS sa, avg(fb) AS ub, stddev_pop(fb) AS sb FROM f WHERE c_custkey % 5 <> 0)
SELECT c_custkey, round((fa - ua) / sa, 6) AS a, round((fb - ub) / sb, 6) AS b, 0.0::DOUBLE AS k, CAST(na AS DOUBLE) AS a_isna, CAST(nb AS DOUBLE) AS b_isna FROM f, u"""

POWERS = {"a": Power(0.3, 1.2, 0.8), "b": Power(0.0, 0.5, 1.5), "c": Power(2.0, -0.4, 0.9), "d": Power(-1.5, 0.1, 0.2)}


def _signed(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read(spark, sf_dir, "customer")
    x = F.col("c_acctbal") / 997.0
    return c.select("c_custkey", *(x.alias(t) for t in POWERS))


def yeo_johnson(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four scalers applied to balances of both signs."""
    return rounded(targets.scale(_signed(spark, sf_dir), POWERS, ["c_custkey"]))


def _power_sql(x: str, p: Power) -> str:
    up = f"ln(1 + {x})" if p.lam == 0 else f"(pow({x} + 1, {p.lam}::DOUBLE) - 1) / {p.lam}::DOUBLE"
    down = f"-ln(1 - {x})" if p.lam == 2 else f"-(pow(1 - {x}, {2 - p.lam}::DOUBLE) - 1) / {2 - p.lam}::DOUBLE"
    return f"((CASE WHEN {x} >= 0 THEN {up} ELSE {down} END) - {p.mean}::DOUBLE) / {p.scale}::DOUBLE"


POWER_SQL = "WITH c AS (SELECT c_custkey, c_acctbal / 997.0::DOUBLE AS x FROM customer) SELECT c_custkey, " + ", ".join(f"round({_power_sql('x', p)}, 6) AS {t}" for t, p in POWERS.items()) + " FROM c"


def scaler_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Targets whose round trip stays below the tolerance."""
    errors = verify.round_trip(_signed(spark, sf_dir), POWERS)
    return errors.select("target", (F.col("error") < verify.ROUND_TRIP).alias("passes"))


TRIP_SQL = "SELECT unnest(['a', 'b', 'c', 'd']) AS target, true AS passes"


def winsor_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Residuals of one line number by flag; a target of few rows has no bounds."""
    li = read(spark, sf_dir, "lineitem")
    r = F.log("l_extendedprice") - F.col("l_quantity") / 7
    rows = li.select(*(F.when(F.col("l_returnflag") == f, r).alias(f) for f in "ANR"), F.when(F.col("l_orderkey") % 100_000_007 < 3, r).alias("few"))
    return rounded(targets.winsor_bounds(rows, ["A", "N", "R", "few"]))


WINSOR_SQL = """
WITH r AS (SELECT l_returnflag AS target, ln(l_extendedprice) - l_quantity / 7 AS r, l_orderkey FROM lineitem),
s AS (SELECT target, r FROM r UNION ALL SELECT 'few', r FROM r WHERE l_orderkey % 100000007 < 3)
SELECT target, count(*) AS n, round(CASE WHEN count(*) >= 20 THEN quantile_cont(r, 0.025) END, 6) AS lo,
       round(CASE WHEN count(*) >= 20 THEN quantile_cont(r, 0.975) END, 6) AS hi FROM s GROUP BY target"""

DRAWN = [-0.6, -0.25, 0.0, 0.1, 0.4, 0.9]


def smear_inverse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Back-transformed predictions with literal residual draws, inside ranges."""
    p = POWERS["a"]
    x = F.when(F.col("c_custkey") % 11 != 0, F.col("c_acctbal") / 2500.0)
    c = read(spark, sf_dir, "customer").select("c_custkey", x.alias("x"))
    how = {"smeared": targets.Smear(p, tuple(DRAWN), (-2.0, 3.0), (-1.0, 40.0)), "plain": targets.Smear(p, (), (-2.0, 3.0))}
    return rounded(targets.smear_batches(c, {k: [("x", s)] for k, s in how.items()}, ["c_custkey"]))


def _inverse_sql(z: str, p: Power) -> str:
    y = f"({z} * {p.scale}::DOUBLE + {p.mean}::DOUBLE)"
    return f"CASE WHEN {y} >= 0 THEN pow({y} * {p.lam}::DOUBLE + 1, 1 / {p.lam}::DOUBLE) - 1 ELSE 1 - pow(1 - {2 - p.lam}::DOUBLE * {y}, 1 / {2 - p.lam}::DOUBLE) END"


def _smear_sql() -> str:
    p = POWERS["a"]
    clip = lambda v: f"greatest(-2.0::DOUBLE, least(3.0::DOUBLE, {v}))"
    mean = " + ".join(f"({_inverse_sql(clip(f'{clip("x")} + {d}::DOUBLE'), p)})" for d in DRAWN)
    return f"""
WITH c AS (SELECT c_custkey, CASE WHEN c_custkey % 11 <> 0 THEN c_acctbal / 2500.0::DOUBLE END AS x FROM customer)
SELECT c_custkey, CASE WHEN x IS NOT NULL THEN round(greatest(-1.0::DOUBLE, least(40.0::DOUBLE, ({mean}) / {len(DRAWN)})), 6) END AS smeared,
       CASE WHEN x IS NOT NULL THEN round({_inverse_sql(clip('x'), p)}, 6) END AS plain FROM c"""


def valid_fraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bands of order lines by flag: valid share of native rows, and deviation."""
    li = read(spark, sf_dir, "lineitem").select(
        "l_returnflag", (F.col("l_linenumber") < 5).alias("native"), F.when(F.col("l_quantity") > 10, F.log("l_quantity")).alias("q"), F.lit(3.0).alias("flat"), F.when(F.col("l_quantity") > 49, F.col("l_tax")).alias("rare")
    )
    checks = verify.band_checks(li, ["l_returnflag"], ["q", "flat", "rare"])
    problems = verify.band_problems(checks, ["l_returnflag"]).groupBy("l_returnflag", "band").agg(F.count("*").alias("n_problems"))
    return rounded(checks.join(problems, ["l_returnflag", "band"], "left").withColumn("n_problems", F.coalesce("n_problems", F.lit(0).cast("long"))))


VALID_SQL = """
WITH l AS (SELECT l_returnflag, l_linenumber < 5 AS native, CASE WHEN l_quantity > 10 THEN ln(l_quantity) END AS q, 3.0::DOUBLE AS flat, CASE WHEN l_quantity > 49 THEN l_tax END AS rare FROM lineitem),
u AS (SELECT l_returnflag, native, 'q' AS band, q AS value FROM l UNION ALL SELECT l_returnflag, native, 'flat', flat FROM l UNION ALL SELECT l_returnflag, native, 'rare', rare FROM l),
c AS (SELECT l_returnflag, band, avg(CASE WHEN value IS NULL THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END) FILTER (native) AS f, stddev_pop(value) AS s FROM u GROUP BY ALL)
SELECT l_returnflag, band, round(f, 6) AS valid_frac, round(s, 6) AS sd, CAST((f < 0.05)::INT + (s = 0)::INT AS BIGINT) AS n_problems FROM c"""


ASKED_TILES, ASKED_YEARS = ["7", "19", "250", "999"], [1996, 1997]


def requested_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verification of a request: rows of each tile and year asked for, 0 where none came."""
    o = read(spark, sf_dir, "orders").select((F.col("o_custkey") % 300).cast("string").alias("tile_id"), F.year("o_orderdate").alias("year"), "o_totalprice")
    found = verify.requested(o, ASKED_TILES, ASKED_YEARS).groupBy("tile_id", "year").agg(F.count("*").alias("n"), F.max("o_totalprice").alias("top"))
    lost = verify.missing_outputs(o, ASKED_TILES, ASKED_YEARS).select("tile_id", "year", F.lit(0).cast("long").alias("n"), F.lit(None).cast("double").alias("top"))
    return rounded(found.unionByName(lost))


REQUESTED_SQL = f"""
WITH o AS (SELECT CAST(o_custkey % 300 AS VARCHAR) AS tile_id, CAST(year(o_orderdate) AS INT) AS year, o_totalprice FROM orders)
SELECT t AS tile_id, CAST(y AS INT) AS year, count(o_totalprice) AS n, round(max(o_totalprice), 6) AS top
FROM (SELECT unnest({ASKED_TILES}) AS t), (SELECT unnest({ASKED_YEARS}) AS y) LEFT JOIN o ON tile_id = t AND year = y GROUP BY t, y"""


def seed_ensemble_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean of five seeds (line numbers), some of which give nothing."""
    li = read(spark, sf_dir, "lineitem").select("l_partkey", *(F.when(F.col("l_linenumber") % k != 0, F.log("l_extendedprice")).alias(f"t{k}") for k in (2, 3)))
    return rounded(stats.seed_mean(li, ["l_partkey"], ["t2", "t3"]))


SEED_SQL = "SELECT l_partkey, " + ", ".join(f"round(avg(CASE WHEN l_linenumber % {k} <> 0 THEN ln(l_extendedprice) END), 6) AS t{k}" for k in (2, 3)) + " FROM lineitem GROUP BY l_partkey"


def facet_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores by facet and target with subtotals (extension)."""
    p = read(spark, sf_dir, "part").select(F.col("p_type").alias("facet"), F.col("p_brand").alias("target"), F.log("p_retailprice").alias("score"))
    return rounded(stats.facet_report(p))


FACET_SQL = "SELECT p_type AS facet, p_brand AS target, round(avg(ln(p_retailprice)), 6) AS score, count(p_retailprice) AS n FROM part GROUP BY ROLLUP (p_type, p_brand)"


def tile_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pixels, native and predicted ones by tile and year."""
    li = read(spark, sf_dir, "lineitem").select(F.floor(F.col("l_partkey") / TILE_PARTS).alias("tile"), F.year("l_shipdate").alias("year"), (F.col("l_returnflag") == "N").alias("native"), (F.col("l_linestatus") == "O").alias("predicted"))
    return stats.tile_counts(li, ["tile", "year"])


COUNTS_SQL = f"SELECT l_partkey // {TILE_PARTS} AS tile, CAST(year(l_shipdate) AS INT) AS year, count(*) AS n_px, count(*) FILTER (l_returnflag = 'N') AS n_native, count(*) FILTER (l_linestatus = 'O') AS n_pred FROM lineitem GROUP BY ALL"


def range_of_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scaled range of each target over all plots."""
    s = targets.scale(_signed(spark, sf_dir), POWERS, [])
    one = s.agg(*(F.struct(F.min(t).alias("lo"), F.max(t).alias("hi")).alias(t) for t in POWERS))
    return rounded(one.select(F.explode(F.array(*(F.struct(F.lit(t).alias("target"), F.col(f"{t}.lo").alias("lo"), F.col(f"{t}.hi").alias("hi")) for t in POWERS))).alias("s")).select("s.*"))


RANGE_SQL = " UNION ALL ".join(f"SELECT '{t}' AS target, round(min({_power_sql('(c_acctbal / 997.0::DOUBLE)', p)}), 6) AS lo, round(max({_power_sql('(c_acctbal / 997.0::DOUBLE)', p)}), 6) AS hi FROM customer" for t, p in POWERS.items())

QUERIES = {
    "nearest_year": nearest_year, "window_and_mask": window_and_mask, "cover_window": cover_window, "cover_samples": cover_samples, "utm_projection": utm_projection,
    "tile_grid": tile_grid, "tile_backlog": tile_backlog, "resume_filter": resume_filter, "manifest_reconcile": manifest_reconcile, "status_rows": status_rows,
    "manifest_progress": manifest_progress, "design_matrix": design_matrix, "composite_block": composite_block, "target_join": target_join,
    "impute_standardise": impute_standardise, "yeo_johnson": yeo_johnson, "scaler_round_trip": scaler_round_trip, "winsor_bounds": winsor_bounds,
    "smear_inverse": smear_inverse, "valid_fraction": valid_fraction, "seed_ensemble_mean": seed_ensemble_mean, "requested_outputs": requested_outputs, "facet_report": facet_report,
    "tile_counts": tile_counts, "target_ranges": range_of_targets, "feature_blocks": feature_blocks, "centre_blocks": centre_blocks, "context_rows": context_rows,
    "median_predicted": median_predicted, "first_tiles": first_tiles,
}
ORACLE_SQL = {
    "nearest_year": NEAREST_SQL, "window_and_mask": MASK_SQL, "cover_window": COVER_SQL, "cover_samples": SAMPLE_SQL, "utm_projection": _utm_sql(),
    "tile_grid": TILE_SQL, "tile_backlog": BACKLOG_SQL, "resume_filter": RESUME_SQL, "manifest_reconcile": RECONCILE_SQL, "status_rows": STATUS_SQL,
    "manifest_progress": PROGRESS_SQL, "design_matrix": _design_sql(), "composite_block": _composite_sql(), "target_join": TARGET_SQL,
    "impute_standardise": IMPUTE_SQL, "yeo_johnson": POWER_SQL, "scaler_round_trip": TRIP_SQL, "winsor_bounds": WINSOR_SQL,
    "smear_inverse": _smear_sql(), "valid_fraction": VALID_SQL, "seed_ensemble_mean": SEED_SQL, "requested_outputs": REQUESTED_SQL, "facet_report": FACET_SQL,
    "tile_counts": COUNTS_SQL, "target_ranges": RANGE_SQL, "feature_blocks": _feature_sql(), "centre_blocks": _centre_sql(), "context_rows": _context_sql(),
    "median_predicted": MEDIAN_SQL, "first_tiles": FIRST_SQL,
}
