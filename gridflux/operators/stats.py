"""Statistics of curves, observations, tiles and patches."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gridflux.operators.ranks import percentiles
from gridflux.operators.staging import fixed

STATS = ("mean", "sd", "p10", "p25", "p50", "p75", "p90", "min", "max", "range", "iqr", "cv")
TINY_MEAN, TINY_LEVEL = 1e-9, 1e-6


def curve_stats(rows: DataFrame, key: list[str], value: str = "value") -> DataFrame:
    """Twelve statistics over the non-null values of each key: sample deviation,
    exact linear percentiles; cv is the deviation over the mean's absolute value, null
    where that is next to nothing."""
    p = F.percentile(value, F.array(*[F.lit(q) for q in (0.1, 0.25, 0.5, 0.75, 0.9)]))
    base = rows.groupBy(*key).agg(
        F.avg(value).alias("mean"), F.stddev_samp(value).alias("sd"), p.alias("p"), F.min(value).alias("min"), F.max(value).alias("max")
    )
    q = {name: F.col("p")[i] for i, name in enumerate(("p10", "p25", "p50", "p75", "p90"))}
    out = base.select(
        *key, "mean", "sd", *(c.alias(n) for n, c in q.items()), "min", "max",
        (F.col("max") - F.col("min")).alias("range"), (q["p75"] - q["p25"]).alias("iqr"),
        F.when(F.abs("mean") > TINY_MEAN, F.col("sd") / F.abs("mean")).alias("cv"),
    )
    return out


def array_stats(curves: DataFrame, key: list[str], curve: str = "curve") -> DataFrame:
    return curve_stats(curves.select(*key, F.explode(curve).alias("value")), key)


def composite_block(curves: DataFrame, key: list[str], prefix: str = "comp_") -> DataFrame:
    stats = array_stats(curves, key)
    return stats.select(*key, *(F.col(s).alias(prefix + s) for s in STATS))


def contrast_block(stats: DataFrame, key: list[str], index: str, names: list[str]) -> DataFrame:
    """Contrasts of each pair of indices."""
    wide = stats.groupBy(*key).pivot(index, names).agg(F.first("mean").alias("mean"), F.first("cv").alias("cv"))
    of = lambda i: (F.col(f"{i}_mean"), F.col(f"{i}_cv"))
    return wide.select(*key, *(c.alias(n) for a, b in combinations(names, 2) for n, c in contrasts(a, b, of(a), of(b))))


def contrasts(a: str, b: str, x: tuple[Column, Column], y: tuple[Column, Column]) -> list[tuple[str, Column]]:
    """Level difference, ratio and cv difference of two indices, given (mean, cv) of each."""
    return [
        (f"ctr_{a}_{b}_diff", x[0] - y[0]),
        (f"ctr_{a}_{b}_ratio", F.when(F.abs(y[0]) > TINY_LEVEL, x[0] / y[0])),
        (f"ctr_{a}_{b}_cvdiff", x[1] - y[1]),
    ]


def observation_stats(obs: DataFrame, key: list[str], ts: str = "ts", value: str = "v") -> DataFrame:
    """Per key: times with a value, largest and mean gap of the days of the year
    (pooled over years, sorted, not circular), count by year, share of valid values."""
    share = obs.groupBy(*key).agg(F.avg(F.col(value).isNotNull().cast("double")).alias("frac_valid"))
    times = obs.where(F.col(value).isNotNull()).select(*key, ts).distinct()
    days = times.select(*key, F.year(ts).alias("year"), F.dayofyear(ts).alias("doy"))
    order = Window.partitionBy(*key).orderBy("doy")
    gaps = days.withColumn("gap", F.col("doy") - F.lag("doy").over(order))
    by_year = days.groupBy(*key, "year").agg(F.count("*").alias("n"))
    years = by_year.groupBy(*key).agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("year", "n")))).alias("n_per_year"))
    total = gaps.groupBy(*key).agg(F.count("*").alias("n_obs"), F.max("gap").alias("max_gap"), F.avg("gap").alias("mean_gap"))
    return share.join(total, key, "left").join(years, key, "left").withColumn("n_obs", F.coalesce("n_obs", F.lit(0).cast("long")))


def tile_counts(pixels: DataFrame, group: list[str]) -> DataFrame:
    """n_px, n_native, n_pred of each tile and year."""
    return pixels.groupBy(*group).agg(
        F.count("*").alias("n_px"), F.count_if(F.col("native")).alias("n_native"), F.count_if(F.col("predicted")).alias("n_pred")
    )


def _near(sites: DataFrame, half: int) -> DataFrame:
    """(site_id, dr, dc, row, col) of the cells around each site.  Spark's size estimate
    leaves out that there are 25 of them: join them by ``hint("merge")``, never by broadcast."""
    step = F.explode(F.sequence(F.lit(-half), F.lit(half)))
    near = sites.select("site_id", F.col("row").alias("r0"), F.col("col").alias("c0"), step.alias("dr")).select("*", step.alias("dc"))
    return near.select("site_id", "dr", "dc", (F.col("r0") + F.col("dr")).alias("row"), (F.col("c0") + F.col("dc")).alias("col"))


def patch_stats(grid: DataFrame, sites: DataFrame, names: list[str], half: int = 2) -> DataFrame:
    """Centre value, mean and population deviation over a square around each
    site's cell, cut at the grid's edge.  Sites bring (site_id, row, col)."""
    joined = _near(sites, half).join(grid.hint("merge"), ["row", "col"])
    centre = (F.col("dr") == 0) & (F.col("dc") == 0)
    aggs = []
    for n in names:
        aggs += [F.max(F.when(centre, F.col(n))).alias(n), F.avg(n).alias(f"{n}_mean"), F.stddev_pop(n).alias(f"{n}_std")]
    return joined.groupBy("site_id").agg(*aggs)


def patch_arrays(grid: DataFrame, sites: DataFrame, names: list[str], half: int = 2) -> DataFrame:
    """(site_id, height, width, an array a layer): the square around each site's cell,
    row by row, cut at the grid's edge."""
    cells = _near(sites, half).join(grid.hint("merge"), ["row", "col"])
    ordered = F.sort_array(F.collect_list(F.struct("row", "col", *(F.col(n).alias(n) for n in names))))  # a patch has 25 cells
    out = cells.groupBy("site_id").agg(ordered.alias("p"), F.countDistinct("row").cast("int").alias("height"), F.countDistinct("col").cast("int").alias("width"))
    return out.select("site_id", "height", "width", *(F.col(f"p.{n}").alias(n) for n in names))


def describe(df: DataFrame, names: list[str], digits: int = 2) -> DataFrame:
    """(column, count, mean, std, min, p25, p50, p75, max) of columns, rounded.  The columns
    are fixed first: several passes read them."""
    kept = fixed(df.select(*(F.col(n).cast("double").alias(n) for n in names)))
    whole = kept.agg(*(f(n).alias(f"{k}_{n}") for n in names for k, f in (("count", F.count), ("mean", F.avg), ("std", F.stddev_samp), ("min", F.min), ("max", F.max)))).first()
    found = percentiles(kept, {n: F.col(n) for n in names}, [0.25, 0.5, 0.75])
    kinds = ("mean", "std", "min", "p25", "p50", "p75", "max")
    rows = [(n, whole[f"count_{n}"], *(whole[f"{k}_{n}"] for k in kinds[:3]), *(found[n] or (None,) * 3), whole[f"max_{n}"]) for n in names]
    out = df.sparkSession.createDataFrame(rows, f"column string, count long, {', '.join(f'{k} double' for k in kinds)}")
    return out.select("column", "count", *(F.round(k, digits).alias(k) for k in kinds))


def seed_mean(preds: DataFrame, key: list[str], targets: list[str]) -> DataFrame:
    """Mean over an ensemble's seeds, skipping nulls."""
    return preds.groupBy(*key).agg(*(F.avg(t).alias(t) for t in targets))


def facet_report(scores: DataFrame) -> DataFrame:
    """Mean score by facet, and over all (rollup)."""
    return scores.rollup("facet", "target").agg(F.avg("score").alias("score"), F.count("score").alias("n"))
