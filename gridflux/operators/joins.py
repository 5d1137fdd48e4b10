"""Keyed lookups: nearest year, backlog, resume, reconciliation, completeness, chunks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridflux.operators.ranks import place


def nearest_year(wanted: DataFrame, available: DataFrame, year: str = "year", at: str = "map_year") -> DataFrame:
    """For each wanted year the nearest available one (the earlier of two as near)
    and the signed distance.  Both sides are distinct years, hence short."""
    w, a = wanted.select(year).distinct(), available.select(at).distinct()
    pairs = w.join(F.broadcast(a), F.lit(True))  # distinct calendar years: some dozens
    best = pairs.groupBy(year).agg(F.min_by(at, F.struct(F.abs(F.col(at) - F.col(year)), F.col(at))).alias(at))
    return best.withColumn("delta", F.col(at) - F.col(year))


def backlog(tiles: DataFrame, years: list[int], done: DataFrame) -> DataFrame:
    """(tile_id, year) planned and not done; a tile is missing if any year is."""
    planned = tiles.select("tile_id").distinct().select("tile_id", F.explode(F.array(*map(F.lit, sorted(set(years))))).alias("year"))
    return planned.join(done.select("tile_id", "year").distinct(), ["tile_id", "year"], "left_anti")


def done_pairs(manifest: DataFrame) -> DataFrame:
    """Pairs with an ok row, whatever other rows they have."""
    return manifest.where("status = 'ok'").select("tile_id", "year").distinct()


def reconcile(manifest: DataFrame, objects: DataFrame) -> DataFrame:
    """ok rows without an object, and objects without an ok row."""
    ok = done_pairs(manifest)
    there = objects.select("tile_id", "year").distinct()
    lost = ok.join(there, ["tile_id", "year"], "left_anti").withColumn("problem", F.lit("ok without object"))
    stray = there.join(ok, ["tile_id", "year"], "left_anti").withColumn("problem", F.lit("object without ok"))
    return lost.unionByName(stray)


def missing_ids(ids: DataFrame, table: DataFrame, key: str) -> DataFrame:
    return ids.select(key).join(table.select(key), key, "left_anti")


def require_ids(ids: DataFrame, table: DataFrame, key: str, name: str) -> None:
    """Raise with a sample of five if ids are missing from a table."""
    lost = [r[0] for r in missing_ids(ids, table, key).orderBy(key).limit(5).collect()]
    if lost:
        raise ValueError(f"{name} lacks ids, such as {lost}")


def status_rows(planned: DataFrame, produced: DataFrame, errors: DataFrame) -> DataFrame:
    """ok, error (message cut at 200 characters) or no_data for each planned pair."""
    key = ["tile_id", "year"]
    e = errors.groupBy(*key).agg(F.max("error").alias("error"))
    rows = planned.join(produced.withColumn("_made", F.lit(True)), key, "left").join(e, key, "left")
    status = F.when(F.col("error").isNotNull(), "error").when(F.col("_made"), "ok").otherwise("no_data")
    return rows.withColumn("status", status).withColumn("error", F.substring("error", 1, 200)).drop("_made")


def round_robin(df: DataFrame, order: list[str], n: int, partition: list[str] | None = None) -> DataFrame:
    """Every n-th row of an order goes to one job."""
    rows, at = place(df, order, partition)
    return rows.withColumn("job", F.pmod(at, F.lit(n)).cast("int")).select(*df.columns, "job")


def contiguous_chunks(df: DataFrame, order: list[str], n: int, total: int, partition: list[str] | None = None) -> DataFrame:
    """n chunks of ceil(total / n) rows of an order."""
    size = max(1, -(-total // n))
    rows, at = place(df, order, partition)
    return rows.withColumn("chunk", F.floor(at / size).cast("int")).select(*df.columns, "chunk")


def first_tiles(tiles: DataFrame, n: int, order: list[str]) -> DataFrame:
    """The first n tiles of a list in its order (a trial run's limit)."""
    return tiles.orderBy(*order).limit(n)


def median_predicted(manifest: DataFrame) -> DataFrame:
    """(tile_id, n_years, n_pred): years that are ok and their median of predicted
    pixels, cut to a whole number."""
    ok = manifest.where("status = 'ok'")
    return ok.groupBy("tile_id").agg(F.count("*").alias("n_years"), F.percentile("n_pred", F.lit(0.5)).cast("long").alias("n_pred"))


def progress(manifest: DataFrame, planned: int) -> DataFrame:
    """Pairs by last status and their share of the plan."""
    return manifest.groupBy("status").agg(F.count("*").alias("n"), (F.countDistinct("tile_id", "year") * 100.0 / planned).alias("pct"))
