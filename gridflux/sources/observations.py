"""Observation scans: sensors, window and box pruned at the Parquet reader."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridflux.functions.indices import SENSOR_YEARS, kndvi, ndvi, reflectance, with_clear

KNDVI_BANDS = ("red", "nir")


def in_years(ts: Column, first: int, last: int) -> Column:
    """A range on the raw column, so that it reaches the scan."""
    return (ts >= F.lit(f"{first}-01-01").cast("timestamp_ntz")) & (ts < F.lit(f"{last + 1}-01-01").cast("timestamp_ntz"))


def load_window(spark: SparkSession, path: str, first: int, last: int, box: tuple[int, int, int, int] | None = None) -> DataFrame | None:
    """Observations of all sensors that operated in the years, with a clear mask
    (made by sensor before anything is united); None if no sensor did."""
    sensors = operating_sensors(spark, first, last)
    if not sensors:
        return None
    obs = spark.read.parquet(path).where(F.col("sensor").isin(*sensors) & in_years(F.col("ts"), first, last))
    if box:
        r0, r1, c0, c1 = box
        obs = obs.where(F.col("row").between(r0, r1) & F.col("col").between(c0, c1))
    return with_clear(obs)


def load_kndvi(spark: SparkSession, path: str, first: int, last: int, box: tuple[int, int, int, int] | None = None) -> DataFrame | None:
    """(tile_id, px, row, col, ts, sensor, v): only two bands and the mask are read."""
    obs = load_window(spark, path, first, last, box)
    if obs is None:
        return None
    red, nir = (reflectance(F.col(b), F.col("clear")) for b in KNDVI_BANDS)
    return obs.select("tile_id", "px", "row", "col", "ts", "sensor", kndvi(ndvi(nir, red)).alias("v"))


def unite_sensors(frames: dict[str, DataFrame]) -> DataFrame:
    """Union by name of a frame for each sensor, tagged; missing columns are null."""
    tagged = [df.withColumn("sensor", F.lit(s)) for s, df in sorted(frames.items())]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def sensor_dimension(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(s, a, b) for s, (a, b) in SENSOR_YEARS.items()], "sensor string, year_start int, year_end int")


def operating_sensors(spark: SparkSession, first: int, last: int) -> list[str]:
    """Sensors that operated in any year from ``first`` to ``last`` (of four)."""
    there = sensor_dimension(spark).where((F.col("year_start") <= last) & (F.col("year_end") >= first))
    return sorted(r["sensor"] for r in there.collect())


def operating(obs: DataFrame, dimension: DataFrame) -> DataFrame:
    """Observations in the operating years of their sensor (four rows, broadcast)."""
    return obs.join(F.broadcast(dimension), "sensor").where(F.year("ts").between(F.col("year_start"), F.col("year_end"))).drop("year_start", "year_end")


def _local_day(lon: Column) -> Column:
    """Calendar day of ``ts`` in the sun's time at a longitude."""
    return F.to_date(F.col("ts").cast("timestamp") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), lon * 240))


def solar_day(obs: DataFrame, key: list[str], lon: Column, order: str = "ts") -> DataFrame:
    """One row for each key, sensor and local solar day: the first acquisition."""
    rest = [c for c in obs.columns if c not in (*key, "sensor")]
    first = F.min_by(F.struct(*rest), F.col(order)).alias("s")
    return obs.withColumn("solar_day", _local_day(lon)).groupBy(*key, "sensor", "solar_day").agg(first).select(*key, "sensor", "solar_day", "s.*")


def solar_mosaic(obs: DataFrame, key: list[str], lon: Column, bands: list[str], order: list[str]) -> DataFrame:
    """One row for each key, sensor and local solar day that mosaics the day's scenes: of
    each band the first value that isn't null in ``order``, so that a scene that is empty
    or masked at a cell leaves it to the next one; ``ts`` is the first acquisition's.
    Partial minima per task: no cell's scenes are gathered."""
    first = [F.min(F.when(F.col(b).isNotNull(), F.struct(*order, F.col(b).alias("_v"))))["_v"].alias(b) for b in bands]
    return obs.withColumn("solar_day", _local_day(lon)).groupBy(*key, "sensor", "solar_day").agg(F.min("ts").alias("ts"), *first)


def place_nearest(targets: DataFrame, scenes: DataFrame, pixels: DataFrame, tile: str = "tile_id") -> DataFrame:
    """Each target cell with the nearest cell of each scene of its tile.

    ``targets``: tile, x, y (cell centres) and more.  ``scenes``: scene, tile, west,
    north, size (a scene has a grid of its own), ts, sensor.  ``pixels``: scene, row,
    col and bands.  Cells outside a scene are left out.
    """
    met = targets.join(scenes, tile)  # a tile's scenes are a list of dates
    at = met.withColumns({"row": F.floor((F.col("north") - F.col("y")) / F.col("size")).cast("int"), "col": F.floor((F.col("x") - F.col("west")) / F.col("size")).cast("int")})
    return at.join(pixels, ["scene", "row", "col"]).drop("row", "col", "west", "north", "size")
