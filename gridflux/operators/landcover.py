"""Land-cover rasters as (year, row, col, class) rows: masks, samples, reprojection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridflux.functions.geo import affine_cell, to_lonlat

# Classes that count as native vegetation.
NATIVE = (3, 59, 60, 61, 11, 12, 63, 66)


def is_native(code: Column) -> Column:
    """Null and the fill class 0 aren't native."""
    return F.coalesce(code.isin(*NATIVE), F.lit(False))


def window_native(cover: DataFrame, year: int, span: int = 3) -> DataFrame:
    """Cells that are native in each year of a causal window."""
    rows = cover.where(F.col("year").between(year - span + 1, year))
    return rows.groupBy("row", "col").agg(F.bool_and(is_native(F.col("class"))).alias("native"))


def read_window(cover: DataFrame, year: int, r0: int, r1: int, c0: int, c1: int) -> DataFrame:
    """Cells of a rectangle; those outside the raster are class 0."""
    spark = cover.sparkSession
    cells = spark.range(r0, r1 + 1).select(F.col("id").cast("int").alias("row")).crossJoin(
        spark.range(c0, c1 + 1).select(F.col("id").cast("int").alias("col"))
    )  # the rectangle asked for
    part = cover.where((F.col("year") == year) & F.col("row").between(r0, r1) & F.col("col").between(c0, c1)).select("row", "col", "class")
    return cells.join(part, ["row", "col"], "left").withColumn("class", F.coalesce("class", F.lit(0)))


def sample_at(points: DataFrame, cover: DataFrame, west: float, north: float, size: float, lon: str = "lon", lat: str = "lat") -> DataFrame:
    """Class at each point's cell (nearest, by floor) in the points' ``year``."""
    row, col = affine_cell(F.col(lon), F.col(lat), west, north, size)
    placed = points.withColumn("row", row).withColumn("col", col)
    joined = placed.join(cover.select("year", "row", "col", "class"), ["year", "row", "col"], "left")
    return joined.withColumn("class", F.coalesce("class", F.lit(0)))


def reproject_nearest(cells: DataFrame, cover: DataFrame, west: float, north: float, size: float, x: str = "x", y: str = "y") -> DataFrame:
    """Class of the nearest raster cell at each projected cell centre (``x``, ``y`` in
    metres, with a ``year``); outside the raster class 0."""
    lon, lat = to_lonlat(F.col(x), F.col(y))
    placed = cells.withColumns({"_lon": lon, "_lat": lat})
    return sample_at(placed, cover, west, north, size, "_lon", "_lat").drop("_lon", "_lat", "row", "col")


def class_names(codes: DataFrame, legend: DataFrame, code: str = "class") -> DataFrame:
    """Legend names; a code without one is UNKNOWN_<code>.  The legend is a short
    dimension table, which Spark broadcasts by its size."""
    named = codes.join(legend.select(F.col("code").alias(code), "name"), code, "left")
    return named.withColumn("name", F.coalesce("name", F.concat(F.lit("UNKNOWN_"), F.col(code).cast("string"))))
