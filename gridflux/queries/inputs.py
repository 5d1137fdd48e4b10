"""Domain roles of the driver's tables, and the same as SQL for the oracles.

lineitem is the multi-year archive (a part is a pixel, a block of parts a tile,
the line number names the sensor), events a short series for each user,
embeddings are curves, customers are plots, parts are grid cells.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TILE_PARTS, GRID_COLS = 2000, 40
YEARS = (1997, 1998, 1999, 2000, 2001)
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scaled bands and a quality field derived from order lines."""
    li = read(spark, sf_dir, "lineitem")
    number = lambda c: F.floor(c).cast("int")
    cloud = F.when(F.col("l_returnflag") == "R", 8).when(F.col("l_returnflag") == "A", 4).otherwise(0)
    return li.select(
        F.concat(F.lit("t"), F.floor(F.col("l_partkey") / TILE_PARTS).cast("string")).alias("tile_id"),
        F.col("l_partkey").alias("px"), (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("tie"), F.col("l_shipdate").alias("ts"),
        F.element_at(F.array(*map(F.lit, ("L5", "L7", "L8", "L9"))), (F.col("l_linenumber") % 4 + 1).cast("int")).alias("sensor"),
        number(F.lit(7000) + F.col("l_quantity") * 100).alias("blue"), number(F.lit(8000) + F.col("l_quantity") * 50).alias("green"),
        number(F.lit(7500) + F.col("l_discount") * 20000).alias("red"), number(F.lit(8000) + F.col("l_extendedprice") % 9000).alias("nir"),
        number(F.lit(6000) + F.col("l_tax") * 40000).alias("swir1"), number(F.lit(7000) + F.col("l_tax") * 50000 - F.col("l_quantity") * 150).alias("swir2"),
        (cloud + F.when(F.col("l_linestatus") == "O", 64).otherwise(0)).alias("qa"),
    )


OBS = f"""obs AS (
  SELECT 't' || CAST(l_partkey // {TILE_PARTS} AS VARCHAR) AS tile_id, l_partkey AS px, l_orderkey * 8 + l_linenumber AS tie, l_shipdate AS ts,
         ['L5', 'L7', 'L8', 'L9'][l_linenumber % 4 + 1] AS sensor,
         CAST(floor(7000 + l_quantity * 100) AS INT) AS blue, CAST(floor(8000 + l_quantity * 50) AS INT) AS green,
         CAST(floor(7500 + l_discount * 20000) AS INT) AS red, CAST(floor(8000 + l_extendedprice % 9000) AS INT) AS nir,
         CAST(floor(6000 + l_tax * 40000) AS INT) AS swir1, CAST(floor(7000 + l_tax * 50000 - l_quantity * 150) AS INT) AS swir2,
         CASE l_returnflag WHEN 'R' THEN 8 WHEN 'A' THEN 4 ELSE 0 END + CASE l_linestatus WHEN 'O' THEN 64 ELSE 0 END AS qa
  FROM lineitem),
clear AS (SELECT *, (qa & CASE WHEN sensor IN ('L8', 'L9') THEN 63 ELSE 59 END) = 0 AS clear FROM obs)"""


def part_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(px, ts, t, tie, v) from order lines: log price per unit by ship day."""
    li = read(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_partkey").alias("px"), F.col("l_shipdate").alias("ts"), F.datediff(F.to_date("l_shipdate"), F.lit("1970-01-01").cast("date")).cast("double").alias("t"),
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("tie"), F.log(F.col("l_extendedprice") / F.col("l_quantity")).alias("v"),
        (F.col("l_linenumber") % 4).alias("sensor"),
    )


PART = """part_series AS (
  SELECT l_partkey AS px, l_shipdate AS ts, CAST(datediff('day', DATE '1970-01-01', CAST(l_shipdate AS DATE)) AS DOUBLE) AS t,
         l_orderkey * 8 + l_linenumber AS tie, ln(l_extendedprice / l_quantity) AS v, l_linenumber % 4 AS sensor FROM lineitem)"""


def event_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(key, t, tie, v): values by user and day; errors carry no value."""
    e = read(spark, sf_dir, "events")
    return e.select(
        F.col("user_id").alias("key"), F.datediff(F.to_date("ts"), F.lit("1970-01-01").cast("date")).cast("double").alias("t"),
        F.col("event_id").alias("tie"), F.when(F.col("event_type") != "error", F.col("value")).alias("v"),
    )


EVENT = """event_series AS (
  SELECT user_id AS key, CAST(datediff('day', DATE '1970-01-01', CAST(ts AS DATE)) AS DOUBLE) AS t, event_id AS tie,
         CASE WHEN event_type <> 'error' THEN value END AS v FROM events)"""


def curves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, curve) from embeddings."""
    return read(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("curve"), "label")


CURVE = """curve AS (
  SELECT vec_id AS id, label, unnest(range(0, len(embedding))) AS i, CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings)"""


def elevation_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(tile_id, row, col, elevation) from parts; some cells are nodata."""
    p = read(spark, sf_dir, "part")
    local = F.col("p_partkey") % TILE_PARTS
    high = F.when(F.col("p_partkey") % 97 == 5, -9999.0).otherwise(F.col("p_retailprice") + F.col("p_size") * 10.0)
    return p.select(
        F.floor(F.col("p_partkey") / TILE_PARTS).cast("int").alias("tile_id"), F.floor(local / GRID_COLS).cast("int").alias("row"),
        (local % GRID_COLS).cast("int").alias("col"), high.alias("elevation"),
    )


GRID = f"""grid AS (
  SELECT CAST(p_partkey // {TILE_PARTS} AS INT) AS tile_id, CAST((p_partkey % {TILE_PARTS}) // {GRID_COLS} AS INT) AS row,
         CAST((p_partkey % {TILE_PARTS}) % {GRID_COLS} AS INT) AS col,
         CASE WHEN p_partkey % 97 = 5 THEN -9999.0 ELSE p_retailprice + p_size * 10.0 END AS raw_elevation FROM part),
valid AS (SELECT tile_id, row, col, CASE WHEN raw_elevation > -1000 THEN raw_elevation END AS elevation FROM grid)"""


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round float columns, as the oracles do."""
    kinds = dict(df.dtypes)
    return df.select(*((F.round(c, digits) + F.lit(0.0)).alias(c) if kinds[c] in ("double", "float") else F.col(c) for c in df.columns))
