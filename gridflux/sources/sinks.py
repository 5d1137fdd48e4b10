"""Writers: tile-year layers, manifests, run metadata, CSV echoes."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridflux.sources.tables import MANIFEST


#: What readers of the maps must know; part of each run's tags.
CAVEAT = "predictions are means over an ensemble; they are valid for native vegetation and inside the training range only"


def write_tile_years(layers: DataFrame, path: str) -> None:
    """Float layers partitioned by year and tile; a run replaces only the
    partitions that it made, and Spark's commit protocol makes each appear whole."""
    fixed = {"tile_id", "year", "row", "col"}
    rows = layers.select(*(F.col(c) if c in fixed else F.col(c).cast("float").alias(c) for c in layers.columns))
    rows.repartition("year", "tile_id").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("year", "tile_id").parquet(path)


def manifest_frame(rows: DataFrame) -> DataFrame:
    """Rows with all manifest columns in order; missing ones are null."""
    wanted = [x.split() for x in MANIFEST.split(", ")]
    return rows.select(*((F.col(n) if n in rows.columns else F.lit(None)).cast(k).alias(n) for n, k in wanted))


def append_manifest(rows: DataFrame, path: str) -> None:
    manifest_frame(rows).coalesce(1).write.mode("append").option("header", True).csv(path)  # a row for each tile and year


def compact_manifest(spark: SparkSession, path: str, to: str) -> None:
    """The files of many appends as one, under another path (readers switch to it)."""
    manifest_frame(spark.read.csv(path, header=True, schema=MANIFEST)).coalesce(1).write.mode("errorifexists").option("header", True).csv(to)


def merge_manifests(parts: list[DataFrame]) -> DataFrame:
    out = manifest_frame(parts[0])
    for p in parts[1:]:
        out = out.unionByName(manifest_frame(p))
    return out


def write_run(spark: SparkSession, path: str, meta: dict) -> None:
    """Run metadata as one JSON line, with its tags as a map of strings."""
    meta = {"caveat": CAVEAT, **meta}
    row = {"run_id": str(meta.get("run_id", "")), "tags": {k: str(v) for k, v in meta.items()}, "body": json.dumps(meta, sort_keys=True, default=str)}
    spark.createDataFrame([row], "run_id string, tags map<string,string>, body string").coalesce(1).write.mode("overwrite").json(path)


def read_run(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("run_id string, tags map<string,string>, body string").json(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)  # lists of tiles
