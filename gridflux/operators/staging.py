"""Tables that later steps must agree on, computed once."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder, which driver and executors share.  Only in plain local mode,
    and only where none is set, a temporary one is made."""
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        base = spark.conf.get("spark.checkpoint.dir", None)
        if not base and (sc.master.startswith("local-cluster") or not sc.master.startswith("local")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(base or tempfile.mkdtemp(prefix="gridflux-"))
    return sc.getCheckpointDir()


def fixed(df: DataFrame) -> DataFrame:
    """``df`` as a checkpoint in the shared folder: its lineage ends there, so a lost
    executor doesn't recompute it."""
    shared_folder(df.sparkSession)
    return df.checkpoint()
