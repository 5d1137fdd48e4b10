"""Streaming extensions: windowed statistics of observations and resumable sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_events(spark: SparkSession, path: str, schema: StructType, pattern: str = "*.parquet") -> DataFrame:
    """A Parquet table, one file or a folder of them as Spark writes it, as a stream; new
    files of a folder are read as they come.  ``ts`` becomes a timestamp for watermarks.
    A path that isn't there is an error."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(hadoop).isDirectory():
        path, pattern = str(hadoop.getParent()), hadoop.getName()
    stream = spark.readStream.schema(schema).option("pathGlobFilter", pattern).parquet(path)
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


def windowed_stats(events: DataFrame, size: str = "1 day", late: str = "2 days", key: str = "event_type") -> DataFrame:
    """Tumbling windows with a watermark: count, mean and range by key."""
    return (
        events.withWatermark("ts", late)
        .groupBy(F.window("ts", size), key)
        .agg(F.count("*").alias("n"), F.avg("value").alias("mean"), F.min("value").alias("low"), F.max("value").alias("high"))
        .select(F.col("window.start").alias("start"), key, "n", "mean", "low", "high")
    )


def resume_sink(path: str, key: list[str]):
    """A foreachBatch function that writes each batch, without rows that repeat a key in
    it, to the partition of its number: a batch that is replayed replaces itself, and
    nothing that was written before is read."""

    def write(batch: DataFrame, number: int) -> None:
        rows = batch.dropDuplicates(key).withColumn("batch", F.lit(number).cast("long"))
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(path)

    return write
