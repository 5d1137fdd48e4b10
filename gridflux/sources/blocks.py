"""Rasters as square blocks: a row for each 256 x 256 cells instead of one for each cell.

A block is keyed by (year, block_row, block_col) and holds its cells' codes row by row
as bytes, so a raster of billions of cells is some tens of thousands of rows.  Files
are sorted by key: a window's bounds on the block numbers are pushed to the Parquet
reader, which skips row groups and never decodes a block that the window doesn't
touch.  Single cells are read from the binary by expressions of Spark; whole blocks
are decoded in Arrow batches.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridflux.functions.geo import affine_cell

SIDE = 256
KEY = ["year", "block_row", "block_col"]
KIND = "year int, block_row int, block_col int, cells binary"


def block_of(place: Column) -> Column:
    return F.floor(place / SIDE).cast("int")


def encode_blocks(cover: DataFrame) -> DataFrame:
    """Blocks of (year, row, col, class) rows, codes 0 to 255; cells without a row are 0.
    A cell that comes more than once has its largest code.  A group is a block, so it
    never holds more than its cells' distinct codes."""

    def pack(group: pa.Table) -> pa.Table:
        at, code = (group.column(k).to_numpy().astype(np.int64) for k in ("at", "class"))
        if code.min(initial=0) < 0 or code.max(initial=0) > 255:
            raise ValueError(f"a code of {code.min()} to {code.max()} doesn't fit a byte")
        cells = np.zeros(SIDE * SIDE, np.uint8)
        cells[at] = code
        return pa.table({**{k: group.column(k)[:1] for k in KEY}, "cells": pa.array([cells.tobytes()], pa.binary())})

    at = F.pmod("row", F.lit(SIDE)) * SIDE + F.pmod("col", F.lit(SIDE))
    rows = cover.where("class IS NOT NULL").select(F.col("year").cast("int").alias("year"), block_of(F.col("row")).alias("block_row"), block_of(F.col("col")).alias("block_col"), at.cast("int").alias("at"), F.col("class").cast("int").alias("class"))
    rows = rows.groupBy(*KEY, "at").agg(F.max("class").alias("class"))
    return rows.groupBy(*KEY).applyInArrow(pack, KIND)


def write_blocks(blocks: DataFrame, path: str) -> None:
    """Sorted by key over files of ranges, in row groups of some tens of blocks."""
    ordered = blocks.repartitionByRange(*KEY).sortWithinPartitions(*KEY)
    ordered.write.mode("overwrite").option("compression", "zstd").option("parquet.block.size", str(4 << 20)).parquet(path)


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(KIND).parquet(path)


def touched(blocks: DataFrame, year: int, r0: int, r1: int, c0: int, c1: int) -> DataFrame:
    """Blocks of a year that a rectangle (bounds included) touches: bounds at the reader."""
    return blocks.where(
        (F.col("year") == year) & F.col("block_row").between(r0 // SIDE, r1 // SIDE) & F.col("block_col").between(c0 // SIDE, c1 // SIDE)
    )


def read_rectangle(blocks: DataFrame, year: int, r0: int, r1: int, c0: int, c1: int) -> DataFrame:
    """(row, col, class) of a rectangle; cells outside the raster are class 0."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for br, bc, cells in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                top, left = br * SIDE, bc * SIDE
                a, b, c, d = max(r0, top), min(r1, top + SIDE - 1), max(c0, left), min(c1, left + SIDE - 1)
                if cells is None:
                    part = np.zeros((b - a + 1, d - c + 1), np.int32)
                else:
                    part = np.frombuffer(cells, np.uint8).reshape(SIDE, SIDE)[a - top : b - top + 1, c - left : d - left + 1].astype(np.int32)
                rows, cols = np.meshgrid(np.arange(a, b + 1, dtype=np.int32), np.arange(c, d + 1, dtype=np.int32), indexing="ij")
                yield pa.RecordBatch.from_arrays([pa.array(x.ravel()) for x in (rows, cols, part)], names=["row", "col", "class"])

    spark = blocks.sparkSession
    asked = spark.range(r0 // SIDE, r1 // SIDE + 1).select(F.col("id").cast("int").alias("block_row"), F.explode(F.sequence(F.lit(c0 // SIDE), F.lit(c1 // SIDE))).alias("block_col"))
    found = touched(blocks, year, r0, r1, c0, c1).select("block_row", "block_col", "cells")
    return asked.join(found, ["block_row", "block_col"], "left").mapInArrow(cut, "row int, col int, class int")


def code_at(cells: Column, row: Column, col: Column) -> Column:
    """Code of one cell of a block's binary."""
    at = F.pmod(row, F.lit(SIDE)) * SIDE + F.pmod(col, F.lit(SIDE))
    return F.conv(F.hex(F.substring(cells, at + 1, F.lit(1))), 16, 10).cast("int")


def sample_blocks(points: DataFrame, blocks: DataFrame, west: float, north: float, size: float, lon: str = "lon", lat: str = "lat") -> DataFrame:
    """Class at each point's cell (by floor) in the points' ``year``, 0 outside; adds row, col
    and class.  Points meet their block by an equi-join, whose skewed keys Spark splits."""
    row, col = affine_cell(F.col(lon), F.col(lat), west, north, size)
    placed = points.withColumn("row", row).withColumn("col", col)
    keyed = placed.withColumns({"block_row": block_of(F.col("row")), "block_col": block_of(F.col("col"))})
    joined = keyed.join(blocks.select(*KEY, "cells"), KEY, "left")
    return joined.withColumn("class", F.coalesce(code_at(F.col("cells"), F.col("row"), F.col("col")), F.lit(0))).drop("block_row", "block_col", "cells")
