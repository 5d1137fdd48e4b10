"""Helpers of the training-data operators: staged tables, text buffers, word hashes.

Text columns reach Python as Arrow; the UTF-8 bytes of a whole batch are then
one numpy array, and words, shingles and n-grams are found with array
arithmetic instead of Python strings.  A batch is worked through in slices of
bounded size (``byte_slices``), so memory does not depend on the partition.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

SLICE_BYTES, SLICE_ROWS = 1 << 20, 4096

# Arrow's own allocator keeps what it frees; Python workers live long and share
# an executor's memory with its heap.
pa.set_memory_pool(pa.system_memory_pool())


def shared_dir(spark: SparkSession) -> str:
    """Folder that driver and executors share: ``spark.checkpoint.dir``.

    Only where it is unset, and only in plain local mode, a temporary folder
    is made; on a cluster that would be a folder nobody else can read.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    if not base:
        if sc.master.startswith("local-cluster") or not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(tempfile.mkdtemp(prefix="gridflux-"))
        base = sc.getCheckpointDir()
    if base.startswith("/"):
        base = "file://" + base
    elif base.startswith("file:/") and not base.startswith("file://"):
        base = "file://" + base[len("file:"):]
    return base.rstrip("/")


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it again: cuts the lineage,
    survives lost executors, and fixes what later passes must agree on."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/gridflux/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quoted(columns: list[str]) -> list[str]:
    return [f"`{c}`" for c in columns]


def tucked(docs: DataFrame, needed: list[str]) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``docs`` with all but the needed columns under numbered names, so that no
    name of theirs can clash with a working column; and the way back."""
    names = {c: c if c in needed else f"_c{i}" for i, c in enumerate(docs.columns)}
    inner = docs.select(*(docs[q].alias(names[c]) for c, q in zip(docs.columns, quoted(docs.columns), strict=True)))
    return inner, lambda out: out.select(*(out[names[c]].alias(c) for c in docs.columns))


def text_buffers(col: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, bounds): row i's UTF-8 is bytes[bounds[i]:bounds[i+1]]; null is empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks() if col.num_chunks != 1 else col.chunk(0)
    if col.null_count:
        col = pc.fill_null(col, b"" if pa.types.is_binary(col.type) or pa.types.is_large_binary(col.type) else "")
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    _, offsets, data = col.buffers()
    if len(col) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(col) + 1, np.int64)
    bounds = np.frombuffer(offsets, np.int64 if wide else np.int32)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), bounds


def byte_slices(bounds: np.ndarray, limit: int = SLICE_BYTES, rows: int = SLICE_ROWS) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes and ``rows`` rows each, but of one row at least."""
    i, n = 0, len(bounds) - 1
    while i < n:
        j = int(np.searchsorted(bounds, bounds[i] + limit, side="right")) - 1
        j = min(max(j, i + 1), i + rows, n)
        yield i, j
        i = j


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True

_M1, _M2, _GOLD = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)


def mix64(x: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser on an array of unsigned 64-bit integers."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= _M1
    x ^= x >> np.uint64(27)
    x *= _M2
    x ^= x >> np.uint64(31)
    return x


_CODE = mix64(np.arange(1, 257, dtype=np.uint64) * _GOLD)
_CODE[65:91] = _CODE[97:123]
_BASE = 0x5851F42D4C957F2D
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of an odd base and of its inverse modulo 2**64."""
    if len(_powers[0]) < n:
        size = max(n, 2 * SLICE_BYTES)
        for k, b in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, np.uint64(b), np.uint64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps, dtype=np.uint64)
    return _powers[0][:n], _powers[1][:n]


@dataclass
class Words:
    """Words of consecutive rows: ``hash[first[i]:first[i+1]]`` are row i's; ``prefix``
    is the hash of the first bytes of longer words, else 0, where asked for."""

    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray
    prefix: np.ndarray | None = None


def find_words(data: np.ndarray, bounds: np.ndarray, prefix: int = 0) -> Words:
    """Words ``[^\\x20\\x09-\\x0D]+`` of rows, A-Z lower-cased, with 64-bit hashes."""
    lo = int(bounds[0])
    buf = data[lo : int(bounds[-1])]
    rel = bounds - lo
    n = len(buf)
    if n == 0:
        none = np.zeros(0, np.int64)
        return Words(none, none, none.astype(np.uint64), np.zeros(len(bounds), np.int64), none.astype(np.uint64) if prefix else None)
    inside = np.zeros(n + 2, bool)
    inside[1:-1] = ~SPACE[buf]
    edge = np.zeros(n + 1, bool)
    edge[rel] = True
    here = inside[1:]
    before = inside[:-1]
    start = np.flatnonzero((here & (~before | edge))[:n])
    end = np.flatnonzero(before & (~here | edge))
    up, down = _power(n)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_CODE[buf] * up, dtype=np.uint64, out=sums[1:])
    h = mix64((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))
    short = None
    if prefix:
        cut = np.minimum(start + prefix, end)
        short = np.where(cut < end, mix64((sums[cut] - sums[start]) * down[start] + np.uint64(prefix)), np.uint64(0))
    return Words(start, end, h, np.searchsorted(start, rel), short)


def shingle_hashes(words: Words, row: int, size: int = 5) -> np.ndarray:
    """Hashes of a row's runs of ``size`` words, repeated ones included; with
    fewer words, of the whole sequence as one; without words, none."""
    h = words.hash[words.first[row] : words.first[row + 1]]
    if len(h) == 0:
        return h
    k = min(size, len(h))
    out = np.zeros(len(h) - k + 1, np.uint64)
    for i in range(k):
        out *= np.uint64(_BASE)
        out += h[i : len(h) - k + 1 + i]
    return mix64(out + np.uint64(k))


def as_binary(arr: np.ndarray) -> bytes:
    return np.ascontiguousarray(arr).tobytes()
