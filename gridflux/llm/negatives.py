"""Hard-negative mining: integer scores by Strassen products, and heaps that merge.

Rows that take part are packed into blocks where they lie and staged; the anchors
among them are dealt into blocks of their own by a hash.  A cell is one anchor block
and a few blocks of rows: its scores are computed tile by tile with Strassen's
recursion on int64 matrices (odd sizes padded with zeros, additions exact, leaf
products in doubles where every partial sum is below 2**53, else in int64), and only
heaps leave it.  The first pass keeps the best rows of an anchor's label, the second
one for each positive the best rows of other labels within the window of its score.
A heap is an ordered list of at most k (score, id); heaps of cells merge by ranking
their union, which Spark limits before it shuffles.  No row of all pairs exists, and
an anchor block meets each block of rows once a pass.

Of rows that agree in score and id for an anchor one counts, so repeated rows don't
fill a heap.

Defined cases: rows with a null id, label or vector, or with a null or non-finite
entry take no part, nor do rows whose squared integer norm is 2**62 or more (their
scores might not fit a long); shorter vectors are padded with zeros; an anchor without
positives, or a positive of negative score, has no rows (its window is empty); ties
go to the smaller id; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridflux.llm.common import stage, table
from gridflux.llm.vectors import fixed_points

SCALE = 256.0
ANCHORS, ROWS, CELL = 1024, 8192, 4  # anchors of a block, rows of a block, blocks of a cell
TILE, LEAF = 256, 16
NONE = np.iinfo(np.int64).max
BLOCKS = "block long, n int, anchors int, ids binary, labels binary, vectors binary"


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """``a @ b`` of int64 matrices, exact modulo 2**64, by seven half-sized products
    as long as all sizes are at least twice ``leaf``."""
    (m, k), n = a.shape, b.shape[1]
    if min(m, k, n) < 2 * leaf:
        most = float(max(np.abs(a).max(initial=0), 1)) * float(max(np.abs(b).max(initial=0), 1)) * max(k, 1)
        if most < 2.0**53:
            return (a.astype(np.float64) @ b.astype(np.float64)).astype(np.int64)
        return a @ b
    pad = lambda x: np.pad(x, [(0, s % 2) for s in x.shape]) if any(s % 2 for s in x.shape) else x
    a, b = pad(a), pad(b)
    h, i, j = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:h, :i], a[:h, i:], a[h:, :i], a[h:, i:]
    b11, b12, b21, b22 = b[:i, :j], b[:i, j:], b[i:, :j], b[i:, j:]
    both = strassen(a11 + a22, b11 + b22, leaf)
    left = strassen(a21 + a22, b11, leaf)
    upper = strassen(a11, b12 - b22, leaf)
    lower = strassen(a22, b21 - b11, leaf)
    right = strassen(a11 + a12, b22, leaf)
    out = np.empty((2 * h, 2 * j), np.int64)
    out[:h, :j] = both + lower - right + strassen(a12 - a22, b21 + b22, leaf)
    out[:h, j:] = upper + right
    out[h:, :j] = left + lower
    out[h:, j:] = both - left + upper + strassen(a21 - a11, b11 + b12, leaf)
    return out[:m, :n]


def narrow(x: np.ndarray) -> np.ndarray:
    """The same integers in the least of the widths 16, 32 and 64."""
    most = int(np.abs(x).max(initial=0))
    return x.astype(np.int16 if most < 1 << 15 else np.int32 if most < 1 << 31 else np.int64)


def blob(x: np.ndarray) -> bytes:
    return bytes([x.itemsize]) + np.ascontiguousarray(x).tobytes()


def unblob(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, f"i{raw[0]}", offset=1).astype(np.int64)


def block_row(number: int, ids: np.ndarray, labels: np.ndarray, x: np.ndarray, every: int) -> pa.RecordBatch:
    order = np.argsort(ids, kind="stable")
    ids, labels, x = ids[order], labels[order], x[order]
    values = [pa.array([number], pa.int64()), pa.array([len(ids)], pa.int32()), pa.array([int((ids % every == 0).sum())], pa.int32())]
    return pa.RecordBatch.from_arrays([*values, *(pa.array([blob(narrow(v))], pa.binary()) for v in (ids, labels, x.ravel()))], names=["block", "n", "anchors", "ids", "labels", "vectors"])


def unblock(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids, labels = unblob(row["ids"]), unblob(row["labels"])
    return ids, labels, unblob(row["vectors"]).reshape(len(ids), -1)


def pack_rows(vectors: DataFrame, every: int) -> DataFrame:
    """Rows (vec_id, label, embedding) that take part as blocks in order of ids; staged.
    Rows that are wholly alike are one within a block."""
    dims = vectors.agg(F.max(F.size("embedding"))).first()[0]
    dims = max(int(dims or 0), 1)
    most = max(1, min(ROWS, (64 << 20) // (8 * dims)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, size = TaskContext.get().partitionId() << 32, [], 0

        def cut(some: list) -> tuple[np.ndarray, ...]:
            parts = tuple(np.concatenate(x) for x in zip(*some, strict=True))
            _, first = np.unique(np.column_stack((parts[0], parts[1], parts[2])), axis=0, return_index=True)
            return tuple(x[first] for x in parts)

        for batch in batches:
            named = batch.filter(pa.compute.and_(batch.column(0).is_valid(), batch.column(1).is_valid()))
            rows, x = fixed_points(named.column(2), SCALE, dims, 2.0**31)
            ids, labels = (named.column(k).to_numpy(zero_copy_only=False)[rows].astype(np.int64) for k in (0, 1))
            fits = (x.astype(np.float64) ** 2).sum(axis=1) < 2.0**62
            ids, labels, x = ids[fits], labels[fits], x[fits]
            for i in range(0, len(ids), most):
                held.append((ids[i : i + most], labels[i : i + most], x[i : i + most]))
                size += len(held[-1][0])
                if size >= most:
                    yield block_row(number, *cut(held), every)
                    number, held, size = number + 1, [], 0
        if size:
            yield block_row(number, *cut(held), every)

    return stage(vectors.select("vec_id", "label", "embedding").mapInArrow(run, BLOCKS), "negatives-rows")


def pack_anchors(blocks: DataFrame, every: int) -> tuple[DataFrame, int]:
    """Blocks of distinct anchors by a hash of the row, and their number; staged."""
    total = blocks.agg(F.sum("anchors")).first()[0] or 0
    count = max(1, -(-total // ANCHORS))

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids, labels, x = unblock(row)
                at = np.flatnonzero(ids % every == 0)
                vectors = pa.array([x[k].tobytes() for k in at], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(ids[at]), pa.array(labels[at]), vectors], names=["id", "label", "vector"])

    def gather(group: pa.Table) -> pa.Table:
        ids, labels = (group.column(k).to_numpy().astype(np.int64) for k in ("id", "label"))
        x = np.frombuffer(b"".join(group.column("vector").to_pylist()), np.int64).reshape(len(ids), -1)
        return pa.Table.from_batches([block_row(group.column("a")[0].as_py(), ids, labels, x, every)])

    rows = blocks.where("anchors > 0").mapInArrow(pick, "id long, label long, vector binary").distinct()
    rows = rows.withColumn("a", F.pmod(F.xxhash64("id", "label", "vector"), F.lit(count)))
    return stage(rows.groupBy("a").applyInArrow(gather, BLOCKS), "negatives-anchors"), count


def best(score: np.ndarray, ids: np.ndarray, allowed: np.ndarray, k: int, sort: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(score, id) of the first k allowed columns of each row, higher scores first, then
    smaller ids; unused places have id NONE.  ``ids`` ascend.  With ``sort`` all columns
    are ordered and k is ignored."""
    n = len(ids)
    spread = int(score.max(initial=0)) - int(score.min(initial=0)) + 2
    unique = bool((np.diff(ids) > 0).all())
    if unique and spread * (n + 1) < 1 << 62:
        key = (int(score.max(initial=0)) - score) * n + np.arange(n)
        key[~allowed] = NONE
        if not sort and k < n:
            key = np.partition(key, k - 1, axis=1)[:, :k]
        key.sort(axis=1)
        used = key != NONE
        return np.where(used, int(score.max(initial=0)) - key // n, 0), np.where(used, ids[np.where(used, key % n, 0)], NONE)
    # Ids come again, or scores spread too far for one key.
    top_score, top_id = np.zeros((len(score), n), np.int64), np.full((len(score), n), NONE)
    for r in range(len(score)):
        at = np.flatnonzero(allowed[r])
        at = at[np.lexsort((ids[at], -score[r, at]))]
        fresh = np.ones(len(at), bool)
        fresh[1:] = (score[r, at][1:] != score[r, at][:-1]) | (ids[at][1:] != ids[at][:-1])
        at = at[fresh]
        top_score[r, : len(at)], top_id[r, : len(at)] = score[r, at], ids[at]
    return (top_score, top_id) if sort else (top_score[:, :k], top_id[:, :k])


def tiles(anchors: np.ndarray, rows: np.ndarray) -> Iterator[tuple[slice, np.ndarray]]:
    """Scores of anchors against rows, by slices of anchors."""
    right = np.ascontiguousarray(rows.T)
    for i in range(0, len(anchors), TILE):
        yield slice(i, min(i + TILE, len(anchors))), strassen(anchors[i : i + TILE], right)


def cells(anchors: DataFrame, count: int, blocks: DataFrame, groups: int, run, schema: str) -> DataFrame:
    """``run(anchor block row, row blocks)`` for each anchor block and group of row blocks."""
    left = anchors.withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    deal = F.pmod(F.xxhash64("block"), F.lit(groups)).cast("int")
    right = blocks.withColumn("g", deal).withColumn("a", F.explode(F.sequence(F.lit(0), F.lit(count - 1)).cast("array<long>")))
    left = left.withColumn("a", F.col("block"))

    def cell(own: pa.Table, other: pa.Table) -> pa.Table:
        got = [run(row, other) for row in own.to_pylist()] if other.num_rows else []
        return pa.concat_tables(got) if got else pa.schema(target).empty_table()

    target = [pa.field(n, {"long": pa.int64(), "int": pa.int32()}[k]) for n, k in (x.split() for x in schema.split(", "))]
    return left.groupBy("a", "g").cogroup(right.groupBy("a", "g")).applyInArrow(cell, schema)


def merged(rows: DataFrame, key: list[str], k: int, rank: Column | None = None) -> DataFrame:
    """Heaps of all cells as one: the first k distinct (score, id) of each key, with ``rank``."""
    order = Window.partitionBy(*key).orderBy(F.desc("score"), "id")
    return rows.withColumn("rank", F.dense_rank().over(order)).where(F.col("rank") <= k).dropDuplicates([*key, "rank"])


def mine(vectors: DataFrame, every: int = 50, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95) -> DataFrame:
    """Hard negatives of ``vectors`` (vec_id, label, embedding).

    Anchors are the rows whose id ``every`` divides; a negative scores between ``low``
    and ``high`` per cent of its positive.  Returns anchor_id, anchor (the anchor row's
    number), positive_id, positive_score, negative_id, negative_score and rank.
    """
    blocks = pack_rows(vectors, every)
    anchors, count = pack_anchors(blocks, every)
    groups = max(1, -(-blocks.count() // CELL))

    def near(row: dict, other: pa.Table) -> pa.Table:
        ids, labels, x = unblock(row)
        out = []
        for block in other.to_pylist():
            row_ids, row_labels, rows = unblock(block)
            for part, score in tiles(x, rows):
                allowed = (labels[part, None] == row_labels) & (ids[part, None] != row_ids)
                s, i = best(score, row_ids, allowed, positives)
                at, slot = np.nonzero(i != NONE)
                out.append((at + part.start, s[at, slot], i[at, slot]))
        at, s, i = (np.concatenate(v) for v in zip(*out, strict=True))
        return pa.table({"a": pa.array(np.full(len(at), row["block"])), "at": pa.array(at), "score": pa.array(s), "id": pa.array(i)})

    found = merged(cells(anchors, count, blocks, groups, near, "a long, at long, score long, id long"), ["a", "at"], positives)

    def lined(group: pa.Table) -> pa.Table:
        """Positives of an anchor block as one row."""
        cols = [blob(narrow(group.column(k).to_numpy().astype(np.int64))) for k in ("at", "rank", "score", "id")]
        return pa.table({"block": group.column("a")[:1], **{k: pa.array([v], pa.binary()) for k, v in zip(("p_at", "p_rank", "p_score", "p_id"), cols, strict=True)}})

    lines = found.select("a", "at", "rank", "score", "id").groupBy("a").applyInArrow(lined, "block long, p_at binary, p_rank binary, p_score binary, p_id binary")
    armed = stage(anchors.join(lines, "block"), "negatives-positives")

    def window(row: dict, other: pa.Table) -> pa.Table:
        ids, labels, x = unblock(row)
        at, rank, score, positive = (unblob(row[k]) for k in ("p_at", "p_rank", "p_score", "p_id"))
        # low p <= 100 s <= high p in whole numbers, without products that overflow.
        floor = lambda v, share: v // 100 * share + v % 100 * share // 100
        least, most = -floor(-score, low), floor(score, high)
        some = np.flatnonzero(least <= most)
        some = some[np.argsort(at[some], kind="stable")]
        out = [(np.zeros(0, np.int64),) * 3]
        for block in other.to_pylist():
            row_ids, row_labels, rows = unblock(block)
            for part, products in tiles(x, rows):
                own = some[np.searchsorted(at[some], part.start) : np.searchsorted(at[some], part.stop)]
                if not len(own):
                    continue
                s, i = best(products, row_ids, labels[part, None] != row_labels, 0, sort=True)
                used = (i != NONE).sum(axis=1)
                for p in own:
                    k = at[p] - part.start
                    line = s[k, : used[k]]
                    begin = used[k] - np.searchsorted(line[::-1], most[p], side="right")
                    take = np.arange(begin, min(begin + negatives, used[k]))
                    take = take[line[take] >= least[p]]
                    out.append((np.full(len(take), p), line[take], i[k, take]))
        p, s, i = (np.concatenate(v) for v in zip(*out, strict=True))
        columns = (np.full(len(p), row["block"]), at[p], ids[at[p]], rank[p], positive[p], score[p], s, i)
        return pa.table({n: pa.array(v.astype(np.int64)) for n, v in zip(("a", "at", "anchor_id", "positive_rank", "positive_id", "positive_score", "score", "id"), columns, strict=True)})

    kind = "a long, at long, anchor_id long, positive_rank long, positive_id long, positive_score long, score long, id long"
    hard = merged(cells(armed, count, blocks, groups, window, kind), ["a", "at", "positive_rank"], negatives)
    return hard.select("anchor_id", ((F.col("a") * ANCHORS * 1024) + F.col("at")).alias("anchor"), "positive_id", "positive_score", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"), "rank")


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    mined = mine(rows.select("vec_id", label.alias("label"), "embedding"))
    return mined.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
