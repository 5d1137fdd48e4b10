"""N-gram Jaccard join: rare-first prefixes, filters, and links verified once.

A document is its set of distinct five-word shingles.  Equal sets are one class
from the first pass on, so copies are never compared.  The order of shingles is
rare first, by a counting sketch of fixed size over all documents (any total
order gives right results; a rare one gives short lists).  The prefix of a set
of n shingles, n - ceil(t n) + 1 of them, is dealt by hash range; sets whose
Jaccard similarity reaches t share a shingle of their prefixes.  Postings of
shingles that the sketch counts as hot are dealt by their class instead and stay
plain rows, which Spark aggregates and joins with skewed keys split.

A list of one shingle's sets isn't expanded into all pairs.  First each set is
paired with the hub of the list alone, its first class (linear in the lists; the
lists of near copies hence mostly have the same hub); verified links give
components.  Lists that still hold sets of different components then take some
hubs of their own, by a hash of list and class, which joins the rest of large
groups in linear work.  What is mixed after that is expanded, by bands of fitting
lengths, across components alone.  No pair is tried twice.  All
pairs pass the length filter and the positional filter, which counts as missed a
set's shingles before the first common one; distinct pairs then pass a parity
filter (sets that differ in d shingles have bitmaps of parities that differ in d
bits at most) before shingle sets are fetched, and are verified once, behind a
suffix filter.  Two sets with a link are hence in one component at the end: they
share a list, and in it either had one component or were compared.

Defined cases: null and empty texts have no shingles and link with nothing;
texts of fewer than five words are one shingle; repeated rows are in one class;
rows with a null id take part but don't name a component; rows of one id with
different texts are documents of their own; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridflux.llm.common import byte_slices, find_words, mix64, shingle_hashes, stage, table, text_buffers
from gridflux.llm.components import components

SIZE, PERCENT = 5, 75
CELL_BITS = 21
LOW56 = np.uint64((1 << 56) - 1)
PER_BUCKET = 400_000
BROADCAST_ROWS = 500_000
FIRST = "doc_id long, n int, class long, parity binary, slice int, task int, cells binary"
POSTING = "list long, class long, n int, cost int"
#: Classes that a task remembers, so that copies near each other are dealt once.
MOST_SEEN = 1 << 18
#: Blobs of a sketch slice that one group adds up.
FAN_IN = 256
#: Rounds in which each list has so many hubs of its own before lists are expanded.
HUB_ROUNDS, HUBS = 1, 16


def _distinct(hashes: np.ndarray) -> np.ndarray:
    return np.unique(hashes & LOW56)


def _class(distinct: np.ndarray) -> int:
    """64-bit name of a set, signed."""
    total = mix64(distinct + np.uint64(0x5BD1E995)).sum(dtype=np.uint64) + np.uint64(len(distinct))
    return int(mix64(np.array([total], np.uint64)).view(np.int64)[0])


def _sets(data: np.ndarray, bounds: np.ndarray, size: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, distinct shingle hashes in order) of all rows."""
    for i, j in byte_slices(bounds):
        words = find_words(data, bounds[i : j + 1])
        for r in range(j - i):
            yield i + r, _distinct(shingle_hashes(words, r, size))


def parity(distinct: np.ndarray) -> bytes:
    """Bitmap of at least as many bits as shingles: for each cell of the hashes' low
    bits whether an odd number of shingles falls into it."""
    bits = 1 << max(6, int(len(distinct) - 1).bit_length())
    odd = np.bincount((distinct & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(bool), bitorder="little").tobytes()


def least_difference(x: bytes, y: bytes) -> int:
    """A lower bound on the shingles that only one of two sets has.  The halves of
    the longer bitmap, added, are the parities of the shorter one's cells."""
    a, b = (int.from_bytes(z, "little") for z in (x, y))
    size = min(len(x), len(y))
    a, b = _folded(a, len(x), size), _folded(b, len(y), size)
    return (a ^ b).bit_count()


def _folded(bits: int, size: int, to: int) -> int:
    while size > to:
        size //= 2
        bits = (bits >> (8 * size)) ^ (bits & ((1 << (8 * size)) - 1))
    return bits


def first_pass(docs: DataFrame, size: int) -> DataFrame:
    """A row for each document (doc_id, n, class, parity), and counts of sketch cells."""
    slice_bits = CELL_BITS - 16

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(1 << CELL_BITS, np.int64)
        pending: list[np.ndarray] = []
        held = 0

        def add() -> None:
            nonlocal held
            if pending:
                np.add(cells, np.bincount(np.concatenate(pending), minlength=len(cells)), out=cells)
                pending.clear()
                held = 0

        names = [x.split()[0] for x in FIRST.split(", ")]
        for batch in batches:
            data, bounds = text_buffers(batch.column(1))
            n, names_of, bitmaps = np.zeros(batch.num_rows, np.int32), np.zeros(batch.num_rows, np.int64), [b""] * batch.num_rows
            for row, s in _sets(data, bounds, size):
                if len(s):
                    n[row], names_of[row], bitmaps[row] = len(s), _class(s), parity(s)
                pending.append((s >> np.uint64(56 - CELL_BITS)).astype(np.int32))
                held += len(s)
                if held > 1 << 21:
                    add()
            empty = [pa.nulls(batch.num_rows, t) for t in (pa.int32(), pa.int32(), pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n), pa.array(names_of), pa.array(bitmaps, pa.binary()), *empty], names=names)
        add()
        slices, blobs = [], []
        for k in range(1 << slice_bits):
            part = cells[k << 16 : (k + 1) << 16]
            if part.any():
                slices.append(k)
                blobs.append(_sparse(part))
        none = [pa.nulls(len(slices), t) for t in (pa.int64(), pa.int32(), pa.int64(), pa.binary())]
        task = pa.array([TaskContext.get().partitionId()] * len(slices), pa.int32())
        yield pa.RecordBatch.from_arrays([*none, pa.array(slices, pa.int32()), task, pa.array(blobs, pa.binary())], names=names)

    return stage(docs.select("doc_id", "text").mapInArrow(run, FIRST), "jaccard-sets")


def _sparse(counts: np.ndarray) -> bytes:
    """Cells that aren't 0 and their counts (below 2**32: enough for an order)."""
    at = np.flatnonzero(counts)
    return at.astype(np.uint16).tobytes() + np.minimum(counts[at], (1 << 32) - 1).astype(np.uint32).tobytes()


def _total(blobs: pa.ChunkedArray) -> np.ndarray:
    total = np.zeros(1 << 16, np.int64)
    for blob in blobs:
        raw = blob.as_py()
        n = len(raw) // 6
        total[np.frombuffer(raw, np.uint16, n)] += np.frombuffer(raw, np.uint32, n, 2 * n)
    return total


def rarity(first: DataFrame) -> np.ndarray:
    """Level (0 rare to 255 frequent) of each sketch cell: of fixed size, 2 MB.  Tasks'
    counts are added up FAN_IN at a time, whatever their number."""
    parts = first.where("cells IS NOT NULL").select("slice", "task", "cells")

    def add(group: pa.Table) -> pa.Table:
        return pa.table({
            "slice": group.column("slice").slice(0, 1), "task": group.column("task").slice(0, 1),
            "cells": pa.array([_sparse(_total(group.column("cells")))], pa.binary()),
        })

    def level(group: pa.Table) -> pa.Table:
        counts = np.minimum(255, np.round(8 * np.log2(_total(group.column("cells")) + 1))).astype(np.uint8)
        return pa.table({"slice": group.column("slice").slice(0, 1), "level": pa.array([counts.tobytes()], pa.binary())})

    tasks = (parts.agg(F.max("task")).first()[0] or 0) + 1
    while tasks > FAN_IN:
        parts = parts.withColumn("task", F.floor(F.col("task") / FAN_IN).cast("int"))
        parts = parts.groupBy("slice", "task").applyInArrow(add, "slice int, task int, cells binary")
        tasks = -(-tasks // FAN_IN)
    out = np.zeros(1 << CELL_BITS, np.uint8)
    for r in parts.select("slice", "task", "cells").groupBy("slice").applyInArrow(level, "slice int, level binary").collect():
        out[r["slice"] << 16 : (r["slice"] + 1) << 16] = np.frombuffer(r["level"], np.uint8)
    return out


def _code(n: np.ndarray) -> np.ndarray:
    """Counts in 16 bits: exact below 2**15, beyond that within 0.03 %."""
    n = n.astype(np.float64)
    far = 32768 + np.floor(np.log(np.maximum(n, 32768) / 32768) * 4096)
    return np.where(n < 32768, n, np.minimum(far, 65535)).astype(np.uint16)


def _decode(code: np.ndarray) -> np.ndarray:
    far = 32768 * np.exp((code.astype(np.float64) - 32768) / 4096)
    return np.where(code < 32768, code, np.minimum(far, 2**31 - 1)).astype(np.int32)


def prefix_postings(docs: DataFrame, levels: np.ndarray, buckets: int, size: int, percent: int, hot: int) -> DataFrame:
    """(list, class, n, cost) of sets that share the shingle with another set within
    the length filter.  ``cost`` counts the set's shingles before this one.  Postings
    of cells with ``hot`` documents and more are dealt by class, not by list."""
    shared = docs.sparkSession.sparkContext.broadcast(levels)
    hot_level = min(255, int(8 * np.log2(hot + 1)))

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        parts: list[tuple[np.ndarray, ...]] = []
        held = 0

        def flush() -> pa.RecordBatch:
            h, c, n, cost = (np.concatenate(x) for x in zip(*parts, strict=True))
            which = (((h >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(24)).astype(np.int64)
            often = shared.value[h >> np.uint64(56 - CELL_BITS)] >= hot_level
            group = np.where(often, buckets + mix64(c.view(np.uint64)).astype(np.int64) % buckets, which)
            group[group < 0] += buckets  # a negative remainder
            order = np.argsort(group, kind="stable")
            h, c, n, cost, group = ((which[order] << 32) | (h[order].astype(np.int64) & 0xFFFFFFFF)), c[order], n[order], cost[order], group[order]
            heads = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
            cuts = np.append(heads, len(group))
            blobs = [_joined(group[a] >= buckets, h[a:b], c[a:b], n[a:b], cost[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
            return pa.RecordBatch.from_arrays([pa.array(group[heads].astype(np.int32)), pa.array(blobs, pa.binary())], names=["bucket", "blob"])

        for batch in batches:
            data, bounds = text_buffers(batch.column(0))
            for _, s in _sets(data, bounds, size):
                if not len(s):
                    continue
                name = _class(s)
                if name in seen:
                    continue
                if len(seen) >= MOST_SEEN:  # ``lists`` drops what comes again after this
                    seen.clear()
                seen.add(name)
                n = len(s)
                take = n - -(-percent * n // 100) + 1
                order = np.sort((shared.value[s >> np.uint64(56 - CELL_BITS)].astype(np.uint64) << np.uint64(56)) | s)[:take] if n > 1 else s
                # The level may cut ties of its own hash bits: the full hash is in the low 56.
                parts.append((order & LOW56, np.full(take, name, np.int64), _code(np.full(take, n)), _code(np.arange(take))))
                held += take
                if held > 1 << 20:
                    yield flush()
                    parts.clear()
                    held = 0
        if parts:
            yield flush()

    def lists(group: pa.Table) -> pa.Table:
        bucket = group.column("bucket")[0].as_py() if group.num_rows else 0
        salted = bucket >= buckets
        parts = ([], [], [], [])
        for blob in group.column("blob"):
            raw = blob.as_py()
            wide = 8 if salted else 4
            m = len(raw) // (wide + 12)
            for out, (kind, at) in zip(parts, ((np.int64 if salted else np.uint32, 0), (np.int64, wide * m), (np.uint16, (wide + 8) * m), (np.uint16, (wide + 10) * m)), strict=True):
                out.append(np.frombuffer(raw, kind, m, at))
        h, c, n, cost = (np.concatenate(x) for x in parts)
        if not salted:
            order = np.argsort(h, kind="stable")
            keep = order[_runs(h[order])]  # lists of one row are most of all: drop them before sorting the rest
            h, c, n, cost = h[keep], c[keep], n[keep], cost[keep]
        n, cost = _decode(n), _decode(cost)
        order = np.lexsort((c, n, h))
        h, c, n, cost = h[order], c[order], n[order], cost[order]
        fresh = np.ones(len(h), bool)
        fresh[1:] = (h[1:] != h[:-1]) | (c[1:] != c[:-1])
        h, c, n, cost = h[fresh], c[fresh], n[fresh], cost[fresh]
        if not salted:
            near = _neighbours(h, n, percent)
            h, c, n, cost = h[near], c[near], n[near], cost[near]
            h = (np.int64(bucket) << 32) | h.astype(np.int64)
        return pa.table({"list": pa.array(h), "class": pa.array(c), "n": pa.array(n), "cost": pa.array(cost)})

    rows = docs.select("text").mapInArrow(emit, "bucket int, blob binary")
    return rows.groupBy("bucket").applyInArrow(lists, POSTING)


def _joined(wide: bool, h: np.ndarray, *rest: np.ndarray) -> bytes:
    return (h if wide else h.astype(np.uint32)).tobytes() + b"".join(x.tobytes() for x in rest)


def _runs(ordered: np.ndarray) -> np.ndarray:
    """Which places of an ordered array hold a value that occurs more than once."""
    same = np.zeros(len(ordered) + 1, bool)
    same[1:-1] = ordered[1:] == ordered[:-1]
    return same[1:] | same[:-1]


def _neighbours(lists: np.ndarray, n: np.ndarray, percent: int) -> np.ndarray:
    """Which rows, ordered by list and n, have another within the length filter."""
    pair = (lists[1:] == lists[:-1]) & (n[:-1] >= np.floor(n[1:] * (percent / 100) * 0.999))
    ok = np.zeros(len(lists) + 1, bool)
    ok[1:-1] = pair
    return ok[1:] | ok[:-1]


def most_overlap(x: np.ndarray, y: np.ndarray, depth: int = 3) -> int:
    """Suffix filter: a bound on the overlap of two ordered sets from splits at
    the middle of the first."""
    if depth == 0 or not len(x) or not len(y):
        return min(len(x), len(y))
    k = len(x) // 2
    at = int(np.searchsorted(y, x[k]))
    return most_overlap(x[:k], y[:at], depth - 1) + most_overlap(x[k:], y[at:], depth - 1)


def linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    need = -(-percent * (len(x) + len(y)) // (100 + percent))
    if most_overlap(x, y) < need:
        return False
    at = np.minimum(np.searchsorted(y, x), len(y) - 1)
    both = int((y[at] == x).sum())
    return 100 * both >= percent * (len(x) + len(y) - both)


def verify(docs: DataFrame, classes: DataFrame, pairs: DataFrame, size: int, percent: int) -> DataFrame:
    """Links (a, b) among distinct staged ``pairs`` of classes, staged."""

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, an, bn, ap, bp = batch.columns
            both = an.to_numpy().astype(np.int64) + bn.to_numpy()
            most = both - 2 * -(-percent * both // (100 + percent))
            good = [least_difference(x.as_py(), y.as_py()) <= m for x, y, m in zip(ap, bp, most.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([a, b], names=["a", "b"]).filter(pa.array(good, pa.bool_()))

    left, right = (classes.select(F.col("class").alias(k), F.col("n").alias(f"{k}n"), F.col("parity").alias(f"{k}p")) for k in "ab")
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "an", "bn", "ap", "bp")
    pairs = stage(both.mapInArrow(near, "a long, b long"), "jaccard-near")
    needed = pairs.select(F.col("a").alias("class")).union(pairs.select(F.col("b").alias("class"))).distinct()
    wanted = stage(classes.join(needed, "class", "left_semi").where("rep IS NOT NULL").select(F.col("rep").alias("doc_id")).distinct(), "jaccard-wanted")
    if wanted.count() <= BROADCAST_ROWS:  # 8 bytes a row; beyond that Spark shuffles
        wanted = F.broadcast(wanted)
    rows = docs.select("doc_id", "text")
    rows = rows.join(wanted, "doc_id", "left_semi").union(rows.where("doc_id IS NULL"))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, bounds = text_buffers(batch.column(0))
            for i, j in byte_slices(bounds):
                sets = [s for _, s in _sets(data, bounds[i : j + 1], size) if len(s)]
                yield pa.RecordBatch.from_arrays([pa.array([_class(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())], names=["class", "shingles"])

    sets = rows.select("text").mapInArrow(build, "class long, shingles binary")
    sets = stage(sets.join(needed, "class", "left_semi").dropDuplicates(["class"]), "jaccard-shingles")

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = [linked(np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64), percent) for x, y in zip(batch.column(2), batch.column(3), strict=True)]
            yield batch.select([0, 1]).filter(pa.array(good, pa.bool_()))

    left = sets.select(F.col("class").alias("a"), F.col("shingles").alias("a_shingles"))
    right = sets.select(F.col("class").alias("b"), F.col("shingles").alias("b_shingles"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "a_shingles", "b_shingles")
    return stage(both.mapInArrow(test, "a long, b long"), "jaccard-links")


def passes(x: str, y: str, percent: int) -> Column:
    """Length and positional filters of two sets' postings in a list: if this is the
    first shingle that they share, each misses those before it in its order."""
    t = percent / 100
    xn, yn, xc, yc = (F.col(f"{k}.{c}") for c in ("n", "cost") for k in (x, y))
    slack = F.when(F.greatest(xn, yn) >= 32768, (xn + yn) * 0.001).otherwise(1e-9)
    common = (xn + yn) * (t / (1 + t)) - slack
    return (F.least(xn, yn) + slack >= F.greatest(xn, yn) * t) & (xn - xc >= common) & (yn - yc >= common)


def _pairs(both: DataFrame, x: str, y: str) -> DataFrame:
    """Distinct pairs, the smaller class first."""
    a, b = F.col(f"{x}.class"), F.col(f"{y}.class")
    return both.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct()


ME = ("class", "n", "cost", "component")


def hub_pairs(rows: DataFrame, hubs: int, percent: int) -> DataFrame:
    """Each set of a list with the list's hubs, the first class of each of ``hubs`` hash
    slots, unless both have one component."""
    me = F.struct(*(c for c in ME if c in rows.columns))
    slot = F.pmod(F.xxhash64("class", "list"), F.lit(hubs))
    hubs = rows.groupBy("list", slot.alias("slot")).agg(F.min(me).alias("hub")).drop("slot")
    both = rows.select("list", me.alias("own")).join(hubs, "list")
    apart = F.col("own.component") != F.col("hub.component") if "component" in rows.columns else F.lit(True)
    return _pairs(both.where((F.col("own.class") != F.col("hub.class")) & apart & passes("own", "hub", percent)), "own", "hub")


def mixed_lists(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Postings of lists that hold different components so far; staged."""
    rows = rows.drop("component").join(found, "class", "left").withColumn("component", F.coalesce("component", "class"))
    mixed = rows.groupBy("list").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high").select("list")
    return stage(rows.join(mixed, "list", "left_semi").select("list", *ME), "jaccard-mixed")


def cross_pairs(rows: DataFrame, percent: int) -> DataFrame:
    """Pairs of a list whose sets have different components.  Sets meet only in bands
    of lengths that the length filter can pass."""
    band = F.floor(F.log("n") / float(np.log(100.1 / percent))).cast("int")
    rows = rows.select("list", band.alias("band"), F.struct(*ME).alias("x"))
    theirs = rows.select("list", F.explode(F.array(F.col("band"), F.col("band") + 1)).alias("band"), F.col("x").alias("y"), F.col("band").alias("own"))
    both = rows.join(theirs, ["list", "band"])
    once = (F.col("own") < F.col("band")) | (F.col("x.class") < F.col("y.class"))
    return _pairs(both.where((F.col("x.component") != F.col("y.component")) & once & passes("x", "y", percent)), "x", "y")


def _node() -> Column:
    """A class by its least id, those without one last: the least of a component names it."""
    return F.struct(F.col("rep").isNull().alias("lone"), F.coalesce("rep", F.lit(0)).alias("rep"), "class")


def _labelled(links: DataFrame, classes: DataFrame) -> DataFrame:
    nodes = classes.select("class", _node().alias("node"))
    left, right = (nodes.select(F.col("class").alias(k), F.col("node").alias(f"{k}_node")) for k in "ab")
    return links.join(left, "a").join(right, "b").select(F.col("a_node").alias("a"), F.col("b_node").alias("b"))


def _by_class(found: DataFrame) -> DataFrame:
    return found.select(F.col("node.class").alias("class"), F.col("component.class").alias("component"))


def _named(classes: DataFrame, found: DataFrame) -> DataFrame:
    """(class, component_id, least_class) of all classes."""
    of_class = found.select(F.col("node.class").alias("class"), "component")
    joined = classes.join(of_class, "class", "left").withColumn("component", F.coalesce("component", _node()))
    least = F.when(~F.col("component.lone"), F.col("component.rep"))
    return joined.select("class", least.alias("component_id"), F.col("component.class").alias("least_class"))


def join_similar(docs: DataFrame, size: int = SIZE, percent: int = PERCENT, hot: int = PER_BUCKET) -> DataFrame:
    """(doc_id, n_shingles, class, component_id, least_class) of each document."""
    spark = docs.sparkSession
    first = first_pass(docs, size)
    of_doc = first.where("n IS NOT NULL").select("doc_id", "n", "class")
    one = first.where("n > 0").groupBy("class").agg(F.min("doc_id").alias("rep"), F.max("n").alias("n"), F.any_value("parity").alias("parity"))
    classes = stage(one, "jaccard-classes")
    total = classes.agg(F.sum("n")).first()[0] or 0
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(partitions, total * (101 - percent) // 100 // PER_BUCKET + 1)
    postings = stage(prefix_postings(docs, rarity(first), buckets, size, percent, hot), "jaccard-lists")
    tested = stage(hub_pairs(postings, 1, percent), "jaccard-pairs")
    links = verify(docs, classes, tested, size, percent)
    mixed = postings
    for step in range(HUB_ROUNDS + 1):
        mixed = mixed_lists(mixed, _by_class(components(_labelled(links, classes))))
        if mixed.isEmpty():
            break
        pairs = hub_pairs(mixed, HUBS << step, percent) if step < HUB_ROUNDS else cross_pairs(mixed, percent)
        pairs = stage(pairs.join(tested, ["a", "b"], "left_anti"), "jaccard-pairs")
        links, tested = links.union(verify(docs, classes, pairs, size, percent)), tested.union(pairs)
    named = stage(_named(classes, components(_labelled(links, classes))), "jaccard-components")
    joined = of_doc.join(named, "class", "left")
    alone = F.col("n") == 0
    return joined.select(
        "doc_id", F.col("n").cast("long").alias("n_shingles"), F.when(~alone, F.col("class")).alias("class"),
        F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"), F.when(~alone, F.col("least_class")).alias("least_class"),
    )


def keep_one(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """One document of each component: the one with the least id, of several texts
    with that id the one of the least class (rows that repeat it are that document).
    Texts without words all stay, and of a component without ids one class."""
    inner = docs.withColumnsRenamed({c: f"_c{i}" for i, c in enumerate(docs.columns)})
    at = docs.columns.index("text")
    kinds = [f.dataType.simpleString() for f in docs.schema.fields]

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, bounds = text_buffers(batch.column(at))
            names = np.zeros(batch.num_rows, np.int64)
            for row, s in _sets(data, bounds, size):
                names[row] = _class(s) if len(s) else 0
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(names)], names=[*batch.schema.names, "_class"])

    grouped = join_similar(docs, size).where("n_shingles > 0")
    gone = grouped.where("class <> least_class OR NOT (doc_id <=> component_id)")
    gone = stage(gone.select("doc_id", "class").distinct(), "jaccard-gone")
    if gone.count() <= BROADCAST_ROWS:  # 16 bytes a row
        gone = F.broadcast(gone)
    named = inner.mapInArrow(name, ", ".join(f"_c{i} {k}" for i, k in enumerate(kinds)) + ", _class long")
    lost = F.col(f"_c{docs.columns.index('doc_id')}").eqNullSafe(F.col("doc_id")) & (F.col("_class") == F.col("class"))
    kept = named.join(gone, lost, "left_anti").drop("_class")
    return kept.select(*(F.col(f"_c{i}").alias(c) for i, c in enumerate(docs.columns)))


def op8_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join_similar(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")
