"""Best-fit packing of documents into sequences by bin completion.

Documents are cut into pieces of at most ``capacity`` tokens.  Packing needs
only how many pieces have each length, so the branch and bound runs on a
histogram of at most ``capacity`` numbers, whatever the number of documents.  A
node takes the largest length left and enumerates the undominated fillings of
the rest of its sequence (a bounded subset-sum table over the lengths left leads
to those with the least waste first) and how often to apply one.  Best-fit
decreasing gives the first incumbent; a branch is cut where its waste exceeds
what a plan with one sequence less than the incumbent may waste.  The search
backtracks with a growing number of choices that aren't the first (limited
discrepancies), until it meets the lower bound, has tried all branches, or has
done ``work`` steps.  The result, a list of (filling, times), is turned into
places: pieces of one length are numbered over the cluster (rank inside small
(length, bucket) groups plus group offsets), and a number says which filling,
which copy and which offset.

Defined cases: a null or empty text is the single id 0; a special string in a
text is its special id, as in the ``tokenizers`` library; repeated rows are
packed as often as they come; ties are dealt by (doc_id, piece); an empty table
gives an empty table; columns beyond the id and the text are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gridflux.llm.common import stage
from gridflux.llm.tokens import encoder, read_vocabulary

CAPACITY, NODE = 2048, 400
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces; the first one takes the remainder."""
    k = -(-n // capacity)
    first = n - capacity * (k - 1)
    return [(0, first)] + [(first + i * capacity, capacity) for i in range(k - 1)]


def tokenize_pieces(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str | None = None) -> DataFrame:
    blob = docs.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(blob.value)
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                docs_, piece, start, length, crc = [], [], [], [], []
                for doc, text in zip(part.column(0).to_pylist(), part.column(1), strict=True):
                    ids = np.concatenate((enc.ids(text.as_py() or ""), np.zeros(1, np.uint32))).astype("<u4")
                    for k, (s, n) in enumerate(cut(len(ids), capacity)):
                        docs_.append(doc)
                        piece.append(k)
                        start.append(s)
                        length.append(n)
                        crc.append(zlib.crc32(ids[s : s + n].tobytes()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(docs_, pa.int64()), pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc))],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"],
                )

    return docs.select("doc_id", "text").mapInArrow(run, PIECES)


def _take(counts: np.ndarray, filling: tuple[int, ...]) -> int:
    """Apply a filling as often as possible; how often."""
    lengths, need = np.unique(filling, return_counts=True)
    times = int((counts[lengths] // need).min())
    counts[lengths] -= need * times
    return times


def _best_fit(counts: np.ndarray, room: int) -> tuple[int, ...]:
    """The largest length that fits, again and again."""
    out: list[int] = []
    used: dict[int, int] = {}
    top = room
    while room > 0 and top > 0:
        fits = np.flatnonzero(counts[1 : min(room, top) + 1])
        if not len(fits):
            break
        n = int(fits[-1]) + 1
        k = min(int(counts[n]) - used.get(n, 0), room // n)
        out += [n] * k
        used[n] = used.get(n, 0) + k
        room -= n * k
        top = n - 1
    return tuple(out)


def _bits(reach: int, at: int) -> bool:
    return at >= 0 and bool(reach >> at & 1)


def _sums(lengths: list[int], counts: np.ndarray, room: int) -> list[int]:
    """Bit k of the i-th number: whether pieces of ``lengths[i:]`` can add up to k."""
    mask = (1 << (room + 1)) - 1
    out = [1] * (len(lengths) + 1)
    for i in range(len(lengths) - 1, -1, -1):
        reach, n = out[i + 1], lengths[i]
        left, step = min(int(counts[n]), room // n), 1
        while left > 0:
            step = min(step, left)
            reach |= (reach << (n * step)) & mask
            left -= step
            step *= 2
        out[i] = reach
    return out


def _with_sum(lengths: list[int], counts: np.ndarray, sums: list[int], at: int, goal: int) -> Iterator[tuple[int, ...]]:
    """Fillings of ``lengths[at:]`` with a given sum, large pieces first."""
    if goal == 0:
        yield ()
        return
    for i in range(at, len(lengths)):
        n = lengths[i]
        if n > goal:
            continue
        for k in range(min(int(counts[n]), goal // n), 0, -1):
            if _bits(sums[i + 1], goal - n * k):
                for rest in _with_sum(lengths, counts, sums, i + 1, goal - n * k):
                    yield (n,) * k + rest


def dominates(one: tuple[int, ...], other: tuple[int, ...]) -> bool:
    """Whether the pieces of ``other`` fit into room as large as those of ``one``."""
    if sum(other) > sum(one):
        return False
    if len(other) > 8 or len(one) > 8:
        return False  # not worth the search

    def put(k: int, room: list[int]) -> bool:
        if k == len(other):
            return True
        for i in range(len(room)):
            if room[i] >= other[k] and room[i] not in room[:i]:
                room[i] -= other[k]
                if put(k + 1, room):
                    return True
                room[i] += other[k]
        return False

    return put(0, list(one))


def fillings(counts: np.ndarray, room: int, most_waste: int, most: int) -> list[tuple[int, ...]]:
    """Undominated fillings of ``room``, least waste first, ``most`` at most."""
    return some_fillings(counts, room, most_waste, most)[0]


def some_fillings(counts: np.ndarray, room: int, most_waste: int, most: int) -> tuple[list[tuple[int, ...]], bool]:
    """``fillings``, and whether there may be more."""
    lengths = (np.flatnonzero(counts[1 : room + 1])[::-1] + 1).tolist()
    if not lengths:
        return [()], False
    if lengths[0] == room:
        return [(room,)], False  # dominates every other filling
    sums = _sums(lengths, counts, room)
    out: list[tuple[int, ...]] = []
    tried, goal = 0, sums[0].bit_length() - 1
    while goal > 0 and room - goal <= most_waste:
        if _bits(sums[0], goal):
            for filling in _with_sum(lengths, counts, sums, 0, goal):
                tried += 1
                fits = next((n for n in reversed(lengths) if counts[n] > filling.count(n)), room + 1) <= room - goal
                if not fits and not any(dominates(f, filling) for f in out):
                    out.append(filling)
                if len(out) == most or tried >= 4 * most:
                    return out, True
        goal -= 1
    return out, False


def lower_bound(counts: np.ndarray, capacity: int) -> int:
    """No packing has fewer sequences: pieces over half a sequence never share one,
    and the others must fit beside them."""
    n = np.arange(capacity + 1)
    best = -(-int((counts * n).sum()) // capacity)
    pieces, tokens = np.concatenate(([0], np.cumsum(counts))), np.concatenate(([0], np.cumsum(counts * n)))
    half = capacity // 2
    for k in range(1, half + 1):
        alone = int(pieces[-1] - pieces[capacity - k + 1])
        large = int(pieces[capacity - k + 1] - pieces[half + 1])
        free = large * capacity - int(tokens[capacity - k + 1] - tokens[half + 1])
        small = int(tokens[half + 1] - tokens[k])
        best = max(best, alone + large + max(0, -(-(small - free) // capacity)))
    return best


def _descend(counts: np.ndarray, capacity: int, choose) -> tuple[list[tuple[tuple[int, ...], int]], int]:
    counts = counts.copy()
    out, bins = [], 0
    while True:
        left = np.flatnonzero(counts)
        if not len(left):
            return out, bins
        top = int(left[-1])
        counts[top] -= 1
        rest = choose(counts, capacity - top)
        counts[top] += 1
        filling = (top, *rest)
        times = _take(counts, filling)
        out.append((filling, times))
        bins += times


@dataclass
class _Node:
    """Options (filling, times) of a node; which is applied, and what the branch wasted before."""

    options: list[tuple[tuple[int, ...], int]]
    waste: int
    spare: int  # choices other than the first that this branch may still take
    at: int = -1


class _Search:
    def __init__(self, counts: np.ndarray, capacity: int, plan: list, bins: int, work: int, most: int):
        self.counts, self.capacity, self.best, self.bins, self.work, self.most = counts, capacity, plan, bins, work, most
        self.tokens = int((counts * np.arange(capacity + 1)).sum())
        self.cut = False  # whether a branch was left out for its discrepancies, or a filling for the limit

    def may_waste(self) -> int:
        return (self.bins - 1) * self.capacity - self.tokens

    def node(self, waste: int, spare: int) -> _Node | None:
        left = np.flatnonzero(self.counts)
        if not len(left):
            return None
        self.work -= len(left) + NODE
        top = int(left[-1])
        self.counts[top] -= 1
        some, more = some_fillings(self.counts, self.capacity - top, self.may_waste() - waste, self.most)
        self.cut |= more
        self.counts[top] += 1
        options = []
        for f in some:
            filling = (top, *f)
            lengths, need = np.unique(filling, return_counts=True)
            times = int((self.counts[lengths] // need).min())
            alone = len(some) == 1 and (not f or sum(filling) == self.capacity and len(f) == 1)
            for rank, t in enumerate([times] if alone else dict.fromkeys((times, -(-times // 2), 1))):
                options.append((rank, len(options), filling, t))
        return _Node([(f, t) for *_, f, t in sorted(options)], waste, spare)

    def apply(self, filling: tuple[int, ...], times: int) -> None:
        np.subtract.at(self.counts, list(filling), times)

    def descend(self, spare: int, bound: int) -> None:
        """All branches with at most ``spare`` choices that aren't the first."""
        first = self.node(0, spare)
        stack = [first] if first else []
        while stack and self.work > 0 and self.bins > bound:
            node = stack[-1]
            if node.at >= 0:
                self.apply(node.options[node.at][0], -node.options[node.at][1])
            node.at += 1
            if node.at == len(node.options) or (node.at and not node.spare):
                self.cut |= node.at < len(node.options)
                stack.pop()
                continue
            filling, times = node.options[node.at]
            self.apply(filling, times)
            waste = node.waste + times * (self.capacity - sum(filling))
            if waste > self.may_waste():
                continue
            below = self.node(waste, node.spare - (node.at > 0))
            if below:
                stack.append(below)
            else:
                self.best = [n.options[n.at] for n in stack]
                self.bins = sum(t for _, t in self.best)
        for node in stack:
            if node.at >= 0:
                self.apply(node.options[node.at][0], -node.options[node.at][1])


def complete_bins(histogram: dict[int, int], capacity: int = CAPACITY, work: int = 3_000_000, most: int = 12) -> list[tuple[tuple[int, ...], int]]:
    """(filling, times) that hold every piece of the histogram, in few sequences.

    ``work`` bounds the search: a node costs NODE and the number of lengths left,
    about a microsecond each; ``most`` bounds the fillings of a node and grows with the
    choices that a branch may take.
    """
    counts = np.zeros(capacity + 1, np.int64)
    for n, c in histogram.items():
        counts[n] = c
    bound = lower_bound(counts, capacity)
    plan, bins = _descend(counts, capacity, _best_fit)
    search, spare = _Search(counts, capacity, plan, bins, work, most), 0
    while search.bins > bound and search.work > 0:
        search.cut, search.most = False, most * (spare + 1)
        search.descend(spare, bound)
        if not search.cut:
            break  # all branches were tried
        spare = 2 * spare + 1
    return search.best


def places(plan: list[tuple[tuple[int, ...], int]], capacity: int = CAPACITY) -> dict[int, np.ndarray]:
    """By length, rows (first rank, times, first sequence, offset): the pieces
    with ranks from ``first rank`` on fill copies of one filling in turn."""
    at, seq = dict.fromkeys(range(capacity + 1), 0), 0
    out: dict[int, list[tuple[int, int, int, int]]] = {}
    for filling, times in plan:
        offset = 0
        for n in filling:
            out.setdefault(n, []).append((at[n], times, seq, offset))
            at[n] += times
            offset += n
        seq += times
    return {n: np.array(x, np.int64) for n, x in out.items()}


def pack(pieces: DataFrame, capacity: int = CAPACITY, group: int = 10_000) -> DataFrame:
    """``pieces`` (staged) with ``sequence_id`` and ``offset``."""
    spark = pieces.sparkSession
    total = pieces.count()
    buckets = max(1, -(-total // group))
    dealt = pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(buckets)).cast("int"))
    sizes = dealt.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # capacity rows at most
    table = spark.sparkContext.broadcast(places(complete_bins(histogram, capacity), capacity))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
    bases = sizes.select("length", "bucket", F.coalesce(before, F.lit(0)).alias("base"))
    order = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece")
    ranked = dealt.withColumn("rank", F.row_number().over(order)).join(bases, ["length", "bucket"])
    ranked = ranked.select(*pieces.columns, (F.col("base") + F.col("rank") - 1).alias("rank"))
    keep = pieces.columns
    at = keep.index("length")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows_of = table.value
        for batch in batches:
            length, rank = batch.column(at).to_numpy(), batch.column(len(keep)).to_numpy()
            seq, off = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for n in np.unique(length):
                mine = np.flatnonzero(length == n)
                rows = rows_of[int(n)]
                row = rows[np.searchsorted(rows[:, 0], rank[mine], side="right") - 1]
                seq[mine] = row[:, 2] + rank[mine] - row[:, 0]
                off[mine] = row[:, 3]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(len(keep))), pa.array(seq), pa.array(off)], names=[*keep, "sequence_id", "offset"]
            )

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema.fields)
    return ranked.mapInArrow(place, fields + ", sequence_id long, offset long")


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str | None = None) -> DataFrame:
    return pack(stage(tokenize_pieces(docs, capacity, vocabulary), "pieces"), capacity)


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
