"""LM scoring by a probabilistic suffix tree of words, with the unigram baseline.

Symbols are lower-cased words and the end of a text.  The tree's states are the
contexts of the last two words, of the last word, and the root:

* root: a known word has its share of the learning tokens, less the Good-Turing
  mass of unseen words; an unseen word has that mass times the probability of its
  spelling, by a byte model with contexts of two bytes, one or none, fitted on the
  distinct learning words, of which each is spelled by the one block that its hash
  range picks;
* one word: kept where it occurs ``LEAST`` times, smoothed towards the root;
* two words: kept where they occur ``LEAST`` times and their next-word distribution
  diverges from that of their suffix: the mean log ratio of both, each occurrence
  predicted from the others (deleted estimates), is ``least_divergence`` nats or
  more.  They are smoothed towards the suffix.

A token is scored in its longest kept state.  States are counted over all learning
documents, so their number grows with the corpus, and the tree is never in one
place: blocks of documents ask for the counts of their distinct words and pairs of
words, hash ranges add them up and answer to the block; then blocks ask by contexts
of two words, whose hash range has all their next words, makes the divergence test
and answers with the change that the longer context makes to a token's log10
(in steps of 1/2048, as the probabilities it is asked with).  A context that occurs
``HOT`` times is dealt by its next words instead; its test is summed up in two steps,
by next word and then by context, and comes out as it would in one.

Defined cases: a null or empty text is the end symbol alone; without learning
documents no word is known and words have the probability of their spelling;
repeated rows count and are scored as often as they come; a null id learns (its
remainder is null, so it isn't held out); an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridflux.llm.common import LOWER, byte_slices, find_words, mix64, stage, table, text_buffers
from gridflux.llm.langid import remainder

#: Occurrences that a kept context has, and those from which it is dealt by next words.
LEAST, HOT = 4, 1 << 20
#: Weights of the suffix in a context's smoothing: one word, two words, bytes.
MU_ONE, MU_TWO, MU_BYTE = 200.0, 6.0, 8.0
LEAST_DIVERGENCE = 0.02
BLOCK_BYTES, PER_BUCKET = 8 << 20, 1 << 20
EDGE, BYTES = 256, 257  # the byte model's symbol before and after a word; its symbols
STEP = 2048.0
KEY = np.uint64((1 << 40) - 1)
_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
END_HASH = mix64(np.array([0x7E57ED], np.uint64))[0]

BLOCKS = "chunk long, docs binary, held binary, sizes binary, tokens binary, vocab binary, rare binary, spell binary, n_tokens long, n_docs long"
REQUESTS = "bucket int, chunk long, words binary, pairs binary"
ANSWERS = "bucket int, chunk long, words binary, pairs binary, spells binary, types long, singles long, top long"
SECOND = "chunk long, docs binary, rows binary, at binary, bucket int, ask binary"
SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, n_long long"


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed blob, their bytes by significance."""
    head = np.array([len(arrays), *(x for a in arrays for x in (len(a), a.itemsize, "ui f".index(a.dtype.kind)))], np.int64)
    body = b"".join(np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize).T.tobytes() for a in arrays)
    raw = head.tobytes() + body
    return len(raw).to_bytes(8, "little") + pa.Codec("zstd", 1).compress(raw, asbytes=True)


def unpack(blob: bytes) -> list[np.ndarray]:
    raw = pa.Codec("zstd", 1).decompress(blob[8:], int.from_bytes(blob[:8], "little"), asbytes=True)
    n = int(np.frombuffer(raw, np.int64, 1)[0])
    head = np.frombuffer(raw, np.int64, 3 * n, 8).reshape(n, 3)
    out, at = [], 8 + 24 * n
    for size, width, kind in head.tolist():
        planes = np.frombuffer(raw, np.uint8, size * width, at).reshape(width, size)
        out.append(np.ascontiguousarray(planes.T).view(f"{'ui f'[kind]}{width}").reshape(size))
        at += size * width
    return out


def bucketed(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Hash range and 40 bits of the hash as one number."""
    return ((((hashes >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)) << np.uint64(40)) | (hashes & KEY)


def bucket_cuts(keys: np.ndarray, buckets: int) -> np.ndarray:
    return np.searchsorted(keys, np.arange(buckets + 1, dtype=np.uint64) << np.uint64(40))


def steps_of(keys: np.ndarray) -> np.ndarray:
    return np.diff(keys & KEY, prepend=np.uint64(0))


def batch_of(schema: str, rows: list[dict]) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    fields = [x.split() for x in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r.get(n) for r in rows], kinds[k]) for n, k in fields], names=[n for n, _ in fields])


def spelled(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(codes, first): for each byte of words and the edge after each, the two
    symbols before it and itself as one number; word i's are [first[i], first[i + 1])."""
    size = end - start + 1
    first = np.concatenate(([0], np.cumsum(size)))
    out = np.full(int(first[-1]), EDGE, np.int64)
    inner = np.arange(len(out)) - np.repeat(first[:-1], size)
    here = inner < np.repeat(size - 1, size)
    out[here] = LOWER[data[(np.repeat(start, size) + inner)[here]]]
    one = np.where(inner >= 1, np.concatenate(([EDGE], out[:-1])), EDGE)
    two = np.where(inner >= 2, np.concatenate(([EDGE, EDGE], out[:-2]))[: len(out)], EDGE)
    return (two * BYTES + one) * BYTES + out, first


def gather(docs: DataFrame) -> DataFrame:
    """Blocks of documents as numbers of their own vocabulary, and byte grams; staged."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        serial = TaskContext.get().partitionId() << 32
        for batch in batches:
            data, bounds = text_buffers(batch.column(2))
            ids = batch.column(0).to_pylist()
            held = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
            for i, j in byte_slices(bounds, BLOCK_BYTES, 1 << 20):
                hashes, starts, ends, sizes = [], [], [], []
                for a, b in byte_slices(bounds[i : j + 1]):
                    words = find_words(data, bounds[a + i : b + i + 1])
                    hashes.append(words.hash)
                    starts.append(words.start + bounds[a + i])
                    ends.append(words.end + bounds[a + i])
                    sizes.append(np.diff(words.first))
                h, start, end, size = (np.concatenate(x) for x in (hashes, starts, ends, sizes))
                vocab, at, inverse, n = np.unique(h, return_index=True, return_inverse=True, return_counts=True)
                often = np.argsort(-n, kind="stable")
                rank = np.empty(len(often), np.uint32)
                rank[often] = np.arange(len(often))
                vocab, at, tokens = vocab[often], at[often], rank[inverse]
                own = np.repeat(~held[i:j], size)
                known = np.bincount(tokens[own], minlength=len(vocab))
                rare = np.flatnonzero(known == 0)  # perhaps unseen: their spelling is needed
                codes, first = spelled(data, start[at[rare]], end[at[rare]])
                long = np.where(known > 0, end[at] - start[at], 0)
                letters = np.repeat(start[at] - (np.cumsum(long) - long), long) + np.arange(int(long.sum()))
                null = np.array([x is None for x in ids[i:j]], bool)
                yield batch_of(BLOCKS, [
                    {"chunk": serial, "docs": pack(np.array([x or 0 for x in ids[i:j]], np.int64), null.view(np.uint8)), "held": pack(held[i:j].view(np.uint8)),
                     "sizes": pack(size.astype(np.uint32)), "tokens": pack(tokens), "vocab": pack(vocab),
                     "rare": pack(rare.astype(np.uint32), np.diff(first).astype(np.uint32), codes.astype(np.uint32)),
                     "spell": pack(long.astype(np.uint32), data[letters]), "n_tokens": int(own.sum()), "n_docs": int((~held[i:j]).sum())},
                ])
                serial += 1

    held = F.coalesce(remainder("doc_id", 7) == 2, F.lit(False))
    return stage(docs.select("doc_id", held.alias("held"), "text").mapInArrow(run, BLOCKS), "lm-blocks")


@dataclass
class Spelling:
    """Byte model: counts after two symbols (codes in order), and after one."""

    codes: np.ndarray
    counts: np.ndarray
    contexts: np.ndarray
    totals: np.ndarray
    one: np.ndarray  # probabilities, by symbol before and symbol

    def log(self, codes: np.ndarray) -> np.ndarray:
        """Natural logs of the last symbols of codes."""
        def look(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
            if not len(keys):
                return np.zeros(len(wanted))
            at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
            return np.where(keys[at] == wanted, values[at], 0)

        shorter = self.one[codes // BYTES % BYTES, codes % BYTES]
        return np.log((look(self.codes, self.counts, codes) + MU_BYTE * shorter) / (look(self.contexts, self.totals, codes // BYTES) + MU_BYTE))


def word_keys(vocab: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(order, keys) of a block's words and the end, by hash range."""
    keys = bucketed(mix64(np.append(vocab, END_HASH) + _C), buckets)
    order = np.argsort(keys, kind="stable")
    return order, keys[order]


def spelling(blocks: DataFrame, answers: DataFrame, buckets: int, least_share: float = 1e-5) -> Spelling:
    """The byte model of the words that blocks were picked to spell.  Contexts of two bytes below ``least_share`` are left to those of
    one, so at most 1 / least_share of them reach the driver."""

    def by_range(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Spellings in the order of the words' keys: their hashes aren't shuffled again."""
        for batch in batches:
            for row in batch.to_pylist():
                (vocab,), (long, letters) = unpack(row["vocab"]), unpack(row["spell"])
                order, _ = word_keys(vocab, buckets)
                long = np.append(long, 0).astype(np.int64)
                first = (np.cumsum(long) - long)[order]
                long = long[order]
                at = np.repeat(first - (np.cumsum(long) - long), long) + np.arange(int(long.sum()))
                yield pa.RecordBatch.from_arrays([pa.array([row["chunk"]], pa.int64()), pa.array([pack(long.astype(np.uint32), letters[at])], pa.binary())], names=["chunk", "spell"])

    def run(body: pa.Table, answer: pa.Table) -> pa.Table:
        own = joined(list(zip(answer.column("bucket").to_pylist(), answer.column("spells").to_pylist(), strict=True))) > 0
        found = []
        for blob in body.column("spell").to_pylist():
            long, letters = unpack(blob)
            end = np.cumsum(long.astype(np.int64))
            pick = np.flatnonzero(own & (long > 0))
            found.append(spelled(letters, end[pick] - long[pick], end[pick])[0])
        codes, n = np.unique(np.concatenate(found), return_counts=True) if found else (np.zeros(0, np.int64),) * 2
        return pa.table({"code": pa.array(codes.astype(np.int64)), "n": pa.array(n.astype(np.int64))})

    bodies = blocks.select("chunk", "vocab", "spell").mapInArrow(by_range, "chunk long, spell binary").groupBy("chunk")
    codes = bodies.cogroup(answers.where("spells IS NOT NULL").select("chunk", "bucket", "spells").groupBy("chunk")).applyInArrow(run, "code long, n long")
    codes = stage(codes.groupBy("code").agg(F.sum("n").alias("n")), "lm-bytes").withColumn("context", F.floor(F.col("code") / BYTES))
    one = np.zeros((BYTES, BYTES))
    for r in codes.groupBy((F.col("code") % (BYTES * BYTES)).alias("pair")).agg(F.sum("n").alias("n")).collect():  # 257 x 257 at most
        one[r["pair"] // BYTES, r["pair"] % BYTES] = r["n"]
    contexts = codes.groupBy("context").agg(F.sum("n").alias("total")).where(F.col("total") >= least_share * one.sum())
    rows = codes.join(contexts, "context").select("code", "n", "context", "total").orderBy("code").collect()
    code, n, context, total = (np.array([r[k] for r in rows], np.int64) for k in range(4))
    context, first = np.unique(context, return_index=True)
    root = (one.sum(axis=0) + 1) / (one.sum() + BYTES)
    return Spelling(code, n, context, total[first], (one + MU_BYTE * root) / (one.sum(axis=1, keepdims=True) + MU_BYTE))


class Block:
    """A block's tokens with ends, and their distinct pairs."""

    def __init__(self, row: dict, buckets: int):
        (self.sizes,), (tokens,), (vocab,), (held,) = (unpack(row[k]) for k in ("sizes", "tokens", "vocab", "held"))
        self.held = held.view(bool)
        docs = len(self.sizes)
        self.length = self.sizes.astype(np.int64) + 1
        self.stop = np.cumsum(self.length)
        self.first = self.stop - self.length
        self.end = len(vocab)  # the end's number
        self.token = np.full(int(self.stop[-1]) if docs else 0, self.end, np.int64)
        inner = np.ones(len(self.token), bool)
        inner[self.stop - 1] = False
        self.token[inner] = tokens
        self.hash = np.append(vocab, END_HASH)
        self.learns = np.repeat(~self.held, self.length)
        self.place = np.arange(len(self.token)) - np.repeat(self.first, self.length)
        later = np.flatnonzero(self.place > 0)
        h = self.hash[self.token]
        pair = bucketed(mix64(h[later - 1] * _A + h[later] * _B + _C), buckets)
        self.pairs, inverse = np.unique(pair, return_inverse=True)
        self.pair_at = np.full(len(self.token), -1, np.int64)  # number of the pair that ends here
        self.pair_at[later] = inverse
        self.word_order, self.words = word_keys(vocab, buckets)

    def counts(self) -> tuple[np.ndarray, np.ndarray]:
        """The block's own learning counts of words and pairs, in the order of their keys."""
        own = self.token[self.learns]
        pairs = self.pair_at[self.learns]
        return np.bincount(own, minlength=len(self.hash))[self.word_order], np.bincount(pairs[pairs >= 0], minlength=len(self.pairs))


def ask_counts(blocks: DataFrame, buckets: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                block = Block(row, buckets)
                parts = [(k, n.astype(np.uint32), bucket_cuts(k, buckets)) for k, n in zip((block.words, block.pairs), block.counts(), strict=True)]
                rows = []
                for b in range(buckets):
                    blobs = [pack(steps_of(k[cuts[b] : cuts[b + 1]]), n[cuts[b] : cuts[b + 1]]) if cuts[b + 1] > cuts[b] else None for k, n, cuts in parts]
                    if any(blobs):
                        rows.append({"bucket": b, "chunk": row["chunk"], "words": blobs[0], "pairs": blobs[1]})
                yield batch_of(REQUESTS, rows)

    return blocks.select("chunk", "sizes", "tokens", "vocab", "held").mapInArrow(run, REQUESTS)


def summed(blobs: list[bytes | None]) -> tuple[list[bytes | None], list[bytes | None], np.ndarray]:
    """For each blob of keys and counts its keys' totals, which of its keys it is picked for
    (each key that counts has one blob of those that count it), and all keys' totals."""
    parts = [unpack(x) if x is not None else None for x in blobs]
    some = [p for p in parts if p is not None]
    if not some:
        return [None] * len(parts), [None] * len(parts), np.zeros(0, np.int64)
    keys, counts = np.concatenate([np.cumsum(p[0], dtype=np.uint64) for p in some]), np.concatenate([p[1] for p in some])
    distinct, inverse = np.unique(keys, return_inverse=True)
    total = np.bincount(inverse, counts, minlength=len(distinct)).astype(np.int64)
    at = np.flatnonzero(counts)
    pick = np.zeros(len(keys), np.uint8)
    pick[at[np.unique(inverse[at], return_index=True)[1]]] = 1
    cuts = np.cumsum([len(p[0]) for p in some])[:-1]
    each, picked = iter(np.split(total[inverse], cuts)), iter(np.split(pick, cuts))
    return [pack(next(each).astype(np.uint64)) if p is not None else None for p in parts], [pack(next(picked)) if p is not None else None for p in parts], total


def answer_counts(requests: DataFrame) -> DataFrame:
    def answer(group: pa.Table) -> pa.Table:
        words, spells, total = summed(group.column("words").to_pylist())
        pairs, _, of_pairs = summed(group.column("pairs").to_pylist())
        n = group.num_rows
        return pa.table({
            "bucket": group.column("bucket"), "chunk": group.column("chunk"), "words": pa.array(words, pa.binary()), "pairs": pa.array(pairs, pa.binary()), "spells": pa.array(spells, pa.binary()),
            "types": pa.array([int((total > 0).sum())] * n, pa.int64()), "singles": pa.array([int((total == 1).sum())] * n, pa.int64()),
            "top": pa.array([int(of_pairs.max(initial=0))] * n, pa.int64()),
        })

    return stage(requests.groupBy("bucket").applyInArrow(answer, ANSWERS), "lm-counts")


def joined(answers: list[tuple[int, bytes | None]]) -> np.ndarray:
    """Answers of buckets in order."""
    parts = [unpack(blob)[0] for _, blob in sorted(answers, key=lambda x: x[0]) if blob is not None]
    return np.concatenate(parts).astype(np.int64) if parts else np.zeros(0, np.int64)


@dataclass
class Totals:
    """Learning tokens with ends, distinct ones, and those seen once."""

    tokens: int
    types: int
    singles: int

    @property
    def unseen(self) -> float:
        """Good-Turing mass of words that weren't seen."""
        return min(0.5, (self.singles + 1) / (self.tokens + 2)) if self.tokens else 1.0


def shorter_states(block: Block, row: dict, c1: np.ndarray, c2: np.ndarray, totals: Totals, model: Spelling) -> np.ndarray:
    """Natural log of each token in the state of one word or in the root."""
    with np.errstate(divide="ignore"):
        root = np.log1p(-totals.unseen) + np.log(c1 / max(1, totals.tokens)) if totals.tokens else np.full(len(c1), -np.inf)
    rare, size, codes = unpack(row["rare"])
    sums = np.concatenate(([0.0], np.cumsum(model.log(codes.astype(np.int64)))))
    stop = np.cumsum(size.astype(np.int64))
    spelt = sums[stop] - sums[stop - size.astype(np.int64)]
    unseen = c1[rare] == 0
    root[rare[unseen]] = np.log(totals.unseen) + spelt[unseen]
    if not totals.tokens:
        root[block.end] = 0.0
    p = root[block.token]
    at = np.flatnonzero(block.pair_at >= 0)
    context = c1[block.token[at - 1]]
    at, context = at[context >= LEAST], context[context >= LEAST]
    with np.errstate(divide="ignore"):
        p[at] = np.logaddexp(np.log(c2[block.pair_at[at]]), np.log(MU_ONE) + p[at]) - np.log(context + MU_ONE)
    return p


def longer_states(block: Block, c2: np.ndarray, p: np.ndarray, buckets: int, hot: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[tuple[int, bytes]]]:
    """(token, number of its gram) where a context of two words may be kept, the hot
    context of each gram (0: none), and the requests by bucket, whose grams' numbers
    follow each other."""
    at = np.flatnonzero(block.place >= 2)
    n = c2[block.pair_at[at - 1]]
    at, n = at[n >= LEAST], n[n >= LEAST].astype(np.int64)
    context, word = block.pairs[block.pair_at[at - 1]], block.hash[block.token[at]]
    gram = mix64(context * _A + word * _B + _C)
    name = mix64(np.where(n >= hot, gram, context * _B + _C))
    key, low = bucketed(name, buckets), gram >> np.uint64(32)
    order = np.lexsort((low, key))
    k, g = key[order], low[order]
    fresh = np.ones(len(k), bool)
    fresh[1:] = (k[1:] != k[:-1]) | (g[1:] != g[:-1])
    number = np.empty(len(k), np.int64)
    number[order] = np.cumsum(fresh) - 1
    heads = order[fresh]
    own = np.bincount(number[block.learns[at]], minlength=len(heads))
    owner = np.where(n[heads] >= hot, mix64(context[heads] * _B + _C) | np.uint64(1), np.uint64(0))
    k, g, n, q = key[heads], low[heads].astype(np.uint32), n[heads], np.round(-p[at[heads]] / np.log(10) * STEP).clip(0, 65535).astype(np.uint16)
    cuts, asks = bucket_cuts(k, buckets), []
    for b in np.flatnonzero(np.diff(cuts)):
        part = slice(cuts[b], cuts[b + 1])
        new = np.flatnonzero(np.diff(k[part], prepend=np.uint64(0)) != 0)
        new = np.union1d(new, [0])
        asks.append((int(b), pack(steps_of(k[part][new]), n[part][new].astype(np.uint64), np.diff(np.append(new, len(k[part]))).astype(np.uint32), g[part], own[part].astype(np.uint32), q[part], owner[part][new])))
    return at, number, owner, asks


def second_pass(blocks: DataFrame, answers: DataFrame, totals: Totals, model: Spelling, buckets: int, hot: int) -> DataFrame:
    """Rows of documents scored in shorter states, and requests for longer ones."""
    shared = blocks.sparkSession.sparkContext.broadcast((totals, model))

    def run(body: pa.Table, answer: pa.Table) -> pa.Table:
        totals, model = shared.value
        rows = []
        number, words, pairs = (answer.column(k).to_pylist() for k in ("bucket", "words", "pairs"))
        for row in body.to_pylist():
            block = Block(row, buckets)
            c1 = np.zeros(len(block.hash), np.int64)
            c1[block.word_order] = joined(list(zip(number, words, strict=True)))
            c2 = joined(list(zip(number, pairs, strict=True)))
            p = shorter_states(block, row, c1, c2, totals, model)
            at, gram, owner, asks = longer_states(block, c2, p, buckets, hot)
            own = c1[block.token]
            base = np.log10(own + 1.0) - np.log10(totals.tokens + 1.0 * (totals.types + 1))
            add = [np.add.reduceat(x, block.first) for x in (base, p / np.log(10), (own > 0).astype(np.float64))] if len(block.first) else [np.zeros(0)] * 3
            longer = np.bincount(np.searchsorted(block.stop, at, side="right"), minlength=len(block.first)).astype(np.uint32)
            rows.append({"chunk": row["chunk"], "docs": row["docs"], "rows": pack(block.held.view(np.uint8), block.length.astype(np.uint32), *(x.astype(np.float64) for x in add), longer), "at": pack(gram.astype(np.uint32), np.flatnonzero(owner).astype(np.uint32), owner[owner != 0])})
            rows += [{"chunk": row["chunk"], "bucket": b, "ask": blob} for b, blob in asks]
        return pa.Table.from_batches([batch_of(SECOND, rows)])

    bodies = blocks.drop("spell", "n_tokens", "n_docs")
    return bodies.groupBy("chunk").cogroup(answers.select("chunk", "bucket", "words", "pairs").groupBy("chunk")).applyInArrow(run, SECOND)


def judged(count: np.ndarray, n: np.ndarray, p: np.ndarray, context: np.ndarray, least_divergence: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of grams (context numbers in ``context``): log10 of their probability over that in
    the suffix, whether their context is kept, and its summed gain."""
    deleted = count * np.log((np.maximum(count - 1, 0) + MU_TWO * p) / ((n - 1 + MU_TWO) * p))
    gain = np.bincount(context, deleted)
    kept = (gain >= least_divergence * np.maximum.reduceat(n, np.flatnonzero(np.diff(context, prepend=-1)))) if len(context) else np.zeros(0, bool)
    return np.log10((count + MU_TWO * p) / ((n + MU_TWO) * p)), kept[context], gain


def answer_states(asks: DataFrame, least_divergence: float) -> DataFrame:
    """(bucket, chunk, change, owner, gain, n): changes of each block's grams, and for grams
    of hot contexts, whose changes are given in any case, rows with their gain alone."""

    def answer(group: pa.Table) -> pa.Table:
        parts = [unpack(x) for x in group.column("ask").to_pylist()]
        context = np.concatenate([np.repeat(np.cumsum(p[0], dtype=np.uint64), p[2]) for p in parts])
        n = np.concatenate([np.repeat(p[1].astype(np.int64), p[2]) for p in parts])
        owner = np.concatenate([np.repeat(p[6], p[2]) for p in parts])
        gram, own, q = (np.concatenate([p[k] for p in parts]) for k in (3, 4, 5))
        order = np.lexsort((gram, context))
        k, g = context[order], gram[order]
        fresh = np.ones(len(k), bool)
        fresh[1:] = (k[1:] != k[:-1]) | (g[1:] != g[:-1])
        heads = np.flatnonzero(fresh)
        count = np.add.reduceat(own[order].astype(np.float64), heads)
        new = np.ones(len(heads), bool)
        new[1:] = k[heads][1:] != k[heads][:-1]
        p = 10.0 ** (q[order][heads] / -STEP)
        n, owner = n[order][heads], owner[order][heads]
        change, kept, gain = judged(count, n.astype(np.float64), p, np.cumsum(new) - 1, least_divergence)
        coded = np.where(kept | (owner != 0), np.round(change * STEP).clip(-32767, 32767), -32768).astype(np.int16)
        back = np.empty(len(k), np.int16)
        back[order] = coded[np.cumsum(fresh) - 1]
        each = np.split(back, np.cumsum([len(x[3]) for x in parts])[:-1])
        hot = np.flatnonzero(new & (owner != 0))
        m = len(parts)
        columns = {
            "bucket": [*group.column("bucket").to_pylist(), *[None] * len(hot)], "chunk": [*group.column("chunk").to_pylist(), *[None] * len(hot)],
            "change": [*(pack(x) for x in each), *[None] * len(hot)], "owner": [*[None] * m, *owner[hot].view(np.int64).tolist()],
            "gain": [*[None] * m, *gain[(np.cumsum(new) - 1)[hot]].tolist()], "n": [*[None] * m, *n[hot].tolist()],
        }
        kinds = (pa.int32(), pa.int64(), pa.binary(), pa.int64(), pa.float64(), pa.int64())
        return pa.table({c: pa.array(v, t) for (c, v), t in zip(columns.items(), kinds, strict=True)})

    return asks.groupBy("bucket").applyInArrow(answer, "bucket int, chunk long, change binary, owner long, gain double, n long")


def dropped_contexts(answers: DataFrame, least_divergence: float) -> np.ndarray:
    """Hot contexts that fail the test.  There are at most learning tokens / hot of them."""
    sums = answers.where("owner IS NOT NULL").groupBy("owner").agg(F.sum("gain").alias("gain"), F.max("n").alias("n"))
    rows = sums.where(F.col("gain") < least_divergence * F.col("n")).select("owner").collect()
    return np.sort(np.array([r["owner"] for r in rows], np.int64).view(np.uint64))


def finish(bodies: DataFrame, answers: DataFrame, train_tokens: int, dropped: np.ndarray) -> DataFrame:
    shared = bodies.sparkSession.sparkContext.broadcast(dropped)

    def run(body: pa.Table, answer: pa.Table) -> pa.Table:
        change = joined(list(zip(answer.column("bucket").to_pylist(), answer.column("change").to_pylist(), strict=True)))
        out = []
        for row in body.to_pylist():
            ids, null = unpack(row["docs"])
            held, length, base, score, known, longer = unpack(row["rows"])
            gram, hot, owner = unpack(row["at"])
            if len(hot) and len(shared.value):
                change[hot[np.isin(owner, shared.value)]] = -32768
            kept = change[gram] > -32768
            cuts = np.concatenate(([0], np.cumsum(longer.astype(np.int64))))
            more, states = (np.concatenate(([0.0], np.cumsum(x)))[cuts] for x in (np.where(kept, change[gram], 0) / STEP, kept))
            out.append(pa.table({
                "doc_id": pa.array(ids, pa.int64(), mask=null.view(bool)), "held_out": pa.array(held.view(bool)), "n_tokens": pa.array(length.astype(np.int64)),
                "n_known": pa.array(known.astype(np.int64)), "train_tokens": pa.array([train_tokens] * len(ids), pa.int64()),
                "base_score": pa.array(base), "score": pa.array(score + np.diff(more)), "n_long": pa.array(np.diff(states).astype(np.int64)),
            }))
        return pa.concat_tables(out)

    bodies = bodies.select("chunk", "docs", "rows", "at")
    return bodies.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(run, SCORES)


def score_texts(docs: DataFrame, least_divergence: float = LEAST_DIVERGENCE, hot: int = HOT) -> DataFrame:
    """Scores of all documents; ``n_long`` counts their tokens scored after two words."""
    spark = docs.sparkSession
    blocks = gather(docs)
    sums = blocks.agg(F.sum("n_tokens"), F.sum("n_docs")).first()
    tokens, n_docs = (x or 0 for x in sums)
    buckets = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")), tokens // PER_BUCKET)
    counts = answer_counts(ask_counts(blocks, buckets))
    of_bucket = counts.groupBy("bucket").agg(F.max("types").alias("types"), F.max("singles").alias("singles"), F.max("top").alias("top"))
    types, singles, top = (x or 0 for x in of_bucket.agg(F.sum("types"), F.sum("singles"), F.max("top")).first())
    totals = Totals(tokens + n_docs, types, singles)
    second = second_pass(blocks, counts, totals, spelling(blocks, counts, buckets), buckets, hot)
    changes = answer_states(second.where("ask IS NOT NULL").select("bucket", "chunk", "ask"), least_divergence)
    dropped = np.zeros(0, np.uint64)
    if top >= hot:  # else no context was dealt by its next words
        changes = stage(changes, "lm-changes")
        dropped = dropped_contexts(changes, least_divergence)
    return finish(second.where("docs IS NOT NULL"), changes.where("chunk IS NOT NULL").select("bucket", "chunk", "change"), totals.tokens, dropped)


def op7_suffix_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(table(spark, sf_dir, "documents"))
