"""Toxicity by maximum-scoring segments of token log-odds.

Tokens are runs of letters (A-Z lower-cased), without digits and marks.  A token's
log-odds compare in how many toxic and in how many other learning documents it
occurs.  Its Dirichlet prior is the odds of its beginning (four bytes), which counts
each of its different tokens once and whose own prior is even odds, so unseen words of
a telling stem have a score too.  A token that comes again within ``AGAIN`` tokens is
no new evidence.  Less a margin, scores of ordinary tokens are negative, and the maximal
scoring segments of a text, found in one linear scan, are its candidate passages.

Extreme-value calibration: ``rate`` solves E[exp(rate * score)] = 1 over the tokens of
clean calibration documents, and ``k`` is fitted to the best segments of those, so
that a text of m tokens has k * m * exp(-rate * s) segments of score s by chance.
A passage is significant if fewer than ``E_VALUE`` such are expected; its evidence is how
far it lies above the best one that chance gives, in nats, and a document's is the sum
over its significant passages.  A logistic curve on calibration
documents turns evidence into the share of toxic documents.

The model is fitted on about ``sample`` labelled documents (twice as many at most, of
each id one row; a documented bound), three quarters of them for the odds and the
rest for calibration, and keeps the ``most`` most telling tokens.  Every text is
scored whole.

Defined cases: a null or empty text, or one without letters, has no passage and the
score of texts without any; labels that disagree for one id count as toxic, null ones
not at all; repeated rows are scored as often as they come; without labels of both
kinds all scores are the share of toxic labels, or 0 without any; an empty table
gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridflux.llm.common import LOWER, Words, byte_slices, find_words, stage, table, text_buffers
from gridflux.llm.langid import remainder

STEM = 4  # bytes of a beginning
PRIOR = 2.0  # documents that a prior counts for
MARGIN = 0.5  # nats
LEAST_DOCS = 3  # learning documents that hold a kept token
AGAIN = 32  # tokens
E_VALUE = 0.01
BIN = 0.05  # nats, of the scores that calibration counts
#: Letters as they are, all else as spaces.
LETTERS = np.full(256, 32, np.uint8)
LETTERS[65:91] = LOWER[65:91]
LETTERS[97:123] = np.arange(97, 123)
LETTERS[128:] = np.arange(128, 256)


def tokens_of(data: np.ndarray, bounds: np.ndarray) -> Words:
    """Tokens and their beginnings; offsets count from the first row's first byte."""
    lo = int(bounds[0])
    return find_words(LETTERS[data[lo : int(bounds[-1])]], bounds - lo, STEM)


@dataclass
class Model:
    keys: np.ndarray  # hashes of tokens and beginnings, sorted
    odds: np.ndarray
    rate: float = 1.0
    k: float = 1.0
    curve: tuple[float, float, float] = (0.0, 0.0, 0.0)

    def scores(self, words: Words) -> np.ndarray:
        """Log-odds less the margin of each token: its own, its beginning's, or even ones."""
        out = np.full(len(words.hash), -MARGIN)
        for keys in (words.prefix, words.hash) if len(self.keys) else ():
            at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            hit = self.keys[at] == keys
            out[hit] = self.odds[at[hit]] - MARGIN
        some = np.flatnonzero(out > 0)
        order = some[np.argsort(words.hash[some], kind="stable")]
        row = np.searchsorted(words.first, order, side="right")
        again = (words.hash[order][1:] == words.hash[order][:-1]) & (row[1:] == row[:-1]) & (np.diff(order) <= AGAIN)
        out[order[1:][again]] = -MARGIN
        return out

    def surprise(self, score: np.ndarray, m: int) -> np.ndarray:
        """Nats by which segments of a text of m tokens exceed the best one that chance
        gives, the negative log of their expected number."""
        return self.rate * np.asarray(score) - np.log(self.k * max(m, 1))

    def probability(self, evidence: np.ndarray) -> np.ndarray:
        some = evidence > 0
        z = self.curve[0] + np.where(some, self.curve[1] + self.curve[2] * np.log1p(evidence), 0.0)
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def maximal_segments(score: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(total, first, stop) of all maximal scoring segments, in order.

    Runs of positive scores are single items; an item joins the last earlier segment
    that starts lower if it ends higher than that one did, else it stands alone.  Each
    segment remembers that earlier one, so the scan is linear.
    """
    positive = score > 0
    edge = np.flatnonzero(np.diff(np.concatenate(([False], positive, [False])).astype(np.int8)))
    first, stop = edge[::2], edge[1::2]
    total = np.concatenate(([0.0], np.cumsum(score)))
    low, high = total[first].tolist(), total[stop].tolist()
    stack: list[list] = []  # low, high, first, stop, place of the last earlier one that starts lower
    for a, b, lo, hi in zip(first.tolist(), stop.tolist(), low, high, strict=True):
        item = [lo, hi, a, b, -1]
        at = len(stack) - 1
        while True:
            while at >= 0 and stack[at][0] >= item[0]:
                at = stack[at][4]
            if at < 0 or stack[at][1] >= item[1]:
                item[4] = at
                stack.append(item)
                break
            item[0], item[2] = stack[at][0], stack[at][2]
            before = stack[at][4]
            del stack[at:]
            at = before
    found = np.array([[x[1] - x[0], x[2], x[3]] for x in stack]).reshape(-1, 3)
    return found[:, 0], found[:, 1].astype(np.int64), found[:, 2].astype(np.int64)


def toxic_marks(labels: DataFrame) -> DataFrame:
    """One row an id: 1 if any of its labels is toxic."""
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL")
    return known.groupBy("doc_id").agg(F.max((F.col("toxic") != 0).cast("int")).alias("toxic"))


def draw(docs: DataFrame, marks: DataFrame, sample: int) -> DataFrame:
    """Texts of the sample with ``toxic`` and ``part`` (0 for calibration); staged."""
    total = marks.count()
    deal = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    pick = marks.where(deal < int((1 << 30) * min(1.0, sample / max(1, total)))).orderBy(deal, "doc_id").limit(2 * sample)
    rows = docs.select("doc_id", "text").join(F.broadcast(pick), "doc_id")
    rows = rows.groupBy("doc_id").agg(F.min_by("text", F.xxhash64("text")).alias("text"), F.max("toxic").alias("toxic"))
    return stage(rows.select("text", "toxic", F.pmod(F.hash("doc_id"), F.lit(4)).alias("part")), "toxic-sample")


def count_tokens(texts: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(keys, odds) of the most telling tokens and beginnings of ``texts`` (text, toxic)."""
    classes = {r["toxic"]: r["count"] for r in texts.groupBy("toxic").count().collect()}
    toxic, clean = classes.get(1, 0), classes.get(0, 0)
    if not toxic or not clean:
        return np.zeros(0, np.uint64), np.zeros(0)
    kind = "key long, stem long, toxic long, clean long"
    share = toxic / clean

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, bounds = text_buffers(batch.column(0))
            marks = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
            for i, j in byte_slices(bounds):
                words = tokens_of(data, bounds[i : j + 1])
                row = np.repeat(np.arange(j - i), np.diff(words.first))
                order = np.lexsort((row, words.hash))
                key, stem, of = words.hash[order], words.prefix[order], row[order]
                fresh = np.ones(len(key), bool)
                fresh[1:] = (key[1:] != key[:-1]) | (of[1:] != of[:-1])
                key, stem, mark = key[fresh], stem[fresh], marks[i:j][of[fresh]]
                heads = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, np.int64)
                counts = (np.add.reduceat(x, heads) if len(heads) else np.zeros(0, np.int64) for x in (mark, 1 - mark))
                yield pa.RecordBatch.from_arrays([pa.array(key[heads].view(np.int64)), pa.array(stem[heads].view(np.int64)), *(pa.array(c) for c in counts)], names=["key", "stem", "toxic", "clean"])

    tokens = texts.select("text", "toxic").mapInArrow(run, kind).groupBy("key", "stem").agg(F.sum("toxic").cast("double").alias("t"), (F.sum("clean") * share).alias("c"))
    tokens = stage(tokens, "toxic-tokens")
    part = F.col("t") / (F.col("t") + F.col("c"))
    stems = tokens.where("stem <> 0").groupBy(F.col("stem").alias("key")).agg(F.sum(part).alias("t"), F.sum(1 - part).alias("c"))
    frequent = tokens.where(F.col("t") + F.col("c") / share >= LEAST_DOCS)
    both = frequent.union(stems.select("key", F.lit(0).cast("long").alias("stem"), "t", "c").where(F.col("t") + F.col("c") >= LEAST_DOCS))
    telling = both.orderBy(F.desc(F.pow(F.col("t") - F.col("c"), 2) / (F.col("t") + F.col("c"))), "key", "stem").limit(most)
    rows = telling.toPandas()
    keys, over = (rows[k].to_numpy(np.int64).view(np.uint64) for k in ("key", "stem"))
    t, c = rows["t"].to_numpy(float), rows["c"].to_numpy(float)
    odds = np.log((t + PRIOR) / (c + PRIOR))
    top = np.flatnonzero(over == 0)
    top = top[np.argsort(keys[top], kind="stable")]
    at = top[np.minimum(np.searchsorted(keys[top], over), len(top) - 1)] if len(top) else np.zeros(len(keys), np.int64)
    prior = np.where((over != 0) & (keys[at] == over), odds[at], 0.0) if len(keys) else odds
    odds = np.log((t + PRIOR * np.exp(prior / 2)) / (c + PRIOR * np.exp(-prior / 2)))
    keys, first = np.unique(keys, return_index=True)
    return keys, odds[first]


def segments_of(batch_text: pa.Array, model: Model) -> Iterator[tuple[int, int, int, int, tuple[np.ndarray, np.ndarray, np.ndarray], Words]]:
    """(row, tokens, first token, offset of the row's bytes, segments, words) of each text."""
    data, bounds = text_buffers(batch_text)
    for i, j in byte_slices(bounds):
        words = tokens_of(data, bounds[i : j + 1])
        score = model.scores(words)
        some = np.concatenate(([0], np.cumsum(score > 0)))
        for r, (a, b) in enumerate(zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True)):
            found = maximal_segments(score[a:b]) if some[b] > some[a] else (np.zeros(0), np.zeros(0, np.int64), np.zeros(0, np.int64))
            yield i + r, b - a, a, int(bounds[i + r] - bounds[i]), found, words


def calibrate(texts: DataFrame, model: Model) -> None:
    """Fits ``rate``, ``k`` and ``curve`` of the model on ``texts`` (text, toxic)."""
    shared = texts.sparkSession.sparkContext.broadcast(model)

    def bins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, total = shared.value, np.zeros(0, np.int64)
        edges = np.zeros(0, np.int64)
        for batch in batches:
            data, bounds = text_buffers(batch.column(0))
            for i, j in byte_slices(bounds):
                at = np.round(m.scores(tokens_of(data, bounds[i : j + 1])) / BIN).astype(np.int64)
                edges, inverse = np.unique(np.concatenate((edges, at)), return_inverse=True)
                total = np.bincount(inverse, np.concatenate((total, np.ones(len(at)))), minlength=len(edges)).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(edges, pa.int64()), pa.array(total, pa.int64())], names=["at", "n"])

    got = texts.where("toxic = 0").select("text").mapInArrow(bins, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).collect()  # a few hundred bins
    score, n = (np.array([r[k] for r in got], np.float64) for k in ("at", "n"))
    score *= BIN
    if len(n) and (score > 0).any() and (score * n).sum() < 0:
        low, high = 0.0, 1.0
        while high < 64 and (n * np.exp(np.minimum(high * score, 600))).sum() < n.sum():
            high *= 2
        for _ in range(60):
            middle = (low + high) / 2
            low, high = (middle, high) if (n * np.exp(np.minimum(middle * score, 600))).sum() < n.sum() else (low, middle)
        model.rate = (low + high) / 2
    shared = texts.sparkSession.sparkContext.broadcast(model)

    def tops(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            mark = batch.column(1)
            rows = [(mark[r].as_py(), m, found[0].tolist()) for r, m, _, _, found, _ in segments_of(batch.column(0), shared.value)]
            columns = list(zip(*rows, strict=True)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.list_(pa.float64()))], names=["toxic", "m", "best"])

    every = stage(texts.select("text", "toxic").mapInArrow(tops, "toxic int, m long, best array<double>"), "toxic-segments")
    best = F.coalesce(F.array_max("best"), F.lit(0.0))
    clean, chance = every.where("toxic = 0 AND m > 0").agg(F.count("*"), F.sum(F.col("m") * F.exp(-model.rate * best))).first()
    if clean:
        model.k = float((clean + 1) / (chance + 1))
    over = F.transform("best", lambda s: s * model.rate - F.log(F.lit(model.k) * F.greatest("m", F.lit(1))))
    sure = F.filter(over, lambda s: s >= -float(np.log(E_VALUE)))
    rows = every.select("toxic", F.aggregate(sure, F.lit(0.0), lambda a, b: a + b).alias("evidence")).collect()  # of the sample
    y, evidence = np.array([r["toxic"] for r in rows], float), np.array([r["evidence"] for r in rows], float)
    z = np.column_stack((np.ones(len(y)), evidence > 0, np.log1p(evidence)))
    w, ridge = np.zeros(3), np.diag([0.1, 0.1, 0.1])
    for _ in range(50):  # Newton steps
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + ridge, z.T @ (p - y) + ridge @ w)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    model.curve = (float(w[0]), float(w[1]), max(float(w[2]), 0.0))


def fit(docs: DataFrame, labels: DataFrame, sample: int = 20_000, most: int = 100_000) -> Model:
    """Model of ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic)."""
    texts = draw(docs, toxic_marks(labels), sample)
    model = Model(*count_tokens(texts.where("part <> 0"), most))
    if len(model.keys):
        calibrate(texts.where("part = 0"), model)
    else:
        n, toxic = texts.agg(F.count("*"), F.sum("toxic")).first()
        share = min(max((toxic or 0) / n, 1e-9), 1 - 1e-9) if n else 1e-9
        model.curve = (float(np.log(share / (1 - share))), 0.0, 0.0)
    return model


PASSAGE = "array<struct<start: int, stop: int, log_odds: double, e_value: double>>"


def find_passages(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """Columns ``keep``, ``score`` and ``passages``: the significant ones of each text with
    their first and last byte + 1, log-odds and expected number by chance."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    passage = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("log_odds", pa.float64()), ("e_value", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            texts = batch.column(len(keep))
            evidence, passages = np.zeros(len(texts)), [[] for _ in range(len(texts))]
            for r, n, a, base, (total, first, stop), words in segments_of(texts, m):
                if not len(total):
                    continue
                over = m.surprise(total, n)
                sure = np.flatnonzero(over >= -np.log(E_VALUE))
                evidence[r] = over[sure].sum()
                passages[r] = [
                    {"start": int(words.start[a + first[s]]) - base, "stop": int(words.end[a + stop[s] - 1]) - base, "log_odds": float(total[s]), "e_value": float(np.exp(-over[s]))}
                    for s in sure
                ]
            kept = [batch.column(c) for c in range(len(keep))]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(m.probability(evidence)), pa.array(passages, passage)], names=[*keep, "score", "passages"])

    schema = "".join(f"`{c}` {kinds[c]}, " for c in keep)
    return docs.select(*keep, "text").mapInArrow(run, f"{schema}score double, passages {PASSAGE}")


def learning_row(column: str = "doc_id") -> Column:
    """Rows that labels may be learned from."""
    return F.coalesce(remainder(column, 4) != 2, F.lit(True))


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(learning_row())
    scored = find_passages(docs, fit(docs, labels), ["doc_id"])
    return scored.select("doc_id", (~learning_row()).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"), F.size("passages").alias("n_passages"))
