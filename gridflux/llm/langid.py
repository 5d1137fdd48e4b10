"""Language ID: blended-spectrum presence kernels, Nystroem landmarks, kernel ridge.

A text is the set of its byte n-grams (n = 2, 3, 4 of the lower-cased UTF-8,
blended), each hashed to one of ``width`` cells; the kernel of two texts is the
number of cells that both have over the geometric mean of their own numbers.
Landmarks are learning texts; the Nystroem map takes kernel values against them
to features, one-versus-rest ridge regression is solved on these, and texts are
scored in batches by two matrix products (presence x landmarks x weights).

Learning uses all labelled texts (rows that repeat an id and text are one): tasks add
up the ridge regression's normal equations in fixed point, so that the sums depend on
the table alone, and count the texts that hold an n-gram.  The landmarks alone, the
map's basis, are about ``landmarks_per_lang`` texts of each language.  Every whole text
is scored.

``keep_known`` rejects texts that look like none of the languages: those of which a
smaller share of n-grams is usual in the predicted language (``COMMON`` of its learning
texts hold them) than in nearly all passages of their length, one from each learning
text; what is usual for a passage, the other texts of its language say.  Texts of fewer
than 31 characters are too short to tell.

Defined cases: a text that is null or has no letter (Unicode category L) is ``und`` with score 0;
with no learning rows every text is; ties go to the language first in
alphabetical order; repeated rows are all kept; rows with a null id are scored
as any other and count as not held out (their remainder is null).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridflux.llm.common import LOWER, byte_slices, stage, text_buffers, tucked

NGRAMS = (2, 3, 4)
WIDTH = 1 << 14
#: Share of a language's learning texts that hold a usual n-gram.
COMMON = 0.03
#: Steps of the shares of usual n-grams of which the quantiles are taken.
STEPS = 10_000
#: Numbers in a slice of the sums, and sums that one task adds up.
SLICE, FAN_IN = 1 << 13, 64
#: Languages whose shares are broadcast.
MOST_LANGS = 100_000
LETTER = regex.compile(r"\p{L}")


def remainder(id_col: str, divisor: int) -> Column:
    return F.crc32(F.encode(F.col(id_col).cast("string"), "UTF-8")) % divisor


def presence(data: np.ndarray, bounds: np.ndarray, width: int = WIDTH) -> np.ndarray:
    """Boolean matrix (rows x width) of the n-gram cells of each text."""
    n_rows = len(bounds) - 1
    out = np.zeros(n_rows * width, bool)
    lo, hi = int(bounds[0]), int(bounds[-1])
    buf = LOWER[data[lo:hi]].astype(np.uint32)
    rel = bounds - lo
    row = np.repeat(np.arange(n_rows, dtype=np.int64) * width, np.diff(rel))
    left = np.repeat(rel[1:], np.diff(rel)) - np.arange(hi - lo)  # bytes to the end of the row
    gram = buf.copy()
    for n in range(2, max(NGRAMS) + 1):
        m = hi - lo - n + 1
        if m <= 0:
            break
        gram = (gram[:m] << np.uint32(8)) | buf[n - 1 :]
        if n in NGRAMS:
            cell = (gram * np.uint32(2654435761) + np.uint32(n * 40503)) >> np.uint32(8)
            cell = (cell ^ (cell >> np.uint32(11))) % np.uint32(width)
            inside = left[:m] >= n
            out[(row[:m] + cell)[inside]] = True
    return out.reshape(n_rows, width)


@dataclass
class LanguageModel:
    langs: list[str]
    weights: np.ndarray  # (width, languages): landmarks times ridge weights
    bias: np.ndarray
    usual: np.ndarray | None = None  # (width, languages): 1 for the usual cells
    others: np.ndarray | None = None  # the same without one text that holds the cell

    def known(self, cells: np.ndarray, best: np.ndarray, own: np.ndarray | None = None) -> np.ndarray:
        """Share of each presence row's cells that is usual in the language ``best``; in
        the other texts of it for passages of its learning texts (``own``: their language)."""
        if self.usual is None:
            return np.ones(len(cells))
        at, real = np.arange(len(cells)), cells.astype(np.float32)
        shared = (real @ self.usual)[at, best]
        if own is not None:
            shared = np.where(own == best, (real @ self.others)[at, best], shared)
        return shared / np.maximum(cells.sum(axis=1), 1)

    def score(self, cells: np.ndarray) -> np.ndarray:
        """One-versus-rest scores of presence rows."""
        own = np.sqrt(np.maximum(cells.sum(axis=1), 1)).astype(np.float32)
        return (cells.astype(np.float32) @ self.weights) / own[:, None] + self.bias


def learning_rows(docs: DataFrame, per_lang: float | None = None) -> DataFrame:
    """All labelled rows that may be learned from, or for each language those with the
    smallest hashes of id and text, about ``per_lang`` by an estimated threshold.
    Repeated rows are one."""
    rows = docs.where("lang IS NOT NULL AND text IS NOT NULL").where(F.coalesce(remainder("doc_id", 3), F.lit(0)) != 1)
    rows = rows.select("doc_id", "lang", "text")
    if per_lang is not None:
        shares = stage(rows.groupBy("lang").agg((F.lit(float(per_lang)) / F.count("*")).alias("share")), "languages")
        if shares.count() <= MOST_LANGS:  # a row a language; beyond that Spark shuffles
            shares = F.broadcast(shares)
        spread = F.pmod(F.xxhash64("doc_id", "lang", "text"), F.lit(1 << 30)) / float(1 << 30)
        rows = rows.join(shares, "lang").where(spread < F.col("share")).select("doc_id", "lang", "text")
    return rows.dropDuplicates()


@dataclass
class Basis:
    """Landmarks as presence rows, and the bits of fixed-point kernel values."""

    langs: list[str]
    cells: np.ndarray
    bits: int

    @cached_property
    def land(self) -> np.ndarray:
        return self.cells.astype(np.float32).T

    @cached_property
    def own(self) -> np.ndarray:
        return np.sqrt(np.maximum(self.cells.sum(axis=1, dtype=np.float64), 1))

    def sizes(self) -> tuple[int, ...]:
        """Sums of: products of kernel values, these by language, texts by language
        and cell, texts by language."""
        m, k = len(self.cells), len(self.langs)
        return m * m, k * m, k * WIDTH, k

    def sums(self) -> np.ndarray:
        return np.zeros(sum(self.sizes()), np.int64)

    def split(self, sums: np.ndarray) -> list[np.ndarray]:
        m, k = len(self.cells), len(self.langs)
        parts = np.split(sums, np.cumsum(self.sizes())[:-1])
        return [x.reshape(d) for x, d in zip(parts, ((m, m), (k, m), (k, WIDTH), (k,)), strict=True)]

    def add(self, sums: np.ndarray, cells: np.ndarray, y: np.ndarray) -> None:
        """Adds presence rows of the languages numbered ``y``, a block at a time: sums of
        so few whole numbers are exact in doubles."""
        gram, by_lang, held, texts = self.split(sums)
        for i in range(0, len(cells), 64):
            some = cells[i : i + 64].astype(np.float32)
            size = np.sqrt(np.maximum(some.sum(axis=1, dtype=np.float64), 1))
            kernel = np.rint((some @ self.land).astype(np.float64) / np.outer(size, self.own) * float(1 << self.bits))
            of = (np.arange(len(self.langs))[:, None] == y[i : i + 64]).astype(np.float64)
            gram += (kernel.T @ kernel).astype(np.int64)
            by_lang += (of @ kernel).astype(np.int64)
            held += (of.astype(np.float32) @ some).astype(np.int64)
            texts += of.sum(axis=1).astype(np.int64)


def basis(cells: np.ndarray, lang_of: list[str], landmarks_per_lang: int, n: int) -> Basis:
    """Landmarks from presence rows, for sums of ``n`` rows."""
    langs = sorted(set(lang_of))
    y = np.array([langs.index(k) for k in lang_of])
    pick: list[int] = []
    for k in range(len(langs)):
        own = np.flatnonzero(y == k)
        pick += own[np.linspace(0, len(own) - 1, min(len(own), landmarks_per_lang)).astype(int)].tolist()
    return Basis(langs, cells[pick], min(23, (62 - n.bit_length()) // 2))


def learn(docs: DataFrame, landmarks_per_lang: int = 64, ridge: float = 1e-3) -> LanguageModel:
    return learn_rows(stage(learning_rows(docs), "language-rows"), landmarks_per_lang, ridge)


def learn_rows(rows: DataFrame, landmarks_per_lang: int = 64, ridge: float = 1e-3) -> LanguageModel:
    """The model of all ``rows``, which are distinct learning rows."""

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, bounds = text_buffers(batch.column(1))
            for i, j in byte_slices(bounds):
                bits = np.packbits(presence(data, bounds[i : j + 1]), axis=1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), pa.array([x.tobytes() for x in bits], pa.binary()), batch.column(2).slice(i, j - i)],
                    names=["lang", "cells", "doc_id"],
                )

    some = learning_rows(rows, 2 * landmarks_per_lang).select("lang", "text", "doc_id").mapInArrow(packed, "lang string, cells binary, doc_id long")
    found = sorted(some.collect(), key=lambda r: (r["lang"], r["cells"], r["doc_id"] or 0))  # candidates for landmarks
    if not found:
        return no_languages()
    cells_of = np.unpackbits(np.frombuffer(b"".join(r["cells"] for r in found), np.uint8).reshape(len(found), WIDTH // 8), axis=1)
    base = basis(cells_of, [r["lang"] for r in found], landmarks_per_lang, rows.count())
    return solve(base, summed(rows, base), ridge)


def summed(rows: DataFrame, base: Basis) -> np.ndarray:
    """``base``'s sums over all rows: by task, then in levels slice by slice."""
    shared = rows.sparkSession.sparkContext.broadcast(base)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = shared.value
        number = {k: i for i, k in enumerate(base.langs)}
        sums = base.sums()
        for batch in batches:
            data, bounds = text_buffers(batch.column(1))
            y = np.array([number.get(k, -1) for k in batch.column(0).to_pylist()])
            for i in range(0, len(y), 64):  # rows of a presence matrix
                j = min(i + 64, len(y))
                base.add(sums, presence(data, bounds[i : j + 1]), y[i:j])
        task = TaskContext.get().partitionId()
        parts = [sums[i : i + SLICE].tobytes() for i in range(0, len(sums), SLICE)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(len(parts)), pa.int32()), pa.array([task] * len(parts), pa.int32()), pa.array(parts, pa.binary())],
            names=["slice", "task", "sums"],
        )

    def add(group: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x.as_py(), np.int64) for x in group.column("sums"))
        return pa.table({
            "slice": group.column("slice").slice(0, 1), "task": pa.array([group.column("task")[0].as_py() // FAN_IN], pa.int32()),
            "sums": pa.array([total.tobytes()], pa.binary()),
        })

    kind = "slice int, task int, sums binary"
    parts = stage(rows.select("lang", "text").mapInArrow(run, kind), "language-sums")
    most = parts.agg(F.max("task")).first()[0]
    while most:
        parts, most = parts.groupBy("slice", F.floor(F.col("task") / FAN_IN).alias("meet")).applyInArrow(add, kind), most // FAN_IN
    got = sorted(parts.collect(), key=lambda r: r["slice"])  # a row a slice
    return np.frombuffer(b"".join(r["sums"] for r in got), np.int64)


def no_languages() -> LanguageModel:
    return LanguageModel([], np.zeros((WIDTH, 0), np.float32), np.zeros(0, np.float32))


def usual_cells(held: np.ndarray, texts: np.ndarray) -> np.ndarray:
    return ((held > 0) & (held >= COMMON * texts[:, None])).T.astype(np.float32)


def fit(cells: np.ndarray, lang_of: list[str], landmarks_per_lang: int = 64, ridge: float = 1e-3) -> LanguageModel:
    """Ridge regression on the Nystroem features of presence rows."""
    if not lang_of:
        return no_languages()
    base = basis(cells, lang_of, landmarks_per_lang, len(cells))
    sums = base.sums()
    base.add(sums, cells, np.array([base.langs.index(k) for k in lang_of]))
    return solve(base, sums, ridge)


def solve(base: Basis, sums: np.ndarray, ridge: float) -> LanguageModel:
    """The model from the sums over all learning rows."""
    gram, by_lang, held, texts = base.split(sums)
    land = base.cells.astype(np.float32) / np.sqrt(np.maximum(base.cells.sum(axis=1, dtype=np.float32), 1))[:, None]
    values, vectors = np.linalg.eigh((land @ land.T).astype(np.float64))
    good = values > 1e-6 * values.max()
    root = vectors[:, good] / np.sqrt(values[good])  # K_mm^-1/2 on its range
    n, unit = int(texts.sum()), float(1 << base.bits)
    cross = by_lang.T / unit
    centre, mean = root.T @ cross.sum(axis=1) / n, texts / n
    products = root.T @ (gram / unit**2) @ root - n * np.outer(centre, centre)
    solved = np.linalg.solve(products + ridge * n * np.eye(len(centre)), root.T @ cross - n * np.outer(centre, mean))
    weights = land.T @ (root @ solved)
    return LanguageModel(base.langs, weights.astype(np.float32), (mean - centre @ solved).astype(np.float32), usual_cells(held, texts), usual_cells(held - 1, texts - 1))


def predict(docs: DataFrame, model: LanguageModel, text_col: str = "text", own_col: str | None = None) -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` (softmax share of the best language) and
    ``known`` (share of the text's n-grams that are usual in it; for passages of learning
    texts, whose language ``own_col`` holds, in its other texts)."""
    keep = [c for c in docs.columns if c not in ("lang_pred", "score", "known")]
    at = keep.index(text_col)
    own_at = None if own_col is None else keep.index(own_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        number = {k: i for i, k in enumerate(m.langs)}
        for batch in batches:
            data, bounds = text_buffers(batch.column(at))
            own = None if own_at is None else np.array([number.get(k, -1) for k in batch.column(own_at).to_pylist()])
            pred, score, known = [], [], []
            for i, j in byte_slices(bounds, 1 << 18):
                letters = [LETTER.search(str(data[a:b].tobytes(), "utf-8")) is not None for a, b in zip(bounds[i:j], bounds[i + 1 : j + 1], strict=True)]
                for a in range(i, j, 64):  # rows of a presence matrix
                    b = min(a + 64, j)
                    if not m.langs:
                        pred += ["und"] * (b - a)
                        score += [0.0] * (b - a)
                        known += [0.0] * (b - a)
                        continue
                    cells = presence(data, bounds[a : b + 1])
                    s = m.score(cells).astype(np.float64)
                    best = s.argmax(axis=1)
                    share = m.known(cells, best, None if own is None else own[a:b])
                    e = np.exp(4 * (s - s.max(axis=1, keepdims=True)))
                    for k in range(b - a):
                        seen = letters[a - i + k]
                        pred.append(m.langs[best[k]] if seen else "und")
                        score.append(float(1 / e[k].sum()) if seen else 0.0)
                        known.append(float(share[k]) if seen else 0.0)
            kept = [batch.column(k) for k in range(len(keep))]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(pred, pa.string()), pa.array(score, pa.float64()), pa.array(known, pa.float64())], names=[*keep, "lang_pred", "score", "known"])

    fields = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    schema = ", ".join(f"`{c}` {fields[c]}" for c in keep) + ", lang_pred string, score double, known double"
    return docs.select(*keep).mapInArrow(run, schema)


SHORTEST, LONGEST = 4, 12


def length_class(n: Column) -> Column:
    """Powers of two of a text's length, up to 30 characters in one class, 4,096 and
    more in one."""
    return F.least(F.greatest(F.floor(F.log2(n + 1.0)), F.lit(SHORTEST)), F.lit(LONGEST)).cast("int")


def least_known(rows: DataFrame, model: LanguageModel, low: float = 0.01, share: float = 0.88) -> dict[int, float]:
    """By class of length the share of usual n-grams that a text of a known language
    reaches: ``share`` of the ``low`` quantile over passages of the class's least length,
    one from each of the learning ``rows`` that is so long, in steps of 1 / ``STEPS``.
    The class of the shortest, and one of fewer than 20 passages, ask for nothing."""
    size, h = F.length("text"), F.xxhash64("text")
    lengths = [1 << k for k in range(SHORTEST + 1, LONGEST + 1)]
    parts = F.array(*(F.when(size >= n, F.col("text").substr((F.pmod(h, size - n + 1) + 1).cast("int"), F.lit(n))) for n in lengths))
    passages = rows.select("lang", F.explode(parts).alias("text")).where("text IS NOT NULL")
    scored = predict(passages, model, own_col="lang").where("lang_pred <> 'und'")
    scored = scored.select(length_class(F.length("text")).alias("size"), F.floor(F.col("known") * STEPS).alias("step"))
    found = scored.groupBy("size", "step").agg(F.count("*").alias("n")).orderBy("size", "step").collect()  # eight classes of STEPS + 1 steps at most
    least = {}
    for size in {r["size"] for r in found}:
        steps, n = np.array([(r["step"], r["n"]) for r in found if r["size"] == size]).T
        if n.sum() >= 20:
            place = low * (n.sum() - 1)
            below, above = steps[np.searchsorted(n.cumsum(), [np.floor(place), np.ceil(place)], side="right")]
            least[size] = float(share * (below + (above - below) * (place % 1)) / STEPS)
    return least


def keep_known(docs: DataFrame, **params) -> DataFrame:
    """Rows with a language that the model knows; their own columns."""
    inner, back = tucked(docs, ["doc_id", "text", "lang"])
    rows = stage(learning_rows(inner), "language-rows")
    model = learn_rows(rows)
    asked = F.lit(0.0)
    for size, least in least_known(rows, model, **params).items():
        asked = F.when(length_class(F.length("text")) == size, least).otherwise(asked)
    return back(predict(inner, model).where((F.col("lang_pred") != "und") & (F.col("known") >= asked)))


def op5_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = learn(docs.select("doc_id", "lang", "text"))
    scored = predict(docs.select("doc_id", "text"), model)
    held = F.coalesce(remainder("doc_id", 3) == 1, F.lit(False))
    return scored.select("doc_id", held.alias("held_out"), "lang_pred", "score")

