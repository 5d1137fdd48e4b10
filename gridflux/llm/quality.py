"""Quality classifier: document evidence with host and path posteriors.

A logistic classifier on whole texts (shares of character classes, word
statistics, presence of telling words and beginnings of words, which languages with
many endings need) gives each document a log-likelihood
ratio.  Sites are a hierarchy: all documents, hosts (``source``), paths
(``source`` and ``lang``).  A site's count of good documents is the sum of its
documents' probabilities, labelled ones counting as their label; Beta priors
fitted by the method of moments shrink a sparse path towards its host and a
sparse host towards the global mean.  The posterior of a document is its
evidence plus the logit of its path's posterior mean; documents below the
threshold are rejected.

A document is good if its label says quality 1 and not toxic.  The classifier
is fitted on all labelled documents (of each id one row): words are counted by Spark,
and Spark ML's logistic regression adds up its gradients over all of them; site
statistics and scores cover all documents.

Defined cases: a null or empty text has the evidence of a text without words
and is rejected; a null source or language is a site of its own; repeated rows
count and are kept as often as they come; labels that disagree for one id count
as bad; without labels of both kinds the evidence is 0 and nothing but empty
texts is rejected.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridflux.llm.common import byte_slices, find_words, stage, table, text_buffers, tucked

SHAPE, PREFIX = 14, 4
#: Labelled ids that are broadcast to find their texts.
MOST_MARKS = 2_000_000


def _classes() -> np.ndarray:
    """Byte classes: 0 lower letter, 1 upper letter, 2 digit, 3 space, 4 common
    punctuation, 5 other symbol, 6 byte of a multi-byte letter."""
    out = np.full(256, 5, np.int64)
    out[97:123], out[65:91], out[48:58] = 0, 1, 2
    out[[9, 10, 11, 12, 13, 32]] = 3
    out[[ord(c) for c in ".,;:'\"-()?"]] = 4
    out[128:] = 6
    return out


CLASSES = _classes()


@dataclass
class Evidence:
    """Logistic regression; ``vocabulary`` holds word hashes, sorted."""

    vocabulary: np.ndarray
    weights: np.ndarray
    bias: float

    def score(self, x: np.ndarray) -> np.ndarray:
        return x @ self.weights + self.bias


def features(data: np.ndarray, bounds: np.ndarray, vocabulary: np.ndarray) -> np.ndarray:
    """Shape features, then for each word of the vocabulary whether the text has it."""
    n = len(bounds) - 1
    words = find_words(data, bounds, PREFIX)
    rel = bounds - bounds[0]
    row = np.repeat(np.arange(n), np.diff(rel))
    kinds = np.bincount(row * 7 + CLASSES[data[int(bounds[0]) : int(bounds[-1])]], minlength=7 * n).reshape(n, 7)
    size = np.maximum(np.diff(rel), 1)[:, None]
    count = np.diff(words.first)
    length = words.end - words.start
    of = np.repeat(np.arange(n), count)
    some = np.maximum(count, 1)
    mean = np.bincount(of, length, minlength=n) / some
    spread = np.sqrt(np.maximum(np.bincount(of, length**2, minlength=n) / some - mean**2, 0))
    first = np.lexsort((words.hash, of))
    sorted_hash, sorted_of = words.hash[first], of[first]
    fresh = np.ones(len(first), bool)
    fresh[1:] = (sorted_hash[1:] != sorted_hash[:-1]) | (sorted_of[1:] != sorted_of[:-1])
    distinct = np.bincount(sorted_of[fresh], minlength=n) / some
    again = np.zeros(n)
    if len(of) > 1:
        same = (words.hash[1:] == words.hash[:-1]) & (of[1:] == of[:-1])
        again = np.bincount(of[1:][same], minlength=n) / some
    short = np.bincount(of[length == 1], minlength=n) / some
    shape = np.column_stack((kinds / size, np.log1p(count), mean, spread, distinct, again, short, count == 0)).astype(np.float64)
    out = np.zeros((n, SHAPE + len(vocabulary)))
    out[:, :SHAPE] = shape
    for some in (words.hash, words.prefix) if len(vocabulary) else ():
        at = np.minimum(np.searchsorted(vocabulary, some), len(vocabulary) - 1)
        hit = vocabulary[at] == some
        out[of[hit], SHAPE + at[hit]] = 1.0
    return out


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row an id: 1 for good, 0 for bad."""
    good = (F.coalesce("quality", F.lit(1)) == 1) & (F.coalesce("toxic", F.lit(0)) == 0)
    known = labels.where("doc_id IS NOT NULL AND (quality IS NOT NULL OR toxic IS NOT NULL)")
    return known.groupBy("doc_id").agg(F.min(good.cast("int")).alias("good"))


def fit_evidence(docs: DataFrame, labels: DataFrame, sample: int | None = None, words: int = 600, steps: int = 300, ridge: float = 1e-3) -> Evidence | None:
    """The classifier from all labelled documents, or from about ``sample`` of them."""
    marks = labelled(docs, labels)
    if sample is not None:
        total = marks.count()
        marks = marks.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int((1 << 30) * min(1.0, sample / max(1, total))))
    marks = stage(marks, "quality-marks")
    if marks.count() <= MOST_MARKS:  # else Spark shuffles the texts
        marks = F.broadcast(marks)
    rows = docs.select("doc_id", "text").join(marks, "doc_id")
    # Of several rows with one id one counts.
    rows = rows.groupBy("doc_id").agg(F.min_by("text", F.xxhash64("text")).alias("text"), F.max("good").alias("good"))

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Distinct hashes of words and their beginnings of each text, and its shape."""
        for batch in batches:
            data, bounds = text_buffers(batch.column(0))
            shapes, vocab = [], []
            for i, j in byte_slices(bounds):
                shapes += [x.tobytes() for x in features(data, bounds[i : j + 1], np.zeros(0, np.uint64))]
                w = find_words(data, bounds[i : j + 1], PREFIX)
                for a, b in zip(w.first[:-1], w.first[1:], strict=True):
                    both = np.unique(np.concatenate((w.hash[a:b], w.prefix[a:b])))
                    vocab.append(both[both != 0].tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(shapes, pa.binary()), pa.array(vocab, pa.binary()), batch.column(1)], names=["shape", "vocab", "good"])

    got = stage(rows.select("text", "good").mapInArrow(gather, "shape binary, vocab binary, good int"), "quality-rows")
    n1, n0 = got.agg(F.count_if(F.col("good") == 1), F.count_if(F.col("good") == 0)).first()
    if not n1 or not n0:
        return None
    vocabulary = telling_words(got, n1, n0, words)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 1024):
                some = batch.slice(i, 1024)
                x = np.zeros((some.num_rows, SHAPE + len(vocabulary)))
                for k, (shape, vocab) in enumerate(zip(some.column(0).to_pylist(), some.column(1).to_pylist(), strict=True)):
                    x[k, :SHAPE] = np.frombuffer(shape, np.float64)
                    x[k, SHAPE:] = np.isin(vocabulary, np.frombuffer(vocab, np.uint64))
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32()), pa.array(x.ravel()))
                yield pa.RecordBatch.from_arrays([lists, some.column(2)], names=["x", "good"])

    # Balanced: the prior enters through the sites.
    weight = F.when(F.col("good") == 1, 0.5 * (n1 + n0) / n1).otherwise(0.5 * (n1 + n0) / n0)
    data = got.mapInArrow(vectors, "x array<double>, good int").select(array_to_vector("x").alias("x"), F.col("good").cast("double").alias("good"), weight.alias("weight"))
    model = LogisticRegression(featuresCol="x", labelCol="good", weightCol="weight", regParam=ridge, maxIter=steps, tol=1e-8).fit(data)
    return Evidence(vocabulary, model.coefficients.toArray(), float(model.intercept))


def telling_words(got: DataFrame, n1: int, n0: int, most: int) -> np.ndarray:
    """Hashes of the words whose document frequency differs most between the kinds."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = [np.frombuffer(x, np.uint64) for x in batch.column(0).to_pylist()]
            good = np.repeat(np.array(batch.column(1).to_pylist(), np.int64), [len(h) for h in hashes])
            distinct, inverse, df = np.unique(np.concatenate(hashes), return_inverse=True, return_counts=True)
            of_good = np.bincount(inverse, good, minlength=len(distinct)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(distinct.view(np.int64)), pa.array(of_good), pa.array(df.astype(np.int64) - of_good)], names=["word", "a", "b"])

    counts = got.select("vocab", "good").mapInArrow(count, "word long, a long, b long").groupBy("word").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    p1, p0 = (F.col("a") + 0.5) / (n1 + 1), (F.col("b") + 0.5) / (n0 + 1)
    telling = F.abs(p1 - p0) / F.sqrt(p1 * (1 - p1) / n1 + p0 * (1 - p0) / n0)
    found = counts.where(F.col("a") + F.col("b") >= 5).select("word", telling.alias("telling")).where("telling > 3")
    picked = found.orderBy(F.desc("telling"), "word").limit(most).collect()
    return np.sort(np.array([r["word"] for r in picked], np.int64).view(np.uint64))


def with_evidence(docs: DataFrame, model: Evidence | None) -> DataFrame:
    """``docs`` with ``evidence`` (log-likelihood ratio) and ``has_words``."""
    keep = [c for c in docs.columns if c not in ("evidence", "has_words")]
    at = keep.index("text")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            data, bounds = text_buffers(batch.column(at))
            score, some = [np.zeros(0)], [np.zeros(0, bool)]
            for i, j in byte_slices(bounds):
                x = features(data, bounds[i : j + 1], m.vocabulary if m else np.zeros(0, np.uint64))
                some.append(x[:, SHAPE - 1] == 0)
                score.append(m.score(x) if m else np.zeros(j - i))
            kept = [batch.column(k) for k in range(len(keep))]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(np.concatenate(score)), pa.array(np.concatenate(some))], names=[*keep, "evidence", "has_words"])

    kinds = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    return docs.select(*keep).mapInArrow(run, ", ".join(f"`{c}` {kinds[c]}" for c in keep) + ", evidence double, has_words boolean")


def _logit(p: Column) -> Column:
    return F.log(p / (1 - p))


def site_posteriors(scored: DataFrame, labels: DataFrame) -> DataFrame:
    """(source, lang, path_mean): posterior share of good documents of each path.

    ``scored`` has doc_id, source, lang, evidence.  All sums are grouped
    aggregates with map-side partials, so a host with a third of all documents
    is one partial row a task.
    """
    marks = labelled(scored, labels)
    share, low, high = marks.agg(F.avg("good"), F.min("good"), F.max("good")).first()
    if low == high:  # nothing to tell good from bad by
        return scored.select("source", "lang", F.lit(0.5).alias("path_mean")).distinct()
    share = min(0.99, max(0.01, share))
    prior = float(np.log(share / (1 - share)))
    p = 1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), F.col("evidence") + prior))))
    rows = scored.select("doc_id", "source", "lang", p.alias("p")).join(marks, "doc_id", "left")
    value = F.coalesce(F.col("good").cast("double"), "p")
    paths = stage(rows.groupBy("source", "lang").agg(F.sum(value).alias("k"), F.count("*").alias("n")), "paths")
    hosts = paths.groupBy("source").agg(F.sum("k").alias("k"), F.sum("n").alias("n"))
    k, n, groups = hosts.agg(F.sum("k"), F.sum("n"), F.count("*")).first()
    if not groups:
        return paths.select("source", "lang", F.lit(0.5).alias("path_mean"))
    mean = (k + 1) / (n + 2)
    spread = hosts.agg(F.avg(F.pow(F.col("k") / F.col("n") - mean, 2))).first()[0]
    s_host = prior_weight(spread, mean, n, groups)
    hosts = hosts.select(F.col("source").alias("host"), ((F.col("k") + s_host * mean) / (F.col("n") + s_host)).alias("host_mean"))
    joined = paths.join(hosts, F.col("source").eqNullSafe(F.col("host")))
    spread, mean, n, groups = joined.agg(
        F.avg(F.pow(F.col("k") / F.col("n") - F.col("host_mean"), 2)), F.avg("host_mean"), F.sum("n"), F.count("*")
    ).first()
    s_path = prior_weight(spread, mean, n, groups)
    posterior = (F.col("k") + s_path * F.col("host_mean")) / (F.col("n") + s_path)
    return joined.select("source", "lang", F.greatest(F.lit(0.01), F.least(F.lit(0.99), posterior)).alias("path_mean"))


def prior_weight(spread: float, mean: float, n: int, groups: int) -> float:
    """Beta prior's weight by the method of moments, mean (1 - mean) / variance - 1,
    of the variance between groups without that of their counts."""
    between = max(spread - mean * (1 - mean) * groups / n, 1e-4)
    return max(1.0, min(1e4, mean * (1 - mean) / between - 1))


def judge(scored: DataFrame, sites: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Adds ``site_mean``, ``quality_score`` and ``accepted``."""
    sites = sites.select(F.col("source").alias("site_source"), F.col("lang").alias("site_lang"), F.col("path_mean").alias("site_mean"))
    same = F.col("source").eqNullSafe(F.col("site_source")) & F.col("lang").eqNullSafe(F.col("site_lang"))
    joined = scored.join(sites, same, "left").drop("site_source", "site_lang")
    total = F.greatest(F.lit(-30.0), F.least(F.lit(30.0), F.col("evidence") + _logit(F.coalesce("site_mean", F.lit(0.5)))))
    p = F.when(F.col("has_words"), 1 / (1 + F.exp(-total))).otherwise(0.0)
    return joined.withColumn("quality_score", p).withColumn("accepted", F.col("quality_score") >= threshold)


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Accepted rows; their own columns.  Only the narrow evidence of all rows is written,
    for the sites' statistics; texts are scored again as they are judged."""
    inner, back = tucked(docs, ["doc_id", "text", "source", "lang"])
    model = fit_evidence(inner, labels)
    narrow = with_evidence(inner.select("doc_id", "text", "source", "lang"), model).drop("text")
    sites = stage(site_posteriors(stage(narrow, "quality"), labels), "sites")
    return back(judge(with_evidence(inner, model), sites).where("accepted"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    labels = table(spark, sf_dir, "labels")
    scored = with_evidence(docs, fit_evidence(docs, labels)).drop("text")
    scored = stage(scored, "quality")
    sites = stage(site_posteriors(scored, labels), "sites")
    return judge(scored, sites).select("doc_id", "source", "lang", "evidence", "site_mean", "quality_score", "accepted")
