"""Toxicity: segments by definition, held-out accuracy, planted passages, edges."""

import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridflux.llm import toxicity

SF = "/root/testdata/sf0.01"


def by_definition(score):
    """Maximal segments: the best one, then those of what is left on both sides."""

    def split(a, b):
        best = (0.0, None)
        for i in range(a, b):
            total = 0.0
            for j in range(i, b):
                total += score[j]
                if total > best[0] + 1e-12:
                    best = (total, (i, j + 1))
        if best[1] is None:
            return []
        i, j = best[1]
        return [*split(a, i), best[0], *split(j, b)]

    return split(0, len(score))


def test_maximal_segments():
    rng = np.random.default_rng(0)
    for _ in range(400):
        score = rng.normal(-0.3, 1, rng.integers(0, 25))
        total, first, stop = toxicity.maximal_segments(score)
        assert np.allclose(total, by_definition(score)) and np.allclose(total, [score[a:b].sum() for a, b in zip(first, stop, strict=True)])
        assert (first[1:] >= stop[:-1]).all()


def test_maximal_segments_of_a_long_text():
    """Linear: rising and falling runs that a scan without memory would search again."""
    score = np.tile([1.0, -0.5], 100_000)
    assert np.isclose(toxicity.maximal_segments(score)[0].max(), 50_000.5)
    assert len(toxicity.maximal_segments(np.tile([0.5, -1.0], 100_000))[0]) == 100_000


def quality(rows, marks):
    seen = [(r, marks[r.doc_id]) for r in rows if r.doc_id in marks]
    hit = sum(r.predicted for r, y in seen if y)
    scores = sorted((r.score, y) for r, y in seen)
    ranks = [k for k, (_, y) in enumerate(scores, 1) if y]
    n1, n0 = len(ranks), len(scores) - len(ranks)
    return hit / n1, sum(1 - r.predicted for r, y in seen if not y) / n0, (sum(ranks) - n1 * (n1 + 1) / 2) / (n1 * n0)


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    got = toxicity.op12_toxicity(spark, sf).collect()
    assert len(got) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    marks = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").groupBy("doc_id").agg(F.max("toxic").alias("toxic")).collect()}
    caught, left, area = quality([r for r in got if r.held_out], marks)
    assert caught >= 0.85 and left >= 0.97 and area >= 0.95


def test_held_out_labels_and_columns_are_not_inputs(spark, tmp_path):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    docs.withColumn("lang", F.lit("xx")).withColumn("source", F.col("doc_id").cast("string")).write.parquet(f"{tmp_path}/documents.parquet")
    labels.withColumn("toxic", F.when(toxicity.learning_row(), F.col("toxic")).otherwise(1 - F.col("toxic"))).write.parquet(f"{tmp_path}/labels.parquet")
    a, b = ({r.doc_id: round(r.score, 12) for r in toxicity.op12_toxicity(spark, d).collect()} for d in (SF, str(tmp_path)))
    assert a == b


@pytest.fixture(scope="module")
def planted(spark):
    """Invented prose with insults, some of them with an unseen ending of a seen stem."""
    rng = random.Random(5)
    calm = ["".join(rng.choice("aeiou") + rng.choice("lmnrst") for _ in range(rng.randrange(1, 4))) for _ in range(300)]
    insult = [f"grmpf{a}{b}" for a in "aeiou" for b in ("", "k", "st", "nz", "rd", "lb")]
    rows, marks = [], []
    for i in range(900):
        text = [rng.choice(calm) for _ in range(rng.randrange(20, 200))]
        bad = i % 6 == 0
        if bad:
            at = rng.randrange(len(text))
            text[at:at] = [x for _ in range(4) for x in (rng.choice(insult), rng.choice(calm))]
        rows.append((i, " ".join(text).capitalize() + "."))
        marks.append((i, int(bad)))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(marks, "doc_id long, toxic int"), calm


def test_planted_passages_and_stems(spark, planted):
    docs, labels, calm = planted
    model = toxicity.fit(docs, labels)
    text = "é " + " ".join(calm[:80]) + ". Grmpfel you grmpfund, GRMPFYX! " + " ".join(calm[80:160])
    clean = " ".join(calm[:160]) + " 12 ### " + " ".join([calm[0]] * 400)
    got = {r.k: r for r in toxicity.find_passages(spark.createDataFrame([(1, text), (2, clean), (3, text.replace("Grmpfel", "Grmpfel grmpfa grmpfok grmpfist grmpfunz grmpferd") + clean * 30)], "k int, text string"), model, ["k"]).collect()}
    (passage,) = got[1].passages
    found = text.encode()[passage.start : passage.stop].decode()
    assert found.startswith("Grmpfel") and "grmpfund" in found and passage.e_value <= toxicity.E_VALUE and got[1].score >= 0.3
    assert not got[2].passages and got[2].score < 0.1
    assert len(got[3].passages) == 1 and got[3].passages[0].start == passage.start  # chance grows with the text, the place stays


def test_every_passage_is_found(spark, planted):
    docs, labels, calm = planted
    model = toxicity.fit(docs, labels)
    text = " ".join(w for k in range(5) for w in [*calm[k * 50 : k * 50 + 50], "grmpfa", "grmpfok", "grmpfist"])
    (r,) = toxicity.find_passages(spark.createDataFrame([(1, text)], "k int, text string"), model, ["k"]).collect()
    assert len(r.passages) == 5


def test_toxicity_edges(spark, planted):
    docs, labels, _ = planted
    rows = [(1, None, "a"), (2, "", "b"), (3, " 12 ## ", "c"), (None, "grmpfa grmpfok grmpfist", None), (5, "grmpfa " * 50_000, "d"), (5, "grmpfa " * 50_000, "d")]
    edge = spark.createDataFrame(rows, "doc_id long, text string, passages string")
    model = toxicity.fit(docs.union(edge.select("doc_id", "text")), labels.union(spark.createDataFrame([(None, 1), (1, None), (6, 1), (6, 0)], labels.schema)))
    got = toxicity.find_passages(edge, model, ["doc_id"]).collect()
    assert len(got) == 6 and all(0 <= r.score <= 1 for r in got)
    score = {r.doc_id: r.score for r in got}
    assert score[1] == score[2] == score[3] < score[None]
    assert len({r.score for r in got if r.doc_id == 5}) == 1
    assert toxicity.find_passages(edge.where("false"), model, ["doc_id"]).count() == 0
    for some, share in (("false", 0.0), ("toxic = 0", 0.0), ("toxic = 1", 1.0)):  # labels of no or of one kind
        flat = toxicity.fit(docs, labels.where(some))
        assert {round(r.score, 3) for r in toxicity.find_passages(edge, flat, ["doc_id"]).collect()} == {share}
    assert toxicity.fit(docs.where("false"), labels).keys.size == 0


def test_calibration_is_of_extreme_values(spark, planted):
    """Chance segments of clean texts: about E_VALUE of them hold a significant one."""
    docs, labels, calm = planted
    model = toxicity.fit(docs, labels)
    rng = random.Random(8)
    fresh = spark.createDataFrame([(i, " ".join(rng.choice(calm) for _ in range(150))) for i in range(300)], "k int, text string")
    share = toxicity.find_passages(fresh, model, ["k"]).agg(F.avg((F.size("passages") > 0).cast("int"))).first()[0]
    assert share <= 5 * toxicity.E_VALUE and math.isfinite(model.rate) and model.rate > 0 and model.k > 0
