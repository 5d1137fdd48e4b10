"""Whitening and hard negatives against brute force and on edge cases."""

import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from gridflux.llm import negatives, whitening
from gridflux.llm.vectors import fixed_points

SF = "/root/testdata/sf0.001"
NAN, INF = float("nan"), float("inf")


@pytest.fixture(scope="module")
def vectors(spark):
    """Nulls in each column, bad entries, ties, repeats, short rows, and extra columns."""
    rng = random.Random(1)
    rows = [(i, [rng.randrange(-8, 9) / 16 for _ in range(6)], i % 3, float(i), "x", 7) for i in range(400)]
    rows += [rows[k] for k in (0, 50, 60, 60, 60)]  # repeated rows
    rows += [(400 + i, rows[i][1], i % 3, 0.0, "y", 7) for i in range(60)]  # equal vectors, other ids
    rows += [(900, None, 1, 0.0, None, 7), (950, [0.5, None, 0.1, 0.0, 0.0, 0.0], 1, 0.0, None, 7), (951, [NAN] * 6, 1, 0.0, None, 7), (952, [INF, 0.0, 0.0, 0.0, 0.0, 0.0], 2, 0.0, None, 7)]
    rows += [(953, [0.25, 0.5], 1, 0.0, None, 7), (1000, [0.25, -0.5], None, 0.0, None, 7), (None, [0.1] * 6, 1, 0.0, None, 7), (954, [], 0, 0.0, None, 7), (955, [1e300, 0.0], 0, 0.0, None, 7)]
    schema = "vec_id long, embedding array<double>, label int, score double, whitened string, block int"
    return spark.createDataFrame(rows, schema).repartition(3)


def grid(rows, scale, dims):
    """Fixed-point vectors of the rows that take part."""
    out = []
    for r in rows:
        e = r["embedding"]
        if e is None or any(x is None or not math.isfinite(x) or abs(x) > 1e9 for x in e):
            continue
        out.append((r, [math.floor(scale * x) for x in e] + [0] * (dims - len(e))))
    return out


# 11 whitening


def test_singular_values_and_directions():
    rng = np.random.default_rng(0)
    q, _ = np.linalg.qr(rng.standard_normal((40, 40)))
    w21 = np.diag(np.abs(np.arange(-10, 11)).astype(float)) + np.diag(np.ones(20), 1) + np.diag(np.ones(20), -1)
    cases = [rng.standard_normal((500, 64)), rng.standard_normal((3, 20)), np.vstack([np.eye(16)] * 3) - 1 / 16, (q * np.repeat([3, 2, 1, 0.5], 10)) @ q.T]
    cases += [(q * np.repeat([3, 3 - 1e-9, 1, 1e-5], 10)) @ q.T, (q * 10.0 ** -np.arange(40)) @ q.T, np.outer(rng.standard_normal(9), rng.standard_normal(5)), np.linalg.cholesky(w21 + 3 * np.eye(21)).T, np.ones((4, 1))]
    for m in cases:
        values, z, every = whitening.directions(np.linalg.qr(m, mode="r"), 8)
        want = np.linalg.svd(m, compute_uv=False) ** 2
        k = len(values)
        assert k == min(8, int((want > 1e-20 * want[0]).sum()))
        assert np.allclose(values, want[:k], rtol=1e-9, atol=1e-13 * want[0]) and np.allclose(every[: len(want)], want, atol=1e-12 * want[0])
        assert np.abs(z.T @ z - np.eye(k)).max() < 1e-10 and np.abs(m.T @ (m @ z) - z * values).max() < 1e-12 * want[0]
    assert whitening.directions(np.zeros((4, 3)), 8)[1].shape == (3, 0) and whitening.directions(np.zeros((0, 0)), 8)[1].shape == (0, 0)


def test_dqds_to_high_relative_accuracy():
    """Values of a graded bidiagonal that a method in plain doubles would lose."""
    from fractions import Fraction

    a, b = [1.0, 1e-3, 1e-6, 1e-9], [1e-2, 1e-5, 1e-8]
    got = whitening.dqds(np.array(a) ** 2, np.array(b) ** 2)
    fa, fb = [Fraction(x) for x in a], [Fraction(x) for x in b]
    tri = [[fa[i] ** 2 + (fb[i - 1] ** 2 if i else 0) if i == j else fa[min(i, j)] * fb[min(i, j)] if abs(i - j) == 1 else Fraction(0) for j in range(4)] for i in range(4)]

    def below(x):
        """Eigenvalues less than x, by Sylvester's law in exact numbers."""
        n, d = 0, Fraction(1)
        for i in range(4):
            d = tri[i][i] - x - (tri[i][i - 1] ** 2 / d if i else 0)
            n += d < 0
        return n

    for k, v in enumerate(sorted(got)):
        assert below(Fraction(v) * (1 - Fraction(1, 10**13))) <= k < below(Fraction(v) * (1 + Fraction(1, 10**13)))


def check_whitening(got, x):
    n, dims = len(x), len(x[0])
    sums = [sum(r[i] for r in x) for i in range(dims)]
    centred = np.array([[(n * v - s) for v, s in zip(r, sums, strict=True)] for r in x], float) / n
    cov = centred.T @ centred / n
    e, v = np.linalg.eigh(cov)
    e, v = e[::-1][:8], v[:, ::-1][:, :8]
    deviations = [sum((n * v - s) ** 2 for v, s in zip(r, sums, strict=True)) for r in x]
    assert sorted(r.deviation for r in got if r.component == 1) == sorted(deviations)
    k = max(r.component for r in got)
    assert len(got) == n * k and {r.n for r in got} == {n} and {r.identity_error for r in got} == {got[0].identity_error} and 0 <= got[0].identity_error < 1e-9
    for c in range(k):
        mine = [r for r in got if r.component == c + 1]
        assert all(math.isclose(r.explained, e[c] / np.trace(cov), rel_tol=1e-9) for r in mine)
        want = np.abs(centred @ v[:, c]) / math.sqrt(e[c])
        gaps = [abs(e[c] - e[j]) for j in range(len(e)) if j != c]
        if min(gaps, default=1) > 1e-6 * e[0]:
            assert np.allclose(sorted(abs(r.whitened) for r in mine), sorted(want), atol=1e-8)


def test_whitening_query(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    got = whitening.op11_whitening(spark, SF).collect()
    x = [[math.floor(1024 * float(v)) + 100_000 for v in r.embedding] for r in rows]
    check_whitening(got, x)
    signs = {(r.vec_id, r.component): r.whitened for r in got}
    assert len(signs) == len(got)
    white = np.array([[signs[r.vec_id, c] for c in range(1, 9)] for r in rows])
    assert np.allclose(np.cov(white.T, bias=True), np.eye(8), atol=1e-9)  # one sign for all rows


def test_whitening_edges(spark, vectors, tmp_path):
    vectors.write.parquet(f"{tmp_path}/embeddings.parquet")
    got = whitening.op11_whitening(spark, str(tmp_path)).collect()
    kept = grid(vectors.collect(), 1024, 6)
    check_whitening(got, [[v + 100_000 for v in x] for _, x in kept])
    assert sorted(str(r.vec_id) for r in got if r.component == 1) == sorted(str(r.vec_id) for r, _ in kept)
    own = whitening.whiten(vectors, whitening.fit(vectors), ["vec_id", "score", "block"])
    assert own.columns == ["vec_id", "score", "block", "deviation", "whitened"] and own.count() == len(kept)
    for some in ("false", "vec_id = 5", "vec_id = 900", "vec_id = 954"):  # nothing, one row, none that counts, no dimensions
        part = tmp_path / some.replace(" ", "")
        vectors.where(some).write.parquet(f"{part}/embeddings.parquet")
        out = whitening.op11_whitening(spark, str(part))
        assert out.count() == 0 and [t for _, t in out.dtypes] == ["bigint", "int", "bigint", "bigint", "double", "double", "double"]


def test_whitening_in_many_tasks(spark, vectors):
    """The same factor however the rows are dealt."""
    few, many = (whitening.fit(vectors.repartition(n)) for n in (1, 40))
    assert few.centre == many.centre and np.allclose(few.values, many.values, rtol=1e-12)
    assert np.allclose(np.abs((few.vectors * many.vectors).sum(axis=0)), 1, atol=1e-9)


def test_exact_deviations():
    rng = random.Random(3)
    for most, n in ((50, 10), (1 << 38, 10), (1 << 38, 1 << 33)):
        x = [[rng.randrange(-most, most) for _ in range(5)] for _ in range(10)]
        sums = [sum(r[i] for r in x) + rng.randrange(n) - 7 for i in range(5)]
        got = whitening.Centre(n, sums).deviations(np.array(x, np.int64))
        want = [sum((n * v - s) ** 2 for v, s in zip(r, sums, strict=True)) for r in x]
        assert got == [v if v < 1 << 63 else None for v in want]


# 13 hard negatives


@pytest.mark.parametrize("sizes", [(1, 1, 1), (33, 64, 100), (257, 65, 1001), (0, 64, 5), (40, 64, 0), (100, 1, 50), (64, 130, 64)])
def test_strassen(sizes):
    rng = np.random.default_rng(sum(sizes))
    m, k, n = sizes
    for most in (300, 1 << 27):
        a, b = rng.integers(-most, most, (m, k)), rng.integers(-most, most, (k, n))
        assert np.array_equal(negatives.strassen(a, b), a @ b) and np.array_equal(negatives.strassen(a, b, 4), a @ b)


def test_heaps_of_columns():
    rng = np.random.default_rng(2)
    for n, spread, ids in ((40, 5, np.arange(40)), (40, 5, np.sort(rng.integers(0, 12, 40))), (30, 1 << 61, np.arange(30)), (3, 4, np.arange(3))):
        score, allowed = rng.integers(-spread, spread, (7, n)), rng.random((7, n)) < 0.6
        s, i = negatives.best(score, ids, allowed, 5)
        every = negatives.best(score, ids, allowed, 0, sort=True)
        for r in range(7):
            want = sorted({(-score[r, c], ids[c]) for c in range(n) if allowed[r, c]})
            assert [(-a, b) for a, b in zip(s[r], i[r], strict=True) if b != negatives.NONE] == want[:5]
            assert [(-a, b) for a, b in zip(every[0][r], every[1][r], strict=True) if b != negatives.NONE] == want


def brute_negatives(rows, dims, every=50):
    kept = {(r["vec_id"], label(r), tuple(x)) for r, x in grid(rows, 256, dims) if r["vec_id"] is not None and r["label"] is not None}
    out = []
    for a, kind, x in kept:
        if a % every:
            continue
        scores = sorted({(-sum(u * v for u, v in zip(x, y, strict=True)), b, other) for b, other, y in kept})
        positives = list(dict.fromkeys((s, b) for s, b, other in scores if other == kind and b != a))[:5]
        for s, b in positives:
            found = list(dict.fromkeys((t, c) for t, c, other in scores if other != kind and 50 * -s <= 100 * -t <= 95 * -s))[:3]
            out += [(a, b, rank, c, -s, -t) for rank, (t, c) in enumerate(found, 1)]
    return sorted(out)


def label(r):
    return (r["label"] + 1) % 10 if r["vec_id"] % 7 == 0 else r["label"]


def test_hard_negatives_query(spark):
    got = sorted(map(tuple, negatives.op13_hard_negatives(spark, SF).collect()))
    rows = pd.read_parquet(f"{SF}/embeddings.parquet").to_dict("records")
    assert got == brute_negatives([{**r, "embedding": [float(v) for v in r["embedding"]]} for r in rows], 64) and got


@pytest.mark.parametrize("small", [False, True])
def test_hard_negatives_edges(spark, vectors, tmp_path, monkeypatch, small):
    """Small blocks make many cells, whose heaps must merge to the same."""
    if small:
        monkeypatch.setattr(negatives, "ROWS", 16)
        monkeypatch.setattr(negatives, "ANCHORS", 3)
        monkeypatch.setattr(negatives, "CELL", 1)
    vectors.write.parquet(f"{tmp_path}/embeddings.parquet")
    got = [tuple(r) for r in negatives.op13_hard_negatives(spark, str(tmp_path)).collect()]
    want = brute_negatives(vectors.collect(), 6)
    assert sorted(got) == want and len(want) > 20
    out = negatives.mine(vectors.where("false"))
    assert out.count() == 0
    assert negatives.mine(vectors.where("vec_id % 50 <> 0")).count() == 0  # no anchors
    assert negatives.mine(vectors.where("label = 1 OR vec_id = 50").withColumn("label", F.lit(1))).count() == 0  # one label


def test_fixed_points_of_slices(spark):
    import pyarrow as pa

    col = pa.array([[9.0], [0.1, None], None, [0.5, -0.25], [], [INF], [1.0]], pa.list_(pa.float32())).slice(1)
    rows, x = fixed_points(col, 4)
    assert rows.tolist() == [2, 3, 5] and x.tolist() == [[2, -1], [0, 0], [4, 0]]
