"""Joint forests with out-of-bag predictions against a forest grown by recursion."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridflux.operators import bagging
from gridflux.operators.targets import oof_residuals
from gridflux.functions.power import Power


def plain_weight(key, tree, seed):
    """Splitmix64 and a Poisson draw in Python's integers."""
    full = (1 << 64) - 1
    x = (key + (tree + 1) * 0x9E3779B97F4A7C15) & full
    for more in (seed, tree):
        x = (x ^ (x >> 30)) * 0xBF58476D1CE4E5B9 & full
        x = (x ^ (x >> 27)) * 0x94D049BB133111EB & full
        x = ((x ^ (x >> 31)) + more * 0x9E3779B97F4A7C15) & full
    u, k, below = (x >> 11) / 2.0**53, 0, math.exp(-1)
    while u >= below:
        k += 1
        below += math.exp(-1) / math.factorial(k)
    return k


def grow(rows, tree, seed, edges, depth, leaf, share):
    """A function of a row's features: the tree as nested tuples, nodes named by level."""
    w = [plain_weight(key, tree, seed) for key, _, _ in rows]
    code = lambda x: [sum(v > e for e in ends) if v is not None else 0 for v, ends in zip(x, edges, strict=True)]
    bins = [code(x) for _, x, _ in rows]
    number, level, nodes = 1, [(0, list(range(len(rows))))], {}
    for d in range(depth + 1):
        following = []
        for name, own in level:
            total = sum(w[i] for i in own)
            mean = [sum(w[i] * rows[i][2][t] for i in own) / max(total, 1) for t in range(len(rows[0][2]))]
            best = None
            if d < depth and total >= 2 * leaf:
                picks = sorted(np.random.default_rng([seed, tree, name]).permutation(len(edges))[: max(1, int(share * len(edges)))].tolist())
                spread = lambda some: sum(sum(w[i] * rows[i][2][t] for i in some) ** 2 for t in range(len(mean))) / max(sum(w[i] for i in some), 1)
                for f in picks:
                    for cut in range(len(edges[f])):
                        left, right = [i for i in own if bins[i][f] <= cut], [i for i in own if bins[i][f] > cut]
                        if min(sum(w[i] for i in left), sum(w[i] for i in right)) >= leaf:
                            gain = spread(left) + spread(right) - spread(own)
                            if best is None or gain > best[0] + 1e-9 * max(abs(gain), abs(best[0])):
                                best = (gain, f, cut, left, right)
                if best and best[0] <= 1e-12 * max(spread(own), 1e-300):
                    best = None
            if best:
                nodes[name] = (mean, best[1], best[2], number)
                following += [(number, best[3]), (number + 1, best[4])]
                number += 2
            else:
                nodes[name] = (mean, None, None, None)
        level = following

    def ask(x):
        at, b = 0, code(x)
        while nodes[at][1] is not None:
            at = nodes[at][3] + (b[nodes[at][1]] > nodes[at][2])
        return nodes[at][0]

    return ask


@pytest.mark.parametrize("cells", [bagging.CELLS, 900])
def test_out_of_bag_equals_a_plain_forest(spark, monkeypatch, cells):
    monkeypatch.setattr(bagging, "CELLS", cells)  # nodes in several passes
    rng = np.random.default_rng(4)
    rows = []
    for key in range(140):
        a, b, c = rng.normal(), int(rng.integers(0, 5)), rng.normal()
        rows.append((key * 7 - 300, float(a) if key % 11 else None, float(b), float(c), 2 * a + rng.normal() * 0.1, b - a * c if key % 13 else None, "x"))
    df = spark.createDataFrame(rows, "id long, a double, b double, c double, y double, z double, n_trees string").repartition(3)
    params = {"trees": 12, "depth": 5, "leaf": 2, "share": 0.7, "bins": 8, "seed": 3}
    model = bagging.fit(df, "id", ["a", "b", "c"], ["y", "z"], **params)
    whole = [(r[0], list(r[1:4]), list(r[4:6])) for r in rows if r[5] is not None]
    trees = [grow(whole, t, 3, [e.tolist() for e in model.edges], 5, 2, 0.7) for t in range(12)]
    got = {r.id: r for r in bagging.out_of_bag(model, df, "id").collect()}
    assert set(got) == {k for k, _, _ in whole}
    for key, x, y in whole:
        out = [t for t in range(12) if plain_weight(key, t, 3) == 0]
        assert got[key].n_trees == len(out) and (got[key].y_obs, got[key].z_obs) == tuple(y)
        for k, name in enumerate(("y_pred", "z_pred")):
            want = np.mean([trees[t](x)[k] for t in out]) if out else None
            assert (got[key][name] is None) == (want is None) and (want is None or math.isclose(got[key][name], want, rel_tol=1e-9, abs_tol=1e-9))
    every = {r.id: r.y_pred for r in bagging.predict(model, df, "id", ["id"]).collect()}
    assert len(every) == 140 and all(math.isclose(every[r[0]], np.mean([t(list(r[1:4]))[0] for t in trees]), rel_tol=1e-9, abs_tol=1e-9) for r in rows)
    residuals = oof_residuals(bagging.out_of_bag(model, df, "id"), {"y": Power(1.0, 0.0, 1.0)})
    assert residuals.where("y IS NOT NULL").count() >= 125


def test_forest_learns_and_its_bag_is_honest(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 3))
    rows = [(i, *map(float, r), float(r[0] * 3 + r[1]), float(rng.normal())) for i, r in enumerate(x)]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double, y double, noise double")
    oob = bagging.out_of_bag(bagging.fit(df, "id", ["a", "b", "c"], ["y", "noise"], trees=40), df, "id").toPandas()
    assert np.corrcoef(oob.y_obs, oob.y_pred)[0, 1] > 0.9 and abs(np.corrcoef(oob.noise_obs, oob.noise_pred)[0, 1]) < 0.25
    assert 8 < oob.n_trees.mean() < 22  # a share of 1 / e


def test_forest_edges(spark):
    df = spark.createDataFrame([(1, 1.0, 2.0), (2, None, 2.0), (3, 5.0, None)], "id long, x double, y double")
    model = bagging.fit(df, "id", ["x"], ["y"], trees=5)
    assert {round(r.y_pred, 9) for r in bagging.predict(model, df, "id", ["id"]).collect() if r.n_trees} == {2.0}
    none = bagging.fit(df.where("false"), "id", ["x"], ["y"], trees=3)
    assert [r.y_pred for r in bagging.predict(none, df, "id", ["id"]).collect()] == [None] * 3
    assert bagging.out_of_bag(none, df.where("false"), "id").count() == 0


@pytest.mark.parametrize("task_rows", [bagging.TASK_ROWS, 7])
def test_trees_of_few_different_rows_grow_in_one_task(spark, monkeypatch, task_rows):
    """Without a pass a level, and as the passes grow them; with bins of many rows in parts."""
    monkeypatch.setattr(bagging, "TASK_ROWS", task_rows)
    rng = np.random.default_rng(2)
    rows = [(key, float(rng.integers(0, 3)), float(rng.integers(0, 4)), float(key % 2) if key % 9 else None, float(rng.normal()), 3.0) for key in range(300)]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double, y double, same double")
    params = {"trees": 6, "depth": 4, "bins": 4}

    def passes(*_):
        raise AssertionError("a pass of a level")

    with monkeypatch.context() as m:
        m.setattr(bagging, "_splits", passes)
        whole = bagging.fit(df, "id", ["a", "b", "c"], ["y", "same"], **params)
    monkeypatch.setattr(bagging, "WHOLE", 0)
    levels = bagging.fit(df, "id", ["a", "b", "c"], ["y", "same"], **params)
    for x, y in zip(whole.trees, levels.trees, strict=True):
        assert [list(getattr(x, n)) for n in ("feature", "cut", "child")] == [list(getattr(y, n)) for n in ("feature", "cut", "child")] and len(x.feature) > 1
        assert np.allclose(np.asarray(x.value), np.asarray(y.value))
    a, b = ({r.id: (r.y_pred, r.n_trees) for r in bagging.out_of_bag(m, df, "id").collect()} for m in (whole, levels))
    assert len(a) == 300 and all(a[k][1] == b[k][1] and (a[k][0] is None or math.isclose(a[k][0], b[k][0], rel_tol=1e-9, abs_tol=1e-12)) for k in a)


def test_regression_of_orders(spark, tmp_path, monkeypatch):
    """All orders get a prediction of the stated forest; none with fewer than 20 prices."""
    from gridflux.queries.grids import rf_regression

    trees = []
    monkeypatch.setattr(bagging, "fit", lambda *a, fit=bagging.fit, **p: trees.append(fit(*a, **p)) or trees[-1])
    n = 400
    orders = spark.range(n).select(F.when(F.col("id") > 0, F.col("id")).alias("o_orderkey"), (F.col("id") * 7 % 50).alias("o_custkey"), F.exp(F.col("id") * 7 % 25 / 5.0).alias("o_totalprice"), F.expr("timestamp_ntz '1995-01-01' + make_dt_interval(cast(id as int))").alias("o_orderdate"))
    orders = orders.withColumn("o_totalprice", F.when(F.col("o_custkey") != 49, F.col("o_totalprice")))
    orders.write.parquet(f"{tmp_path}/orders.parquet")
    got = rf_regression(spark, str(tmp_path)).join(orders, "o_orderkey").toPandas()
    assert len(got) == n - 1 and got.price_pred.notna().all() and len(trees[0].trees) == 500 and max(len(t.feature) for t in trees[0].trees) > 50
    known = got[got.o_totalprice.notna()]
    assert np.corrcoef(known.price_pred, np.log(known.o_totalprice))[0, 1] > 0.9
    orders.limit(19).write.parquet(f"{tmp_path}/few/orders.parquet")
    assert [r.price_pred for r in rf_regression(spark, f"{tmp_path}/few").collect()] == [None] * 19
