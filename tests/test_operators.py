"""Fixtures of the edge cases, and numpy definitions written apart."""

import datetime as dt
import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gridflux.functions import geo, images, indices
from gridflux.functions.power import Power, np_inverse, np_yeo_johnson
from gridflux.functions.semantics import clean, clip, ieee_div
from gridflux.operators import design, forest, joins, nn, preprocess, regularize, stats, targets, terrain, verify, windows
from gridflux.plans import map_inference
from gridflux.queries.grids import stand_in_ensemble
from gridflux.sources import observations, sinks, tables
from gridflux.streaming.events import resume_sink


def one(spark, **columns):
    return spark.range(1).select(*(c.alias(n) for n, c in columns.items())).first().asDict()


def test_division_and_clip(spark):
    d = lambda a, b: clip(ieee_div(F.lit(a), F.lit(b)), -1.0, 1.0)
    got = one(spark, a=d(1.0, 0.0), b=d(-1.0, 0.0), c=d(0.0, 0.0), d=d(1.0, 2.0))
    assert got == {"a": 1.0, "b": -1.0, "c": None, "d": 0.5}


def test_nan_becomes_null(spark):
    df = spark.createDataFrame([(float("nan"), 1), (2.0, 2)], "x double, k int")
    assert [r.x for r in clean(df).orderBy("k").collect()] == [None, 2.0]


def test_nan_from_arrow_is_null(spark):
    rows = spark.createDataFrame([([1.0, None],)], "curve array<double>").select(images.mtf("curve").alias("m"))
    assert rows.first().m is None


def test_mask_and_reflectance(spark):
    rows = [("L8", 4, 9000), ("L5", 4, 9000), ("L5", 8, 9000), ("L9", 0, 0), ("L7", 2, 9000)]
    df = spark.createDataFrame(rows, "sensor string, qa int, dn int")
    got = df.select(indices.reflectance(F.col("dn"), indices.clear_mask(F.col("qa"), F.col("sensor"))).alias("r")).collect()
    assert [None if r.r is None else round(r.r, 6) for r in got] == [None, 0.0475, None, None, None]
    assert observations.operating_sensors(spark, 1985, 1990) == ["L5"] and observations.operating_sensors(spark, 1970, 1980) == []


def reference_curve(t, v, lo, hi, steps, roll):
    """Scan of the definition: no searchsorted, no windows."""
    out = []
    for k in range(steps):
        x = lo + (hi - lo) * k / (steps - 1)
        before = [i for i in range(len(t)) if t[i] <= x]
        after = [i for i in range(len(t)) if t[i] >= x]
        if not before:
            out.append(v[after[0]])
        elif not after or t[after[0]] <= t[before[-1]]:
            out.append(v[before[-1]])
        else:
            a, b = before[-1], after[0]
            out.append(v[a] + (v[b] - v[a]) * (x - t[a]) / (t[b] - t[a]))
    h = roll // 2 if roll > 1 else 0
    return [sum(out[max(0, i - h) : i + h + 1]) / len(out[max(0, i - h) : i + h + 1]) for i in range(steps)]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 40), st.floats(-5, 5)), min_size=5, max_size=30), st.integers(0, 6))
def test_interpolation(points, roll):
    points = sorted(points, key=lambda p: p[0])
    t, v = np.array([p[0] for p in points], float), np.array([p[1] for p in points])
    if t[0] < t[-1]:
        got = regularize.smooth_rows(regularize.interpolate(t, v, t[0], t[-1], 11)[None], roll)[0]
        assert np.allclose(got, reference_curve(t.tolist(), v.tolist(), t[0], t[-1], 11, roll))


def test_regularize_edges(spark):
    rows = [(k, float(t), t, float(t * t)) for k, n in ((1, 4), (2, 5)) for t in range(n)]
    rows += [(3, 7.0, i, float(i)) for i in range(6)]  # one time
    obs = spark.createDataFrame(rows, "key int, t double, tie int, v double")
    spans = regularize.own_spans(obs, ["key"])
    grid = regularize.regularize(obs, spans, ["key"], 9)
    curves = {r.key: r.curve for r in regularize.curve_arrays(grid, ["key"]).collect()}
    arrays = {r.key: r.curve for r in regularize.regularize_arrays(obs, spans, ["key"], 9).collect()}
    assert curves[1] is None and arrays[1] is None and 3 not in curves and 3 not in arrays
    assert np.allclose(curves[2], arrays[2])
    assert np.allclose(curves[2], reference_curve([0, 1, 2, 3, 4], [0, 1, 4, 9, 16], 0, 4, 9, 5))
    assert regularize.half_width(0) == regularize.half_width(1) == 0 and regularize.half_width(4) == regularize.half_width(5) == 2


def test_causal_window(spark):
    days = [dt.datetime(2003, 12, 31), dt.datetime(2004, 1, 1)]
    obs = spark.createDataFrame([(d,) for d in days], "ts timestamp")
    got = windows.explode_target_years(obs, [2003]).collect()
    assert [r.ts for r in got] == [days[0]]


@settings(max_examples=20, deadline=None)
@given(st.permutations(list(range(8))))
def test_stats_ignore_order(order):
    x = np.array([3.0, 1, 4, 1, 5, 9, 2, 6])
    assert np.allclose(np.percentile(x[order], [10, 90]), np.percentile(x, [10, 90]))


def test_cv_and_ratio_guards(spark):
    rows = spark.createDataFrame([(1, -1.0), (1, 1.0)], "id int, value double")
    r = stats.curve_stats(rows, ["id"]).first()
    assert r.cv is None and r.p50 == 0.0 and r.range == 2.0
    con = stats.contrast_block(spark.createDataFrame([(1, "a", 1.0, None), (1, "b", 0.0, 0.5)], "id int, index string, mean double, cv double"), ["id"], "index", ["a", "b"]).first()
    assert con.ctr_a_b_diff == 1.0 and con.ctr_a_b_ratio is None and con.ctr_a_b_cvdiff is None


def test_images():
    assert sorted(images.serpentine_order(10)) == list(range(100))
    assert images.serpentine_order(3) == [0, 1, 2, 5, 4, 3, 6, 7, 8]
    for order in (1, 2, 3):
        side = 1 << order
        at = np.array(images.hilbert_order(order)).reshape(side, side)
        where = {int(v): np.array(p) for p, v in np.ndenumerate(at)}
        assert all(np.abs(where[i] - where[i + 1]).sum() == 1 for i in range(side * side - 1))
    assert np.array_equal(images.np_mtf(np.full((1, 6), 2.0)), np.ones((1, 6, 6)))
    x = np.sin(np.arange(64) / 5)[None]
    assert images.np_cwt(x).shape == (1, 24, 64) and images.image_shape("gaf", 52) == (52, 52, 2)
    assert images.np_spectrogram(x).shape[1:] == images.image_shape("spectrogram", 64)[:2]
    assert images.np_cwt(x)[0, 9].mean() > images.np_cwt(x)[0, 0].mean()


def test_wrap_pad(spark):
    got = one(spark, w=images.wrap_pad(F.array(*map(F.lit, (1.0, 2.0, 3.0))), 5), r=images.per_sample(F.array(F.array(F.lit(2.0), F.lit(4.0)), F.array(F.lit(3.0), F.lit(2.0)))))
    assert got["w"] == [1, 2, 3, 1, 2] and got["r"] == [[0, 1], [0.5, 0]]


def test_terrain_planes(spark):
    """A plane that falls to the north looks north; a flat one has no aspect."""
    rows = [(0, r, c, float(r * 30)) for r in range(9) for c in range(9)] + [(1, r, c, 5.0) for r in range(9) for c in range(9)]
    grid = spark.createDataFrame(rows, "tile_id int, row int, col int, elevation double")
    got = {r.tile_id: r for r in terrain.terrain_layers(grid, 30.0, -33.0).where("row = 4 AND col = 4").collect()}
    assert math.isclose(got[0].northness, 1.0) and abs(got[0].slope - 45) < 1e-9 and abs(got[0].tpi) < 1e-9 and abs(got[0].curvature) < 1e-12
    assert got[1].aspect is None and got[1].heat_load is None and got[1].tri == 0


def test_power_round_trip():
    x = np.concatenate((np.linspace(-4, 9, 101), [0.0]))
    for lam in (-1.5, 0.0, 0.3, 1.0, 2.0):
        assert np.allclose(np_inverse(np_yeo_johnson(x, lam), lam), x, atol=1e-9)
    rng = np.random.default_rng(0)
    skewed = np.exp(rng.normal(0, 1, 3000)) - 1

    def likelihood(lam):
        z = np_yeo_johnson(skewed, lam)
        return -len(z) / 2 * np.log(z.var()) + (lam - 1) * (np.sign(skewed) * np.log1p(np.abs(skewed))).sum()

    grid = np.arange(-2, 2, 0.001)
    assert abs(targets.fit_power(skewed).lam - grid[np.argmax([likelihood(x) for x in grid])]) < 2e-3


def test_smearing_draws_and_bounds(spark):
    r = {"few": np.arange(19.0), "many": np.arange(20.0)}
    draws = targets.smearing_draws(r, seed=1)
    assert list(draws) == ["many"] and len(draws["many"]) == 128
    lo, hi = np.percentile(np.arange(20.0), [2.5, 97.5])
    want = np.random.default_rng(1).choice(np.clip(np.arange(20.0), lo, hi), size=128)
    assert np.allclose(draws["many"], want)
    bounds = targets.winsor_bounds(spark.createDataFrame([(float(i), float(i) if i else None) for i in range(20)], "a double, b double"), ["a", "b"])
    got = {b.target: b for b in bounds.collect()}
    assert math.isclose(got["a"].lo, lo) and got["b"].lo is None


def test_target_catalogue(spark):
    assert len(targets.resolve("all")) == 15 and len(targets.SETS) == 17
    with pytest.raises(ValueError):
        targets.resolve(["mpd", "pd_faith"])
    ids = spark.createDataFrame([(1,), (2,)], "id int")
    with pytest.raises(ValueError, match="2"):
        targets.load_targets(ids, [(spark.createDataFrame([(1, 0.5)], "id int, t double"), ["t"])], "id")


def test_design_errors(spark):
    plots = spark.createDataFrame([(1, 100.0, "cover", 1.0, 2.0, 2000)], "id int, area_m2 double, stratum string, lon double, lat double, year int")
    t = design.Tables(plots=plots)
    with pytest.raises(ValueError, match="unknown"):
        design.build_design(t, "area+nothing")
    with pytest.raises(ValueError, match="twice"):
        design.build_design(t, "area+area")
    with pytest.raises(FileNotFoundError):
        design.build_design(t, "topo")
    with pytest.raises(ValueError, match="index"):
        design.build_design(design.Tables(plots=plots, lsp=plots), "qc")
    assert design.step_columns(["s10", "s2", "id"]) == ["s2", "s10"]
    with pytest.raises(ValueError):
        design.step_columns(["id"])


def test_preprocess_edges(spark):
    df = spark.createDataFrame([(1, None, 2.0), (2, None, 2.0), (3, 5.0, 2.0)], "id int, a double, b double")
    fits = {f.name: f for f in preprocess.fit(df, F.col("id") < 3, ["a", "b"])}
    assert fits["a"].median == 5.0 and fits["a"].gaps and fits["b"].sd == 1.0 and not fits["b"].gaps
    assert preprocess.transform(df, list(fits.values()), ["id"]).columns == ["id", "a", "b", "a_isna"]


def test_resume_and_waves(spark):
    m = spark.createDataFrame([("t0_0", 2000, "error"), ("t0_0", 2000, "ok"), ("t1_0", 2000, "ok")], "tile_id string, year int, status string")
    tiles = spark.createDataFrame([("t0_0",), ("t1_0",), ("t-1_2",)], "tile_id string")
    lost = joins.backlog(tiles, [2000], joins.done_pairs(m))
    assert [r.tile_id for r in lost.collect()] == ["t-1_2"]
    assert list(map_inference.pending_waves(tiles, [2000, 2001], m, 2)) == [["t-1_2", "t0_0"], ["t1_0"]]
    with pytest.raises(RuntimeError):
        map_inference.run_waves(iter([["x"]]), lambda n: m.where("status = 'none'"), lambda d: None)


def test_tiles_and_years(spark):
    got = geo.tile_grid(spark, -10.0, 0.0, 990.0, 10.0, 990.0)
    assert sorted(r.tile_id for r in got.collect()) == ["t-1_0", "t0_0", "t1_0"]
    name = spark.createDataFrame([("a/t-3_17_2004.tif",), ("x.tif",)], "p string").select(*geo.parse_tile(F.col("p"))).collect()
    assert tuple(name[0]) == ("t-3_17", 2004) and name[1][0] is None
    assert tables.year_list("2000-2002, 2010,2001") == [2000, 2001, 2002, 2010]
    rows = tables.year_rows(spark.createDataFrame([("2000-2002, 2010",)], "spec string"))
    assert sorted(r.year for r in rows.collect()) == [2000, 2001, 2002, 2010]


def test_manifest_and_run(spark, tmp_path):
    old = spark.createDataFrame([("t0_0", 2000, "ok")], "tile_id string, year int, status string")
    sinks.append_manifest(old, f"{tmp_path}/m")
    sinks.append_manifest(old.withColumn("n_px", F.lit(5)), f"{tmp_path}/m")
    assert sorted((r.n_px or 0) for r in tables.read_manifest(spark, f"{tmp_path}/m").collect()) == [0, 5]
    sinks.write_run(spark, f"{tmp_path}/run", {"run_id": "r", "seeds": 4, "smearing": "none"})
    problems = verify.tag_problems(sinks.read_run(spark, f"{tmp_path}/run"))
    assert problems.count() == 2
    layers = spark.createDataFrame([("t0_0", 2000, 0, 0, 1.5)], "tile_id string, year int, row int, col int, x double")
    sinks.write_tile_years(layers, f"{tmp_path}/out")
    sinks.write_tile_years(layers.withColumn("year", F.lit(2001)), f"{tmp_path}/out")
    assert spark.read.parquet(f"{tmp_path}/out").count() == 2


def test_resumable_stream_sink(spark, tmp_path):
    """A replayed batch replaces itself; a later batch may bring a key again."""
    write = resume_sink(f"{tmp_path}/s", ["k"])
    batch = spark.createDataFrame([(1,), (2,), (2,)], "k int")
    for number in (0, 0, 1, 1):
        write(batch if number == 0 else spark.createDataFrame([(3,), (1,)], "k int"), number)
    assert sorted((r.batch, r.k) for r in spark.read.parquet(f"{tmp_path}/s").collect()) == [(0, 1), (0, 2), (1, 1), (1, 3)]


def slow_conv(x, w, stride, circular):
    """Plain loops over a one-channel convolution."""
    k = len(w) // 2
    n = len(x)
    at = lambda i: x[i % n] if circular else (x[i] if 0 <= i < n else 0.0)
    return [sum(w[j] * at(i + j - k) for j in range(len(w))) for i in range(0, n, stride)]


def test_networks():
    rng = np.random.default_rng(1)
    x, w = rng.normal(size=13), rng.normal(size=5)
    for circular in (True, False):
        got = nn.depthwise(x[None, None, None], w[None, None], (1, 2), ("zeros", "circular" if circular else "zeros"))[0, 0, 0]
        assert np.allclose(got, slow_conv(x, w, 2, circular))
    assert np.allclose(nn.erf(np.array([-7, -1.3, 0, 0.2, 3.9])), [math.erf(v) for v in (-7, -1.3, 0, 0.2, 3.9)], atol=1e-13)
    for family, width, shape, ctx, count in (("C1D", "B", (1, 1, 52), 28, 15303), ("C2D", "B", (1, 1, 8, 8), 28, 15943), ("MLP", "B", (1, 80), 0, 19463)):
        net = nn.Net()
        nn.forward(net, family, np.zeros(shape), 7, width, np.zeros((1, ctx)) if ctx else None)
        assert nn.n_parameters(net) == count
    for fusion in ("none", "late", "film", "patch", "patchctx"):
        for arch in ("sep", "res", "se", "multi"):
            out = nn.forward(nn.Net(), "C2D", np.zeros((2, 1, 9, 9)), 3, "A", np.zeros((2, 4)), np.zeros((2, 9, 5, 5)), fusion, arch)
            assert out.shape == (2, 3)
    with pytest.raises(ValueError):
        nn.forward(nn.Net(), "other", np.zeros((1, 1)), 1)


def test_ensemble_gates(spark):
    from gridflux.operators.predict import back_transform, predict

    model = stand_in_ensemble(2, ("c",), seeds=2)
    rows = spark.createDataFrame([(1, [0.1, 0.2, 0.3, 0.4], 1.0), (2, [0.1, None, 0.3, 0.4], 1.0), (3, None, 1.0), (4, [0.1, 0.2, 0.3, 0.4], None)], "id int, image array<double>, c double")
    got = {r.id: r for r in back_transform(predict(rows, model, ["id"]), model, ["id"]).collect()}
    assert got[1].first is not None and all(got[k].first is None for k in (2, 3, 4))


def test_forest_floor(spark):
    df = spark.createDataFrame([(i, float(i % 5), float(i % 5) * 2 if i < 19 else None) for i in range(40)], "id int, x double, y double")
    assert forest.fit_forest(df, ["x"], "y") is None
    full = df.withColumn("y", F.col("x") * 2)
    pred = forest.fold_predictions(full, "id", ["x"], "y", folds=2, trees=5)
    assert pred.count() == 40 and forest.fit_all(full, ["x"], ["y"], trees=3)["y"] is not None


def test_checkpoint_round_trip(spark, tmp_path):
    """An ensemble comes back from its file and predicts the same; a weight of another
    shape, and members that disagree, are errors."""
    from gridflux.operators.predict import back_transform, predict, read_checkpoint, write_checkpoint

    model = stand_in_ensemble(2, ("c",), seeds=2)
    write_checkpoint(model, f"{tmp_path}/m.npz")
    again = read_checkpoint(f"{tmp_path}/m.npz", "A")
    assert again.targets == model.targets and again.members[1].scalers == model.members[1].scalers
    rows = spark.createDataFrame([(1, [0.1, 0.2, 0.3, 0.4], 1.0)], "id int, image array<double>, c double")
    a, b = (back_transform(predict(rows, m, ["id"]), m, ["id"]).first() for m in (model, again))
    assert np.allclose(a[1:], b[1:])
    with open(f"{tmp_path}/m.npz", "rb") as f:
        assert read_checkpoint(f, "A").context == ("c",)
    with pytest.raises(ValueError, match="shape"):
        read_checkpoint(f"{tmp_path}/m.npz", "B")


def test_film_and_smoothing_by_definition():
    rng = np.random.default_rng(4)
    net = nn.Net()
    net.film("f", np.zeros((2, 3)), (4, 2))
    for name, shape in net.shapes.items():
        net.weights[name] = rng.normal(size=shape)
    ctx = rng.normal(size=(2, 3))
    raw = net.linear("f.b", nn.gelu(net.linear("f.a", ctx, 32)), 12)
    (g1, b1), (g2, b2) = net.film("f", ctx, (4, 2))
    assert np.allclose(g1[:, :, 0, 0], 1 + raw[:, :4]) and np.allclose(b1[:, :, 0, 0], raw[:, 4:8])
    assert np.allclose(g2[:, :, 0, 0], 1 + raw[:, 8:10]) and np.allclose(b2[:, :, 0, 0], raw[:, 10:])
    x = rng.normal(size=(3, 9))
    want = [[np.mean(row[max(0, i - 2) : i + 3]) for i in range(9)] for row in x]
    assert np.allclose(regularize.smooth_rows(x, 4), want) and np.array_equal(regularize.smooth_rows(x, 1), x)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.lists(st.tuples(st.integers(0, 20), st.floats(-5, 5)), min_size=1, max_size=12), min_size=1, max_size=5))
def test_interpolation_of_many_series(series):
    series = [sorted(s, key=lambda p: p[0]) for s in series]
    n = np.array([len(s) for s in series])
    t, v = (np.array([p[k] for s in series for p in s], float) for k in (0, 1))
    lo, hi = np.array([s[0][0] - 1.0 for s in series]), np.array([s[-1][0] + 2.0 for s in series])
    first = np.cumsum(n) - n
    got = regularize.interpolate_all(t, v, first, n, lo, hi, 7)
    for r, s in enumerate(series):
        assert np.allclose(got[r], regularize.interpolate(t[first[r] : first[r] + n[r]], v[first[r] : first[r] + n[r]], lo[r], hi[r], 7))


def test_elevation_scan_and_reprojection(spark):
    from gridflux.operators import landcover

    dem = spark.createDataFrame([("a", r, c, float(r * 10 + c)) for r in range(8) for c in range(8)] + [("b", 0, 0, -9999.0)], "tile_id string, row int, col int, elevation double")
    part = terrain.scan_elevation(dem, "a", (3, 4), (3, 4), 2)
    assert part.count() == 36 and part.agg(F.min("row"), F.max("col")).first() == (0, 5)
    inner = terrain.crop(part, 2, 2, 2)
    assert sorted(r.elevation for r in inner.collect()) == [33.0, 34.0, 43.0, 44.0]
    with pytest.raises(ValueError, match="empty"):
        terrain.scan_elevation(dem, "b", (0, 0), (0, 0))
    cover = spark.createDataFrame([(2000, r, c, 10 * r + c) for r in range(4) for c in range(4)], "year int, row int, col int, class int")
    lon, lat = F.lit(-70.0) + (F.col("c") + 0.3) * 0.01, F.lit(-33.0) - (F.col("r") + 0.7) * 0.01
    x, y = geo.to_utm(lon, lat)
    cells = cover.select(F.col("row").alias("r"), F.col("col").alias("c"), "year").withColumns({"x": x, "y": y})
    got = landcover.reproject_nearest(cells, cover, -70.0, -33.0, 0.01).collect()
    assert len(got) == 16 and all(g["class"] == 10 * g.r + g.c for g in got)
    far = landcover.reproject_nearest(cells.withColumn("x", F.col("x") + 90000), cover, -70.0, -33.0, 0.01)
    assert {r["class"] for r in far.collect()} == {0}


def test_geometry_helpers(spark):
    lon, lat = geo.cell_centres(F.lit(1), F.lit(2), 10.0, -4.0, 18.0, 0.0, 4, 8)
    got = one(spark, lon=lon, lat=lat, n=geo.nearest_cell(F.lit(2.5), 0.0, 1.0, 9), low=geo.nearest_cell(F.lit(-7.0), 0.0, 1.0, 9))
    assert got == {"lon": 12.5, "lat": -1.5, "n": 2, "low": 0}
    assert tables.prefixed_ids(spark.createDataFrame([(7,)], "id long"), "LT_").first().id == "LT_7"


def test_scans_of_files(spark, tmp_path):
    """Archive by years and box, land cover by file name, outputs by object name, forests on disk."""

    root = str(tmp_path)
    rows = [("t0", i, i, 0, dt.datetime(1999 + i, 6, 1), s, 8000, 9000, 0) for i in range(6) for s in ("L5", "L8")]
    spark.createDataFrame(rows, "tile_id string, px long, row int, col int, ts timestamp_ntz, sensor string, red int, nir int, qa int").write.parquet(f"{root}/obs")
    got = observations.load_kndvi(spark, f"{root}/obs", 2000, 2002, (0, 2, 0, 0)).collect()
    assert sorted(r.px for r in got) == [1, 2] and {r.sensor for r in got} == {"L5"} and all(0 < r.v < 1 for r in got)
    assert observations.load_window(spark, f"{root}/obs", 1970, 1975) is None
    for year in (2003, 2004):
        path = f"{root}/cover/cover_{year}_v1.parquet"
        (tmp_path / "cover").mkdir(exist_ok=True)
        spark.createDataFrame([(0, 0, year % 100)], "row int, col int, class int").toPandas().to_parquet(path)
    assert sorted((r.year, r["class"]) for r in tables.read_landcover(spark, f"{root}/cover").collect()) == [(2003, 3), (2004, 4)]
    assert sorted(r.map_year for r in tables.available_years(spark, f"{root}/cover").collect()) == [2003, 2004]
    (tmp_path / "out").mkdir()
    for name in ("t-3_17_2004.tif", "t1_0_2005.tif", "note.txt"):
        (tmp_path / "out" / name).write_bytes(b"x")
    assert sorted(tuple(r) for r in tables.listed_outputs(spark, f"{root}/out").collect()) == [("t-3_17", 2004), ("t1_0", 2005)]
    df = spark.createDataFrame([(float(i % 5), float(i % 5) * 2) for i in range(40)], "x double, y double")
    model = forest.fit_forest(df, ["x"], "y", trees=3)
    forest.save_forest(model, f"{root}/rf")
    a, b = (forest.predict_forest(m, df, ["x"], "y").agg(F.sum("y_pred")).first()[0] for m in (model, forest.load_forest(f"{root}/rf")))
    assert a == b and forest.importances(model, ["x"])[0][0] == "x"


def test_heat_load_of_both_hemispheres(spark):
    got = one(spark, **{f"h{k}": terrain.heat_load(F.lit(lat), F.lit(20.0), F.lit(100.0)) for k, lat in enumerate((-33.5, 33.5))})
    assert got["h0"] == got["h1"]
    south = 0.339 + 0.808 * math.cos(math.radians(33.5)) * math.cos(math.radians(20)) - 0.196 * math.sin(math.radians(33.5)) * math.sin(math.radians(20))
    assert math.isclose(got["h0"], south - 0.482 * math.cos(math.radians(abs(180 - 215))) * math.sin(math.radians(20)))


def test_cv_of_a_negative_mean(spark):
    rows = spark.createDataFrame([(1, -1.0), (1, -3.0)], "id int, value double")
    assert math.isclose(stats.curve_stats(rows, ["id"]).first().cv, math.sqrt(2) / 2)


def test_lambda_of_thousands():
    """Values of a narrow range next to 0, as site contributions have."""
    x = 3.4e-4 + 1e-4 * np.linspace(0, 1, 400) ** 3
    got = targets.fit_power(x)
    assert got.lam < -1000 and np.allclose(np_inverse(np_yeo_johnson(x, got.lam), got.lam), x, rtol=1e-9)

    def loss(lam):
        return np.log(np_yeo_johnson(x, lam).std()) - (lam - 1) * np.log1p(x).mean()

    assert loss(got.lam) <= min(loss(got.lam * 0.99), loss(got.lam * 1.01))


def test_map_plan_reads_the_archive_once(spark, tmp_path):
    """One scan of the observations, with bounds of time at the reader."""
    obs = spark.createDataFrame([("t0", 1, dt.datetime(1995 + i % 8, 3, 1 + i % 20), "L5", 0.1 * i) for i in range(60)], "tile_id string, px long, ts timestamp_ntz, sensor string, v double")
    obs.write.parquet(f"{tmp_path}/obs")
    cells = spark.createDataFrame([("t0", 1, 0, 0), ("t0", 2, 0, 1)], "tile_id string, px long, row int, col int")
    cover = spark.createDataFrame([("t0", p, 2000, 3) for p in (1, 2)], "tile_id string, px long, year int, class int")
    rows = map_inference.map_rows(spark.read.parquet(f"{tmp_path}/obs"), cells, cover, map_inference.Config((2000,), steps=9))
    got = {r.px: r for r in rows.collect()}
    assert got[1].ready and got[1].n_obs == 22 and not got[2].ready and got[2].n_obs is None
    plan = rows._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    assert final.count("FileScan parquet") == 1 and "ReusedExchange" in final
    assert "GreaterThanOrEqual(ts,1998-01-01T00:00)" in final and "LessThan(ts,2001-01-01T00:00)" in final


def test_readers_of_tables(spark, tmp_path):
    """Feature, target, prediction and land-cover files of a layout."""
    root = str(tmp_path)
    ids = [1, 2, 3]
    spark.createDataFrame([(i, 100.0 * i, "cover", 1.0, 2.0, 2000, "living_trees" if i < 3 else "plots") for i in ids], "id long, area_m2 double, stratum string, lon double, lat double, year int, source string").write.parquet(f"{root}/plots.parquet")
    curves = spark.createDataFrame([(i, "ndvi", "mean5x5", [float("nan") if k == 1 else 0.1 * k for k in range(4)]) for i in ids], "id long, index string, px string, curve array<double>")
    curves.write.parquet(f"{root}/curves.parquet")
    topo = spark.createDataFrame([(i, *[float(i)] * 16) for i in ids], "id long, " + ", ".join(f"{v}_{s} double" for v in design.TOPO_VARS for s in ("mean", "std")))
    topo.write.parquet(f"{root}/topography.parquet")
    got = design.build_design(tables.load_tables(spark, tables.Layout(root)), "area+topo+year").orderBy("id").collect()
    assert [r.id for r in got] == ids and got[0].topo_topo_flat == 0.0 and math.isclose(got[1].area_log10, math.log10(200))
    curves.where("id > 1").write.parquet(f"{root}/fewer.parquet")
    with pytest.raises(ValueError, match="lacks ids"):
        tables.load_tables(spark, tables.Layout(root, curves="fewer.parquet"))
    with pytest.raises(FileNotFoundError, match="extract"):
        tables.read_optional(spark, f"{root}/none.parquet", "extract it first")
    spark.createDataFrame([(i, 0.5 * i, float("nan")) for i in ids], "id long, mpd double, mntd double").write.parquet(f"{root}/phylo_responses.parquet")
    y = tables.read_targets(spark, root, ["mpd", "mntd"], spark.createDataFrame([(i,) for i in ids], "id long")).orderBy("id").collect()
    assert [r.mpd for r in y] == [0.5, 1.0, 1.5] and {r.mntd for r in y} == {None}
    with open(f"{root}/oof.csv", "w") as f:
        f.write("seed,a_obs,a_pred\n5,1.0,0.5\n2,2.0,1.0\n2,3.0,\n")
    res = targets.oof_residuals(tables.read_oof(spark, f"{root}/oof.csv", ["a"]), {"a": Power(1.0, 0.0, 1.0)}).collect()
    assert sorted((r.a is None, r.a and round(r.a, 9)) for r in res) == [(False, 1.0), (True, None)]
    for year in (2003, 2004):
        spark.createDataFrame([(0, 0, 3), (0, 1, year % 100)], "row int, col int, class int").coalesce(1).toPandas().to_parquet(f"{root}/cover_{year}_v1.parquet")
    cover = spark.read.parquet(f"{root}/cover_2003_v1.parquet")
    assert cover.count() == 2
    with open(f"{root}/legend.csv", "w") as f:
        f.write("code,name\n3,forest\n")
    assert tables.read_legend(spark, f"{root}/legend.csv").first().name == "forest"


def test_manifest_compaction_and_caveat(spark, tmp_path):
    rows = spark.createDataFrame([("t0_0", 2000, "ok")], "tile_id string, year int, status string")
    for _ in range(3):
        sinks.append_manifest(rows, f"{tmp_path}/m")
    sinks.compact_manifest(spark, f"{tmp_path}/m", f"{tmp_path}/m2")
    assert tables.read_manifest(spark, f"{tmp_path}/m2").count() == 3
    assert len([p for p in (tmp_path / "m2").iterdir() if p.name.startswith("part")]) == 1
    sinks.write_run(spark, f"{tmp_path}/run", {"run_id": "r"})
    assert "native" in sinks.read_run(spark, f"{tmp_path}/run").first().tags["caveat"]


def test_sites_of_empty_tiles(spark):
    from gridflux.plans.topography import failed_sites

    dem = spark.createDataFrame([(0, 0, 0, 10.0), (1, 0, 0, -9999.0)], "tile_id int, row int, col int, elevation double")
    sites = spark.createDataFrame([(7, 0), (8, 1), (9, 2)], "site_id int, tile_id int")
    assert sorted((r.site_id, r.error) for r in failed_sites(dem, sites).collect()) == [(8, "empty elevation"), (9, "empty elevation")]


def test_terrain_edges(spark):
    """Edges by the published rules, against numpy; or null."""
    rng = np.random.default_rng(3)
    e = rng.uniform(0, 100, (6, 8))
    grid = spark.createDataFrame([(0, r, c, float(e[r, c])) for r in range(6) for c in range(8)], "tile_id int, row int, col int, elevation double")
    got = {(r.row, r.col): r for r in terrain.terrain_layers(grid, 30.0, -33.0).collect()}
    near, mirror = np.pad(e, 3, mode="edge"), np.pad(e, 1, mode="symmetric")
    squares = sum((e - np.roll(e, (a, b), (0, 1))) ** 2 for a in (-1, 0, 1) for b in (-1, 0, 1))
    for (r, c), row in got.items():
        assert math.isclose(row.tpi, e[r, c] - near[r : r + 7, c : c + 7].mean(), abs_tol=1e-9) and math.isclose(row.tri, math.sqrt(squares[r, c]), rel_tol=1e-9)
        around = mirror[r, c + 1] + mirror[r + 2, c + 1] + mirror[r + 1, c] + mirror[r + 1, c + 2]
        assert math.isclose(row.curvature, (around - 4 * e[r, c]) / 900, abs_tol=1e-12)
    none = {(r.row, r.col): r for r in terrain.terrain_layers(grid, 30.0, -33.0, edges="null").collect()}
    assert none[0, 0].tpi is None and none[0, 3].tri is None and none[2, 0].curvature is None and none[2, 3].tri is not None


def test_scaler_gate(spark):
    df = spark.createDataFrame([(float(i),) for i in range(-20, 60)], "a double")
    assert verify.round_trip(df, {"a": Power(0.4, 0.0, 1.0)}).first().error < 1e-6


def test_scalers_of_many_rows_with_a_hot_value(spark):
    """All rows count, beyond 100,000 too, where a third of them are equal."""
    x = F.when(F.col("id") % 3 == 0, 40.0).otherwise(F.exp(F.pmod(F.xxhash64("id"), F.lit(1000)) / 400.0))
    df = spark.range(120_000).select(x.alias("x"), F.when(F.col("id") % 3 == 0, -2.0).when(F.col("id") % 7 > 0, F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1000)) / 250.0 - 2).alias("y"))
    values = df.toPandas()
    got = targets.fit_scalers(df, ["x", "y"])
    for t in ("x", "y"):
        want = targets.fit_power(values[t].fillna(values[t].median()).to_numpy())
        assert np.allclose([got[t].lam, got[t].mean, got[t].scale], [want.lam, want.mean, want.scale], rtol=1e-4, atol=1e-4)
