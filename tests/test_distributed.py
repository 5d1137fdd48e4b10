"""Steps that cut, merge or isolate: against the uncut thing, numpy, and planted failures."""

import datetime as dt
import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gridflux.operators import isolation, joins, nn, ranks, stats, targets, terrain, verify, windows
from gridflux.operators.staging import fixed
from gridflux.operators.stats import patch_arrays
from gridflux.functions.power import Power
from gridflux.plans import map_inference
from gridflux.plans.topography import extract_patches, extract_topography
from gridflux.queries.grids import stand_in_ensemble, terrain_patches, tiled_sites, topography_summary
from gridflux.sources import blocks, observations, sinks
from gridflux.streaming.events import read_events, windowed_stats


def test_failing_parts_become_error_rows(spark):
    rows = spark.range(60).select((F.col("id") % 3).alias("tile"), F.col("id").alias("px"), F.col("id").cast("double").alias("v")).coalesce(1)

    def work(batch):
        if 1 in batch.column(0).to_pylist():
            raise ValueError("poisoned " + "x" * 300)
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.compute.multiply(batch.column(2), 2.0)], names=["tile", "px", "twice"])

    out = isolation.map_isolated(rows, work, "tile long, px long, twice double", ["tile"])
    good, errors = isolation.split_failures(out, ["tile"])
    assert sorted((r.px, r.twice) for r in good.collect()) == [(i, 2.0 * i) for i in range(60) if i % 3 != 1]
    (bad,) = errors.collect()
    assert bad.tile == 1 and bad.error.startswith("ValueError: poisoned") and len(bad.error) == 200
    assert isolation.map_isolated(rows.where("false"), work, "tile long, px long, twice double", ["tile"]).count() == 0


@pytest.mark.parametrize("poison", [None, "t1"])
def test_one_poisoned_tile_of_three(spark, tmp_path, poison):
    """Its networks raise: it has its error row, the others their layers, in one job."""
    obs = spark.createDataFrame(
        [(f"t{t}", t * 10 + p, dt.datetime(1998 + i % 3, 1 + i % 12, 3), "L5", 0.1 + 0.01 * i + 0.05 * p) for t in range(3) for p in range(2) for i in range(24)],
        "tile_id string, px long, ts timestamp_ntz, sensor string, v double",
    )
    cells = spark.createDataFrame([(f"t{t}", t * 10 + p, 0, p) for t in range(3) for p in range(2)], "tile_id string, px long, row int, col int")
    cover = cells.select("tile_id", "px", F.lit(2000).alias("year"), F.lit(3).alias("class"))
    context = cells.select("tile_id", "px", F.when(F.col("tile_id") == poison, 1e300).otherwise(0.5).alias("c") if poison else F.lit(0.5).alias("c"))
    model = stand_in_ensemble(3, ("c",), seeds=2)
    config = map_inference.Config((2000,), steps=9)
    layers = map_inference.map_layers(obs, cells, context, cover, model, config, isolate=True)
    planned = cells.select("tile_id", F.lit(2000).alias("year")).distinct()
    manifest = {r.tile_id: r for r in map_inference.emit(layers, planned, "first", f"{tmp_path}/out").collect()}
    bad = {poison} - {None}
    assert {k for k, r in manifest.items() if r.status == "error"} == bad
    assert all(r.status == "ok" and r.n_pred == 2 for k, r in manifest.items() if k not in bad)
    assert all("OverflowError: an input is beyond single precision" in manifest[k].error for k in bad)
    assert {r.tile_id for r in spark.read.parquet(f"{tmp_path}/out").select("tile_id").distinct().collect()} == {"t0", "t1", "t2"} - bad


@pytest.mark.parametrize("shape,halo", [((3, 4), 5), ((7, 5), 4), ((2, 2), 4)])
def test_tiles_with_halo_are_the_uncut_grid(spark, shape, halo):
    rng = np.random.default_rng(3)
    cells = [(r, c, None if rng.random() < 0.1 else float(rng.normal(100, 20))) for r in range(13) for c in range(11)]
    whole = spark.createDataFrame([(0, *x) for x in cells], "tile_id int, row int, col int, elevation double")
    want = terrain.terrain_layers(terrain.fill_holes(whole), 10.0, -20.0, edges="null")
    cut = whole.select(
        F.floor(F.col("row") / shape[0]).cast("int").alias("tile_row"), F.floor(F.col("col") / shape[1]).cast("int").alias("tile_col"),
        (F.col("row") % shape[0]).alias("row"), (F.col("col") % shape[1]).alias("col"), "elevation",
    )
    grid = terrain.with_halo(cut, shape, halo).withColumn("tile_id", F.struct("tile_row", "tile_col"))
    got = terrain.without_halo(terrain.terrain_layers(terrain.fill_holes(grid), 10.0, -20.0, edges="null"), shape)
    got = got.select(F.lit(0).alias("tile_id"), (F.col("tile_id.tile_row") * shape[0] + F.col("row")).alias("row"), (F.col("tile_id.tile_col") * shape[1] + F.col("col")).alias("col"), *terrain.LAYERS)
    a, b = (d.orderBy("row", "col").toPandas()[["row", "col", *terrain.LAYERS]].to_numpy(float) for d in (want, got))
    assert a.shape == b.shape and np.allclose(a, b, equal_nan=True)


def test_patches_cross_the_borders_of_tiles(spark):
    grid = spark.createDataFrame([(r // 4, c // 4, r % 4, c % 4, float(r * 20 + c)) for r in range(12) for c in range(12)], "tile_row int, tile_col int, row int, col int, elevation double")
    sites = spark.createDataFrame([(1, 1, 1, 0, 3, -30.0), (2, 0, 0, 0, 0, -30.0)], "site_id int, tile_row int, tile_col int, row int, col int, lat double")
    patches = {r.site_id: r for r in extract_patches(grid, sites, 30.0, shape=(4, 4), halo=8).collect()}
    assert (patches[1].height, patches[1].width, patches[2].height) == (5, 5, 3)
    assert patches[1].elevation == [float(r * 20 + c) for r in range(2, 7) for c in range(5, 10)]
    means = {r.site_id: r for r in extract_topography(grid, sites, 30.0, shape=(4, 4), halo=8).collect()}
    assert math.isclose(means[1].elevation_mean, 4 * 20 + 7) and means[2].tpi is None


def test_cells_around_sites_are_never_broadcast(spark, sf_dir):
    """Spark's size estimate leaves out that each site has 25 cells."""
    assert "BroadcastHashJoin" not in terrain_patches(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    grid = spark.createDataFrame([(r, c, 1.0) for r in range(6) for c in range(6)], "row int, col int, elevation double")
    sites = spark.createDataFrame([(1, 0, 0), (2, 3, 3)], "site_id int, row int, col int")
    found = patch_arrays(grid, sites, ["elevation"])
    assert "BroadcastHashJoin" not in found._jdf.queryExecution().executedPlan().toString()
    assert {r.site_id: len(r.elevation) for r in found.collect()} == {1: 9, 2: 25}


def test_cells_with_halo_are_never_broadcast(spark, sf_dir, tmp_path):
    """Many sites on few tiles: estimates find the copied cells smaller than latitudes."""
    cells = [(r // 4, c // 4, r % 4, c % 4, float(r * 20 + c)) for r in range(12) for c in range(12)]
    spark.createDataFrame(cells, "tile_row int, tile_col int, row int, col int, elevation double").coalesce(1).write.parquet(f"{tmp_path}/grid")
    sites = spark.range(20_000).select(F.col("id").alias("site_id"), *((F.xxhash64("id", F.lit(k)) % n).cast("int").alias(c) for k, (c, n) in enumerate((("tile_row", 3), ("tile_col", 3), ("row", 4), ("col", 4)))), F.rand(1).alias("lat"))
    sites.withColumns({c: F.abs(c) for c in ("tile_row", "tile_col", "row", "col")}).coalesce(1).write.parquet(f"{tmp_path}/sites")
    for name in ("grid", "sites"):
        spark.read.parquet(f"{tmp_path}/{name}").createOrReplaceTempView(name)
    found = extract_topography(spark.table("grid"), spark.table("sites"), 30.0, shape=(4, 4), halo=7)
    for plan in (found, tiled_sites(spark, sf_dir)):
        joins = [x for x in plan._jdf.queryExecution().executedPlan().toString().splitlines() if "Join" in x]
        assert len(joins) >= 2 and not any("BuildLeft" in x or "BroadcastHashJoin [row" in x for x in joins)
    assert found.count() == 20_000 and found.where("elevation <> elevation OR elevation IS NULL").count() == 0


def test_summary_of_sites_sends_no_cells_through_the_driver(spark, sf_dir, monkeypatch):
    """The plan that the summary fixes: its only broadcasts have a row a tile."""
    plans = []
    monkeypatch.setattr(stats, "fixed", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or fixed(df))
    assert topography_summary(spark, sf_dir).count() == 4
    joins = [x for x in plans[0].splitlines() if "Join" in x]
    assert len(plans) == 1 and any("SortMergeJoin [row" in x for x in joins)
    assert not any("BuildLeft" in x or "BroadcastHashJoin [row" in x for x in joins)


def test_panes_are_the_windows(spark):
    rng = np.random.default_rng(5)
    rows = [(int(t), dt.datetime(1996 + int(y), int(m), 4), "L5", float(d) if d > 0.3 else None) for t, y, m, d in zip(rng.integers(0, 3, 200), rng.integers(0, 7, 200), rng.integers(1, 13, 200), rng.random(200), strict=True)]
    obs = spark.createDataFrame(rows, "tile int, ts timestamp_ntz, sensor string, v double").withColumn("t", F.datediff(F.to_date("ts"), F.lit("1990-01-01").cast("date")).cast("double"))
    years = [1997, 2000, 2003]
    want = windows.window_spans(windows.explode_target_years(obs, years, name="year"), ["tile", "year"])
    got = windows.merge_panes(windows.slice_panes(obs, ["tile"]), ["tile"], years)
    assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(map(tuple, want.collect()))


def test_each_observation_is_shuffled_once(spark, tmp_path):
    """Rows through exchanges, of an archive that all windows of three years hold."""
    obs = spark.createDataFrame([("t0", p, dt.datetime(1998 + i % 3, 1 + i % 12, 1 + i % 20), "L5", 0.1 * i) for p in range(20) for i in range(60)], "tile_id string, px long, ts timestamp_ntz, sensor string, v double")
    obs.write.parquet(f"{tmp_path}/obs")
    rows = map_inference.year_curves(spark.read.parquet(f"{tmp_path}/obs"), map_inference.Config((1998, 1999, 2000, 2001, 2002), steps=9))
    assert rows.count() == 100
    rows.collect()
    plan = rows._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    dealt = [x for x in plan.splitlines() if "REPARTITION_BY_COL" in x and "ReusedExchange" not in x]
    assert len(dealt) == 1 and "hashpartitioning(tile_id" in dealt[0] and plan.count("FileScan parquet") == 1


@pytest.mark.parametrize("few,bins", [(1, 2), (4, 8), (4096, 2048)])
def test_percentiles_by_histograms(spark, few, bins):
    rng = np.random.default_rng(2)
    n = 3000
    data = {
        "normal": rng.normal(size=n), "hot": np.where(rng.random(n) < 0.4, 7.0, rng.normal(size=n)), "wide": np.where(np.arange(n) % 2, 1e308, -1e308) * rng.random(n),
        "tiny": rng.random(n) * 1e-300, "one": np.full(n, 3.5), "same": np.repeat([1.0, 2.0], n // 2),
    }
    df = spark.createDataFrame([tuple(float(v[i]) for v in data.values()) + ((None, float("nan"))[i % 2], None if i else 4.0) for i in range(n)], ", ".join(f"{k} double" for k in [*data, "none", "single"]))
    shares = [0.0, 0.025, 0.25, 0.5, 0.9731, 1.0]
    got = ranks.percentiles(fixed(df), {k: F.col(k) for k in [*data, "none", "single"]}, shares, bins, few)
    want = df.agg(*(F.percentile(k, F.array(*map(F.lit, shares))).alias(k) for k in [*data, "single"])).first()
    assert got["none"] is None and all(got[k] == list(want[k]) for k in [*data, "single"])


def test_row_numbers_by_ranges(spark):
    df = spark.range(5000).select(F.pmod(F.xxhash64("id"), F.lit(997)).alias("k"), "id").repartition(7)
    rows = ranks.numbered(df, ["k", F.desc("id")]).collect()
    order = sorted(rows, key=lambda r: (r.k, -r.id))
    assert [r.number for r in order] == list(range(5000))
    chunks = joins.contiguous_chunks(df, ["k", "id"], 4, 5000)
    assert sorted((r.chunk, r["count"]) for r in chunks.groupBy("chunk").count().collect()) == [(i, 1250) for i in range(4)]
    turn = {r.id: r.job for r in joins.round_robin(df, ["k", "id"], 3).collect()}
    assert [turn[r.id] for r in sorted(rows, key=lambda r: (r.k, r.id))] == [i % 3 for i in range(5000)]
    assert ranks.numbered(df.where("false"), ["k"]).count() == 0
    plan = chunks._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "Window" not in plan


def test_blocks_of_rasters(spark, tmp_path):
    rng = np.random.default_rng(8)
    cells = {(int(y), int(r), int(c)): int(v) for y, r, c, v in zip(rng.integers(2000, 2003, 900), rng.integers(0, 700, 900), rng.integers(0, 900, 900), rng.integers(0, 256, 900), strict=True)}
    cover = spark.createDataFrame([(*k, v) for k, v in cells.items()], "year int, row int, col int, class int")
    blocks.write_blocks(blocks.encode_blocks(cover.union(cover.withColumn("class", F.lit(0)))), f"{tmp_path}/b")
    store = blocks.read_blocks(spark, f"{tmp_path}/b")
    assert store.where("length(cells) <> 65536").isEmpty() and store.count() == len({(y, r // 256, c // 256) for y, r, c in cells})
    part = blocks.read_rectangle(store, 2001, 250, 261, -3, 300)
    assert {(r.row, r.col): r["class"] for r in part.collect()} == {(r, c): cells.get((2001, r, c), 0) for r in range(250, 262) for c in range(-3, 301)}
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = blocks.touched(store, 2001, 250, 261, 0, 300)._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert all(x in plan for x in ("GreaterThanOrEqual(block_row,0)", "LessThanOrEqual(block_row,1)", "LessThanOrEqual(block_col,1)", "EqualTo(year,2001)"))
    points = spark.createDataFrame([(i, 2002, c + 0.5, -r - 0.5) for i, (y, r, c) in enumerate(cells) if y == 2002] + [(-1, 2002, -4.0, 5.0), (-2, 1990, 1.0, -1.0)], "id int, year int, lon double, lat double")
    got = {r.id: r["class"] for r in blocks.sample_blocks(points, store, 0.0, 0.0, 1.0).collect()}
    assert got == {i: v for i, (k, v) in enumerate(cells.items()) if k[0] == 2002} | {-1: 0, -2: 0}
    with pytest.raises(Exception, match="fit a byte"):
        blocks.encode_blocks(cover.withColumn("class", F.lit(300))).count()


def test_single_precision_networks():
    rng = np.random.default_rng(6)
    x = np.linspace(-5, 5, 4001).astype(np.float32)
    assert np.abs(nn.erf(x) - np.array([math.erf(v) for v in x])).max() < 1e-6
    image, w = rng.normal(size=(2, 3, 6, 5)), rng.normal(size=(4, 3, 3, 3))
    for mode in (("zeros", "zeros"), ("circular", "zeros")):
        for stride in ((1, 1), (2, 2)):
            p = nn.pad(image, 1, 1, mode)
            want = [[[[(p[b, :, i : i + 3, j : j + 3] * w[o]).sum() for j in range(0, 5, stride[1])] for i in range(0, 6, stride[0])] for o in range(4)] for b in range(2)]
            assert np.allclose(nn.dense(image, w, stride, mode), want)
    assert np.allclose(nn.pointwise(image, w[:, :, 0, 0]), np.einsum("bchw,oc->bohw", image, w[:, :, 0, 0]))
    for arch in ("sep", "res", "se", "multi"):
        make = lambda net, v=image[:, :1], arch=arch: nn.forward(net, "C2D", v, 3, "A", arch=arch)
        net = nn.Net(nn.random_weights(make, 1))
        single = make(net.single(), image[:, :1].astype(np.float32))
        assert single.dtype == np.float32 and np.allclose(single, make(net), atol=1e-4)


def test_smearing_in_batches_is_the_expression(spark):
    rng = np.random.default_rng(9)
    df = spark.createDataFrame([(i, float(x) if i % 7 else None, float(y)) for i, (x, y) in enumerate(rng.normal(0, 2, (200, 2)))], "id int, a double, b double")
    for lam in (-0.7, 0.0, 0.5, 2.0, 2.6):
        p, draws = Power(lam, 0.2, 1.1), rng.normal(size=128).tolist()
        how = [targets.Smear(p, tuple(draws), (-2.0, 2.5), (-3.0, 9.0)), targets.Smear(p, (), None, None)]
        got = {r.id: r for r in targets.smear_batches(df, {"x": [("a", how[0])], "y": [("b", how[1])], "both": [("a", how[0]), ("b", how[0])]}, ["id"]).collect()}
        want = df.select("id", targets.smeared(F.col("a"), p, draws, (-2.0, 2.5), (-3.0, 9.0)).alias("x"), targets.smeared(F.col("b"), p, None, None, None).alias("y"), targets.smeared(F.col("b"), p, draws, (-2.0, 2.5), (-3.0, 9.0)).alias("z"))
        for r in want.collect():
            both = [v for v in (r.x, r.z) if v is not None]
            for v, w in ((got[r.id].x, r.x), (got[r.id].y, r.y), (got[r.id].both, sum(both) / len(both) if both else None)):
                assert (v is None) == (w is None) and (v is None or math.isclose(v, w, rel_tol=1e-9, abs_tol=1e-12)), (lam, r, got[r.id])


def test_a_cloudy_first_scene_leaves_cells_to_the_next(spark):
    scenes = spark.createDataFrame([("early", 1, 0.0, 2.0, 1.0, dt.datetime(2020, 1, 1, 12), "L8"), ("late", 1, 0.5, 2.0, 1.0, dt.datetime(2020, 1, 1, 13), "L8")], "scene string, tile_id int, west double, north double, size double, ts timestamp_ntz, sensor string")
    pixels = spark.createDataFrame([("early", 0, 0, None, 5), ("early", 0, 1, 2.0, 6), ("late", 0, 0, 3.0, 7), ("late", 0, 1, 4.0, 8)], "scene string, row int, col int, red double, qa int")
    cells = spark.createDataFrame([(1, 10, 0.6, 1.5), (1, 11, 1.6, 1.5), (1, 12, 0.2, 1.5), (1, 13, 9.0, 9.0)], "tile_id int, px int, x double, y double")
    placed = observations.place_nearest(cells, scenes, pixels)
    days = observations.solar_mosaic(placed, ["px"], F.lit(-70.0), ["red", "qa"], ["ts"])
    assert {r.px: (r.red, r.qa, str(r.solar_day), r.ts.hour) for r in days.collect()} == {10: (3.0, 5, "2020-01-01", 12), 11: (2.0, 6, "2020-01-01", 12), 12: (None, 5, "2020-01-01", 12)}


def test_streams_of_folders_and_empty_windows(spark, tmp_path):
    """A table as Spark writes it, a single file, and a day without values."""
    rows = [(dt.datetime(2024, 1, d, h), "a", None if d == 2 else float(h)) for d in (1, 2, 3) for h in (1, 5)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, event_type string, value double")
    df.repartition(3).write.parquet(f"{tmp_path}/events.parquet")
    df.coalesce(1).write.parquet(f"{tmp_path}/other")
    (part,) = (p for p in (tmp_path / "other").iterdir() if p.name.endswith(".parquet"))
    for n, path in enumerate((f"{tmp_path}/events.parquet", str(part))):
        stats = windowed_stats(read_events(spark, path, df.schema))
        stats.writeStream.format("memory").queryName(f"s{n}").outputMode("complete").trigger(availableNow=True).start().awaitTermination()
        assert sorted((r.start.day, r.n, r["mean"]) for r in spark.table(f"s{n}").collect()) == [(1, 2, 3.0), (2, 2, None), (3, 2, 3.0)]
    with pytest.raises(Exception):
        read_events(spark, f"{tmp_path}/nothing.parquet", df.schema)


def test_merged_manifests_lists_and_bounds(spark, tmp_path):
    a = spark.createDataFrame([("t0", 2000, "ok", 5)], "tile_id string, year int, status string, n_px long")
    b = spark.createDataFrame([("t1", 2001, "error", "lost")], "tile_id string, year int, status string, error string")
    rows = {r.tile_id: r for r in sinks.merge_manifests([a, b]).collect()}
    assert rows["t0"].n_px == 5 and rows["t0"].error is None and rows["t1"].error == "lost" and rows["t1"].n_px is None
    sinks.write_csv(b.select("tile_id", "year"), f"{tmp_path}/list")
    assert [tuple(r) for r in spark.read.csv(f"{tmp_path}/list", header=True, inferSchema=True).collect()] == [("t1", 2001)]
    assert len([p for p in (tmp_path / "list").iterdir() if p.name.startswith("part")]) == 1
    df = spark.createDataFrame([(1.0,), (3.0,), (None,)], "x double")
    lo, hi = targets.scaled_bounds(df, {"x": Power(1.0, 1.0, 2.0)})["x"]
    assert math.isclose(lo, 0.0) and math.isclose(hi, 1.0)


def test_verification_of_what_was_asked_for(spark):
    pixels = spark.createDataFrame([("t0", 2000, 1.0, 2.0), ("t0", 2001, 1.0, None), ("t1", 2000, 1.0, 2.0)], "tile_id string, year int, native double, band double")
    asked = verify.requested(pixels, tiles=["t0"], years=[2000, 2001])
    assert sorted((r.tile_id, r.year) for r in asked.collect()) == [("t0", 2000), ("t0", 2001)]
    assert verify.requested(pixels).count() == 3 and verify.requested(pixels, years=[2000]).count() == 2
    checks = {(r.tile_id, r.year): r.valid_frac for r in verify.band_checks(asked, ["tile_id", "year"], ["band"]).collect()}
    assert checks == {("t0", 2000): 1.0, ("t0", 2001): 0.0}
    lost = verify.missing_outputs(pixels, ["t0", "t2"], [2000])
    assert [(r.tile_id, r.year) for r in lost.collect()] == [("t2", 2000)]


def test_a_constant_band_in_parts(spark):
    """Means of 47 threes are merged as 3 / 47 * 47, which isn't 3."""
    third = F.when(F.col("id") % 3 == 0, float("nan")).otherwise(F.lit(3.0))
    pixels = spark.range(0, 94, 1, 2).select(F.lit("t0").alias("tile_id"), F.lit(1.0).alias("native"), F.lit(3.0).alias("flat"), F.when(F.col("id") < 47, 3.0).otherwise(3.5).alias("two"), third.alias("nan"), F.lit(float("inf")).alias("inf"), F.lit(None).cast("double").alias("none"))
    checks = verify.band_checks(pixels, ["tile_id"], ["flat", "two", "nan", "inf", "none"])
    sd = {r.band: r.sd for r in checks.collect()}
    assert (sd["flat"], sd["none"]) == (0.0, None) and math.isclose(sd["two"], 0.25) and math.isnan(sd["nan"]) and math.isnan(sd["inf"])
    assert sorted((r.band, r.problem) for r in verify.band_problems(checks, ["tile_id"]).collect()) == [("flat", "constant band"), ("none", "too few valid cells")]
