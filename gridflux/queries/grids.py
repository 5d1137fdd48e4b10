"""Queries on images of curves, terrain, models and streams."""

from __future__ import annotations

import math
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridflux.functions import images
from gridflux.functions.power import Power
from gridflux.operators import bagging, forest, predict, terrain
from gridflux.operators.isolation import map_isolated, split_failures
from gridflux.operators.joins import status_rows
from gridflux.operators.nn import forward, random_weights
from gridflux.operators.staging import shared_folder
from gridflux.operators.stats import describe, patch_stats
from gridflux.operators.targets import fit_scalers, oof_residuals, winsor_bounds
from gridflux.plans import map_inference
from gridflux.plans.topography import extract_patches, extract_topography, site_cells
from gridflux.queries.inputs import CURVE, GRID, GRID_COLS, OBS, TILE_PARTS, YEARS, curves, elevation_grid, observations, read, rounded
from gridflux.functions.indices import kndvi, ndvi, reflectance, with_clear

STEPS = 64


def _cells(rows: DataFrame, image: Column) -> DataFrame:
    """(id, row, col, value) of images."""
    lines = rows.select("id", F.posexplode(image).alias("row", "line"))
    return rounded(lines.select("id", "row", F.posexplode("line").alias("col", "value")))


def _line_sums(rows: DataFrame, image: Column) -> DataFrame:
    """Sum and largest value of each image row: fields have thousands of cells."""
    lines = rows.select("id", F.posexplode(image).alias("row", "line"))
    total = F.aggregate("line", F.lit(0.0), lambda s, x: s + x)
    return rounded(lines.select("id", "row", total.alias("total"), F.array_max("line").alias("top")))


def reshape_image(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cells(curves(spark, sf_dir), images.reshape(F.col("curve"), STEPS))


def serpentine_image(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cells(curves(spark, sf_dir), images.serpentine(F.col("curve"), STEPS))


def hilbert_image(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cells(curves(spark, sf_dir), images.hilbert(F.col("curve"), 3))


def wrapped_image(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Curves that start again to fill 9 x 9 cells, scaled to their own range."""
    return _cells(curves(spark, sf_dir), images.per_sample(images.fold(images.wrap_pad(F.col("curve"), 81), 9, 9)))


def _order_sql(order: str) -> str:
    return f"WITH {CURVE} SELECT id, CAST(({order}) // 8 AS INT) AS row, CAST(({order}) % 8 AS INT) AS col, round(v, 6) AS value FROM curve"


RESHAPE_SQL = _order_sql("i")
SERPENTINE_SQL = _order_sql("CASE WHEN (i // 8) % 2 = 0 THEN i ELSE (i // 8) * 8 + 7 - i % 8 END")
HILBERT_SQL = f"""
WITH RECURSIVE {CURVE},
h(d, t, s, x, y) AS (
  SELECT i, i, 1, 0, 0 FROM range(0, 64) r(i)
  UNION ALL
  SELECT d, t // 4, s * 2,
         CASE WHEN ry = 1 THEN x + s * rx WHEN rx = 1 THEN s - 1 - y + s ELSE y END,
         CASE WHEN ry = 1 THEN y + s WHEN rx = 1 THEN s - 1 - x ELSE x END
  FROM (SELECT *, (t // 2) & 1 AS rx, xor(t & 1, (t // 2) & 1) AS ry FROM h) WHERE s < 8)
SELECT id, CAST(y AS INT) AS row, CAST(x AS INT) AS col, round(v, 6) AS value FROM curve JOIN h ON d = i AND s = 8"""
WRAPPED_SQL = f"""
WITH {CURVE}, w AS (SELECT id, k, v FROM curve JOIN range(0, 81) r(k) ON i = k % 64),
m AS (SELECT id, min(v) AS lo, greatest(max(v) - min(v), 1e-8::DOUBLE) AS span FROM w GROUP BY id)
SELECT id, CAST(k // 9 AS INT) AS row, CAST(k % 9 AS INT) AS col, round((v - lo) / span, 6) AS value FROM w JOIN m USING (id)"""


def ndi_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of curves that are lifted to be positive, as vegetation indices are."""
    rows = curves(spark, sf_dir).withColumn("curve", F.transform("curve", lambda x: x * x + 0.01))
    return _line_sums(rows, images.ndi(F.col("curve")))


NDI_SQL = f"""
WITH {CURVE}, c AS (SELECT id, i, v * v + 0.01::DOUBLE AS v FROM curve),
p AS (SELECT a.id, a.i, CASE WHEN abs(a.v + b.v) > 1e-8 THEN (a.v - b.v) / (a.v + b.v) ELSE 0 END AS x FROM c a JOIN c b ON a.id = b.id)
SELECT id, CAST(i AS INT) AS row, round(sum(x), 6) AS total, round(max(x), 6) AS top FROM p GROUP BY id, i"""


def gaf_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = curves(spark, sf_dir).select("id", images.polar(F.col("curve")).alias("angles"))
    lines = rows.select("id", "angles", F.posexplode("angles").alias("row", "own"))
    total = lambda c: F.aggregate(c, F.lit(0.0), lambda s, x: s + x)
    plus, minus = images.gaf_line(F.col("own"), F.col("angles"))
    fields = lines.select("id", "row", plus.alias("plus"), minus.alias("minus"))
    return rounded(fields.select("id", "row", *(c for k in ("plus", "minus") for c in (total(F.col(k)).alias(f"{k}_total"), F.array_max(k).alias(f"{k}_top")))))


GAF_SQL = f"""
WITH {CURVE}, m AS (SELECT id, min(v) AS lo, greatest(max(v) - min(v), 1e-8::DOUBLE) AS span FROM curve GROUP BY id),
c AS (SELECT id, i, acos(greatest(-1.0::DOUBLE, least(1.0::DOUBLE, (v - lo) * 2 / span - 1))) AS f FROM curve JOIN m USING (id)),
p AS (SELECT a.id, a.i, cos(a.f + b.f) AS x, sin(a.f - b.f) AS y FROM c a JOIN c b ON a.id = b.id)
SELECT id, CAST(i AS INT) AS row, round(sum(x), 6) AS plus_total, round(max(x), 6) AS plus_top, round(sum(y), 6) AS minus_total, round(max(y), 6) AS minus_top
FROM p GROUP BY id, i"""


def mtf_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _line_sums(curves(spark, sf_dir), images.mtf(F.col("curve")))


MTF_SQL = f"""
WITH {CURVE},
e AS (SELECT id, list_distinct([quantile_cont(v, 0.2), quantile_cont(v, 0.4), quantile_cont(v, 0.6), quantile_cont(v, 0.8)]) AS edges FROM curve GROUP BY id),
q AS (SELECT id, i, len(list_filter(edges, lambda x: x <= v)) AS q FROM curve JOIN e USING (id)),
t AS (SELECT a.id, a.q AS a, b.q AS b, count(*) AS n FROM q a JOIN q b ON a.id = b.id AND b.i = a.i + 1 GROUP BY ALL),
s AS (SELECT id, a, b, n / sum(n) OVER (PARTITION BY id, a) AS share FROM t),
p AS (SELECT x.id, x.i, coalesce(share, 0) AS v FROM q x JOIN q y ON x.id = y.id LEFT JOIN s ON s.id = x.id AND s.a = x.q AND s.b = y.q)
SELECT id, CAST(i AS INT) AS row, round(sum(v), 6) AS total, round(max(v), 6) AS top FROM p GROUP BY id, i"""


def cwt_image(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _line_sums(curves(spark, sf_dir), images.cwt(F.col("curve")))


def _cwt_sql() -> str:
    """The transform from its definition: for a scale, differences of the sums of curve
    values times the integrated wavelet at scaled places, cut to the middle."""
    step = "((-8.0::DOUBLE + 16.0::DOUBLE / 1023) + 8.0::DOUBLE)"  # rounded as a difference of places
    return f"""
WITH {CURVE},
w AS (SELECT k, -8 + k * (16.0::DOUBLE / 1023) AS t FROM range(0, 1024) r(k)),
g AS (SELECT k, sum(exp(-t * t / 2) * cos(5 * t)) OVER (ORDER BY k) * {step} AS v FROM w),
p AS (SELECT CAST(s AS BIGINT) AS s, j, CAST(floor(j / (s * {step})) AS BIGINT) AS k FROM range(1, 25) a(s), range(0, 24 * 16 + 1) b(j) WHERE j <= 16 * s),
f AS (SELECT s, j, v FROM p JOIN g USING (k)),
m AS (SELECT s, max(j) AS last, count(*) AS n FROM f GROUP BY s),
kern AS (SELECT f.s, m.last - j AS j, v, m.n FROM f JOIN m USING (s)),
step AS (SELECT coalesce(a.s, b.s) AS s, coalesce(a.j, b.j + 1) AS j, coalesce(a.n, b.n) AS n, coalesce(a.v, 0) - coalesce(b.v, 0) AS d
         FROM kern a FULL JOIN kern b ON a.s = b.s AND a.j = b.j + 1),
o AS (SELECT c.id, s, c.i + j - 1 - (n - 2) // 2 AS x, sum(c.v * d) AS v FROM curve c JOIN step ON true GROUP BY c.id, s, x)
SELECT id, CAST(s - 1 AS INT) AS row, round(sum(abs(sqrt(s) * v)), 6) AS total, round(max(abs(sqrt(s) * v)), 6) AS top FROM o WHERE x BETWEEN 0 AND 63 GROUP BY id, s"""


def cos2d_image(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cells(curves(spark, sf_dir), images.cos2d(F.col("curve")))


def spectrogram_image(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _line_sums(curves(spark, sf_dir), images.spectrogram(F.col("curve")))


def _cos2d_sql() -> str:
    """Ten segments' worth: six values each, three apart."""
    return f"""
WITH {CURVE}, seg AS (SELECT id, k, j, v FROM curve JOIN range(0, 20) a(k) ON true JOIN range(0, 6) b(j) ON i = k * 3 + j WHERE k * 3 + 6 <= 64),
c AS (SELECT id, k, j, v - avg(v) OVER (PARTITION BY id, j) AS d FROM seg),
n AS (SELECT count(DISTINCT k) AS m FROM seg),
sync AS (SELECT a.id, a.j AS row, b.j AS col, sum(a.d * b.d) / (max(m) - 1) AS v FROM c a JOIN c b ON a.id = b.id AND a.k = b.k, n GROUP BY ALL),
asyn AS (SELECT a.id, a.j + 6 AS row, b.j AS col, sum(CASE WHEN a.k <> b.k THEN a.d * b.d / (pi() * (a.k - b.k)) ELSE 0 END) / (max(m) - 1) AS v
         FROM c a JOIN c b ON a.id = b.id, n GROUP BY ALL)
SELECT id, CAST(row AS INT) AS row, CAST(col AS INT) AS col, round(v, 6) AS value FROM (FROM sync UNION ALL FROM asyn)"""


def _spectrogram_sql() -> str:
    return f"""
WITH {CURVE}, w AS (SELECT j, 0.5 - 0.5 * cos(2 * pi() * j / 16) AS w FROM range(0, 16) r(j)),
f AS (SELECT i.id, k, w.j, w.w * coalesce(c.v, 0) AS x FROM (SELECT DISTINCT id FROM curve) i CROSS JOIN range(0, 17) f(k) CROSS JOIN w
      LEFT JOIN curve c ON c.id = i.id AND c.i = k * 4 + w.j - 8),
z AS (SELECT id, r, k, sqrt(pow(sum(x * cos(2 * pi() * r * j / 16)), 2) + pow(sum(x * sin(2 * pi() * r * j / 16)), 2)) / 8.0::DOUBLE AS v
      FROM f CROSS JOIN range(0, 9) q(r) GROUP BY id, r, k)
SELECT id, CAST(r AS INT) AS row, round(sum(v), 6) AS total, round(max(v), 6) AS top FROM z GROUP BY id, r"""



def terrain_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = elevation_grid(spark, sf_dir).withColumn("elevation", terrain.valid_elevation(F.col("elevation")))
    layers = terrain.terrain_layers(terrain.fill_holes(g), 30.0, (F.col("row") - 25) * 1.5)  # latitudes of both signs
    return rounded(layers, 6)


FILLED = f"""{GRID},
around AS (SELECT v.tile_id, v.row, v.col, v.elevation, sum(coalesce(n.elevation, 0)) / count(*) AS mean
           FROM valid v JOIN valid n ON n.tile_id = v.tile_id AND abs(n.row - v.row) <= 1 AND abs(n.col - v.col) <= 1 GROUP BY ALL),
filled AS (SELECT tile_id, row, col, coalesce(elevation, mean) AS e FROM around)"""


def _terrain_sql(lat: str = "(row - 25) * 1.5") -> str:
    """Edges as published: central differences one-sided, tpi with the edge repeated, tri
    with neighbours from the other side, curvature with the edge mirrored."""
    names = {"n": (-1, 0), "s": (1, 0), "w": (0, -1), "e": (0, 1)}
    joins = " ".join(f"LEFT JOIN filled {k} ON {k}.tile_id = c.tile_id AND {k}.row = c.row + {r} AND {k}.col = c.col + {q}" for k, (r, q) in names.items())
    cols = ", ".join(f"{k}.e AS z{k}" for k in names)
    return f"""
WITH {FILLED},
lim AS (SELECT *, min(col) OVER r AS c0, max(col) OVER r AS c1, min(row) OVER c AS r0, max(row) OVER c AS r1 FROM filled
        WINDOW r AS (PARTITION BY tile_id, row), c AS (PARTITION BY tile_id, col)),
h AS (SELECT a.tile_id, a.row, a.col, a.r0, a.r1, avg(b.e) AS m FROM lim a, range(-3, 4) k(d) JOIN filled b ON b.tile_id = a.tile_id AND b.row = a.row AND b.col = least(a.c1, greatest(a.c0, a.col + d)) GROUP BY ALL),
m AS (SELECT a.tile_id, a.row, a.col, avg(b.m) AS mean FROM h a, range(-3, 4) k(d) JOIN h b ON b.tile_id = a.tile_id AND b.col = a.col AND b.row = least(a.r1, greatest(a.r0, a.row + d)) GROUP BY ALL),
side AS (SELECT a.tile_id, a.row, a.col, a.e, a.r0, a.r1, w.e AS ww, e.e AS we FROM lim a
         JOIN filled w ON w.tile_id = a.tile_id AND w.row = a.row AND w.col = CASE WHEN a.col = a.c0 THEN a.c1 ELSE a.col - 1 END
         JOIN filled e ON e.tile_id = a.tile_id AND e.row = a.row AND e.col = CASE WHEN a.col = a.c1 THEN a.c0 ELSE a.col + 1 END),
tri AS (SELECT a.tile_id, a.row, a.col, sqrt(pow(a.ww - a.e, 2) + pow(a.we - a.e, 2) + pow(n.e - a.e, 2) + pow(n.ww - a.e, 2) + pow(n.we - a.e, 2)
               + pow(s.e - a.e, 2) + pow(s.ww - a.e, 2) + pow(s.we - a.e, 2)) AS tri FROM side a
        JOIN side n ON n.tile_id = a.tile_id AND n.col = a.col AND n.row = CASE WHEN a.row = a.r0 THEN a.r1 ELSE a.row - 1 END
        JOIN side s ON s.tile_id = a.tile_id AND s.col = a.col AND s.row = CASE WHEN a.row = a.r1 THEN a.r0 ELSE a.row + 1 END),
x AS (SELECT c.tile_id, c.row, c.col, c.e AS z, {cols} FROM filled c {joins}),
g AS (SELECT *, CASE WHEN zs IS NOT NULL AND zn IS NOT NULL THEN (zs - zn) / 60 WHEN zs IS NOT NULL THEN (zs - z) / 30 ELSE (z - zn) / 30 END AS dr,
             CASE WHEN ze IS NOT NULL AND zw IS NOT NULL THEN (ze - zw) / 60 WHEN ze IS NOT NULL THEN (ze - z) / 30 ELSE (z - zw) / 30 END AS dc FROM x),
s AS (SELECT *, degrees(atan(sqrt(dr * dr + dc * dc))) AS slope FROM g),
a AS (SELECT *, CASE WHEN slope >= 0.5 THEN ((90 - degrees(atan2(dr, -dc))) % 360 + 360) % 360 END AS aspect, radians(abs({lat})) AS north FROM s)
SELECT tile_id, row, col, round(z, 6) AS elevation, round(slope, 6) AS slope, round(aspect, 6) AS aspect, round(cos(radians(aspect)), 6) AS northness, round(sin(radians(aspect)), 6) AS eastness,
       round(0.339::DOUBLE + 0.808::DOUBLE * cos(north) * cos(radians(slope)) - 0.196::DOUBLE * sin(north) * sin(radians(slope))
             - 0.482::DOUBLE * cos(radians(abs(180 - abs(aspect - 315)))) * sin(radians(slope)), 6) AS heat_load,
       round(z - mean, 6) AS tpi, round(tri, 6) AS tri,
       round((coalesce(zn, z) + coalesce(zs, z) + coalesce(zw, z) + coalesce(ze, z) - 4 * z) / 900, 6) AS curvature
FROM a JOIN m USING (tile_id, row, col) JOIN tri USING (tile_id, row, col)"""


def _blocks_of_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All parts as one grid of 40 columns, cut into tiles of 16 x 8 cells."""
    p = elevation_grid(spark, sf_dir)
    row = F.col("tile_id") * (TILE_PARTS // GRID_COLS) + F.col("row")
    return p.select(
        F.floor(row / SHAPE[0]).cast("int").alias("tile_row"), F.floor(F.col("col") / SHAPE[1]).cast("int").alias("tile_col"),
        (row % SHAPE[0]).cast("int").alias("row"), (F.col("col") % SHAPE[1]).cast("int").alias("col"), "elevation",
    )


SHAPE = (16, 8)


def tiled_terrain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Layers of a grid in tiles that take their halo from each other: those of the uncut one."""
    g = terrain.with_halo(_blocks_of_grid(spark, sf_dir).withColumn("elevation", terrain.valid_elevation(F.col("elevation"))), SHAPE, 5)
    g = g.withColumn("tile_id", F.struct("tile_row", "tile_col"))
    layers = terrain.terrain_layers(terrain.fill_holes(g), 30.0, (F.col("tile_id.tile_row") * SHAPE[0] + F.col("row") - 25) * 1.5, edges="null")
    layers = terrain.without_halo(layers, SHAPE)
    return rounded(layers.withColumn("row", F.col("tile_id.tile_row") * SHAPE[0] + F.col("row")).withColumn("col", F.col("tile_id.tile_col") * SHAPE[1] + F.col("col")).drop("tile_id"), 6)


UNCUT = f"""
grid AS (SELECT CAST(p_partkey // {GRID_COLS} AS INT) AS row, CAST(p_partkey % {GRID_COLS} AS INT) AS col,
                CASE WHEN p_partkey % 97 <> 5 THEN p_retailprice + p_size * 10.0 END AS elevation FROM part),
filled AS (SELECT a.row, a.col, coalesce(a.elevation, sum(coalesce(n.elevation, 0)) / count(*)) AS e
           FROM grid a JOIN grid n ON abs(n.row - a.row) <= 1 AND abs(n.col - a.col) <= 1 GROUP BY a.row, a.col, a.elevation),
near AS (SELECT a.row, a.col, a.e AS z, max(n.e) FILTER (n.row = a.row - 1 AND n.col = a.col) AS zn, max(n.e) FILTER (n.row = a.row + 1 AND n.col = a.col) AS zs,
                max(n.e) FILTER (n.row = a.row AND n.col = a.col - 1) AS zw, max(n.e) FILTER (n.row = a.row AND n.col = a.col + 1) AS ze,
                avg(n.e) AS mean, count(*) AS n49, sum(pow(n.e - a.e, 2)) FILTER (abs(n.row - a.row) <= 1 AND abs(n.col - a.col) <= 1) AS sq,
                count(*) FILTER (abs(n.row - a.row) <= 1 AND abs(n.col - a.col) <= 1) AS n9
         FROM filled a JOIN filled n ON abs(n.row - a.row) <= 3 AND abs(n.col - a.col) <= 3 GROUP BY a.row, a.col, a.e),
g AS (SELECT *, CASE WHEN zs IS NOT NULL AND zn IS NOT NULL THEN (zs - zn) / 60 WHEN zs IS NOT NULL THEN (zs - z) / 30 ELSE (z - zn) / 30 END AS dr,
             CASE WHEN ze IS NOT NULL AND zw IS NOT NULL THEN (ze - zw) / 60 WHEN ze IS NOT NULL THEN (ze - z) / 30 ELSE (z - zw) / 30 END AS dc FROM near),
s AS (SELECT *, degrees(atan(sqrt(dr * dr + dc * dc))) AS slope FROM g),
uncut AS (SELECT *, CASE WHEN slope >= 0.5 THEN ((90 - degrees(atan2(dr, -dc))) % 360 + 360) % 360 END AS aspect, CASE WHEN n49 = 49 THEN z - mean END AS tpi,
                 CASE WHEN n9 = 9 THEN sqrt(sq) END AS tri, (zn + zs + zw + ze - 4 * z) / 900 AS curvature FROM s)"""

TILED_SQL = f"""
WITH {UNCUT}, a AS (SELECT *, radians(abs((row - 25) * 1.5)) AS north FROM uncut)
SELECT row, col, round(z, 6) AS elevation, round(slope, 6) AS slope, round(aspect, 6) AS aspect, round(cos(radians(aspect)), 6) AS northness, round(sin(radians(aspect)), 6) AS eastness,
       round(0.339::DOUBLE + 0.808::DOUBLE * cos(north) * cos(radians(slope)) - 0.196::DOUBLE * sin(north) * sin(radians(slope))
             - 0.482::DOUBLE * cos(radians(abs(180 - abs(aspect - 315)))) * sin(radians(slope)), 6) AS heat_load,
       round(tpi, 6) AS tpi, round(tri, 6) AS tri, round(curvature, 6) AS curvature FROM a"""


def _tiled_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    sites, _ = _sites(spark, sf_dir)
    row = F.col("tile_id") * (TILE_PARTS // GRID_COLS) + F.col("row")
    return sites.select(
        "site_id", F.floor(row / SHAPE[0]).cast("int").alias("tile_row"), F.floor(F.col("col") / SHAPE[1]).cast("int").alias("tile_col"),
        (row % SHAPE[0]).cast("int").alias("row"), (F.col("col") % SHAPE[1]).cast("int").alias("col"), "lat",
    )


def tiled_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of patches at customers' cells, across the borders of tiles."""
    out = extract_topography(_blocks_of_grid(spark, sf_dir), _tiled_sites(spark, sf_dir), 30.0, shape=SHAPE, halo=7)
    return rounded(out.select("site_id", "elevation", "elevation_mean", "slope_mean", "northness_std", "tpi", "tpi_mean", "tri_mean", "curvature_mean"), 5)


TILED_SITES_SQL = f"""
WITH {UNCUT}, p AS (SELECT c_custkey AS site_id, c_custkey * 13 % (SELECT count(*) FROM part) + 1 AS p FROM customer),
t AS (SELECT site_id, CAST(p // {GRID_COLS} AS INT) AS r, CAST(p % {GRID_COLS} AS INT) AS q FROM p)
SELECT site_id, round(max(z) FILTER (row = r AND col = q), 5) AS elevation, round(avg(z), 5) AS elevation_mean, round(avg(slope), 5) AS slope_mean,
       round(stddev_pop(cos(radians(aspect))), 5) AS northness_std, round(max(tpi) FILTER (row = r AND col = q), 5) AS tpi, round(avg(tpi), 5) AS tpi_mean,
       round(avg(tri), 5) AS tri_mean, round(avg(curvature), 5) AS curvature_mean
FROM t JOIN uncut ON abs(row - r) <= 2 AND abs(col - q) <= 2 GROUP BY site_id"""


def terrain_patches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Elevation over 5 x 5 cells around each part, cut at the edge."""
    g = elevation_grid(spark, sf_dir).withColumn("elevation", terrain.valid_elevation(F.col("elevation")))
    g = g.withColumn("row", F.col("tile_id") * 1000 + F.col("row"))
    sites = g.select((F.col("row") * 100 + F.col("col")).alias("site_id"), "row", "col")
    return rounded(patch_stats(g, sites, ["elevation"]))


PATCH_SQL = f"""
WITH {GRID}, g AS (SELECT tile_id * 1000 + row AS row, col, elevation FROM valid)
SELECT s.row * 100 + s.col AS site_id, round(max(n.elevation) FILTER (n.row = s.row AND n.col = s.col), 6) AS elevation,
       round(avg(n.elevation), 6) AS elevation_mean, round(stddev_pop(n.elevation), 6) AS elevation_std
FROM g s JOIN g n ON abs(n.row - s.row) <= 2 AND abs(n.col - s.col) <= 2 GROUP BY s.row, s.col"""


def _sites(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Customers at parts of all tiles, north and south of the equator; done are those
    with an urgent order."""
    c, parts = read(spark, sf_dir, "customer"), read(spark, sf_dir, "part").count()
    at = F.pmod(F.col("c_custkey") * 13, F.lit(parts)) + 1
    sites = c.select(
        F.col("c_custkey").alias("site_id"), F.floor(at / TILE_PARTS).cast("int").alias("tile_id"), F.floor(at % TILE_PARTS / GRID_COLS).cast("int").alias("row"),
        (at % TILE_PARTS % GRID_COLS).cast("int").alias("col"), ((F.col("c_nationkey") - 9) * 2.0).alias("lat"),
    )
    done = read(spark, sf_dir, "orders").where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("site_id"))
    return sites, done


SITES = f"""spot AS (SELECT c_custkey AS site_id, (c_nationkey - 9) * 2.0::DOUBLE AS lat, c_custkey * 13 % (SELECT count(*) FROM part) + 1 AS p FROM customer),
sites AS (SELECT site_id, lat, CAST(p // {TILE_PARTS} AS INT) AS tile_id, CAST(p % {TILE_PARTS} // {GRID_COLS} AS INT) AS r, CAST(p % {TILE_PARTS} % {GRID_COLS} AS INT) AS q FROM spot),
todo AS (SELECT * FROM sites WHERE site_id NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT'))"""


def site_topography(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All layers and their 5 x 5 statistics at customers' cells, but for those done."""
    sites, done = _sites(spark, sf_dir)
    out = extract_topography(elevation_grid(spark, sf_dir), sites, 30.0, done)
    return rounded(out.select("site_id", "elevation", "elevation_mean", "slope", "slope_mean", "northness_std", "heat_load", "heat_load_mean", "tpi", "tri_mean", "curvature"), 5)


def _site_layers_sql() -> str:
    layers = _terrain_sql("(SELECT avg(lat) FROM sites WHERE sites.tile_id = s.tile_id)").replace(", 6)", ", 13)").replace("WITH ", f"WITH {SITES}, ", 1)
    return f"""
WITH layers AS ({layers}), {SITES},
n AS (SELECT site_id, l.*, l.row = r AND l.col = q AS here, l.row - r AS dr, l.col - q AS dc FROM todo t JOIN layers l ON l.tile_id = t.tile_id AND abs(l.row - r) <= 2 AND abs(l.col - q) <= 2)"""


def _topography_sql() -> str:
    return f"""{_site_layers_sql()}
SELECT site_id, round(max(elevation) FILTER (here), 5) AS elevation, round(avg(elevation), 5) AS elevation_mean, round(max(slope) FILTER (here), 5) AS slope,
       round(avg(slope), 5) AS slope_mean, round(stddev_pop(northness), 5) AS northness_std, round(max(heat_load) FILTER (here), 5) AS heat_load, round(avg(heat_load), 5) AS heat_load_mean,
       round(max(tpi) FILTER (here), 5) AS tpi, round(avg(tri), 5) AS tri_mean, round(max(curvature) FILTER (here), 5) AS curvature
FROM n GROUP BY site_id"""


def site_patches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Patches of the layers as arrays: their shape, first and last slope, and sums."""
    sites, done = _sites(spark, sf_dir)
    p = extract_patches(elevation_grid(spark, sf_dir), sites, 30.0, done)
    total = F.aggregate("elevation", F.lit(0.0), lambda s, x: s + x)
    return rounded(p.select("site_id", "height", "width", F.get("slope", F.lit(0)).alias("first_slope"), F.element_at("slope", -1).alias("last_slope"), total.alias("elevation_sum")), 5)


def _site_patches_sql() -> str:
    return f"""{_site_layers_sql()}
SELECT site_id, CAST(count(DISTINCT row) AS INT) AS height, CAST(count(DISTINCT col) AS INT) AS width, round(arg_min(slope, (row, col)), 5) AS first_slope,
       round(arg_max(slope, (row, col)), 5) AS last_slope, round(sum(elevation), 5) AS elevation_sum FROM n GROUP BY site_id"""


def topography_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Summary of four layers at all customers' cells."""
    sites, _ = _sites(spark, sf_dir)
    return describe(extract_topography(elevation_grid(spark, sf_dir), sites, 30.0), ["elevation", "slope", "heat_load", "tpi"], 4)


def _summary_sql() -> str:
    q = ", ".join(f"round(quantile_cont(x, {p}), 4) AS {n}" for p, n in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75")))
    return f"""{_site_layers_sql().replace("FROM todo t", "FROM sites t")},
u AS (UNPIVOT (SELECT elevation, slope, heat_load, tpi FROM n WHERE here) ON elevation, slope, heat_load, tpi INTO NAME "column" VALUE x)
SELECT "column", count(x) AS count, round(avg(x), 4) AS mean, round(stddev_samp(x), 4) AS std, round(min(x), 4) AS min, {q}, round(max(x), 4) AS max FROM u GROUP BY "column" """


def site_extents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extent and mean latitude of each tile that holds customers."""
    sites, _ = _sites(spark, sf_dir)
    return rounded(site_cells(sites.select(F.col("tile_id").alias("cell"), F.col("col").alias("x"), F.col("row").alias("y"), "lat")))


EXTENT_SQL = f"WITH {SITES} SELECT tile_id AS cell, min(q) AS xmin, max(q) AS xmax, min(r) AS ymin, max(r) AS ymax, round(avg(lat), 6) AS lat FROM sites GROUP BY tile_id"


def stand_in_ensemble(side: int, context: tuple[str, ...], seeds: int = 5) -> predict.Ensemble:
    """Deterministic weights in the place of trained ones."""
    names = ("first", "second", "third")
    scalers = {t: Power(lam, 0.1, 1.3) for t, lam in zip(names, (0.3, 0.0, 1.0), strict=True)}
    make = lambda net: forward(net, "C2D", np.zeros((1, 1, side, side)), len(names), "A", np.zeros((1, len(context))))
    members = tuple(predict.Member(random_weights(make, s), scalers) for s in range(seeds))
    return predict.Ensemble(names, context, side, members, "A")


def cnn_ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five seeds over serpentine images of all embeddings, back-transformed."""
    model = stand_in_ensemble(8, ("label_share",))
    rows = curves(spark, sf_dir).select("id", F.col("curve").alias("image"), (F.col("label") / 10.0).alias("label_share"))
    preds = predict.predict(rows.withColumn("image", images.ordered(F.col("image"), images.serpentine_order(8))), model, ["id"])
    return rounded(predict.back_transform(preds, model, ["id"], limits={t: (-1.0, 50.0) for t in model.targets}))


def transparent_ensemble(side: int, context: tuple[str, ...], seeds: int = 5) -> predict.Ensemble:
    """An ensemble whose layers pass images on: kernels see their middle, channels are
    copied, and a shift of 20 keeps activations in their linear part.  A prediction is hence
    a seed's factor times the sum of the contexts and of the mean of every second cell of
    every second row (the third block's stride)."""
    model = stand_in_ensemble(side, context, seeds)
    members = []
    for seed, m in enumerate(model.members):
        w = {k: np.zeros_like(v) for k, v in m.weights.items()}
        for k, v in w.items():
            if k.endswith(".gamma"):
                v[:] = 1.0
            elif k.endswith(".var"):
                v[:] = 1 - 1e-5
            elif k.endswith(".dw") or k == "stem.w":
                v[..., 1, 1] = 1.0
            elif k.endswith(".pw"):
                v[np.arange(len(v)), np.arange(len(v)) % v.shape[1]] = 1.0
        w["stem.bn.beta"][:] = 20.0
        w["hidden.w"][:] = np.eye(*w["hidden.w"].shape)
        w["hidden.w"][0, -len(context) :] = 1.0
        w["out.w"][:, 0] = 0.5**seed
        w["out.b"][:] = -20 * 0.5**seed
        members.append(predict.Member(w, {t: Power(1.0, 0.1234567, 1.3 + k) for k, t in enumerate(model.targets)}))
    return predict.Ensemble(model.targets, context, side, tuple(members), "A")


def transparent_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ensemble of transparent layers over serpentine images of all embeddings."""
    model = transparent_ensemble(8, ("share",))
    rows = curves(spark, sf_dir).select("id", F.transform("curve", lambda x: F.floor(x * 64) / 64).alias("image"), (F.col("label") / 8.0).alias("share"))
    preds = predict.predict(rows.withColumn("image", images.ordered(F.col("image"), images.serpentine_order(8))), model, ["id"])
    return rounded(predict.back_transform(preds, model, ["id"]), 5)


TRANSPARENT_SQL = f"""
WITH {CURVE}, m AS (SELECT id, any_value(label) / 8.0::DOUBLE + avg(floor(v * 64) / 64) FILTER (i // 8 % 2 = 0 AND i % 2 = 0) AS z FROM curve GROUP BY id),
f AS (SELECT id, z * (1 + 0.5 + 0.25 + 0.125 + 0.0625)::DOUBLE / 5 AS z FROM m)
SELECT id, round(z * 1.3::DOUBLE + 0.1234567::DOUBLE, 5) AS first, round(z * 2.3::DOUBLE + 0.1234567::DOUBLE, 5) AS second, round(z * 3.3::DOUBLE + 0.1234567::DOUBLE, 5) AS third FROM f"""


def _map_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Observations with kNDVI, cells, context and land cover of all parts and years."""
    obs = with_clear(observations(spark, sf_dir))
    v = kndvi(ndvi(reflectance(F.col("nir"), F.col("clear")), reflectance(F.col("red"), F.col("clear"))))
    obs = obs.select("tile_id", "px", "ts", "sensor", v.alias("v"))
    part = read(spark, sf_dir, "part")
    tile = F.concat(F.lit("t"), F.floor(F.col("p_partkey") / 2000).cast("string"))
    cells = part.select(tile.alias("tile_id"), F.col("p_partkey").alias("px"), F.floor(F.col("p_partkey") % 2000 / 40).cast("int").alias("row"), (F.col("p_partkey") % 40).cast("int").alias("col"))
    context = part.select(tile.alias("tile_id"), F.col("p_partkey").alias("px"), F.log("p_retailprice").alias("price"), (F.col("p_size") / 50).alias("size"))
    code = F.when(F.col("p_size") % 3 == 0, 3).when(F.col("p_size") % 3 == 1, 12).otherwise(21)
    cover = part.select(tile.alias("tile_id"), F.col("p_partkey").alias("px"), code.alias("class"), F.explode(F.array(*map(F.lit, YEARS))).alias("year"))
    return obs, cells, context, cover


MAP = map_inference.Config(YEARS, steps=25)


def map_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Map layers of all tiles, parts and target years from the observations."""
    obs, cells, context, cover = _map_inputs(spark, sf_dir)
    layers = map_inference.map_layers(obs, cells, context, cover, stand_in_ensemble(5, ("price", "size")), MAP)
    return rounded(layers.drop("lo", "hi"))


def map_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same up to the networks: what each pixel and year brings to them."""
    obs, cells, _, cover = _map_inputs(spark, sf_dir)
    rows = map_inference.map_rows(obs, cells, cover, MAP)
    mean = F.aggregate("curve", F.lit(0.0), lambda s, x: s + x) / F.size("curve")
    return rounded(rows.select("tile_id", "year", "px", "row", "col", "n_obs", "span_days", "native", "n_dates_window", "ready", mean.alias("curve_mean"), F.get("curve", F.lit(7)).alias("curve_7")))


def _map_sql() -> str:
    refl = lambda b: f"CASE WHEN clear AND {b} > 0 THEN {b} * 0.0000275::DOUBLE + -0.2::DOUBLE END"
    return f"""
WITH {OBS},
b AS (SELECT tile_id, px, ts, sensor, CAST(datediff('day', DATE '1970-01-01', CAST(ts AS DATE)) AS DOUBLE) AS t, {refl('red')} AS r, {refl('nir')} AS n FROM clear),
k AS (SELECT *, CASE WHEN n + r <> 0 THEN (n - r) / (n + r) WHEN n - r > 0 THEN 9e9 WHEN n - r < 0 THEN -9e9 END AS q FROM b),
w AS (SELECT tile_id, y.year, px, t, ts, sensor, CASE WHEN q IS NOT NULL THEN tanh(pow(greatest(-1.0, least(1.0, q)), 2)) END AS v
      FROM k JOIN (SELECT unnest({list(YEARS)}) AS year) y ON year(ts) BETWEEN y.year - 2 AND y.year),
spans AS (SELECT tile_id, year, min(t) FILTER (v IS NOT NULL) AS lo, max(t) FILTER (v IS NOT NULL) AS hi, count(DISTINCT (ts, sensor)) AS n_dates_window,
                 count(DISTINCT (ts, sensor)) FILTER (v IS NOT NULL) AS n_clear FROM w GROUP BY ALL),
o AS (SELECT w.*, CASE WHEN n_clear > 1 THEN lo END AS lo, CASE WHEN n_clear > 1 THEN hi END AS hi, n_dates_window FROM w JOIN spans USING (tile_id, year) WHERE v IS NOT NULL),
p AS (SELECT tile_id, year, px, count(*) AS n_obs, any_value(lo) AS lo, any_value(hi) AS hi, any_value(n_dates_window) AS n_dates_window FROM o GROUP BY ALL),
g AS (SELECT tile_id, year, px, i, lo + (hi - lo) * i / 24 AS x FROM p, range(0, 25) r(i) WHERE n_obs >= 5 AND lo <= hi),
n AS (SELECT g.tile_id, g.year, g.px, g.i, g.x, max({{'t': o.t, 'sensor': o.sensor, 'v': o.v}}) FILTER (o.t <= g.x) AS a, min({{'t': o.t, 'sensor': o.sensor, 'v': o.v}}) FILTER (o.t >= g.x) AS b
      FROM g JOIN o ON o.tile_id = g.tile_id AND o.year = g.year AND o.px = g.px GROUP BY ALL),
r AS (SELECT *, CASE WHEN a IS NULL THEN b.v WHEN b IS NULL OR b.t <= a.t THEN a.v ELSE a.v + (b.v - a.v) * (x - a.t) / (b.t - a.t) END AS raw FROM n),
s AS (SELECT *, avg(raw) OVER (PARTITION BY tile_id, year, px ORDER BY i ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS value FROM r),
c AS (SELECT tile_id, year, px, avg(value) AS m, max(value) FILTER (i = 7) AS seventh FROM s GROUP BY ALL)
SELECT 't' || CAST(p_partkey // 2000 AS VARCHAR) AS tile_id, CAST(y.year AS INT) AS year, p_partkey AS px, CAST(p_partkey % 2000 // 40 AS INT) AS row, CAST(p_partkey % 40 AS INT) AS col,
       CAST(n_obs AS DOUBLE) AS n_obs, hi - lo AS span_days, CAST(p_size % 3 < 2 AS DOUBLE) AS native, n_dates_window, p_size % 3 < 2 AND m IS NOT NULL AS ready,
       round(m, 6) AS curve_mean, round(seventh, 6) AS curve_7
FROM part CROSS JOIN (SELECT unnest({list(YEARS)}) AS year) y LEFT JOIN p ON p.px = p_partkey AND p.year = y.year LEFT JOIN c ON c.px = p_partkey AND c.year = y.year"""


def isolated_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status of all blocks of 100 parts by year: series of a block with a saturated
    band raise in their Arrow step and leave its error row, the others their layers."""
    obs = observations(spark, sf_dir)
    key = ["tile_id", "year"]
    series = obs.select((F.floor(F.col("px") / 100)).cast("long").alias("tile_id"), F.year("ts").alias("year"), "px", "nir").groupBy(*key, "px").agg(F.sort_array(F.collect_list("nir")).alias("nir"))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        size = batch.column(3).value_lengths().to_numpy()
        value = batch.column(3).flatten().to_numpy().astype(float)
        first = np.cumsum(size) - size
        for at in np.flatnonzero(np.maximum.reduceat(value, first) >= SATURATED):
            raise ValueError(f"saturated band in tile {batch.column(0)[at]} of {batch.column(1)[at]}")
        return pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(3)), pa.array(np.add.reduceat(value, first) / size)], names=[*key, "px", "level"])

    rows = map_isolated(series, work, "tile_id long, year int, px long, level double", key)
    good, errors = split_failures(rows, key)
    layers = good.groupBy(*key).agg(F.count("*").alias("n_px"), F.avg("level").alias("level"))
    planned = read(spark, sf_dir, "part").select(F.floor(F.col("p_partkey") / 100).cast("long").alias("tile_id")).distinct().select("tile_id", F.explode(F.array(*map(F.lit, YEARS))).alias("year"))
    return rounded(status_rows(planned, layers, errors))


SATURATED = 16_980
ISOLATED_SQL = f"""
WITH {OBS}, s AS (SELECT px // 100 AS tile_id, year(ts) AS year, px, max(nir) AS top, avg(nir) AS level FROM obs GROUP BY ALL),
t AS (SELECT tile_id, year, max(top) >= {SATURATED} AS bad, count(*) AS n_px, avg(level) AS level FROM s GROUP BY ALL),
p AS (SELECT DISTINCT p_partkey // 100 AS tile_id, CAST(y AS INT) AS year FROM part, (SELECT unnest({list(YEARS)}) AS y))
SELECT p.tile_id, p.year, CASE WHEN bad THEN 'error' WHEN bad IS NULL THEN 'no_data' ELSE 'ok' END AS status, CASE WHEN NOT bad THEN n_px END AS n_px,
       CASE WHEN NOT bad THEN round(level, 6) END AS level, CASE WHEN bad THEN 'ValueError: saturated band in tile ' || p.tile_id || ' of ' || p.year END AS error
FROM p LEFT JOIN t ON t.tile_id = p.tile_id AND t.year = p.year"""


def rf_regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forest of order prices on keys of their customer; predictions of all orders."""
    o = read(spark, sf_dir, "orders").select("o_orderkey", F.dayofyear("o_orderdate").cast("double").alias("doy"), F.year("o_orderdate").cast("double").alias("year"), (F.col("o_custkey") % 25).cast("double").alias("group"), F.log("o_totalprice").alias("price"))
    features = ["doy", "year", "group"]
    if o.where("price IS NOT NULL").limit(forest.LEAST_ROWS).count() < forest.LEAST_ROWS:
        return o.select("o_orderkey", F.lit(None).cast("double").alias("price_pred"))
    o = o.withColumn("_row", F.coalesce("o_orderkey", F.lit(0)))
    model = bagging.fit(o, "_row", features, ["price"])
    return rounded(bagging.predict(model, o, "_row", ["o_orderkey"]).select("o_orderkey", "price_pred"))


def forest_out_of_bag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A joint forest of customers' spending and number of orders, and its out-of-bag
    predictions of all customers with orders."""
    o = read(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.log(F.sum("o_totalprice")).alias("spent"), F.count("*").cast("double").alias("n"), F.avg(F.dayofyear("o_orderdate")).alias("doy"), F.max("o_totalprice").alias("top"))
    c = read(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", F.col("c_nationkey").cast("double").alias("nation"), F.length("c_mktsegment").cast("double").alias("segment"))
    rows = c.join(o, "c_custkey", "left")
    model = bagging.fit(rows, "c_custkey", ["c_acctbal", "nation", "segment", "doy", "top"], ["spent", "n"])
    return rounded(bagging.out_of_bag(model, rows, "c_custkey"), 5)


def _skewed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Balances, squares, and values of a narrow range next to 0, whose lambda is thousands below 0."""
    bal = (F.col("c_acctbal") + 1000) / 11000
    return read(spark, sf_dir, "customer").select((F.col("c_acctbal") / 1000.0).alias("bal"), F.pow(F.col("c_nationkey") + 1.0, F.lit(2.0)).alias("nat"), (F.pow(bal, F.lit(3.0)) * 1e-4 + 3.4e-4).alias("lcbd"))


def fit_yeo_johnson(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fitted scalers of three columns (lambda as digits and power of ten), and the
    winsorised residual bounds of the smallest seed's predictions."""
    c = _skewed(spark, sf_dir)
    scalers = fit_scalers(c, ["bal", "nat", "lcbd"])
    both = [x for t in scalers for x in (F.col(t).alias(f"{t}_obs"), (F.col(t) * 0.9 + (0.3e-4 if t == "lcbd" else 0.3)).alias(f"{t}_pred"))]
    oof = c.select(F.explode(F.array(F.lit(3), F.lit(8))).alias("seed"), "*").select("seed", *both)
    oof = oof.select("seed", *(F.when(F.col("seed") == 3, F.col(x)).otherwise(0.0).alias(x) for x in oof.columns[1:]))
    bounds = winsor_bounds(oof_residuals(oof, scalers), list(scalers))
    rows = []
    for t, p in scalers.items():
        power = math.floor(math.log10(abs(p.lam)))
        rows.append((t, p.lam / 10.0**power, power, p.mean, p.scale))
    fits = spark.createDataFrame(rows, "target string, digits double, power int, mean double, scale double")
    return rounded(bounds.join(fits, "target"), 3)


def _fit_sql(levels: int = 8) -> str:
    """Profile likelihood on a grid of lambdas, then on finer ones around the best."""
    loss = "ln(stddev_pop(CASE WHEN x >= 0 THEN CASE WHEN lam = 0 THEN l ELSE (exp(lam * l) - 1) / lam END ELSE CASE WHEN lam = 2 THEN l ELSE (exp((2 - lam) * -l) - 1) / (lam - 2) END END)) - (lam - 1) * avg(l)"
    steps = ["b0 AS (SELECT target, arg_min(lam, loss) AS best, abs(arg_min(lam, loss)) * 0.4 + 0.2 AS span FROM (SELECT target, lam, " + loss + " AS loss FROM g0 JOIN x USING (target) GROUP BY target, lam) GROUP BY target)"]
    for k in range(1, levels + 1):
        steps.append(f"g{k} AS (SELECT target, best + span * (i - 10) / 10 AS lam, span / 10 AS step FROM b{k - 1}, range(0, 21) r(i))")
        steps.append(f"b{k} AS (SELECT target, arg_min(lam, loss) AS best, any_value(step) AS span FROM (SELECT target, lam, any_value(step) AS step, {loss} AS loss FROM g{k} JOIN x USING (target) GROUP BY target, lam) GROUP BY target)")
    z = "CASE WHEN {x} >= 0 THEN (exp(best * ln(1 + {x})) - 1) / best ELSE (exp((2 - best) * ln(1 - {x})) - 1) / (best - 2) END"
    pred = "(x * 0.9 + CASE WHEN target = 'lcbd' THEN 0.3e-4 ELSE 0.3 END)"
    return f"""
WITH c AS (SELECT c_acctbal / 1000.0::DOUBLE AS bal, pow(c_nationkey + 1.0::DOUBLE, 2) AS nat, pow((c_acctbal + 1000) / 11000, 3) * 1e-4::DOUBLE + 3.4e-4::DOUBLE AS lcbd FROM customer),
x AS (SELECT target, x, sign(x) * ln(1 + abs(x)) AS l FROM (SELECT 'bal' AS target, bal AS x FROM c UNION ALL SELECT 'nat', nat FROM c UNION ALL SELECT 'lcbd', lcbd FROM c)),
most AS (SELECT target, max(abs(l)) AS m FROM x GROUP BY target),
g0 AS (SELECT target, s * pow(10, i / 8.0) AS lam FROM most, (SELECT unnest([-1.0::DOUBLE, 1.0::DOUBLE]) AS s), range(-8, 40) r(i) WHERE pow(10, i / 8.0) * m < 200),
{', '.join(steps)},
f AS (SELECT target, best, avg({z.format(x='x')}) AS mean, stddev_pop({z.format(x='x')}) AS scale FROM x JOIN b{levels} USING (target) GROUP BY ALL),
r AS (SELECT target, (({z.format(x='x')}) - ({z.format(x=pred)})) / scale AS r FROM x JOIN f USING (target)),
q AS (SELECT target, count(*) AS n, quantile_cont(r, 0.025) AS lo, quantile_cont(r, 0.975) AS hi FROM r GROUP BY target)
SELECT target, n, round(lo, 3) AS lo, round(hi, 3) AS hi, round(best / pow(10, floor(log10(abs(best)))), 3) AS digits, CAST(floor(log10(abs(best))) AS INT) AS power,
       round(mean, 3) AS mean, round(scale, 3) AS scale FROM q JOIN f USING (target)"""


def streaming_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a stream through daily windows until all is read (extension).  A row of
    each type far in the future closes all windows, so that all are written; the rows of
    days after the last event are theirs."""
    from gridflux.streaming.events import read_events, windowed_stats

    events = read(spark, sf_dir, "events")
    out = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"
    newest = events.agg(F.max("ts").alias("newest"))
    types = events.select("event_type").distinct().join(newest, F.lit(True))  # one row
    last = types.select("event_type", F.explode(F.array(*(F.col("newest") + F.expr(f"INTERVAL {d} DAYS") for d in (30, 60)))).alias("ts"))
    last.select(*(F.col(c) if c in ("event_type", "ts") else F.lit(None).cast(k).alias(c) for c, k in events.dtypes)).coalesce(1).write.parquet(f"{out}/last")
    stream = read_events(spark, f"{sf_dir}/events.parquet", events.schema).unionByName(read_events(spark, f"{out}/last", events.schema))
    stats = windowed_stats(stream)
    query = stats.writeStream.format("parquet").option("path", f"{out}/rows").option("checkpointLocation", f"{out}/state").trigger(availableNow=True).start()
    query.awaitTermination()
    rows = spark.read.schema(stats.schema).parquet(f"{out}/rows").join(newest, F.col("start") <= F.col("newest"))  # one row
    return rounded(rows.select(F.date_format("start", "yyyy-MM-dd").alias("day"), "event_type", "n", "mean", "low", "high"))


STREAM_SQL = """
SELECT strftime(CAST(ts AS DATE), '%Y-%m-%d') AS day, event_type, count(*) AS n, round(avg(value), 6) AS mean, min(value) AS low, max(value) AS high
FROM events GROUP BY CAST(ts AS DATE), event_type"""

QUERIES = {
    "reshape_image": reshape_image, "serpentine_image": serpentine_image, "hilbert_image": hilbert_image, "wrapped_image": wrapped_image,
    "ndi_field": ndi_field, "gaf_field": gaf_field, "mtf_field": mtf_field, "cwt_image": cwt_image, "cos2d_image": cos2d_image,
    "spectrogram_image": spectrogram_image, "terrain_derivatives": terrain_derivatives, "terrain_patches": terrain_patches, "site_topography": site_topography,
    "cnn_ensemble": cnn_ensemble, "map_pipeline": map_pipeline, "rf_regression": rf_regression, "fit_yeo_johnson": fit_yeo_johnson,
    "streaming_windows": streaming_windows, "map_rows": map_rows, "site_patches": site_patches, "topography_summary": topography_summary, "site_extents": site_extents,
    "tiled_terrain": tiled_terrain, "tiled_sites": tiled_sites, "isolated_tiles": isolated_tiles, "transparent_cnn": transparent_cnn, "forest_out_of_bag": forest_out_of_bag,
}
ORACLE_SQL = {
    "reshape_image": RESHAPE_SQL, "serpentine_image": SERPENTINE_SQL, "hilbert_image": HILBERT_SQL, "wrapped_image": WRAPPED_SQL,
    "ndi_field": NDI_SQL, "gaf_field": GAF_SQL, "mtf_field": MTF_SQL, "cos2d_image": _cos2d_sql(), "spectrogram_image": _spectrogram_sql(),
    "terrain_derivatives": _terrain_sql(), "terrain_patches": PATCH_SQL, "site_topography": _topography_sql(), "streaming_windows": STREAM_SQL,
    "cwt_image": _cwt_sql(), "map_rows": _map_sql(), "fit_yeo_johnson": _fit_sql(), "site_patches": _site_patches_sql(), "topography_summary": _summary_sql(), "site_extents": EXTENT_SQL,
    "tiled_terrain": TILED_SQL, "tiled_sites": TILED_SITES_SQL, "isolated_tiles": ISOLATED_SQL, "transparent_cnn": TRANSPARENT_SQL,
}
