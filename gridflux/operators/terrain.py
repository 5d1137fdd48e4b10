"""Terrain layers of an elevation grid (tile, row, col, elevation).

Neighbourhoods are windows along rows and along columns (``lag``/``lead`` and
moving means), so a tile's grid is sorted twice and never joined with itself;
diagonal neighbours are a vertical step of a horizontal one.  Halos are rows of
the same grid that are filtered afterwards (``crop``); ``with_halo`` brings a tile
those of its up to eight neighbours.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

NODATA, FLAT_DEG, TPI_RADIUS, HALO = -1000.0, 0.5, 3, 20
LAYERS = ("elevation", "slope", "aspect", "northness", "eastness", "heat_load", "tpi", "tri", "curvature")


def valid_elevation(e: Column) -> Column:
    return F.when(e > NODATA, e)


def scan_elevation(dem: DataFrame, tile: str, rows: tuple[int, int], cols: tuple[int, int], halo: int = HALO) -> DataFrame:
    """Valid elevations of a rectangle (bounds included) of a tile with a halo around it,
    numbered from the halo's corner; an error if there are none."""
    inside = (F.col("tile_id") == tile) & F.col("row").between(rows[0] - halo, rows[1] + halo) & F.col("col").between(cols[0] - halo, cols[1] + halo)
    part = dem.where(inside).withColumn("elevation", valid_elevation(F.col("elevation")))
    if part.where("elevation IS NOT NULL").isEmpty():
        raise ValueError(f"empty elevation in tile {tile}")
    return part.withColumn("row", F.col("row") - (rows[0] - halo)).withColumn("col", F.col("col") - (cols[0] - halo))


def with_halo(grid: DataFrame, shape: tuple[int, int], halo: int = HALO, tiles: DataFrame | None = None) -> DataFrame:
    """Each tile's cells with those of its neighbours at most ``halo`` cells away.

    ``grid``: tile_row, tile_col, row, col (within the tile, from 0) and other columns; a
    tile has ``shape`` rows and columns, fewer where the grid ends.  A copied cell has
    the place it would have in the neighbour's numbering, so rows and columns run from
    -halo to size + halo - 1.  Only cells near a border are copied, and only for tiles of
    ``tiles`` (tile_row, tile_col; all that are there if not given).  The halo may be wider
    than a tile.
    """
    (ny, nx), (ry, rx) = shape, (-(-halo // n) for n in shape)
    places = [(i, j) for i in range(-ry, ry + 1) for j in range(-rx, rx + 1)]
    near = F.filter(
        F.array(*(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i, j in places)),
        lambda p: (F.col("row") - p["i"] * ny).between(-halo, ny + halo - 1) & (F.col("col") - p["j"] * nx).between(-halo, nx + halo - 1),
    )
    rest = [c for c in grid.columns if c not in ("tile_row", "tile_col", "row", "col")]
    copied = grid.select("*", F.explode(near).alias("_p")).select(
        (F.col("tile_row") + F.col("_p.i")).alias("tile_row"), (F.col("tile_col") + F.col("_p.j")).alias("tile_col"),
        (F.col("row") - F.col("_p.i") * ny).alias("row"), (F.col("col") - F.col("_p.j") * nx).alias("col"), *rest,
    )
    wanted = (tiles if tiles is not None else grid).select("tile_row", "tile_col").distinct()
    return copied.join(wanted, ["tile_row", "tile_col"], "left_semi")


def without_halo(layers: DataFrame, shape: tuple[int, int], margin: int = 0) -> DataFrame:
    """A tile's own cells, with ``margin`` cells around them."""
    return layers.where(F.col("row").between(-margin, shape[0] - 1 + margin) & F.col("col").between(-margin, shape[1] - 1 + margin))


def _along_row(tile: str) -> Window:
    return Window.partitionBy(tile, "row").orderBy("col")


def _along_col(tile: str) -> Window:
    return Window.partitionBy(tile, "col").orderBy("row")


def fill_holes(grid: DataFrame, tile: str = "tile_id", biased: bool = True) -> DataFrame:
    """Missing elevations from the 3x3 around them.  ``biased`` counts missing
    neighbours as 0, as the published maps did; else they are left out."""
    value = F.coalesce("elevation", F.lit(0.0)) if biased else F.col("elevation")
    r, c = _along_row(tile).rowsBetween(-1, 1), _along_col(tile).rowsBetween(-1, 1)
    rows = grid.withColumn("_s", F.sum(value).over(r)).withColumn("_n", F.count(value).over(r))
    total = rows.withColumn("_s", F.sum("_s").over(c)).withColumn("_n", F.sum("_n").over(c))
    mean = F.when(F.col("_n") > 0, F.col("_s") / F.col("_n"))
    return total.withColumn("elevation", F.coalesce("elevation", mean)).drop("_s", "_n")


def gradient(grid: DataFrame, res: float, tile: str = "tile_id") -> DataFrame:
    """dz_drow, dz_dcol: central differences, one-sided at the edges."""

    def diff(w: Window) -> Column:
        e = F.col("elevation")
        after, before = F.lead("elevation").over(w), F.lag("elevation").over(w)
        has_after, has_before = F.lead(F.lit(1)).over(w), F.lag(F.lit(1)).over(w)
        return (
            F.when(has_after.isNotNull() & has_before.isNotNull(), (after - before) / (2 * res))
            .when(has_after.isNotNull(), (after - e) / res)
            .when(has_before.isNotNull(), (e - before) / res)
        )

    return grid.withColumn("dz_drow", diff(_along_col(tile))).withColumn("dz_dcol", diff(_along_row(tile)))


def slope(dz_drow: Column, dz_dcol: Column) -> Column:
    return F.degrees(F.atan(F.hypot(dz_drow, dz_dcol)))


def aspect(dz_drow: Column, dz_dcol: Column, slope_deg: Column) -> Column:
    """Downslope direction in degrees from north, clockwise; null where flat.
    Rows run from north to south."""
    toward = F.pmod(F.lit(90.0) - F.degrees(F.atan2(dz_drow, -dz_dcol)), F.lit(360.0))
    return F.when(slope_deg >= FLAT_DEG, toward)


def heat_load(lat_deg: Column, slope_deg: Column, aspect_deg: Column) -> Column:
    """McCune and Keon's index, folded about the north-west to south-east line; of the
    distance from the equator, so that both hemispheres agree."""
    lat, s = F.radians(F.abs(lat_deg)), F.radians(slope_deg)
    folded = F.radians(F.abs(F.lit(180.0) - F.abs(aspect_deg - 315.0)))
    return (
        F.lit(0.339) + F.cos(lat) * F.cos(s) * 0.808 - F.sin(lat) * F.sin(s) * 0.196 - F.cos(folded) * F.sin(s) * 0.482
    )


def _beside(value: str, w: Window, step: int, edges: str) -> Column:
    """The value one step along a line; beyond its end that of the other end ("wrap"),
    its own ("reflect") or null."""
    shift = F.lag if step < 0 else F.lead
    beyond = {"wrap": (F.last if step < 0 else F.first)(value).over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)), "reflect": F.col(value)}
    if edges == "null":
        return shift(value).over(w)
    return F.when(shift(F.lit(1)).over(w).isNull(), beyond[edges]).otherwise(shift(value).over(w))


def _box_mean(value: str, w: Window, radius: int) -> Column:
    """Mean along a line over ``radius`` cells to both sides; cells beyond an end count
    as the end's."""
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    place, size = F.row_number().over(w), F.count(F.lit(1)).over(whole)
    before, after = F.greatest(F.lit(0), radius + 1 - place), F.greatest(F.lit(0), radius - (size - place))
    total = F.sum(value).over(w.rowsBetween(-radius, radius)) + before * F.first(value).over(whole) + after * F.last(value).over(whole)
    return total / (2 * radius + 1)


def terrain_layers(grid: DataFrame, res: float, lat_deg: Column | float, tile: str = "tile_id", radius: int = TPI_RADIUS, edges: str = "published") -> DataFrame:
    """All layers.  At the edges of a tile, ``edges="published"`` repeats the edge for
    tpi, takes tri's neighbours from the other side and mirrors curvature; "null"
    leaves these three null within their radius."""
    lat = lat_deg if isinstance(lat_deg, Column) else F.lit(float(lat_deg))
    wrap, mirror = ("null", "null") if edges == "null" else ("wrap", "reflect")
    g = gradient(grid, res, tile)
    r, c = _along_row(tile), _along_col(tile)
    near = F.avg("elevation").over(r.rowsBetween(-radius, radius)) if edges == "null" else _box_mean("elevation", r, radius)
    g = g.withColumns({
        "slope": slope(F.col("dz_drow"), F.col("dz_dcol")),
        "_w": _beside("elevation", r, -1, wrap), "_e": _beside("elevation", r, 1, wrap),
        "_mw": _beside("elevation", r, -1, mirror), "_me": _beside("elevation", r, 1, mirror),
        "_m": near, "_k": F.count("elevation").over(r.rowsBetween(-radius, radius)),
    })
    box = F.avg("_m").over(c.rowsBetween(-radius, radius)) if edges == "null" else _box_mean("_m", c, radius)
    g = g.withColumns({
        "aspect": aspect(F.col("dz_drow"), F.col("dz_dcol"), F.col("slope")),
        "_n": _beside("elevation", c, -1, wrap), "_s": _beside("elevation", c, 1, wrap),
        "_mn": _beside("elevation", c, -1, mirror), "_ms": _beside("elevation", c, 1, mirror),
        "_nw": _beside("_w", c, -1, wrap), "_ne": _beside("_e", c, -1, wrap), "_sw": _beside("_w", c, 1, wrap), "_se": _beside("_e", c, 1, wrap),
        "_mean": box, "_full": F.sum("_k").over(c.rowsBetween(-radius, radius)),
    })
    e = F.col("elevation")
    around = [F.col(n) for n in ("_nw", "_n", "_ne", "_w", "_e", "_sw", "_s", "_se")]
    squares = sum((F.pow(x - e, F.lit(2)) for x in around[1:]), F.pow(around[0] - e, F.lit(2)))
    inside = F.col("_full") == (2 * radius + 1) ** 2 if edges == "null" else F.lit(True)
    return g.select(
        tile, "row", "col", "elevation", "slope", "aspect",
        F.cos(F.radians("aspect")).alias("northness"), F.sin(F.radians("aspect")).alias("eastness"),
        heat_load(lat, F.col("slope"), F.col("aspect")).alias("heat_load"),
        F.when(inside, e - F.col("_mean")).alias("tpi"), F.sqrt(squares).alias("tri"),
        ((F.col("_mn") + F.col("_ms") + F.col("_mw") + F.col("_me") - e * 4) / (res * res)).alias("curvature"),
    )


def crop(grid: DataFrame, halo: int, ny: int, nx: int) -> DataFrame:
    """Drop a halo and number the inner cells from 0."""
    inside = F.col("row").between(halo, halo + ny - 1) & F.col("col").between(halo, halo + nx - 1)
    return grid.where(inside).withColumn("row", F.col("row") - halo).withColumn("col", F.col("col") - halo)


def context_frame(layers: DataFrame, columns: list[str], area_m2: float, stratum: str, strata: tuple[str, ...], keep: list[str]) -> DataFrame:
    """Context columns in the order that a model expects; errors for others."""
    from math import log10

    if stratum not in strata:
        raise ValueError(f"unknown stratum {stratum}")
    made = {f"topo_{c}": F.col(c).cast("double") for c in layers.columns if c not in keep}
    made["topo_topo_flat"] = F.col("heat_load").isNull().cast("double")
    made["area_log10"] = F.lit(log10(area_m2))
    made |= {f"area_stratum_{s}": F.lit(1.0 if s == stratum else 0.0) for s in strata[1:]}
    lost = [c for c in columns if c not in made]
    if lost:
        raise ValueError(f"context columns that aren't made here: {lost}")
    return layers.select(*keep, *(made[c].alias(c) for c in columns))
