"""Topography of sites: fill, layers, centre values and patch statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridflux.operators.stats import patch_arrays, patch_stats
from gridflux.operators.terrain import HALO, LAYERS, fill_holes, terrain_layers, valid_elevation, with_halo, without_halo

PATCH_HALF = 2  # cells of a patch to each side of its site


def site_cells(sites: DataFrame) -> DataFrame:
    """Extent and mean latitude of each elevation cell that holds sites."""
    return sites.groupBy("cell").agg(F.min("x").alias("xmin"), F.max("x").alias("xmax"), F.min("y").alias("ymin"), F.max("y").alias("ymax"), F.avg("lat").alias("lat"))


def extract_topography(dem: DataFrame, sites: DataFrame, res: float, done: DataFrame | None = None, biased_fill: bool = True, shape: tuple[int, int] | None = None,
                       halo: int = HALO) -> DataFrame:
    """(site_id, layer, layer_mean, layer_std …) for sites not done yet.

    ``dem``: tile_id, row, col, elevation with a halo.  ``sites``: site_id,
    tile_id, row, col, lat.  With ``shape``, the rows and columns of a tile, both have
    tile_row and tile_col in the place of tile_id: tiles take ``halo`` cells from their
    neighbours, and patches go on beyond a tile's border.
    """
    return patch_stats(*_placed(dem, sites, res, done, biased_fill, shape, halo), list(LAYERS))


def extract_patches(dem: DataFrame, sites: DataFrame, res: float, done: DataFrame | None = None, biased_fill: bool = True, shape: tuple[int, int] | None = None,
                    halo: int = HALO) -> DataFrame:
    """(site_id, height, width, an array a layer): the layers of 5 x 5 cells around each site."""
    return patch_arrays(*_placed(dem, sites, res, done, biased_fill, shape, halo), list(LAYERS))


def failed_sites(dem: DataFrame, sites: DataFrame) -> DataFrame:
    """(site_id, tile_id, error) of sites whose tile has no elevation at all: they are
    left out, the others go on."""
    there = dem.where(valid_elevation(F.col("elevation")).isNotNull()).select("tile_id").distinct()
    return sites.join(there, "tile_id", "left_anti").select("site_id", "tile_id", F.lit("empty elevation").alias("error"))


def _placed(dem: DataFrame, sites: DataFrame, res: float, done: DataFrame | None, biased_fill: bool, shape: tuple[int, int] | None, halo: int) -> tuple[DataFrame, DataFrame]:
    """Layers of the tiles that hold sites, and the sites, with rows that differ by tile."""
    tile = ["tile_row", "tile_col"] if shape else ["tile_id"]
    lats = sites.groupBy(*tile).agg(F.avg("lat").alias("lat"))  # of all sites of a tile, done or not
    if done is not None:
        sites = sites.join(done.select("site_id").distinct(), "site_id", "left_anti")
    asked = sites.select(*tile).distinct()
    grid = with_halo(dem, shape, halo, asked) if shape else dem.join(asked, tile, "left_semi")
    # All tiles asked for have a latitude.  Of a left join only the right side, a row a tile,
    # can be broadcast; size estimates leave out a halo's copies of cells.
    grid = grid.join(lats, tile, "left").withColumn("elevation", valid_elevation(F.col("elevation")))
    if shape:
        name = F.struct(*tile).alias("tile_id")
        grid, sites = grid.select(name, "row", "col", "elevation", "lat"), sites.select(name, *(c for c in sites.columns if c not in tile))
    # Beyond the archive's edge there is no halo: layers that need one are null there.
    layers = terrain_layers(fill_holes(grid, biased=biased_fill), res, F.col("lat"), edges="null" if shape else "published")
    if shape:
        layers = without_halo(layers, shape, PATCH_HALF)
    key = F.pmod(F.xxhash64("tile_id"), F.lit(1 << 40)) * (1 << 20)
    return layers.withColumn("row", key + F.col("row")), sites.withColumn("row", key + F.col("row"))
