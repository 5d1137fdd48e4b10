"""Tile grid, affine cells and transverse Mercator as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# WGS 84, the UTM scale and offsets, zone 19 south.
AXIS, FLATTENING, SCALE, EAST, NORTH = 6378137.0, 1 / 298.257223563, 0.9996, 500000.0, 10000000.0
ZONE_19_MERIDIAN = -69.0
TILE_M, PIXEL_M = 9990.0, 30.0


def _series() -> tuple[float, list[float], list[float], list[float]]:
    """Rectifying radius and Krueger's coefficients to the third flattening's fourth power."""
    n = FLATTENING / (2 - FLATTENING)
    radius = AXIS / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    alpha = [
        n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16 + 41 * n**4 / 180,
        13 * n**2 / 48 - 3 * n**3 / 5 + 557 * n**4 / 1440,
        61 * n**3 / 240 - 103 * n**4 / 140,
        49561 * n**4 / 161280,
    ]
    beta = [
        n / 2 - 2 * n**2 / 3 + 37 * n**3 / 96 - n**4 / 360,
        n**2 / 48 + n**3 / 15 - 437 * n**4 / 1440,
        17 * n**3 / 480 - 37 * n**4 / 840,
        4397 * n**4 / 161280,
    ]
    delta = [
        2 * n - 2 * n**2 / 3 - 2 * n**3 + 116 * n**4 / 45,
        7 * n**2 / 3 - 8 * n**3 / 5 - 227 * n**4 / 45,
        56 * n**3 / 15 - 136 * n**4 / 35,
        4279 * n**4 / 630,
    ]
    return radius, alpha, beta, delta


RADIUS, ALPHA, BETA, DELTA = _series()
ECC = 2 * math.sqrt(FLATTENING / (2 - FLATTENING)) / (1 + FLATTENING / (2 - FLATTENING))


def _atanh(x: Column) -> Column:
    return F.log((1 + x) / (1 - x)) * 0.5


def to_utm(lon: Column, lat: Column, meridian: float = ZONE_19_MERIDIAN, south: bool = True) -> tuple[Column, Column]:
    """Easting and northing in metres."""
    phi, lam = F.radians(lat), F.radians(lon - meridian)
    s = F.sin(phi)
    t = F.sinh(_atanh(s) - _atanh(s * ECC) * ECC)
    xi, eta = F.atan2(t, F.cos(lam)), _atanh(F.sin(lam) / F.sqrt(t * t + 1))
    x, y = eta, xi
    for j, a in enumerate(ALPHA, 1):
        x = x + F.cos(xi * (2 * j)) * F.sinh(eta * (2 * j)) * a
        y = y + F.sin(xi * (2 * j)) * F.cosh(eta * (2 * j)) * a
    return x * (SCALE * RADIUS) + EAST, y * (SCALE * RADIUS) + (NORTH if south else 0.0)


def to_lonlat(x: Column, y: Column, meridian: float = ZONE_19_MERIDIAN, south: bool = True) -> tuple[Column, Column]:
    xi0, eta0 = (y - (NORTH if south else 0.0)) / (SCALE * RADIUS), (x - EAST) / (SCALE * RADIUS)
    xi, eta = xi0, eta0
    for j, b in enumerate(BETA, 1):
        xi = xi - F.sin(xi0 * (2 * j)) * F.cosh(eta0 * (2 * j)) * b
        eta = eta - F.cos(xi0 * (2 * j)) * F.sinh(eta0 * (2 * j)) * b
    chi = F.asin(F.sin(xi) / F.cosh(eta))
    phi = chi
    for j, d in enumerate(DELTA, 1):
        phi = phi + F.sin(chi * (2 * j)) * d
    return F.degrees(F.atan2(F.sinh(eta), F.cos(xi))) + meridian, F.degrees(phi)


def snapped_tile(tile_m: float = TILE_M, pixel_m: float = PIXEL_M) -> float:
    """Tile size as a whole number of pixels."""
    return max(1, round(tile_m / pixel_m)) * pixel_m


def tile_id(x: Column, y: Column, tile_m: float = TILE_M) -> Column:
    """Id of the lattice tile (origin at the projection's origin) that holds a point."""
    return F.concat(F.lit("t"), F.floor(x / tile_m).cast("string"), F.lit("_"), F.floor(y / tile_m).cast("string"))


def tile_grid(spark: SparkSession, xmin: float, ymin: float, xmax: float, ymax: float, tile_m: float = TILE_M) -> DataFrame:
    """Tiles of an extent; an edge on a tile boundary takes in the next tile too."""
    size = snapped_tile(tile_m)
    a, b, c, d = (math.floor(v / size) for v in (xmin, xmax, ymin, ymax))
    cells = spark.range(a, b + 1).withColumnRenamed("id", "ix").crossJoin(spark.range(c, d + 1).withColumnRenamed("id", "iy"))  # the tiles asked for
    return cells.select(
        F.format_string("t%d_%d", "ix", "iy").alias("tile_id"),
        (F.col("ix") * size).alias("xmin"), (F.col("iy") * size).alias("ymin"),
        ((F.col("ix") + 1) * size).alias("xmax"), ((F.col("iy") + 1) * size).alias("ymax"),
    )


def parse_tile(name: Column) -> tuple[Column, Column]:
    """(tile_id, year) of an output name such as t-3_17_2004.tif."""
    found = lambda k: F.regexp_extract(name, r"(t-?\d+_-?\d+)_(\d{4})\.\w+$", k)
    return F.nullif(found(1), F.lit("")), F.nullif(found(2), F.lit("")).cast("int")


def cell_centres(row: Column, col: Column, west: float, south: float, east: float, north: float, ny: int, nx: int) -> tuple[Column, Column]:
    """Longitude and latitude of cell centres; row 0 is in the north."""
    return (col + 0.5) * ((east - west) / nx) + west, F.lit(north) - (row + 0.5) * ((north - south) / ny)


def affine_cell(x: Column, y: Column, west: float, north: float, size: float) -> tuple[Column, Column]:
    """(row, col) of the cell that holds a point."""
    return F.floor((F.lit(north) - y) / size).cast("int"), F.floor((x - west) / size).cast("int")


def nearest_cell(value: Column, first: float, step: float, n: int) -> Column:
    """Index of the nearest of n regular positions; a tie goes to the first."""
    at = F.ceil((value - first) / step - 0.5)
    return F.greatest(F.lit(0), F.least(F.lit(n - 1), at)).cast("int")
