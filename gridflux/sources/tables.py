"""Catalogue tables: features, targets, land cover, legends, tiles, manifests."""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridflux.functions.geo import parse_tile, to_utm
from gridflux.functions.semantics import clean
from gridflux.operators.design import Tables, step_columns
from gridflux.operators.joins import require_ids
from gridflux.operators.targets import SOURCES, load_targets, resolve

MANIFEST = (
    "tile_id string, year int, status string, n_px bigint, n_native bigint, n_pred bigint, n_dates_window int, grid_first double, "
    "grid_last double, seconds double, load_seconds double, file string, error string"
)
LEGEND = "code int, name string"
TILES = "tile_id string, xmin double, ymin double, xmax double, ymax double"


@dataclass(frozen=True)
class Layout:
    """Which physical tables a run reads; part of any cache key."""

    root: str
    unified: bool = False
    curves: str = "curves.parquet"

    @classmethod
    def from_environment(cls, root: str) -> Layout:
        return cls(root, os.environ.get("GRIDFLUX_UNIFIED", "") == "1", os.environ.get("GRIDFLUX_CURVES", "curves.parquet"))


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists in whatever store its scheme names."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def read_optional(spark: SparkSession, path: str, hint: str) -> DataFrame:
    if not exists(spark, path):
        raise FileNotFoundError(f"{path} isn't there; {hint}")
    return clean(spark.read.parquet(path))


def prefixed_ids(df: DataFrame, prefix: str, key: str = "id") -> DataFrame:
    return df.withColumn(key, F.concat(F.lit(prefix), F.col(key).cast("string")))


def wide_curves(df: DataFrame, keys: list[str]) -> DataFrame:
    """Wide step columns as one array, in the order of their numbers."""
    steps = step_columns(df.columns)
    return df.select(*keys, F.array(*(F.col(c).cast("double") for c in steps)).alias("curve"))


def load_tables(spark: SparkSession, layout: Layout) -> Tables:
    """All tables with complete ids (topography and curves must hold every plot)."""
    root = layout.root
    plots = read_optional(spark, f"{root}/{'unified_' if layout.unified else ''}plots.parquet", "it names the plots")
    if layout.unified:
        plots = plots.withColumn("id", F.concat(F.when(F.col("source") == "living_trees", "LT_").otherwise("PCL_"), F.col("id").cast("string")))
    curves = read_optional(spark, f"{root}/{layout.curves}", "extract the curves first")
    topo = read_optional(spark, f"{root}/topography.parquet", "extract the topography first")
    for name, df in (("curves", curves), ("topography", topo)):
        require_ids(plots, df, "id", name)
    more = {n: clean(spark.read.parquet(f"{root}/{n}.parquet")) if exists(spark, f"{root}/{n}.parquet") else None for n in ("lsp", "cube", "climate")}
    return Tables(plots=plots, curves=curves, topo=topo, **more)


def read_targets(spark: SparkSession, root: str, target_set: str | list[str], ids: DataFrame, key: str = "id") -> DataFrame:
    names = resolve(target_set)
    sources = []
    for file, own in SOURCES.items():
        wanted = [t for t in names if t in own]
        if wanted:
            sources.append((read_optional(spark, f"{root}/{file}", "compute the responses first"), wanted))
    return load_targets(ids, sources, key)


def read_oof(spark: SparkSession, path: str, targets: list[str]) -> DataFrame:
    schema = "seed int, " + ", ".join(f"{t}_obs double, {t}_pred double" for t in targets)
    return clean(spark.read.csv(path, header=True, schema=schema))


def read_landcover(spark: SparkSession, folder: str) -> DataFrame:
    """Rasters of one folder (no sub-folders), the year from names such as cover_2004_v1.parquet."""
    rows = spark.read.option("recursiveFileLookup", "false").parquet(f"{folder}/*.parquet")
    year = F.regexp_extract(F.col("_metadata.file_name"), r"(\d{4})_", 1).cast("int")
    return rows.select(year.alias("year"), "row", "col", "class")


def available_years(spark: SparkSession, folder: str) -> DataFrame:
    files = spark.read.format("binaryFile").load(f"{folder}/*").select("path")
    return files.select(F.regexp_extract("path", r"(\d{4})_[^/]*$", 1).alias("y")).where("y <> ''").select(F.col("y").cast("int").alias("map_year")).distinct()


def read_legend(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, header=True, schema=LEGEND)


def read_tiles(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, header=True, schema=TILES)


def plot_extent(plots: DataFrame, margin_m: float) -> tuple[float, float, float, float]:
    """Envelope of projected plots with a margin."""
    x, y = to_utm(F.col("lon"), F.col("lat"))
    r = plots.select(x.alias("x"), y.alias("y")).agg(F.min("x"), F.min("y"), F.max("x"), F.max("y")).first()
    return r[0] - margin_m, r[1] - margin_m, r[2] + margin_m, r[3] + margin_m


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Manifest rows; files of older runs may lack the last columns."""
    return spark.read.csv(path, header=True, schema=MANIFEST, enforceSchema=True, mode="PERMISSIVE")


def listed_outputs(spark: SparkSession, folder: str) -> DataFrame:
    """(tile_id, year) of output objects by their names."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select("path")
    tile, year = parse_tile(F.col("path"))
    return files.select(tile.alias("tile_id"), year.alias("year")).where("tile_id IS NOT NULL").distinct()


def year_list(spec: str) -> list[int]:
    """Sorted distinct years of a specification such as 2000-2003,2010."""
    out: set[int] = set()
    for part in spec.split(","):
        a, _, b = part.strip().partition("-")
        out |= set(range(int(a), int(b or a) + 1))
    return sorted(out)


def year_rows(specs: DataFrame, column: str = "spec") -> DataFrame:
    """The same for a column of specifications: a row for each year."""
    part = F.explode(F.split(F.col(column), ",")).alias("part")
    bounds = specs.select(part).select(F.split(F.trim("part"), "-").alias("b"))
    years = F.sequence(F.col("b")[0].cast("int"), F.element_at("b", -1).cast("int"))
    return bounds.select(F.explode(years).alias("year")).distinct()
