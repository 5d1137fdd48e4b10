"""Map inference: observations to back-transformed layers for each tile and year.

One lazy plan over all tiles and years: the archive is scanned once, for the years
that the windows need, and dealt once by pixel.  Each pixel and calendar year has one
pane of observations; windows of three years share their panes.  The spans of tiles
are added up from the panes' slices (the exchange is reused, so nothing is read
again), curves and predictions are columns beside a pixel's row: only native pixels
with a whole curve bring an image to the networks.  A tile and year whose networks fail
becomes an error row (``map_layers`` with ``isolate``); waves of tiles bound what any
other failure can cost.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridflux.functions.images import ordered, serpentine_order, wrap_pad
from gridflux.functions.semantics import days_since_epoch
from gridflux.operators.isolation import split_failures
from gridflux.operators.joins import backlog, done_pairs, status_rows
from gridflux.operators.landcover import is_native
from gridflux.operators.predict import Ensemble, back_transform, predict
from gridflux.operators.regularize import interpolated
from gridflux.operators.staging import fixed
from gridflux.operators.windows import SPAN, merge_panes, slice_panes
from gridflux.sources.observations import in_years
from gridflux.sources.sinks import write_tile_years

TILE_YEAR = ["tile_id", "year"]


@dataclass(frozen=True)
class Config:
    years: tuple[int, ...]
    steps: int = 100
    roll: int = 5
    min_obs: int = 5
    wave: int = 250


KEY = [*TILE_YEAR, "px"]


def pixel_panes(obs: DataFrame, config: Config) -> DataFrame:
    """(tile_id, px, pane, s): all observations of each pixel and calendar year, as (t,
    sensor, ts, v) in this order.  Rows are dealt by pixel, for the years' panes and for
    the windows alike, so each observation is shuffled once."""
    wanted = in_years(F.col("ts"), min(config.years) - SPAN + 1, max(config.years))
    rows = obs.where(wanted).select("tile_id", "px", F.year("ts").alias("pane"), F.struct(days_since_epoch(F.col("ts")).cast("double").alias("t"), "sensor", "ts", "v").alias("o"))
    return rows.repartition("tile_id", "px").groupBy("tile_id", "px", "pane").agg(F.sort_array(F.collect_list("o")).alias("s"))


def pane_spans(panes: DataFrame, config: Config) -> DataFrame:
    """(tile_id, year, lo, hi, n_dates_window): first and last clear slice, null with fewer
    than two, and all slices; added up from the panes' slices."""
    slices = panes.select("tile_id", F.explode("s").alias("o")).select("tile_id", "o.*")
    return merge_panes(slice_panes(slices, ["tile_id"]), ["tile_id"], list(config.years)).drop("n_clear")


def year_curves(obs: DataFrame, config: Config) -> DataFrame:
    """(tile_id, year, px, n_obs, lo, hi, n_dates_window, curve) for each pixel of each window.

    A pixel's panes are gathered once; a target year takes those of its window, which
    follow each other in time, so nothing is sorted again.
    """
    panes = pixel_panes(obs, config)
    clear = F.filter("s", lambda o: o["v"].isNotNull())
    pixels = panes.groupBy("tile_id", "px").agg(F.sort_array(F.collect_list(F.struct("pane", clear.alias("s")))).alias("panes"))
    windows = pixels.select("tile_id", "px", "panes", F.explode(F.array(*map(F.lit, config.years))).alias("year"))
    mine = F.filter("panes", lambda p: (p["pane"] <= F.col("year")) & (p["pane"] > F.col("year") - SPAN))
    series = windows.select(*KEY, F.flatten(F.transform(mine, lambda p: p["s"])).alias("s")).where(F.size("s") > 0)
    rows = series.join(pane_spans(panes, config), TILE_YEAR)  # a row for each tile and year: broadcast by its size
    return interpolated(rows.select(*KEY, "lo", "hi", "n_dates_window", "s"), [*KEY, "n_dates_window"], config.steps, config.roll, config.min_obs)


def map_layers(obs: DataFrame, cells: DataFrame, context: DataFrame, cover: DataFrame, model: Ensemble, config: Config,
               draws=None, bounds=None, limits=None, isolate: bool = False) -> DataFrame:
    """Layers of all tiles, years and pixels.  With ``isolate``, rows of a tile and year
    whose networks fail have no predictions but a message in ``error``; ``emit`` parts them.

    ``cells``: tile_id, px, row, col.  ``context``: tile_id, px and the model's
    context columns.  ``cover``: tile_id, px, year, class.
    """
    rows = map_rows(obs, cells, cover, config).join(context.select("tile_id", "px", *model.context), ["tile_id", "px"], "left")
    image = F.when(F.col("ready"), ordered(wrap_pad(F.col("curve"), model.side**2), serpentine_order(model.side)))
    keep = [*KEY, "row", "col", "n_obs", "span_days", "native", "lo", "hi", "n_dates_window"]
    preds = predict(rows.withColumn("image", image), model, keep, isolate=TILE_YEAR if isolate else None)
    more = ["error"] if isolate else []
    out = back_transform(preds, model, [*keep, *more], draws, bounds, limits)
    return out.select(*KEY, "row", "col", *model.targets, "n_obs", "span_days", "native", "lo", "hi", "n_dates_window", *more)


def emit(layers: DataFrame, planned: DataFrame, target: str, path: str) -> DataFrame:
    """Writes the tile-years of ``layers`` (made with ``isolate``) that have no error and
    returns the manifest's rows for all of ``planned``."""
    good, errors = split_failures(layers, TILE_YEAR)
    write_tile_years(good.drop("lo", "hi", "n_dates_window", "px"), path)
    return manifest_rows(good, planned, target, errors)


def map_rows(obs: DataFrame, cells: DataFrame, cover: DataFrame, config: Config) -> DataFrame:
    """What the networks are asked for: a row for each cell and year, with its curve;
    ``ready`` if it is native and has one."""
    years = F.explode(F.array(*map(F.lit, config.years))).alias("year")
    native = cover.select(*KEY, is_native(F.col("class")).alias("native"))
    grid = cells.select("*", years).join(native, KEY, "left").withColumn("native", F.coalesce("native", F.lit(False)))
    rows = grid.join(year_curves(obs, config), KEY, "left")
    return rows.select(
        *KEY, "row", "col", F.col("n_obs").cast("double").alias("n_obs"), (F.col("hi") - F.col("lo")).alias("span_days"), F.col("native").cast("double").alias("native"),
        "lo", "hi", "n_dates_window", "curve", (F.col("native") & F.col("curve").isNotNull()).alias("ready"),
    )


def manifest_rows(layers: DataFrame, planned: DataFrame, target: str, errors: DataFrame | None = None) -> DataFrame:
    """One row for each planned tile and year."""
    counts = layers.groupBy(*TILE_YEAR).agg(
        F.count("*").alias("n_px"), F.count_if(F.col("native") == 1).alias("n_native"), F.count(target).alias("n_pred"),
        F.max("n_dates_window").cast("int").alias("n_dates_window"), F.min("lo").alias("grid_first"), F.max("hi").alias("grid_last"),
        F.count("n_obs").alias("_seen"),
    )
    spark = layers.sparkSession
    errors = errors if errors is not None else spark.createDataFrame([], "tile_id string, year int, error string")
    return status_rows(planned, counts.where("_seen > 0").drop("_seen"), errors)


def pending_waves(tiles: DataFrame, years: list[int], manifest: DataFrame, size: int) -> Iterator[list[str]]:
    """Tiles that still miss a year, in waves of ``size`` (tile lists are short)."""
    lost = backlog(tiles, years, done_pairs(manifest)).select("tile_id").distinct().orderBy("tile_id")
    names = [r[0] for r in lost.toLocalIterator()]
    for i in range(0, len(names), size):
        yield names[i : i + size]


def run_waves(waves: Iterator[list[str]], run: Callable[[list[str]], DataFrame], append: Callable[[DataFrame], None]) -> int:
    """Run each wave and append its manifest rows; stop after a wave without one
    ok row.  Returns how many waves ran."""
    done = 0
    for names in waves:
        rows = fixed(run(names))  # a lost executor must not run the tiles again after the rows were appended
        append(rows)
        done += 1
        if rows.where("status = 'ok'").isEmpty():
            raise RuntimeError(f"wave {done} produced nothing")
    return done
