"""Checks of outputs: valid share, constant bands, tags, scaler round trips."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridflux.functions.power import Power, scaled, unscaled
from gridflux.operators.joins import backlog

LEAST_VALID, ROUND_TRIP = 0.05, 1e-6


def requested(rows: DataFrame, tiles: list[str] | None = None, years: list[int] | None = None) -> DataFrame:
    """Rows of the tiles and years asked for; all if none are named.  Both are bounds on
    the partition columns of written maps, so other files aren't read."""
    if tiles:
        rows = rows.where(F.col("tile_id").isin(*tiles))
    return rows.where(F.col("year").isin(*years)) if years else rows


def missing_outputs(rows: DataFrame, tiles: list[str], years: list[int]) -> DataFrame:
    """(tile_id, year) asked for by name and without any row."""
    asked = rows.sparkSession.createDataFrame([(t,) for t in sorted(set(tiles))], rows.select("tile_id").schema)
    return backlog(asked, years, requested(rows, tiles, years))


def band_checks(pixels: DataFrame, group: list[str], bands: list[str]) -> DataFrame:
    """(group, band, valid_frac, sd): share of native cells with a value, and the
    population deviation of the values, exactly 0 where all are one finite value."""
    pairs = F.explode(F.array(*(F.struct(F.lit(b).alias("band"), F.col(b).cast("double").alias("value")) for b in bands)))
    long = pixels.select(*group, "native", pairs.alias("s")).select(*group, "native", "s.band", "s.value")
    native = F.col("native").cast("boolean")
    # Deviations of parts are merged with rounding, so one value may get some 1e-16.
    sd = F.when(F.max("value") - F.min("value") == 0, F.lit(0.0)).otherwise(F.stddev_pop("value"))
    return long.groupBy(*group, "band").agg(
        F.avg(F.when(native, F.col("value").isNotNull().cast("double"))).alias("valid_frac"), sd.alias("sd")
    )


def band_problems(checks: DataFrame, group: list[str], least: float = LEAST_VALID) -> DataFrame:
    low = F.when(F.coalesce("valid_frac", F.lit(0.0)) < least, F.lit("too few valid cells"))
    flat = F.when(F.col("sd") == 0, F.lit("constant band"))
    return checks.select(*group, "band", F.explode(F.array_compact(F.array(low, flat))).alias("problem"))


def tag_problems(runs: DataFrame, seeds: int = 5, smearing: str = "oof") -> DataFrame:
    """Runs whose tags name another number of seeds or another smearing."""
    wrong = F.array_compact(F.array(
        F.when(F.coalesce(F.col("tags")["seeds"].cast("int"), F.lit(-1)) != seeds, F.lit("number of seeds")),
        F.when(F.coalesce(F.col("tags")["smearing"], F.lit("")) != smearing, F.lit("smearing")),
    ))
    return runs.select("run_id", F.explode(wrong).alias("problem"))


def round_trip(df: DataFrame, scalers: dict[str, Power]) -> DataFrame:
    """(target, error): largest relative error of scaling and back."""
    cols = [F.max(F.abs(unscaled(scaled(F.col(t), p), p) - F.col(t)) / (F.abs(F.col(t)) + 1e-12)).alias(t) for t, p in scalers.items()]
    wide = df.agg(*cols)
    return wide.select(F.explode(F.array(*(F.struct(F.lit(t).alias("target"), F.col(t).alias("error")) for t in scalers))).alias("s")).select("s.*")
