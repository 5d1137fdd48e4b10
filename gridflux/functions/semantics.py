"""Null, NaN and infinity rules that every operator shares.

Missing values are null inside Spark; NaN becomes null where data enters.
Division keeps IEEE results (x/0 is an infinity, 0/0 missing), since clipping
that follows turns an infinity into a bound and must not see a null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def inf(sign: int = 1) -> Column:
    return F.lit(sign * float("inf"))


def nan_to_null(x: Column) -> Column:
    return F.when(~F.isnan(x), x)


def clean(df: DataFrame) -> DataFrame:
    """NaN to null in all float columns."""
    kinds = dict(df.dtypes)
    return df.select(*(nan_to_null(F.col(c)).alias(c) if kinds[c] in ("double", "float") else F.col(c) for c in df.columns))


def ieee_div(num: Column, den: Column) -> Column:
    """num / den with infinities for a zero denominator and null for 0/0."""
    return F.when(den != 0, num / den).when(num > 0, inf()).when(num < 0, inf(-1))


def clip(x: Column, low: Column | float, high: Column | float) -> Column:
    """x in [low, high]; null stays null (least and greatest alone would skip it)."""
    low, high = (F.lit(v) if not isinstance(v, Column) else v for v in (low, high))
    return F.when(x.isNotNull(), F.greatest(low, F.least(high, x)))


def safe_log10(x: Column) -> Column:
    return F.when(x > 0, F.log10(x))


def days_since_epoch(ts: Column) -> Column:
    return F.datediff(F.to_date(ts), F.lit("1970-01-01").cast("date")).cast("double")


def circular(day: Column, period: float = 365.0) -> tuple[Column, Column]:
    """Sine and cosine of a day of the year."""
    angle = day * (2 * 3.141592653589793 / period)
    return F.sin(angle), F.cos(angle)


def doy_label(x: Column, low: Column) -> Column:
    """Day-of-year label of a grid position: 1 at its start, a year is 365.25 days."""
    return F.pmod(x - low, F.lit(365.25)) + 1


def wrap_doy(x: Column) -> Column:
    return F.pmod(x, F.lit(365.0))
