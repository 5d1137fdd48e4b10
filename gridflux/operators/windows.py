"""Causal windows: each observation belongs to up to three target years."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPAN = 3


def causal_window(date: Column, year: Column, span: int = SPAN) -> Column:
    """1 January of year - span + 1 up to 31 December of year, both included."""
    y = F.year(date)
    return (y <= year) & (y > year - span)


def explode_target_years(obs: DataFrame, years: list[int], ts: str = "ts", span: int = SPAN, name: str = "target_year") -> DataFrame:
    """A row for each requested year whose window holds the observation: one scan
    of the archive serves all windows."""
    y = F.year(ts)
    mine = F.filter(F.sequence(y, y + (span - 1)), lambda v: v.isin(*years))
    return obs.withColumn(name, F.explode(mine))


def window_spans(windowed: DataFrame, group: list[str], t: str = "t", v: str = "v", slices: tuple[str, ...] = ("ts", "sensor")) -> DataFrame:
    """Per group the time slices with a clear value (two sensors on one day are
    two), the first and last of them, and all slices clear or not; the span is
    null with fewer than two clear slices."""
    one = F.struct(*slices)
    clear = F.col(v).isNotNull()
    by_slice = windowed.groupBy(*group, one.alias("slice")).agg(  # few slices a group: small after the partial aggregate
        F.bool_or(clear).alias("clear"), F.min(F.when(clear, F.col(t))).alias("lo"), F.max(F.when(clear, F.col(t))).alias("hi")
    )
    out = by_slice.groupBy(*group).agg(
        F.count_if("clear").alias("n_clear"), F.count("*").alias("n_dates_window"), F.min("lo").alias("lo"), F.max("hi").alias("hi")
    )
    enough = F.col("n_clear") >= 2
    return out.withColumn("lo", F.when(enough, F.col("lo"))).withColumn("hi", F.when(enough, F.col("hi")))


def slice_panes(obs: DataFrame, group: list[str], t: str = "t", v: str = "v", slices: tuple[str, ...] = ("ts", "sensor")) -> DataFrame:
    """(group, pane, n_clear, n_dates, lo, hi): the time slices of each calendar year.  No
    slice is in two years, so windows add up their panes (``merge_panes``)."""
    clear = F.col(v).isNotNull()
    by_slice = obs.groupBy(*group, F.struct(*slices).alias("slice")).agg(
        F.bool_or(clear).alias("clear"), F.min(F.when(clear, F.col(t))).alias("lo"), F.max(F.when(clear, F.col(t))).alias("hi")
    )
    pane = F.year(F.col("slice")[slices[0]]).alias("pane")
    return by_slice.groupBy(*group, pane).agg(F.count_if("clear").alias("n_clear"), F.count("*").alias("n_dates"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))


def merge_panes(panes: DataFrame, group: list[str], years: list[int], name: str = "year", span: int = SPAN) -> DataFrame:
    """What ``window_spans`` gives for each target year, from rows by group and pane."""
    mine = F.filter(F.sequence(F.col("pane"), F.col("pane") + (span - 1)), lambda y: y.isin(*years))
    out = panes.withColumn(name, F.explode(mine)).groupBy(*group, name).agg(
        F.sum("n_clear").alias("n_clear"), F.sum("n_dates").alias("n_dates_window"), F.min("lo").alias("lo"), F.max("hi").alias("hi")
    )
    enough = F.col("n_clear") >= 2
    return out.withColumn("lo", F.when(enough, F.col("lo"))).withColumn("hi", F.when(enough, F.col("hi")))
