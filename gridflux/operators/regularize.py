"""Irregular series onto a fixed grid.

Two plans with one result.  ``regularize`` is the relational form: grid rows and
observations share one sorted window per key, so it takes one shuffle by key
and streams through sorted partitions, never an as-of join.  ``regularize_arrays``
folds a key's observations into arrays by one grouped aggregate and interpolates
Arrow batches in numpy, which avoids the row for each grid step; it is the form
for map-scale grids (100 steps for each pixel and year).

Ties in time: the last tie is "previous", the first tie "next"; on a grid point
the previous wins.  Outside the observations the nearest is held constant.  A key
with fewer than ``min_obs`` values has a null curve.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gridflux.functions.semantics import doy_label

STEPS, ROLL, MIN_OBS = 52, 5, 5


def grid_position(lo: Column, hi: Column, i: Column, steps: int) -> Column:
    return lo + (hi - lo) * i / (steps - 1)


def half_width(roll: int | None) -> int:
    """A roll of 1 or less is the identity; an even roll acts as the next odd one."""
    return 0 if not roll or roll <= 1 else roll // 2


def own_spans(obs: DataFrame, key: list[str], t: str = "t", v: str = "v") -> DataFrame:
    return obs.where(F.col(v).isNotNull()).groupBy(*key).agg(F.min(t).alias("lo"), F.max(t).alias("hi"))


def regularize(obs: DataFrame, spans: DataFrame, key: list[str], steps: int = STEPS, roll: int = ROLL, min_obs: int = MIN_OBS) -> DataFrame:
    """(key, i, x, raw, value, n_obs) for each grid step.

    ``obs``: key, t (number), tie, v.  ``spans``: key, lo, hi; keys without
    lo < hi have no rows.
    """
    valid = obs.where(F.col("v").isNotNull()).select(*key, F.col("t").cast("double").alias("t"), "tie", "v")
    good = spans.where(F.col("lo") < F.col("hi"))
    grid = good.select(*key, F.explode(F.sequence(F.lit(0), F.lit(steps - 1))).alias("i"), "lo", "hi").select(
        *key, "i", grid_position(F.col("lo"), F.col("hi"), F.col("i"), steps).alias("t")
    )
    both = valid.withColumn("i", F.lit(None).cast("int")).unionByName(grid, allowMissingColumns=True)
    point = F.when(F.col("v").isNotNull(), F.struct("t", "tie", "v"))
    by_time = Window.partitionBy(*key).orderBy("t")
    both = both.select(
        *key, "i", "t",
        F.max(point).over(by_time.rangeBetween(Window.unboundedPreceding, 0)).alias("a"),
        F.min(point).over(by_time.rangeBetween(0, Window.unboundedFollowing)).alias("b"),
        F.count("v").over(Window.partitionBy(*key)).alias("n_obs"),
    )
    raw = (
        F.when(F.col("a").isNull(), F.col("b.v"))
        .when(F.col("b").isNull() | (F.col("b.t") <= F.col("a.t")), F.col("a.v"))
        .otherwise(F.col("a.v") + (F.col("b.v") - F.col("a.v")) * (F.col("t") - F.col("a.t")) / (F.col("b.t") - F.col("a.t")))
    )
    rows = both.where(F.col("i").isNotNull()).select(*key, "i", F.col("t").alias("x"), raw.alias("raw"), "n_obs")
    h = half_width(roll)
    near = Window.partitionBy(*key).orderBy("i").rowsBetween(-h, h)
    value = F.avg("raw").over(near) if h else F.col("raw")
    return rows.withColumn("value", F.when(F.col("n_obs") >= min_obs, value))


def raw_series(obs: DataFrame, key: list[str], group: list[str], steps: int = STEPS, roll: int = 3, min_obs: int = MIN_OBS) -> DataFrame:
    """Curves of keys pinned to their group's first and last acquisition, clear or
    not, with a day-of-year label for each step.  ``key`` includes ``group``."""
    spans = obs.groupBy(*group).agg(F.min("t").alias("lo"), F.max("t").alias("hi"))
    keys = obs.where(F.col("v").isNotNull()).select(*key).distinct().join(spans, group) if group else None
    if keys is None:  # one group: its span is a single row
        keys = obs.where(F.col("v").isNotNull()).select(*key).distinct().crossJoin(F.broadcast(spans))
    rows = regularize(obs, keys, key, steps, roll, min_obs)
    first = F.min("x").over(Window.partitionBy(*key))
    return rows.withColumn("doy", doy_label(F.col("x"), first))


def curve_arrays(rows: DataFrame, key: list[str]) -> DataFrame:
    """Steps of ``regularize`` as one array a key, null under the floor."""
    ordered = F.transform(F.sort_array(F.collect_list(F.struct("i", "value"))), lambda s: s["value"])
    out = rows.groupBy(*key).agg(ordered.alias("curve"), F.first("n_obs").alias("n_obs"))
    return out.withColumn("curve", F.when(F.forall("curve", lambda x: x.isNotNull()), F.col("curve")))


def regularize_arrays(obs: DataFrame, spans: DataFrame, key: list[str], steps: int = STEPS, roll: int = ROLL, min_obs: int = MIN_OBS) -> DataFrame:
    """(key, n_obs, curve): the same curves from one grouped aggregate, which
    gathers a key's observations in order; numpy interpolates Arrow batches."""
    valid = obs.where(F.col("v").isNotNull())
    series = valid.groupBy(*key).agg(F.sort_array(F.collect_list(F.struct(F.col("t").cast("double").alias("t"), "tie", "v"))).alias("s"))
    joined = spans.where(F.col("lo") < F.col("hi")).join(series, key)
    return interpolated(joined.select(*key, "lo", "hi", "s"), key, steps, roll, min_obs).select(*key, "n_obs", "curve")


def interpolated(rows: DataFrame, key: list[str], steps: int = STEPS, roll: int = ROLL, min_obs: int = MIN_OBS) -> DataFrame:
    """(key, lo, hi, n_obs, curve) of rows with a span and a sorted series ``s`` of (t, v);
    without lo < hi the curve is null, unless many values have one time."""
    rows = rows.select(*key, F.col("lo").cast("double"), F.col("hi").cast("double"), F.col("s.t").alias("t"), F.col("s.v").cast("array<double>").alias("v"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(key)
        for batch in batches:
            lo, hi = (batch.column(c).to_numpy(zero_copy_only=False).astype(float) for c in (k, k + 1))
            t, v = batch.column(k + 2), batch.column(k + 3)
            times, values, at = t.flatten().to_numpy(), v.flatten().to_numpy(), np.concatenate(([0], np.cumsum(t.value_lengths().to_numpy())))
            n = np.diff(at)
            few = (n < min_obs) | ~(lo <= hi)  # a null span is NaN here
            enough = np.flatnonzero(~few)
            curves = np.zeros((batch.num_rows, steps))
            curves[enough] = interpolate_all(times, values, at[:-1][enough], n[enough], lo[enough], hi[enough], steps)
            smooth = smooth_rows(curves, roll)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * steps), pa.array(smooth.reshape(-1)))
            out = pc.if_else(pa.array(few), pa.nulls(batch.num_rows, lists.type), lists)
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(k + 2)), pa.array(n.astype(np.int32)), out], names=[*key, "lo", "hi", "n_obs", "curve"])

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    return rows.mapInArrow(run, ", ".join(f"{c} {kinds[c]}" for c in key) + ", lo double, hi double, n_obs int, curve array<double>")


def interpolate_all(t: np.ndarray, v: np.ndarray, first: np.ndarray, n: np.ndarray, lo: np.ndarray, hi: np.ndarray, steps: int) -> np.ndarray:
    """Grid values of many sorted series at once: series r is [first[r], first[r] + n[r]).
    How many observations are at or before a grid point, and before it, comes from one
    sort of all series and grids by series, time and kind."""
    rows = len(n)
    if not rows:
        return np.zeros((0, steps))
    x = lo[:, None] + (hi - lo)[:, None] * np.arange(steps) / (steps - 1)
    own = np.repeat(np.arange(rows), n)
    where = np.arange(len(own)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)
    times, grid = t[where], x.reshape(-1)
    series = np.concatenate((own, np.repeat(np.arange(rows), steps)))
    is_grid = np.concatenate((np.zeros(len(own), np.int8), np.ones(len(grid), np.int8)))

    def counted(kind: np.ndarray) -> np.ndarray:
        """Observations of its series that sort before each grid point."""
        order = np.lexsort((kind, np.concatenate((times, grid)), series))
        seen = np.cumsum(is_grid[order] == 0)
        out = np.empty(len(order), np.int64)
        out[order] = seen
        return out[len(own) :].reshape(rows, steps) - (np.cumsum(n) - n)[:, None]

    before, after = counted(is_grid) - 1, counted(1 - is_grid)
    a, b = first[:, None] + np.maximum(before, 0), first[:, None] + np.minimum(after, n[:, None] - 1)
    gap = t[b] - t[a]
    blend = v[a] + (v[b] - v[a]) * (x - t[a]) / np.where(gap > 0, gap, 1)
    return np.where(before < 0, v[b], np.where((after >= n[:, None]) | (gap <= 0), v[a], blend))


def interpolate(t: np.ndarray, v: np.ndarray, lo: float, hi: float, steps: int) -> np.ndarray:
    """Grid values of one sorted series."""
    x = lo + (hi - lo) * np.arange(steps) / (steps - 1)
    before, after = np.searchsorted(t, x, side="right") - 1, np.searchsorted(t, x, side="left")
    a, b = np.maximum(before, 0), np.minimum(after, len(t) - 1)
    gap = t[b] - t[a]
    blend = v[a] + (v[b] - v[a]) * (x - t[a]) / np.where(gap > 0, gap, 1)
    return np.where(before < 0, v[b], np.where((after >= len(t)) | (gap <= 0), v[a], blend))


def smooth_rows(curves: np.ndarray, roll: int) -> np.ndarray:
    """Shrinking centred mean of each row."""
    h, n = half_width(roll), curves.shape[1]
    if not h:
        return curves
    near = np.abs(np.subtract.outer(np.arange(n), np.arange(n))) <= h
    return curves @ (near / near.sum(axis=0))


def shrinking_mean(rows: DataFrame, key: list[str], order: str, value: str, roll: int, name: str = "smooth") -> DataFrame:
    h = half_width(roll)
    w = Window.partitionBy(*key).orderBy(order).rowsBetween(-h, h)
    return rows.withColumn(name, F.avg(value).over(w) if h else F.col(value))


def fill_missing(rows: DataFrame, key: list[str], order: str, value: str) -> DataFrame:
    """Last value carried forward, then the first carried backward."""
    w = Window.partitionBy(*key).orderBy(order)
    back = F.last(value, True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    ahead = F.first(value, True).over(w.rowsBetween(0, Window.unboundedFollowing))
    return rows.withColumn("filled", F.coalesce(back, ahead))
