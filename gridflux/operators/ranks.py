"""Exact percentiles and row numbers without a task that holds a whole column.

Percentiles are selected by histogram passes: the range that holds a wanted rank is cut
into bins, one grouped count tells in which bin the rank falls, and that bin's least
and largest value are the next range.  A pass sends a task's non-empty bins, never its
values; it ends when a range is one value or holds few rows.

Row numbers come from a range partitioning: rows in order within partitions, counts of
partitions, and their offsets.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gridflux.operators.staging import fixed

BINS, FEW = 2048, 4096


def _ranks(n: int, shares: list[float]) -> set[int]:
    """Places (from 0) of the values that linear interpolation needs."""
    return {f(p * (n - 1)) for p in shares for f in (math.floor, math.ceil)}


def percentiles(df: DataFrame, columns: dict[str, Column], shares: list[float], bins: int = BINS, few: int = FEW) -> dict[str, list[float] | None]:
    """For each name of ``columns`` its exact percentiles with linear interpolation, as
    ``percentile`` has them, over the values that are neither null nor NaN; None without
    any.  ``df`` is read once a pass, four times or so."""
    names = list(columns)
    value = {t: F.when(~F.isnan(c.cast("double")), c.cast("double")) for t, c in columns.items()}
    narrow = df.select(*(value[t].alias(f"c{k}") for k, t in enumerate(names)))
    first = narrow.agg(*(f(f"c{k}").alias(f"{n}{k}") for k in range(len(names)) for n, f in (("lo", F.min), ("hi", F.max), ("n", F.count)))).first()
    found: dict[int, dict[int, float]] = {k: {} for k in range(len(names))}
    # (column, first rank of the range, ranks wanted in it, rows, least and largest value)
    open_ranges = [(k, 0, _ranks(first[f"n{k}"], shares), first[f"n{k}"], first[f"lo{k}"], first[f"hi{k}"]) for k in range(len(names)) if first[f"n{k}"]]

    def settle(ranges: list[tuple]) -> list[tuple]:
        """Ranges of one value are known."""
        for k, _, ranks, _, lo, hi in ranges:
            if lo == hi:
                found[k].update(dict.fromkeys(ranks, lo))
        return [r for r in ranges if r[4] != r[5]]

    open_ranges = settle(open_ranges)
    while any(r[3] > few for r in open_ranges):
        cuts = []
        for at, (k, _, _, _, lo, hi) in enumerate(open_ranges):
            x = F.col(f"c{k}")
            # Halves, so that the width of any two doubles is finite; monotone in x.
            place = F.least(F.floor((x / 2 - lo / 2) / (hi / 2 - lo / 2) * bins), F.lit(bins - 1)).cast("int")
            cuts.append(F.when(x.between(lo, hi), F.struct(F.lit(at).alias("at"), F.coalesce(place, F.lit(0)).alias("bin"), x.alias("x"))))
        rows = narrow.select(F.explode(F.array_compact(F.array(*cuts))).alias("s")).select("s.*")
        counts = rows.groupBy("at", "bin").agg(F.count("*").alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi")).collect()  # bins of a few ranges
        following = []
        for at, (k, start, ranks, _, lo, hi) in enumerate(open_ranges):
            seen = start
            for r in sorted((r for r in counts if r["at"] == at), key=lambda r: r["lo"]):
                inside = {x for x in ranks if seen <= x < seen + r["n"]}
                if inside:
                    following.append((k, seen, inside, r["n"], r["lo"], r["hi"]))
                seen += r["n"]
        open_ranges = settle(following)
    if open_ranges:
        parts = [F.when(F.col(f"c{k}").between(lo, hi), F.struct(F.lit(at).alias("at"), F.col(f"c{k}").alias("x"))) for at, (k, _, _, _, lo, hi) in enumerate(open_ranges)]
        rows = narrow.select(F.explode(F.array_compact(F.array(*parts))).alias("s")).select("s.*")
        values: dict[int, list] = {}
        for r in rows.groupBy("at", "x").count().collect():  # ``few`` values a range at most
            values.setdefault(r["at"], []).append((r["x"], r["count"]))
        for at, (k, start, ranks, _, _, _) in enumerate(open_ranges):
            ordered = sorted(values[at])
            ends = start + np.cumsum([n for _, n in ordered])
            found[k].update({x: ordered[int(np.searchsorted(ends, x, side="right"))][0] for x in ranks})
    out: dict[str, list[float] | None] = {}
    for k, t in enumerate(names):
        n = first[f"n{k}"]
        places = [p * (n - 1) for p in shares]
        out[t] = [_between(found[k][math.floor(x)], found[k][math.ceil(x)], x) for x in places] if n else None
    return out


def _between(low: float, high: float, place: float) -> float:
    """As Spark's percentile computes it."""
    lower, higher = math.floor(place), math.ceil(place)
    return low if lower == higher or low == high else (higher - place) * low + (place - lower) * high


def numbered(df: DataFrame, order: list[str | Column], name: str = "number") -> DataFrame:
    """Adds each row's number in an order, from 0; of ties some order, the same in every
    use of the result.  Rows are dealt by range and fixed once; only the number of rows
    of each partition meets on the driver."""
    by = [F.col(c) if isinstance(c, str) else c for c in order]
    ordered = df.repartitionByRange(*by).sortWithinPartitions(*by)
    local = F.monotonically_increasing_id()
    kept = fixed(ordered.withColumn("_part", F.shiftright(local, 33)).withColumn("_local", local.bitwiseAND((1 << 33) - 1)))
    sizes = sorted((r["_part"], r["count"]) for r in kept.groupBy("_part").count().collect())
    starts = np.concatenate(([0], np.cumsum([n for _, n in sizes])))[:-1] if sizes else []
    offsets = df.sparkSession.createDataFrame([(int(p), int(s)) for (p, _), s in zip(sizes, starts, strict=True)], "_part long, _start long")
    return kept.join(F.broadcast(offsets), "_part").withColumn(name, F.col("_start") + F.col("_local")).drop("_part", "_local", "_start")  # a row for each partition


def place(df: DataFrame, order: list[str], partition: list[str] | None) -> tuple[DataFrame, Column]:
    """``df`` and each row's place from 0: within ``partition`` by a window, else over all rows."""
    if partition:
        return df, F.row_number().over(Window.partitionBy(*partition).orderBy(*order)) - 1
    return numbered(df, order, "_number"), F.col("_number")
