"""Fold-safe imputation and standardisation.

Parameters are a few numbers a column: which columns have gaps over all rows, and
medians (by histogram passes), means and population deviations over the fit rows.  The transform is one projection.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridflux.operators.ranks import percentiles


@dataclass(frozen=True)
class ColumnFit:
    name: str
    median: float
    mean: float
    sd: float
    gaps: bool


def fit(full: DataFrame, fold: Column, names: list[str]) -> list[ColumnFit]:
    """Parameters from the rows where ``fold`` holds; a column without a value
    there takes the median of all rows, then 0; a constant column has sd 1."""
    gaps = full.agg(*(F.max(F.col(c).isNull()).alias(c) for c in names)).first()
    both = {f"m_{c}": F.when(fold, F.col(c)) for c in names} | {f"a_{c}": F.col(c) for c in names}
    found = percentiles(full, both, [0.5])
    medians = {c: next((v[0] for v in (found[f"m_{c}"], found[f"a_{c}"]) if v), 0.0) for c in names}
    filled = [F.coalesce(F.col(c).cast("double"), F.lit(medians[c])) for c in names]
    seconds = full.where(fold).agg(
        *(F.avg(x).alias(f"u_{c}") for c, x in zip(names, filled, strict=True)),
        *(F.stddev_pop(x).alias(f"s_{c}") for c, x in zip(names, filled, strict=True)),
    ).first()
    out = []
    for c in names:
        sd = seconds[f"s_{c}"] or 0.0
        out.append(ColumnFit(c, medians[c], seconds[f"u_{c}"] or 0.0, sd if sd > 1e-12 else 1.0, bool(gaps[c])))
    return out


def transform(df: DataFrame, fits: list[ColumnFit], keep: list[str], kind: str = "float") -> DataFrame:
    """Standardised columns, then ``_isna`` of those with gaps."""
    values = [((F.coalesce(F.col(f.name).cast("double"), F.lit(f.median)) - f.mean) / f.sd).cast(kind).alias(f.name) for f in fits]
    gaps = [F.col(f.name).isNull().cast(kind).alias(f"{f.name}_isna") for f in fits if f.gaps]
    return df.select(*keep, *values, *gaps)
