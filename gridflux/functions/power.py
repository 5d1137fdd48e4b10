"""Yeo-Johnson transform and its inverse as column expressions, with fitted
parameters per target."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Power:
    """Lambda, mean and scale (population) of one target."""

    lam: float
    mean: float
    scale: float


def yeo_johnson(x: Column, lam: float | Column) -> Column:
    """By expm1 and log1p, so that values next to 0 keep their digits at lambdas of
    thousands."""
    power = lam if isinstance(lam, Column) else F.lit(float(lam))

    def curve(log: Column, p: Column) -> Column:
        return F.when(F.abs(p) < 1e-12, log).otherwise(F.expm1(log * p) / p)

    return F.when(x >= 0, curve(F.log1p(x), power)).when(x < 0, -curve(F.log1p(-x), F.lit(2.0) - power))


def inverse_yeo_johnson(z: Column, lam: float) -> Column:
    """Null where the power has a base that isn't positive."""
    up = F.expm1(z) if abs(lam) < 1e-12 else F.when(z * lam > -1, F.expm1(F.log1p(z * lam) / lam))
    down = -F.expm1(-z) if abs(lam - 2) < 1e-12 else F.when(z * (lam - 2) > -1, -F.expm1(F.log1p(z * (lam - 2)) / (2 - lam)))
    return F.when(z >= 0, up).when(z < 0, down)


def scaled(x: Column, p: Power) -> Column:
    return (yeo_johnson(x, p.lam) - p.mean) / p.scale


def unscaled(z: Column, p: Power) -> Column:
    return inverse_yeo_johnson(z * p.scale + p.mean, p.lam)


def np_yeo_johnson(x: np.ndarray, lam: float) -> np.ndarray:
    out = np.empty_like(x, dtype=np.float64)
    up = x >= 0
    a, b = np.log1p(x[up]), np.log1p(-x[~up])
    with np.errstate(over="ignore"):
        out[up] = a if abs(lam) < 1e-12 else np.expm1(a * lam) / lam
        out[~up] = -b if abs(lam - 2) < 1e-12 else np.expm1(b * (2 - lam)) / (lam - 2)
    return out


def np_inverse(z: np.ndarray, lam: float) -> np.ndarray:
    out = np.empty_like(z, dtype=np.float64)
    up = z >= 0
    with np.errstate(invalid="ignore"):
        out[up] = np.expm1(z[up]) if abs(lam) < 1e-12 else np.expm1(np.log1p(z[up] * lam) / lam)
        out[~up] = -np.expm1(-z[~up]) if abs(lam - 2) < 1e-12 else -np.expm1(np.log1p(z[~up] * (lam - 2)) / (2 - lam))
    return out
