"""Curves (``array<double>``) as images.

Reorderings are higher-order functions with a constant index array; pairwise
fields (NDI, GAF) are nested transforms over the array.  Wavelet, correlation
and spectrogram images need a linear-algebra library: numpy on Arrow batches.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import ArrayType, DoubleType

FLOOR = 1e-8


def wrap_pad(curve: Column, n: int) -> Column:
    """First n values; a shorter curve starts again."""
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.element_at(curve, (i % F.size(curve) + 1).cast("int")))


def ordered(curve: Column, index: list[int]) -> Column:
    """Values of the curve at constant 0-based positions."""
    where = F.array(*[F.lit(i + 1) for i in index])
    return F.transform(where, lambda i: F.element_at(curve, i))


def fold(flat: Column, width: int, height: int) -> Column:
    """Row-major image of a flat array."""
    return F.transform(F.sequence(F.lit(0), F.lit(height - 1)), lambda r: F.slice(flat, r * width + 1, width))


def side_of(n: int) -> int:
    return int(np.ceil(np.sqrt(n)))


def reshape(curve: Column, n: int) -> Column:
    s = side_of(n)
    return fold(wrap_pad(curve, s * s), s, s)


def serpentine_order(side: int) -> list[int]:
    """Flat positions when each second row runs backwards."""
    grid = np.arange(side * side).reshape(side, side)
    grid[1::2] = grid[1::2, ::-1].copy()
    return grid.reshape(-1).tolist()


def serpentine(curve: Column, n: int) -> Column:
    s = side_of(n)
    return fold(ordered(wrap_pad(curve, s * s), serpentine_order(s)), s, s)


def hilbert_order(order: int) -> list[int]:
    """Position on the Hilbert curve of each cell (row-major), grown by quadrants:
    a larger curve is four copies of the smaller one, the first transposed, the
    last transposed over the other diagonal."""
    path = np.zeros((1, 1), np.int64)
    for _ in range(order):
        n = path.size
        path = np.block([[path.T, np.rot90(path.T, 2) + 3 * n], [path + n, path + 2 * n]])
    return path.reshape(-1).tolist()


def hilbert(curve: Column, order: int = 3) -> Column:
    """Cells in the order of a Hilbert curve; a longer curve is cut at 4**order."""
    s = 1 << order
    return fold(ordered(wrap_pad(curve, s * s), hilbert_order(order)), s, s)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once: inside a nested transform an
    outer expression would be computed for each element."""
    return F.element_at(F.transform(F.array(value), body), 1)


def per_sample(image: Column) -> Column:
    """Image scaled to [0, 1] by its own range."""

    def scale(s: Column) -> Column:
        return F.transform(s["image"], lambda row: F.transform(row, lambda v: (v - s["low"]) / s["span"]))

    def measure(img: Column) -> Column:
        flat = F.flatten(img)
        low, high = F.array_min(flat), F.array_max(flat)
        return let(F.struct(img.alias("image"), low.alias("low"), F.greatest(high - low, F.lit(FLOOR)).alias("span")), scale)

    return let(image, measure)


def ndi(curve: Column) -> Column:
    """(x_i - x_j) / (x_i + x_j), 0 where the sum is next to nothing."""
    return F.transform(curve, lambda a: F.transform(curve, lambda b: F.when(F.abs(a + b) > FLOOR, (a - b) / (a + b)).otherwise(0.0)))


def polar(curve: Column) -> Column:
    """Angles of the curve scaled to [-1, 1]."""

    def angles(s: Column) -> Column:
        return F.transform(curve, lambda v: F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), (v - s["low"]) * 2.0 / s["span"] - 1.0))))

    low, high = F.array_min(curve), F.array_max(curve)
    return let(F.struct(low.alias("low"), F.greatest(high - low, F.lit(FLOOR)).alias("span")), angles)


def gaf(angles: Column) -> tuple[Column, Column]:
    """Summation and difference fields of ``polar`` angles."""
    plus = F.transform(angles, lambda a: gaf_line(a, angles)[0])
    return plus, F.transform(angles, lambda a: gaf_line(a, angles)[1])


def gaf_line(own: Column, angles: Column) -> tuple[Column, Column]:
    """One angle's lines of both fields: what a row of lines needs, without the fields."""
    return F.transform(angles, lambda b: F.cos(own + b)), F.transform(angles, lambda b: F.sin(own - b))


def _array_udf(make: Callable[[np.ndarray], np.ndarray]):
    """A UDF of Arrow arrays: ``make`` takes the whole curves of one length at once, as
    (curves, steps), and gives (curves, height, width)."""

    @arrow_udf(ArrayType(ArrayType(DoubleType())))
    def run(curves: pa.Array) -> pa.Array:
        size = pc.fill_null(pc.list_value_length(curves), -1).to_numpy(zero_copy_only=False)
        images: list[np.ndarray] = []
        place = np.full(len(curves), -1, np.int64)
        done = 0
        for n in np.unique(size[size > 0]):
            rows = np.flatnonzero(size == n)
            x = curves.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, n)
            good = np.isfinite(x).all(axis=1)
            if good.any():
                made = make(x[good])
                images.append(made)
                place[rows[good]] = done + np.arange(len(made))
                done += len(made)
        return _nested(images, place)

    return run


def _nested(images: list[np.ndarray], place: np.ndarray) -> pa.Array:
    """Images as lists of lists; a row without one (place -1) is null."""
    kind = pa.list_(pa.list_(pa.float64()))
    if not images:
        return pa.nulls(len(place), kind)
    parts = []
    for x in images:
        n, height, width = x.shape
        lines = pa.ListArray.from_arrays(pa.array(np.arange(n * height + 1, dtype=np.int32) * width), pa.array(x.reshape(-1)))
        parts.append(pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * height), lines))
    return pa.concat_arrays(parts).take(pa.array(place, mask=place < 0))


def np_mtf(x: np.ndarray, bins: int = 5) -> np.ndarray:
    """Markov transition fields of curves over their quantile bins; a state that nothing
    follows gives 0."""
    count, n = x.shape
    edges = np.sort(np.quantile(x, np.arange(1, bins) / bins, axis=1).T, axis=1)
    fresh = np.ones(edges.shape, bool)
    fresh[:, 1:] = edges[:, 1:] != edges[:, :-1]  # equal edges are one
    state = ((x[:, :, None] >= edges[:, None, :]) & fresh[:, None, :]).sum(axis=2)
    moves = np.zeros((count, bins, bins))
    np.add.at(moves, (np.arange(count)[:, None], state[:, :-1], state[:, 1:]), 1.0)
    share = moves / np.maximum(moves.sum(axis=2, keepdims=True), 1)
    return share[np.arange(count)[:, None, None], state[:, :, None], state[:, None, :]]


def np_cwt(x: np.ndarray, scales: int = 24, points: int = 1024) -> np.ndarray:
    """Magnitudes of continuous Morlet transforms by the integrated wavelet:
    psi = exp(-t^2/2) cos(5t) on [-8, 8], scales 1 to ``scales``.  A scale is one
    matrix product with all curves."""
    n = x.shape[1]
    return np.stack([np.abs(x @ m) for m in cwt_matrices(n, scales, points)], axis=1)


@lru_cache(maxsize=8)
def cwt_matrices(n: int, scales: int = 24, points: int = 1024) -> tuple[np.ndarray, ...]:
    """For each scale the (n, n) matrix that takes a curve to its coefficients: the
    difference of its convolution with the integrated wavelet, cut to the middle."""
    t = np.linspace(-8, 8, points)
    step = t[1] - t[0]
    integral = np.cumsum(np.exp(-(t**2) / 2) * np.cos(5 * t)) * step
    out = []
    for scale in range(1, scales + 1):
        at = (np.arange(scale * (t[-1] - t[0]) + 1) / (scale * step)).astype(int)
        kernel = -np.sqrt(scale) * np.diff(integral[at[at < points]][::-1], prepend=0, append=0)
        cut = max(0, (len(kernel) - 3) // 2)
        lag = np.arange(n)[None, :] + cut + 1 - np.arange(n)[:, None]  # of the kernel, by curve and coefficient
        out.append(np.where((lag >= 0) & (lag < len(kernel)), kernel[np.clip(lag, 0, len(kernel) - 1)], 0.0))
    return tuple(out)


def np_cos2d(x: np.ndarray, segments: int = 10) -> np.ndarray:
    """Synchronous fields over the asynchronous ones (Hilbert-Noda), stacked by rows."""
    size = max(2, x.shape[1] // segments)
    rows = np.lib.stride_tricks.sliding_window_view(x, size, axis=1)[:, :: max(1, size // 2)]
    d = rows - rows.mean(axis=1, keepdims=True)
    m = d.shape[1]
    gap = np.subtract.outer(np.arange(m), np.arange(m)).astype(float)
    noda = np.divide(1 / np.pi, gap, out=np.zeros_like(gap), where=gap != 0)
    turned = np.swapaxes(d, 1, 2) / max(m - 1, 1)
    return np.concatenate((turned @ d, turned @ (noda @ d)), axis=1)


def np_spectrogram(x: np.ndarray, size: int = 16, overlap: int = 12) -> np.ndarray:
    """Magnitudes of short-time Fourier transforms: periodic Hann window, zero
    extension at both ends, 'spectrum' scaling."""
    hop = size - overlap
    window = 0.5 - 0.5 * np.cos(2 * np.pi * np.arange(size) / size)
    ahead = size // 2 + -x.shape[1] % hop if (x.shape[1] + size) % hop else size // 2
    padded = np.pad(x, ((0, 0), (size // 2, ahead)))
    frames = np.lib.stride_tricks.sliding_window_view(padded, size, axis=1)[:, ::hop]
    return np.swapaxes(np.abs(np.fft.rfft(frames * window, axis=2)), 1, 2) / window.sum()


mtf, cwt, cos2d, spectrogram = (_array_udf(f) for f in (np_mtf, np_cwt, np_cos2d, np_spectrogram))

#: Images by name: column function of (curve, number of steps).
TRANSFORMS: dict[str, Callable[[Column, int], Column]] = {
    "reshape": reshape,
    "serpentine": serpentine,
    "hilbert": lambda c, n: hilbert(c),
    "ndi": lambda c, n: ndi(c),
    "mtf": lambda c, n: mtf(c),
    "cwt": lambda c, n: cwt(c),
    "cos2d": lambda c, n: cos2d(c),
    "spectrogram": lambda c, n: spectrogram(c),
}


def image_shape(name: str, n: int) -> tuple[int, ...]:
    """(height, width) or (height, width, channels) of an image of n steps."""
    s, seg = side_of(n), max(2, n // 10)
    frames = np_spectrogram(np.zeros((1, n))).shape[2] if n else 0
    return {
        "reshape": (s, s), "serpentine": (s, s), "hilbert": (8, 8), "gaf": (n, n, 2), "mtf": (n, n), "ndi": (n, n),
        "cwt": (24, n), "cos2d": (seg, seg, 2), "spectrogram": (9, frames),
    }[name]
