"""Vectors of Arrow batches as integer matrices on a fixed-point grid."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def fixed_points(col: pa.Array, scale: float, dims: int | None = None, limit: float = 2.0**40) -> tuple[np.ndarray, np.ndarray]:
    """(rows, x): numbers of the rows that take part, and ``floor(scale * c)`` of their
    entries as int64.  Null vectors and vectors with a null or non-finite entry don't
    take part; an entry beyond ``limit`` on the grid counts as non-finite.  Shorter
    vectors are padded with zeros to ``dims`` entries, the longest one's if not given."""
    size = pc.fill_null(pc.list_value_length(col), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    value = np.floor(np.asarray(pc.cast(col.flatten(), pa.float64()).to_numpy(zero_copy_only=False), np.float64) * scale)
    row = np.repeat(np.arange(len(col)), size)
    with np.errstate(invalid="ignore"):
        fine = np.abs(value) < limit
    good = pc.is_valid(col).to_numpy(zero_copy_only=False).copy()
    good[row[~fine]] = False
    width = int(size.max(initial=0)) if dims is None else dims
    kept = np.flatnonzero(good)
    number = np.cumsum(good) - 1
    place = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
    use = good[row]
    out = np.zeros((len(kept), width), np.int64)
    out[number[row[use]], place[use]] = value[use]
    return kept, out
