"""Embedding columns in Arrow batches as arrays."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def matrix(column: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Doubles of a list column, ``dim`` a row, and which rows are usable: not null, without null or non-finite parts.

    Shorter vectors are filled with zeros; unusable rows are zeros.
    """
    rows = len(column)
    out = np.zeros((rows, dim))
    lengths = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten()  # leaves null rows out
    values = flat.cast(pa.float64()).to_numpy(zero_copy_only=False)  # null parts come as NaN
    row = np.repeat(np.arange(rows), lengths)
    place = np.arange(len(row)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out[row, place] = values
    usable = ~np.asarray(column.is_null()) & np.isfinite(out).all(axis=1)
    out[~usable] = 0
    return out, usable
