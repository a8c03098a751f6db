"""Exact inner products of integer vectors."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_SMALLEST, _LARGEST = np.iinfo(np.int64).min, np.iinfo(np.int64).max


def matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    """Integer rows of equal width; shorter vectors are filled up with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = np.asarray(column.value_lengths())
    out = np.zeros((len(column), width), dtype=np.int64)
    values = column.flatten().to_numpy(zero_copy_only=False)
    rows = np.repeat(np.arange(len(column)), lengths)
    out[rows, np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = values
    return out


def width_of(*columns: pa.ChunkedArray | pa.Array) -> int:
    """The longest vector of all."""
    lengths = [np.asarray((c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c).value_lengths()) for c in columns]
    return max(int(np.max(of, initial=0)) for of in lengths)


def products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """``left @ right.T`` without rounding: floats where they are exact, else 64-bit integers, else Python's.

    Products that no 64-bit integer holds are given as the end of that range they lie beyond.
    """
    # magnitudes as Python integers: abs() of the smallest 64-bit integer would overflow
    bound = [max(-int(m.min(initial=0)), int(m.max(initial=0))) for m in (left, right)]
    most = left.shape[1] * bound[0] * bound[1]
    if most < 1 << 53:
        return (left.astype(np.float64) @ right.T.astype(np.float64)).astype(np.int64)
    if most <= _LARGEST:
        return left @ right.T
    return np.clip(left.astype(object) @ right.T.astype(object), _SMALLEST, _LARGEST).astype(np.int64)
