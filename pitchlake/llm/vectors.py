"""Vectors of an Arrow list column as matrices, one for each length."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

#: Doubles hold every whole number up to this.
EXACT = 1 << 53


def matrices(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """(rows, matrix of doubles) for each length of the vectors whose entries are all finite.

    Null vectors and those with null or non-finite entries are in none.
    """
    valid = np.flatnonzero(column.is_valid().to_numpy(zero_copy_only=False))
    if not len(valid):
        return []
    offsets = column.offsets.to_numpy().astype(np.int64)
    values = column.values.to_numpy(zero_copy_only=False).astype(np.float64)  # null entries become NaN
    sizes = offsets[valid + 1] - offsets[valid]
    out = []
    for size in np.unique(sizes):
        rows = valid[sizes == size]
        x = values[offsets[rows][:, None] + np.arange(size)]
        fine = np.isfinite(x).all(axis=1)
        if fine.any():
            out.append((rows[fine], x[fine]))
    return out


def scaled(x: np.ndarray, factor: int) -> tuple[np.ndarray, np.ndarray]:
    """floor(factor * x) as whole numbers, and which rows fit in long integers."""
    y = np.floor(x * float(factor))
    fits = (np.abs(y) < float(1 << 62)).all(axis=1)
    return y[fits].astype(np.int64), fits


def largest(x: np.ndarray) -> int:
    return int(max(abs(int(x.max())), abs(int(x.min())))) if x.size else 0


def product(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Matrix product of whole numbers, exact: in doubles or longs where these hold it, else in objects."""
    bound = max(1, x.shape[1]) * max(1, largest(x)) * max(1, largest(y))
    if bound < EXACT:
        return (x.astype(np.float64) @ y.astype(np.float64)).astype(np.int64)
    if bound < 1 << 63:
        return x @ y
    return x.astype(object) @ y.astype(object)
