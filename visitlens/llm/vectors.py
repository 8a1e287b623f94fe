"""Vector columns in and out of numpy."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def by_length(column: pa.Array) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(length, rows, matrix of double) of the usable vectors: not null, not
    all zero, every component present and finite."""
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    sizes = pc.list_value_length(column).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().cast(pa.float64())
    values = flat.fill_null(np.nan).to_numpy(zero_copy_only=False)
    first = np.cumsum(sizes) - sizes
    out = []
    for n in np.unique(sizes[sizes > 0]).tolist():
        rows = np.flatnonzero(sizes == n)
        matrix = values[first[rows][:, None] + np.arange(n)]
        good = np.isfinite(matrix).all(axis=1) & (matrix != 0).any(axis=1)
        out.append((n, rows[good], matrix[good]))
    return [x for x in out if len(x[1])]


def levelled(matrix: np.ndarray) -> np.ndarray:
    """Rows times a power of two that brings their largest component to
    [0.5, 1): directions stay as they are, and squares of very large or very
    small components neither overflow nor vanish."""
    _, exponent = np.frexp(np.abs(matrix).max(axis=1, initial=0))
    return np.ldexp(matrix, -exponent[:, None])


def lists(matrix: np.ndarray) -> pa.Array:
    ends = np.arange(len(matrix) + 1, dtype=np.int32) * (matrix.shape[1] if matrix.ndim == 2 else 0)
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(np.ascontiguousarray(matrix).ravel()))
