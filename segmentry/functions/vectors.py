"""Vector helpers: JVM-side array arithmetic, and NumPy on Arrow batches inside tasks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHUNK_CELLS = 1_000_000  # distance cells held at once inside a task


def squared_distance(a: Column, b: Column) -> Column:
    """Squared Euclidean distance of two ``array<double>`` columns."""
    diff = F.zip_with(a, b, lambda x, y: (x - y) * (x - y))
    return F.aggregate(diff, F.lit(0.0), lambda acc, x: acc + x)


def matrix(batch: pa.RecordBatch, name: str = "features") -> np.ndarray:
    """Rows x dimensions view of a list column without copying element by element."""
    column = batch.column(name)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    return flat.reshape(len(column), -1) if len(column) else np.empty((0, 0))


def list_array(values: np.ndarray) -> pa.Array:
    """The reverse of ``matrix``."""
    rows, dims = values.shape
    offsets = pa.array(np.arange(0, rows * dims + 1, dims, dtype=np.int32))
    return pa.ListArray.from_arrays(offsets, pa.array(np.ascontiguousarray(values).ravel()))


def squared_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Rows of ``a`` against rows of ``b``; small values are not exact, see ``within``."""
    shift = b.mean(axis=0) if len(b) else 0.0
    a, b = a - shift, b - shift
    out = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2.0 * (a @ b.T)
    return np.maximum(out, 0.0, out=out)


def row_chunks(rows: int, width: int, cells: int | None = None):
    """Slices of at most ``cells`` (``CHUNK_CELLS``) distance cells."""
    step = max(1, (cells or CHUNK_CELLS) // max(width, 1))
    for start in range(0, rows, step):
        yield slice(start, min(start + step, rows))


def within(a: np.ndarray, b: np.ndarray, eps: float) -> np.ndarray:
    """Boolean matrix ``distance <= eps``; pairs near the limit are recomputed exactly."""
    d2, limit = squared_distances(a, b), eps * eps
    near = d2 <= limit
    scale = (a * a).sum(axis=1).max(initial=0.0) + (b * b).sum(axis=1).max(initial=0.0) + limit
    i, j = np.nonzero(np.abs(d2 - limit) <= 1e-10 * scale)
    for part in range(0, len(i), 100_000):
        p, q = i[part : part + 100_000], j[part : part + 100_000]
        near[p, q] = ((a[p] - b[q]) ** 2).sum(axis=1) <= limit
    return near


def vector_size(df: DataFrame) -> int:
    row = df.select(F.size("features")).first()
    if row is None:
        raise ValueError("DataFrame is empty")
    return row[0]


def uniforms(keys: np.ndarray, *salt: int) -> np.ndarray:
    """One number in (0, 1) per int64 key, fixed by key and salt (splitmix64 finaliser).

    Random choices then depend on the row and not on its partition.
    """
    with np.errstate(over="ignore"):
        state = keys.astype(np.int64).view(np.uint64).copy()
        for s in salt:
            state += np.uint64(0x9E3779B97F4A7C15) * np.uint64((int(s) + 1) & (2**64 - 1))
            state ^= state >> np.uint64(30)
            state *= np.uint64(0xBF58476D1CE4E5B9)
            state ^= state >> np.uint64(27)
            state *= np.uint64(0x94D049BB133111EB)
            state ^= state >> np.uint64(31)
    return ((state >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0**53
