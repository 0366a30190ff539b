"""Building Arrow batches in tasks."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa

# A task hands on a batch when it holds this many characters, whatever the number of rows.
FLUSH_CHARS = 1 << 20


def expand(batch: pa.RecordBatch, keep: Sequence[str], rows: Sequence[int], extra: dict[str, pa.Array]) -> pa.RecordBatch:
    """Repeat the kept columns of `batch` at `rows` and add the new columns."""
    taken = pa.array(rows, pa.int64())
    arrays = [batch.column(name).take(taken) for name in keep] + list(extra.values())
    return pa.RecordBatch.from_arrays(arrays, names=[*keep, *extra])


def vector_array(vectors: Sequence) -> pa.Array:
    """list<float> from vectors of any length; None stays null."""
    lengths = [0 if v is None else len(v) for v in vectors]
    offsets = np.zeros(len(vectors) + 1, dtype=np.int32)
    np.cumsum(lengths, out=offsets[1:])
    parts = [np.asarray(v, dtype=np.float32) for v in vectors if v is not None and len(v)]
    flat = np.concatenate(parts) if parts else np.empty(0, dtype=np.float32)
    nulls = pa.array([v is None for v in vectors], pa.bool_())
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.float32()), mask=nulls)


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Rows of a null-free list<float> column as a matrix of doubles."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), dim)
