"""Arrow <-> numpy helpers for the batch operators (zero-copy where Arrow allows it)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def packed_matrix(col: pa.Array, width: int | None = None, dtype=np.float64) -> np.ndarray:
    """A binary column of packed little-endian float32 vectors as a matrix (no copy for float32)."""
    n = len(col)
    if col.null_count:
        raise ValueError("null feature vector")
    large = pa.types.is_large_binary(col.type)
    bufs = col.buffers()
    off_t = np.int64 if large else np.int32
    offsets = np.frombuffer(bufs[1], dtype=off_t, count=n + 1, offset=col.offset * np.dtype(off_t).itemsize)
    lens = np.diff(offsets)
    w = int(lens[0] // 4) if (width is None and n) else (width or 0)
    if n and (lens != 4 * w).any():
        raise ValueError(f"feature vectors must all have length {w}; found byte lengths "
                         f"{sorted(set(lens.tolist()))[:5]}")
    if not n:
        return np.zeros((0, w), dtype)
    flat = np.frombuffer(bufs[2], dtype="<f4", count=int(offsets[-1] - offsets[0]) // 4, offset=int(offsets[0]))
    return flat.astype(dtype, copy=False).reshape(n, w)


def pack_rows(m: np.ndarray) -> pa.Array:
    """Rows of a 2-d array as packed little-endian float32 binary values."""
    m = np.ascontiguousarray(m, dtype="<f4")
    n, w = m.shape
    offsets = pa.array(np.arange(0, n * w * 4 + 1, w * 4, dtype=np.int32))
    return pa.BinaryArray.from_buffers(pa.binary(), n, [None, offsets.buffers()[1], pa.py_buffer(m.tobytes())])


def list_matrix(col: pa.Array, width: int | None = None, dtype=np.float64) -> np.ndarray:
    """Feature column as a matrix of ``dtype`` (rows × width): a list column of equal-length
    numeric arrays, or packed float32 binary (see :func:`packed_matrix`)."""
    if isinstance(col, pa.ChunkedArray):
        col = pa.concat_arrays(col.chunks) if col.num_chunks != 1 else col.chunk(0)
    if pa.types.is_binary(col.type) or pa.types.is_large_binary(col.type):
        return packed_matrix(col, width, dtype)
    n = len(col)
    if col.null_count:
        raise ValueError("null feature vector")
    offsets = col.offsets.to_numpy()
    lens = np.diff(offsets)
    w = int(lens[0]) if (width is None and n) else (width or 0)
    if n and (lens != w).any():
        raise ValueError(f"feature vectors must all have length {w}; found {sorted(set(lens.tolist()))[:5]}")
    values = col.values.slice(int(offsets[0]), int(offsets[-1] - offsets[0])) if n else col.values.slice(0, 0)
    if values.null_count:
        raise ValueError("null element in a feature vector")
    flat = values.to_numpy(zero_copy_only=False)
    return np.asarray(flat, dtype=dtype).reshape(n, w)


def matrix_list(m: np.ndarray, value_type: pa.DataType = pa.float64()) -> pa.Array:
    """Rows of a 2-d array as an Arrow list column."""
    m = np.ascontiguousarray(m)
    n, w = m.shape
    offsets = pa.array(np.arange(0, n * w + 1, w, dtype=np.int32))
    return pa.ListArray.from_arrays(offsets, pa.array(m.ravel(), type=value_type))
