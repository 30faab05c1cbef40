"""Integer and float arrays as compressed bytes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def squeeze(values: np.ndarray) -> bytes:
    """``values`` byte plane by byte plane, compressed, after their number."""
    planes = np.ascontiguousarray(np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.dtype.itemsize).T)
    return len(values).to_bytes(4, "big") + pa.compress(planes, codec="zstd", asbytes=True)


def expand(raw: bytes, dtype) -> np.ndarray:
    n, width = int.from_bytes(raw[:4], "big"), np.dtype(dtype).itemsize
    planes = np.frombuffer(pa.decompress(raw[4:], n * width, codec="zstd"), np.uint8)
    return np.ascontiguousarray(planes.reshape(width, n).T).view(dtype).reshape(n)


def squeeze_sorted(values: np.ndarray) -> bytes:
    """Ascending int64 ``values`` as compressed differences."""
    return squeeze(np.diff(values, prepend=0).astype(np.int64))


def expand_sorted(raw: bytes) -> np.ndarray:
    return np.cumsum(expand(raw, np.int64))
