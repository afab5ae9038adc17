"""Columns of numbers beside sorted 64-bit hashes, packed into one binary value.

Sorted hashes travel as their gaps, and all numbers as planes of bytes, so that upper bytes,
which are mostly zero, lie side by side and compress.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_zstd = pa.Codec("zstd", compression_level=1)


def _planes(column: np.ndarray) -> bytes:
    return np.ascontiguousarray(column.view(np.uint8).reshape(-1, column.dtype.itemsize).T).tobytes()


def pack(ascending: np.ndarray, *beside: np.ndarray) -> bytes:
    """Signed 64-bit hashes, ascending, and columns of the same length."""
    gaps = np.diff(ascending.view(np.uint64), prepend=np.uint64(0))
    columns = [gaps, *beside]
    kinds = ",".join(c.dtype.str for c in columns).encode()
    head = np.array([len(ascending), len(kinds)], "<u8").tobytes()
    raw = head + kinds + b"".join(_planes(np.ascontiguousarray(c)) for c in columns)
    return len(raw).to_bytes(8, "little") + _zstd.compress(raw, asbytes=True)


def unpack(data: bytes) -> list[np.ndarray]:
    """The hashes and the columns beside them."""
    raw = memoryview(_zstd.decompress(data[8:], int.from_bytes(data[:8], "little"), asbytes=True))
    n, size = (int(x) for x in np.frombuffer(raw, "<u8", 2))
    at, out = 16 + size, []
    for kind in bytes(raw[16:at]).decode().split(","):
        width = np.dtype(kind).itemsize
        planes = np.frombuffer(raw, np.uint8, n * width, at).reshape(width, n)
        out.append(np.ascontiguousarray(planes.T).view(kind).ravel())
        at += n * width
    out[0] = np.cumsum(out[0], dtype=np.uint64).view(np.int64)
    return out
