"""Numpy arrays packed into one binary value, for rows that carry many numbers at once."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed blob, each as planes of equal-ranked bytes."""
    parts = [np.array([len(arrays)], np.int64).tobytes()]
    for a in arrays:
        parts.append(np.array([a.dtype.itemsize, len(a)], np.int64).tobytes() + a.dtype.str.encode().ljust(8))
    for a in arrays:
        parts.append(np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.dtype.itemsize).T.tobytes())
    raw = b"".join(parts)
    return np.int64(len(raw)).tobytes() + pa.Codec("zstd", compression_level=1).compress(raw, asbytes=True)


def unpack(blob: bytes) -> list[np.ndarray]:
    size = int(np.frombuffer(blob, np.int64, 1)[0])
    raw = pa.Codec("zstd").decompress(memoryview(blob)[8:], size, asbytes=True)
    n = int(np.frombuffer(raw, np.int64, 1)[0])
    at, out = 8 + 24 * n, []
    for i in range(n):
        width, length = np.frombuffer(raw, np.int64, 2, 8 + 24 * i)
        kind = np.dtype(raw[24 + 24 * i:32 + 24 * i].decode().strip())
        planes = np.frombuffer(raw, np.uint8, width * length, at).reshape(width, length)
        out.append(np.ascontiguousarray(planes.T).reshape(-1).view(kind) if length else np.zeros(0, kind))
        at += width * length
    return out
