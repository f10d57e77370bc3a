"""Arrays as compressed bytes, for columns that only Python reads."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def squeezed(x: np.ndarray) -> bytes:
    """An array's bytes, equal places together, compressed, behind their number."""
    if not len(x):
        return bytes(8)
    flat = np.ascontiguousarray(np.ascontiguousarray(x).view(np.uint8).reshape(len(x), -1).T)
    return len(x).to_bytes(8, "little") + pa.Codec("zstd", 1).compress(flat.tobytes(), asbytes=True)


def restored(x: bytes, kind: str) -> np.ndarray:
    n, size = int.from_bytes(x[:8], "little"), np.dtype(kind).itemsize
    if not n:
        return np.zeros(0, kind)
    flat = np.frombuffer(pa.Codec("zstd").decompress(x[8:], n * size, asbytes=True), np.uint8)
    return np.ascontiguousarray(flat.reshape(size, n).T).view(kind).ravel()


def squeezed_strings(x: pa.Array) -> bytes:
    """The bytes of binary values, and how long each is."""
    x = x.cast(pa.large_binary())
    ends = np.frombuffer(x.buffers()[1], np.int64)[x.offset : x.offset + len(x) + 1] if len(x) else np.zeros(1, np.int64)
    size = squeezed(np.diff(ends).astype("<i4"))
    return len(size).to_bytes(8, "little") + size + squeezed(np.frombuffer(x.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]])


def restored_strings(x: bytes) -> pa.Array:
    n = 8 + int.from_bytes(x[:8], "little")
    ends = np.cumsum(np.append(0, restored(x[8:n], "<i4")), dtype=np.int64)
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends) - 1, [None, pa.py_buffer(ends), pa.py_buffer(restored(x[n:], "u1"))])
