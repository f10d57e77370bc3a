"""Whole columns of text as one byte buffer: words and their hashes by numpy, without a Python object for each."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = (x ^ (x >> U(32))) * U(0xD6E8FEB86659FD93)
    x = (x ^ (x >> U(32))) * U(0xD6E8FEB86659FD93)
    return x ^ (x >> U(32))


#: Spans of more bytes are hashed one by one; there are few of them in any buffer.
_LONG = 64
#: By how many bytes of a chunk of eight are in use: those that count.
_MASK = np.array([(1 << (8 * i)) - 1 for i in range(9)], dtype=U)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


def slices(texts: pa.Array, most: int = 1 << 21, rows: int = 4096) -> Iterator[tuple[int, int]]:
    """Row ranges of about `most` bytes; a longer text is a range of its own."""
    size = np.asarray(pc.fill_null(pc.binary_length(texts), 0), dtype=np.int64)
    ends = np.cumsum(size)
    lo = 0
    while lo < len(size):
        hi = int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + most, "right"))
        hi = min(max(hi, lo + 1), lo + rows, len(size))
        yield lo, hi
        lo = hi


def joined(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The texts one after another, a newline behind each, and where each begins (one more for the end). Null: empty."""
    col = texts.cast(pa.large_string())
    col = pc.binary_join_element_wise(col, pa.scalar("\n", pa.large_string()), pa.scalar("", pa.large_string()), null_handling="replace", null_replacement="")
    col = pa.concat_arrays([col]) if isinstance(col, pa.Array) else col.combine_chunks()
    starts = np.frombuffer(col.buffers()[1], dtype=np.int64)[col.offset : col.offset + len(col) + 1]
    if not len(col) or col.buffers()[2] is None:
        return np.zeros(0, np.uint8), np.zeros(len(col) + 1, np.int64)
    return np.frombuffer(col.buffers()[2], dtype=np.uint8)[starts[0] : starts[-1]], starts - starts[0]


def words(buf: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte and end of each run of word bytes. The buffer ends with a byte that isn't one."""
    inside = np.zeros(len(buf) + 2, dtype=np.int8)
    inside[1:-1] = is_word[buf]
    edge = np.diff(inside)
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span: its length and its chunks of eight bytes, scrambled one into the other.

    Spans of up to eight bytes and one length never collide; other pairs do by chance alone, one in 2^64. Long spans
    have XXH3's hash instead.
    """
    if not len(starts):
        return np.zeros(0, U)
    padded = np.concatenate([buf, np.zeros(8, np.uint8)])
    chunk = np.ndarray(len(buf) + 1, dtype="<u8", buffer=padded, strides=(1,))
    size = ends - starts
    h = mix(size.astype(U) * U(0x9E3779B97F4A7C15) + U(0xA0761D6478BD642F))
    h = mix(h ^ (chunk[starts] & _MASK[np.minimum(size, 8)]))
    for at in range(8, min(int(size.max()), _LONG), 8):
        on = np.flatnonzero(size > at)
        h[on] = mix((h[on] * U(0xD1B54A32D192ED03)) ^ (chunk[starts[on] + at] & _MASK[np.minimum(size[on] - at, 8)]))
    long = np.flatnonzero(size > _LONG)
    if len(long):
        raw = memoryview(np.ascontiguousarray(buf))
        h[long] = [xxhash.xxh3_64_intdigest(raw[a:b]) for a, b in zip(starts[long].tolist(), ends[long].tolist(), strict=True)]
    return h


def owner(starts: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """How many of the sorted positions lie in each document."""
    return np.diff(np.searchsorted(starts, docs))
