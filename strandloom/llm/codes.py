"""Directly addressable codes: token ids in chunk levels with continuation bitmaps and rank directories."""

from __future__ import annotations

import struct
from collections.abc import Callable

import numpy as np

MAGIC = b"DAC1"
#: Bits of the chunks of each level; the last level holds what is left, up to 32 bits in all.
LEVELS = (8, 8, 16)
RANK = 512


def encode(ids: np.ndarray, levels: tuple[int, ...] = LEVELS) -> bytes:
    """magic, number of levels, then for each level: bits, entries, chunks, bitmap, rank directory.

    Level k holds the k-th lowest chunk of every id that reaches it. A set bit of its bitmap says that the id goes on
    in the next level, at the place that the number of set bits before it gives; the directory has that number for
    every RANK bits. Little-endian; chunks take one, two or four bytes.
    """
    now = np.asarray(ids, dtype=np.uint32)
    out = [MAGIC, struct.pack("<I", len(levels))]
    for k, bits in enumerate(levels):
        width = "<u1" if bits <= 8 else "<u2" if bits <= 16 else "<u4"
        rest = now >> np.uint32(bits) if bits < 32 else np.zeros_like(now)
        if k == len(levels) - 1 and rest.any():
            raise ValueError("an id does not fit into the levels")
        goes_on = rest > 0
        bitmap = np.packbits(goes_on, bitorder="little")
        bitmap = np.concatenate([bitmap, np.zeros(-len(bitmap) % (RANK // 8), np.uint8)])
        ranks = np.cumsum(np.bitwise_count(bitmap.reshape(-1, RANK // 8)).sum(axis=1, dtype=np.uint64)) if len(bitmap) else np.zeros(0, np.uint64)
        directory = np.concatenate([[0], ranks[:-1]]) if len(ranks) else ranks
        out += [struct.pack("<IQ", bits, len(now)), (now & np.uint32((1 << bits) - 1)).astype(width).tobytes(), bitmap.tobytes(), directory.astype("<u8").tobytes()]
        now = rest[goes_on]
    return b"".join(out)


class Codes:
    """An encoded run of ids: c[i] is any one of them, c.ids(a, b) a range; no other id is decoded."""

    def __init__(self, raw: bytes) -> None:
        if raw[:4] != MAGIC:
            raise ValueError("not a file of directly addressable codes")
        (n,) = struct.unpack_from("<I", raw, 4)
        at = 8
        self.levels = []
        for _ in range(n):
            bits, size = struct.unpack_from("<IQ", raw, at)
            at += 12
            width = 1 if bits <= 8 else 2 if bits <= 16 else 4
            chunks = np.frombuffer(raw, f"<u{width}", size, at)
            at += size * width
            blocks = -(-size // RANK)
            bitmap = np.frombuffer(raw, np.uint8, blocks * (RANK // 8), at)
            at += len(bitmap)
            directory = np.frombuffer(raw, "<u8", blocks, at)
            at += 8 * blocks
            self.levels.append((bits, chunks, bitmap, directory))

    def __len__(self) -> int:
        return len(self.levels[0][1])

    def _rank(self, level: int, i: int) -> int:
        """Set bits before place i."""
        _, _, bitmap, directory = self.levels[level]
        if i // RANK >= len(directory):
            return int(directory[-1]) + int(np.bitwise_count(bitmap[-(RANK // 8) :]).sum()) if len(directory) else 0
        block = i // RANK
        lo, full = block * (RANK // 8), i // 8
        n = int(directory[block]) + int(np.bitwise_count(bitmap[lo:full]).sum(dtype=np.int64))
        return n + int(bitmap[full] & ((1 << (i % 8)) - 1)).bit_count()

    def __getitem__(self, i: int) -> int:
        if not 0 <= i < len(self):
            raise IndexError(i)
        value = shift = 0
        for k, (bits, chunks, bitmap, _) in enumerate(self.levels):
            value |= int(chunks[i]) << shift
            if not bitmap[i // 8] >> (i % 8) & 1:
                return value
            i, shift = self._rank(k, i), shift + bits
        return value

    def ids(self, a: int = 0, b: int | None = None) -> np.ndarray:
        """Ids of the places a to b, decoded a level at a time."""
        b = len(self) if b is None else b

        def level(k: int, lo: int, hi: int) -> np.ndarray:
            bits, chunks, bitmap, _ = self.levels[k]
            out = chunks[lo:hi].astype(np.uint32)
            on = np.unpackbits(bitmap[lo // 8 : -(-hi // 8)], bitorder="little")[lo % 8 : lo % 8 + hi - lo].astype(bool)
            if on.any():
                first = self._rank(k, lo)
                out[on] |= level(k + 1, first, first + int(on.sum())) << np.uint32(bits)
            return out

        return level(0, a, b) if b > a else np.zeros(0, np.uint32)


class Remote:
    """An encoded run of ids that isn't held: `read(offset, size)` gives bytes of it, as a ranged read of a file does.

    Opening reads the heads of the levels; an id takes, for each of its levels, its chunk, a byte of the bitmap and, where
    it goes on, a directory entry and part of one block of the bitmap.
    """

    def __init__(self, read: Callable[[int, int], bytes]) -> None:
        self.read = read
        if read(0, 4) != MAGIC:
            raise ValueError("not a file of directly addressable codes")
        (n,) = struct.unpack("<I", read(4, 4))
        at = 8
        self.levels = []
        for _ in range(n):
            bits, size = struct.unpack("<IQ", read(at, 12))
            width, blocks = 1 if bits <= 8 else 2 if bits <= 16 else 4, -(-size // RANK)
            chunks = at + 12
            bitmap = chunks + size * width
            directory = bitmap + blocks * (RANK // 8)
            at = directory + 8 * blocks
            self.levels.append((bits, width, size, chunks, bitmap, directory))

    def __getitem__(self, i: int) -> int:
        if not 0 <= i < self.levels[0][2]:
            raise IndexError(i)
        value = shift = 0
        for bits, width, _, chunks, bitmap, directory in self.levels:
            value |= int.from_bytes(self.read(chunks + i * width, width), "little") << shift
            first = i // RANK * (RANK // 8)
            block = int.from_bytes(self.read(bitmap + first, i // 8 - first + 1), "little")
            place = i % RANK
            if not block >> place & 1:
                return value
            (before,) = struct.unpack("<Q", self.read(directory + 8 * (i // RANK), 8))
            i, shift = before + (block & ((1 << place) - 1)).bit_count(), shift + bits
        return value
