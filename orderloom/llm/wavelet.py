"""Wavelet matrix of a sequence of ids: bit-planes with rank and select.

A plane holds one bit of every id, from the highest; below it the ids with bit 0 come first,
then those with bit 1, each in order. Access, counting and occurrence lookup need only ranks
and selects on the planes. All operations take arrays of arguments.
"""

from __future__ import annotations

import numpy as np

BLOCK = 512  # bits of a rank block: eight 64-bit words


class Plane:
    """A bit vector with the number of ones before every block."""

    def __init__(self, words: np.ndarray, ranks: np.ndarray, size: int) -> None:
        self.words, self.ranks, self.size = words, ranks, size

    @classmethod
    def of(cls, bits: np.ndarray) -> Plane:
        packed = np.packbits(bits, bitorder="little")
        words = np.zeros(len(bits) // BLOCK * 8 + 8, np.uint64)
        words.view(np.uint8)[: len(packed)] = packed
        ones = np.bitwise_count(words).reshape(-1, 8).sum(axis=1, dtype=np.uint32)
        ranks = np.zeros(len(ones) + 1, np.uint32)
        np.cumsum(ones, out=ranks[1:])
        return cls(words, ranks, len(bits))

    def bits(self) -> np.ndarray:
        return np.unpackbits(self.words.view(np.uint8), count=self.size, bitorder="little").astype(bool)

    def bit(self, at: np.ndarray) -> np.ndarray:
        return (self.words[at >> 6] >> (at & 63).astype(np.uint64) & np.uint64(1)).astype(np.int64)

    def rank1(self, at: np.ndarray) -> np.ndarray:
        """Ones before each position."""
        block, word = at >> 9, at >> 6
        out = self.ranks[block].astype(np.int64)
        for i in range(7):
            before = block * 8 + i
            out += np.where(before < word, np.bitwise_count(self.words[before]), 0)
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return out + np.bitwise_count(self.words[np.minimum(word, len(self.words) - 1)] & mask)

    def select(self, nth: np.ndarray, bit: int) -> np.ndarray:
        """Position of the nth (from 0) one or zero."""
        blocks = np.arange(len(self.ranks), dtype=np.int64)
        before = self.ranks.astype(np.int64) if bit else blocks * BLOCK - self.ranks
        block = np.searchsorted(before, nth, side="right") - 1
        left, word = nth - before[block], block * 8
        for _ in range(7):
            value = self.words[word] if bit else ~self.words[word]
            n = np.bitwise_count(value).astype(np.int64)
            on = left >= n
            left, word = np.where(on, left - n, left), np.where(on, word + 1, word)
        value = self.words[word] if bit else ~self.words[word]
        at = np.zeros_like(left)
        for half in (32, 16, 8, 4, 2, 1):
            n = np.bitwise_count(value & np.uint64((1 << half) - 1)).astype(np.int64)
            on = left >= n
            left, at = np.where(on, left - n, left), np.where(on, at + half, at)
            value = np.where(on, value >> np.uint64(half), value)
        return word * 64 + at


class WaveletMatrix:
    def __init__(self, planes: list[Plane], size: int) -> None:
        self.planes, self.size = planes, size

    @classmethod
    def of(cls, ids: np.ndarray) -> WaveletMatrix:
        depth = int(ids.max()).bit_length() if len(ids) else 0
        ids = np.array(ids, np.uint16 if depth <= 16 else np.uint32)
        planes, down = [], np.empty_like(ids)
        for shift in range(depth - 1, -1, -1):
            bits = (ids & ids.dtype.type(1 << shift)).astype(bool)
            planes.append(Plane.of(bits))
            zeros = len(ids) - int(planes[-1].ranks[-1])
            # Taking by position is much faster than by mask.
            np.take(ids, np.flatnonzero(~bits), out=down[:zeros], mode="clip")
            np.take(ids, np.flatnonzero(bits), out=down[zeros:], mode="clip")
            ids, down = down, ids
        return cls(planes, len(ids))

    def _zeros(self, plane: Plane) -> int:
        return self.size - int(plane.ranks[-1])

    def decode(self) -> np.ndarray:
        """All ids, by undoing the partitions from the lowest plane up."""
        ids = np.zeros(self.size, np.uint16 if len(self.planes) <= 16 else np.uint32)
        up = np.empty_like(ids)
        for shift, plane in enumerate(reversed(self.planes)):
            bits, zeros = plane.bits(), self._zeros(plane)
            up[np.flatnonzero(~bits)] = ids[:zeros]
            up[np.flatnonzero(bits)] = ids[zeros:] | ids.dtype.type(1 << shift)
            ids, up = up, ids
        return ids.astype(np.uint32)

    def access(self, at) -> np.ndarray:
        at = np.asarray(at, np.int64)
        out = np.zeros(at.shape, np.uint32)
        for plane in self.planes:
            bit, ones = plane.bit(at), plane.rank1(at)
            at = np.where(bit == 1, self._zeros(plane) + ones, at - ones)
            out = out << np.uint32(1) | bit.astype(np.uint32)
        return out

    def _range(self, token: int, start: int, end: int) -> tuple[int, int]:
        if token < 0 or token >> len(self.planes):
            return 0, 0
        lo_hi = np.array([start, end], np.int64)
        for shift, plane in zip(range(len(self.planes) - 1, -1, -1), self.planes):
            ones = plane.rank1(lo_hi)
            lo_hi = self._zeros(plane) + ones if token >> shift & 1 else lo_hi - ones
        return int(lo_hi[0]), int(lo_hi[1])

    def count(self, token: int, start: int = 0, end: int | None = None) -> int:
        """Occurrences of ``token`` in positions [start, end)."""
        lo, hi = self._range(token, start, self.size if end is None else end)
        return hi - lo

    def occurrences(self, token: int, start: int = 0, end: int | None = None) -> np.ndarray:
        """Positions of ``token`` in [start, end), ascending."""
        lo, hi = self._range(token, start, self.size if end is None else end)
        at = np.arange(lo, hi, dtype=np.int64)
        for shift, plane in enumerate(reversed(self.planes)):
            if len(at):
                one = token >> shift & 1
                at = plane.select(at - self._zeros(plane), 1) if one else plane.select(at, 0)
        return at
