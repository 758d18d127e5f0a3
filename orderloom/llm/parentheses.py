"""Trees as balanced parentheses: a node is an open parenthesis, its subtree ends at the close.

Bits stand in preorder, 1 for open. A directory of ranks counts opens and leaf pairs ``()``. The
excess (opens less closes) has its least and greatest value for every block of 512 bits, and these
form a tree over the blocks: ``findclose`` looks through its own block, climbs to the next block that
goes low enough, and looks through that one. All operations take arrays of arguments.
"""

from __future__ import annotations

import numpy as np

from orderloom.llm.wavelet import BLOCK, Plane

_BYTES = BLOCK // 8
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int8)
_WALK = np.cumsum(2 * _BITS - 1, axis=1, dtype=np.int8)
# Of each byte: the excess over it, its least prefix, and the bit at which it first falls by k.
_TOTAL = _WALK[:, -1].astype(np.int64)
_LEAST = _WALK.min(axis=1).astype(np.int64)
_GREATEST = _WALK.max(axis=1).astype(np.int64)
_FALL = np.stack([np.where((_WALK == -k).any(axis=1), (_WALK == -k).argmax(axis=1), 8) for k in range(9)], axis=1)


class Parentheses:
    """A forest of ``size`` bits; ``low`` and ``high`` are trees of block excesses, root at 1."""

    def __init__(self, bits: np.ndarray) -> None:
        bits = np.asarray(bits, bool)
        self.size = len(bits)
        self.opens = Plane.of(bits)
        self.leaves = Plane.of(bits & ~np.append(bits[1:], True)) if self.size else Plane.of(bits)
        self.raw = self.opens.words.view(np.uint8)
        blocks = len(self.raw) // _BYTES
        rows = self.raw.reshape(blocks, _BYTES)
        before = np.cumsum(_TOTAL[rows], axis=1) - _TOTAL[rows]
        ranks = self.opens.ranks[:blocks].astype(np.int64)
        start = (2 * ranks - np.arange(blocks) * BLOCK)[:, None]
        self.leaf = 1 << max(1, blocks - 1).bit_length()
        far = np.iinfo(np.int64).max
        self.low = np.full(2 * self.leaf, far)
        self.high = np.full(2 * self.leaf, -far)
        self.low[self.leaf : self.leaf + blocks] = (start + before + _LEAST[rows]).min(axis=1)
        self.high[self.leaf : self.leaf + blocks] = (start + before + _GREATEST[rows]).max(axis=1)
        for x in range(self.leaf - 1, 0, -1):
            self.low[x] = min(self.low[2 * x], self.low[2 * x + 1])
            self.high[x] = max(self.high[2 * x], self.high[2 * x + 1])

    def excess(self, at: np.ndarray) -> np.ndarray:
        """Opens less closes before each position."""
        return 2 * self.opens.rank1(at) - at

    def nodes(self) -> np.ndarray:
        """The positions of all opens, in preorder."""
        return np.flatnonzero(self.opens.bits())

    def preorder(self, at: np.ndarray) -> np.ndarray:
        """The number of each node, from 0."""
        return self.opens.rank1(at)

    def leaf_pairs(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Leaf pairs that open in [start, end)."""
        return self.leaves.rank1(end) - self.leaves.rank1(start)

    def findclose(self, at: np.ndarray) -> np.ndarray:
        """The position of the close of each open."""
        at = np.asarray(at, np.int64)
        goal = self.excess(at)  # the excess behind the close
        now, here = goal + 1, at + 1
        out = np.full(len(at), -1, np.int64)
        left = np.arange(len(at))
        # To the end of the byte, bit by bit.
        for _ in range(7):
            left = left[(here[left] & 7) != 0]
            if not len(left):
                break
            bit = self.raw[here[left] >> 3] >> (here[left] & 7).astype(np.uint8) & 1
            now[left] += 2 * bit.astype(np.int64) - 1
            done = now[left] == goal[left]
            out[left[done]] = here[left[done]]
            here[left] += 1
            left = left[~done]
        left = np.flatnonzero(out < 0)
        # To the end of the block, byte by byte.
        left = left[here[left] % BLOCK != 0]
        self._bytes(left, here, now, goal, out)
        left = np.flatnonzero(out < 0)
        if len(left):
            block = self._next_block(here[left] // BLOCK, goal[left])
            here[left] = block * BLOCK
            now[left] = self.excess(here[left])
            self._bytes(left, here, now, goal, out)
        return out

    def _bytes(self, left: np.ndarray, here: np.ndarray, now: np.ndarray, goal: np.ndarray, out: np.ndarray) -> None:
        """Look through the rest of each block; positions stand at the start of a byte."""
        for _ in range(_BYTES):
            if not len(left):
                return
            byte = self.raw[here[left] >> 3]
            fall = now[left] - goal[left]
            done = _LEAST[byte] <= -fall
            out[left[done]] = here[left[done]] + _FALL[byte[done], fall[done]]
            now[left] += _TOTAL[byte]
            here[left] += 8
            left = left[~done]
            left = left[here[left] % BLOCK != 0]

    def _next_block(self, first: np.ndarray, goal: np.ndarray) -> np.ndarray:
        """The first block from ``first`` on whose least excess is at most ``goal``."""
        x = first + self.leaf
        up = np.arange(len(x))
        while True:
            low_bit = x[up] & -x[up]
            # As high as the subtree still begins here.
            lifted = np.maximum(x[up] // np.maximum(low_bit, 1), 1)
            deep = self.low[lifted] <= goal[up]
            x[up] = np.where(deep, lifted, lifted + 1)
            up = up[~deep]
            if not len(up):
                break
        down = np.flatnonzero(x < self.leaf)
        while len(down):
            child = 2 * x[down]
            x[down] = np.where(self.low[child] <= goal[down], child, child + 1)
            down = down[x[down] < self.leaf]
        return x - self.leaf
