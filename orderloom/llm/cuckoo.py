"""A cuckoo filter that holds a bounded number of copies of each key's fingerprint.

A key has two buckets of four slots; the second follows from the first and the fingerprint, so
entries can move, and be deleted, without their keys. ``held`` gives the number of equal
fingerprints in a key's buckets: never less than the copies put in, sometimes more (another key
with the same fingerprint there), so a low answer is certain and a high one asks for a look-up.
Only copies that were put in may be taken out; the caller's exact counts see to that.
"""

from __future__ import annotations

import random
import struct

import numpy as np

SLOTS = 4
MAGIC = b"CKF1"
# Entries of the largest load that moving entries about still places easily.
LOAD = 0.8
MOVES = 500


class Full(Exception):
    """The filter has no place for an entry; build a larger one from the exact table."""


class CuckooFilter:
    """Entries are 16-bit fingerprints, zero for a free slot; keys are unsigned 64-bit hashes."""

    def __init__(self, buckets: int, slots: np.ndarray | None = None) -> None:
        if buckets < 1 or buckets & (buckets - 1):
            raise ValueError("the number of buckets must be a power of two")
        self.buckets, self.chance = buckets, random.Random(buckets)
        self.slots = np.zeros((buckets, SLOTS), np.uint16) if slots is None else slots

    @classmethod
    def for_entries(cls, entries: int) -> CuckooFilter:
        need = max(1, int(entries / (SLOTS * LOAD)) + 1)
        return cls(1 << (need - 1).bit_length())

    @property
    def size(self) -> int:
        return int(np.count_nonzero(self.slots))

    def _places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First and second bucket, and fingerprint (never zero)."""
        prints = (keys >> np.uint64(48)).astype(np.uint16)
        prints[prints == 0] = 1
        first = (keys & np.uint64(self.buckets - 1)).astype(np.int64)
        return first, self._other(first, prints), prints

    def _other(self, bucket: np.ndarray, prints: np.ndarray) -> np.ndarray:
        # The bucket an entry may move to: going there twice leads back.
        return bucket ^ ((prints.astype(np.int64) * 0x5BD1E995) & (self.buckets - 1))

    def held(self, keys: np.ndarray) -> np.ndarray:
        """Equal fingerprints in the two buckets of each key."""
        first, second, prints = self._places(keys)
        n = (self.slots[first] == prints[:, None]).sum(axis=1)
        return n + np.where(first == second, 0, (self.slots[second] == prints[:, None]).sum(axis=1))

    def put(self, keys: np.ndarray) -> None:
        """Put a copy of each key in; a key may be given several times."""
        first, second, prints = self._places(keys)
        left = np.arange(len(keys))
        for bucket in (first, second):
            left = left[~self._settle(bucket[left], prints[left])]
        for i in left.tolist():
            self._move(int(first[i]), int(second[i]), int(prints[i]))

    def _settle(self, bucket: np.ndarray, prints: np.ndarray) -> np.ndarray:
        """Place what finds a free slot in its bucket; a mark for each entry placed."""
        order = np.argsort(bucket, kind="stable")
        b = bucket[order]
        begins = np.flatnonzero(np.r_[True, b[1:] != b[:-1]]) if len(b) else np.empty(0, np.int64)
        nth = np.arange(len(b)) - np.repeat(begins, np.diff(np.r_[begins, len(b)]))
        free = self.slots[b] == 0
        slot = np.argsort(~free, axis=1, kind="stable")  # free slots first
        fits = nth < free.sum(axis=1)
        self.slots[b[fits], slot[fits, nth[fits]]] = prints[order[fits]]
        placed = np.zeros(len(bucket), bool)
        placed[order[fits]] = True
        return placed

    def _move(self, bucket: int, second: int, entry: int) -> None:
        slots = self.slots
        for at in (bucket, second):
            for s in range(SLOTS):
                if slots[at, s] == 0:
                    slots[at, s] = entry
                    return
        undo = []
        for _ in range(MOVES):
            s = self.chance.randrange(SLOTS)
            entry, out = int(slots[bucket, s]), entry
            undo.append((bucket, s, entry))
            slots[bucket, s] = out
            bucket = bucket ^ ((entry * 0x5BD1E995) & (self.buckets - 1))
            free = np.flatnonzero(slots[bucket] == 0)
            if len(free):
                slots[bucket, free[0]] = entry
                return
        for at, s, entry in reversed(undo):
            slots[at, s] = entry
        raise Full

    def take(self, keys: np.ndarray) -> None:
        """Take a copy of each key out; every one must have been put in before."""
        for bucket, second, entry in zip(*(a.tolist() for a in self._places(keys))):
            for at in (bucket, second):
                found = np.flatnonzero(self.slots[at] == entry)
                if len(found):
                    self.slots[at, found[0]] = 0
                    break
            else:
                raise KeyError("a key that was never put in")

    def body(self) -> bytes:
        return MAGIC + struct.pack("<Q", self.buckets) + self.slots.astype("<u2").tobytes()

    @classmethod
    def read(cls, body: bytes) -> CuckooFilter:
        if body[:4] != MAGIC:
            raise ValueError("not a cuckoo filter")
        (buckets,) = struct.unpack("<Q", body[4:12])
        return cls(buckets, np.frombuffer(body, "<u2", offset=12).reshape(buckets, SLOTS).copy())
