"""Periodic runs of words: longest common extensions over a difference cover, on a harmonic grid.

A run is a stretch of words with smallest period q, at least ``max(min_words, 2 * q)`` long, that
no neighbouring word extends keeping period q. Texts are worked on in blocks of about
``BLOCK_WORDS`` words, each text followed by a word of its own, so that no comparison passes its end.

* ``Extensions`` answers how far two positions agree. Only suffixes that start at positions of a
  difference cover modulo V are sorted (V words at once, then by doubling over the cover); of
  neighbours in this order the common prefixes are kept in a sparse table of range minima. Any two
  positions reach cover positions together within V words: these few are compared, and the rest
  comes from one range minimum.
* The grid: every run of period p holds two positions x and x + p with x a multiple of
  ``max(p, min_words - p)``. From such pairs of equal words the extensions to both sides give the
  run; pairs over all p are harmonic, n log n in number. Of runs over one stretch the smallest
  period is the primitive one, as all their periods are multiples of it.

A text is the work of one task; its memory is linear in its words, and pairs and extensions are
taken in blocks of bounded size. Documents are not shuffled.

Defined results: a null or empty text has no words, no runs and an empty collapsed text; repeated
rows give a row each; a null id is kept; other columns stay, also under clashing names, as results are in
one struct; no rows give no rows. Equal words are equal bytes in UTF-8.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

MIN_WORDS = 12
BLOCK_WORDS = 100_000
# The most pairs of the grid that are extended at once.
PAIRS = 1_000_000

# A perfect difference cover. Every residue is a difference of two of its members.
V = 31
COVER = (0, 1, 3, 8, 12, 18)

RESULT = (
    "struct<n_words: bigint, runs: array<struct<start: bigint, length: bigint, period: bigint>>, collapsed: string>"
)

_SLOT = np.full(V, -1, np.int64)
_SLOT[list(COVER)] = np.arange(len(COVER))


def _shifts() -> np.ndarray:
    """By two residues: the words to the next place where both are in the cover."""
    k = np.arange(V)
    at = (np.arange(V)[:, None] + k) % V
    both = (_SLOT[at][:, None, :] >= 0) & (_SLOT[at][None, :, :] >= 0)
    return both.argmax(axis=2)


_SHIFT = _shifts()


class Extensions:
    """``of(i, j)``: the number of words from i on that equal those from j on, for i <> j.

    ``words`` are numbers; the last of them must occur once. No positions behind the end are asked.
    """

    def __init__(self, words: np.ndarray) -> None:
        self.words = np.concatenate([words, np.full(2 * V, -1, words.dtype)])
        n = len(words)
        blocks = np.arange(n // V + 2, dtype=np.int64)[:, None] * V
        self.at = (blocks + np.array(COVER)).ravel()
        self.at = self.at[self.at < n]
        ranks = [self._first_ranks()]
        while ranks[-1].max(initial=0) < len(self.at) - 1:
            ranks.append(self._doubled(ranks[-1], V << (len(ranks) - 1)))
        order = np.argsort(ranks[-1])
        self.rank = ranks[-1]
        self.table = [self._neighbours(order, ranks)]
        while 2 << (len(self.table) - 1) <= len(self.table[0]):
            last, half = self.table[-1], 1 << (len(self.table) - 1)
            self.table.append(np.minimum(last[:-half], last[half:]))

    def _first_ranks(self) -> np.ndarray:
        """Ranks of the cover's suffixes by their first V words."""
        low = self.words - self.words.min()
        bits = max(1, int(low.max(initial=0)).bit_length())
        per = max(1, 63 // bits)
        keys = []
        for first in range(0, V, per):
            key = np.zeros(len(self.at), np.int64)
            for k in range(first, min(first + per, V)):
                key = key << bits | low[self.at + k]
            keys.append(key)
        order = np.lexsort(keys[::-1])
        new = np.zeros(len(order), np.int64)
        for key in keys:
            new[1:] |= key[order[1:]] != key[order[:-1]]
        return self._placed(order, new)

    @staticmethod
    def _placed(order: np.ndarray, new: np.ndarray) -> np.ndarray:
        rank = np.empty(len(order), np.int64)
        rank[order] = np.cumsum(new)
        return rank

    def _sample(self, at: np.ndarray) -> np.ndarray:
        """The number of a cover position among all of them."""
        return at // V * len(COVER) + _SLOT[at % V]

    def _after(self, rank: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Ranks of the suffixes at cover positions; behind the end a rank below all."""
        inside = at < len(self.words) - 2 * V
        return np.where(inside, rank[np.where(inside, self._sample(at), 0)], -1)

    def _doubled(self, rank: np.ndarray, step: int) -> np.ndarray:
        key = rank * (len(rank) + 1) + self._after(rank, self.at + step) + 1
        order = np.argsort(key, kind="stable")
        new = np.zeros(len(order), np.int64)
        new[1:] = key[order[1:]] != key[order[:-1]]
        return self._placed(order, new)

    def _neighbours(self, order: np.ndarray, ranks: list[np.ndarray]) -> np.ndarray:
        """Common prefixes of neighbours in the order, by going down the doubled ranks."""
        a, b = self.at[order[:-1]].copy(), self.at[order[1:]].copy()
        start = a.copy()
        for level in range(len(ranks) - 1, -1, -1):
            ra, rb = self._after(ranks[level], a), self._after(ranks[level], b)
            step = np.where((ra == rb) & (ra >= 0), V << level, 0)
            a += step
            b += step
        return a - start + self._compared(a, b, np.full(len(a), V))

    def _compared(self, i: np.ndarray, j: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Equal words from i and j on, at most ``most``."""
        out = most.copy()
        left = np.flatnonzero(most > 0)
        for k in range(V):
            if not len(left):
                break
            same = self.words[i[left] + k] == self.words[j[left] + k]
            out[left[~same]] = k
            left = left[same]
            left = left[most[left] > k + 1]
        return out

    def of(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        shift = _SHIFT[i % V, j % V]
        out = self._compared(i, j, shift)
        on = np.flatnonzero(out == shift)
        a = self.rank[self._sample(i[on] + shift[on])]
        b = self.rank[self._sample(j[on] + shift[on])]
        low, high = np.minimum(a, b), np.maximum(a, b)
        level = np.frexp((high - low).astype(np.float64))[1] - 1
        for k in np.unique(level):
            here = level == k
            row = self.table[k]
            out[on[here]] += np.minimum(row[low[here]], row[high[here] - (1 << int(k))])
        return out


def _pairs(words: np.ndarray, starts: np.ndarray, sizes: np.ndarray, least: int) -> Iterator[tuple]:
    """Grid positions x and periods p with equal words at x and x + p of one text, in blocks.

    Texts must be in order of size: those too short for a period are left out from the front.
    """
    doc_ends = starts + sizes
    xs, ps, held = [], [], 0
    longest = int(sizes.max(initial=0))
    first_doc = np.searchsorted(sizes, np.maximum(least, 2 * np.arange(longest // 2 + 1)))
    for p in range(1, longest // 2 + 1):
        if first_doc[p] == len(sizes):
            break
        step = max(p, least - p)
        begin = -(-int(starts[first_doc[p]]) // step) * step
        same = np.flatnonzero(words[begin : len(words) - p : step] == words[begin + p :: step])
        if len(same):
            xs.append(begin + same * step)
            ps.append(np.full(len(same), p))
            held += len(same)
        if held >= PAIRS:
            yield from _inside(xs, ps, doc_ends)
            xs, ps, held = [], [], 0
    if held:
        yield from _inside(xs, ps, doc_ends)


def _inside(xs: list, ps: list, doc_ends: np.ndarray) -> Iterator[tuple]:
    x, p = np.concatenate(xs), np.concatenate(ps)
    kept = x + p < doc_ends[np.searchsorted(doc_ends, x, side="right")]
    x, p = x[kept], p[kept]
    for at in range(0, len(x), PAIRS):
        yield x[at : at + PAIRS], p[at : at + PAIRS]


def runs_of(texts: list[np.ndarray], least: int = MIN_WORDS) -> list[np.ndarray]:
    """Per text, given as word numbers from 0, its runs as rows of start, length, period.

    Rows are ordered by start, then period.
    """
    by_size = sorted(range(len(texts)), key=lambda d: len(texts[d]))
    sizes = np.array([len(texts[d]) for d in by_size], np.int64)
    starts = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]]).astype(np.int64)
    own = 1 + max((int(t.max(initial=-1)) for t in texts), default=-1)
    parts = []
    for k, d in enumerate(by_size):
        parts += [texts[d], np.array([own + k])]
    words = np.concatenate([np.asarray(p, np.int32) for p in parts]) if parts else np.empty(0, np.int32)
    found = []
    ahead = behind = None
    for x, p in _pairs(words, starts, sizes, least):
        if ahead is None:
            ahead = Extensions(words)
            # The word before the first is a new one; it ends every extension to the left.
            behind = Extensions(np.append(words[::-1], np.int32(own + len(by_size))))
        first = len(words) - x  # in the turned block, the word before x
        b = behind.of(first, first - p)
        f = ahead.of(x, x + p)
        long = p + f + b >= np.maximum(least, 2 * p)
        rows = np.stack([(x - b)[long], (p + f + b)[long], p[long]], axis=1)
        found.append(np.unique(rows, axis=0))
    out = [np.empty((0, 3), np.int64) for _ in texts]
    if not found:
        return out
    rows = np.unique(np.concatenate(found), axis=0)  # by start, length, period
    first = np.ones(len(rows), bool)
    first[1:] = (rows[1:, :2] != rows[:-1, :2]).any(axis=1)
    rows = rows[first]
    rows = rows[np.lexsort([rows[:, 2], rows[:, 0]])]
    doc = np.searchsorted(starts, rows[:, 0], side="right") - 1
    rows[:, 0] -= starts[doc]
    cuts = np.searchsorted(doc, np.arange(len(by_size) + 1))
    for k in np.unique(doc).tolist():
        out[by_size[k]] = rows[cuts[k] : cuts[k + 1]]
    return out


def kept_words(size: int, runs: np.ndarray) -> np.ndarray:
    """Marks of the words that no run holds after its first period."""
    edges = np.zeros(size + 1, np.int64)
    np.add.at(edges, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edges, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(edges)[:-1] == 0


Prepare = Callable[[object, list[bytes]], list[bytes]]


def find_runs(
    docs: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    out: str = "found",
    min_words: int = MIN_WORDS,
    prepare: Prepare | None = None,
) -> DataFrame:
    """``docs`` without ``text``, with a struct ``out``: n_words, runs, collapsed.

    ``runs`` is ordered by start, then period; ``collapsed`` holds the words that no run contains
    after its first period, joined by one space. ``prepare`` may change a document's words,
    given its id, before they are searched.
    """
    if out.lower() in (c.lower() for c in docs.columns if c != text):
        raise ValueError(f"{out} is a column already")
    others = [c for c in docs.columns if c != text]
    table = docs.select(*others, text)
    schema = ", ".join([*(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in others), f"`{out}` {RESULT}"])
    run_type = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def block(words: list[list[bytes]]) -> tuple[list[np.ndarray], list[str]]:
        numbers: dict[bytes, int] = {}
        coded = [np.array([numbers.setdefault(w, len(numbers)) for w in ws], np.int32) for ws in words]
        runs = runs_of(coded, min_words)
        texts = []
        for ws, rs in zip(words, runs):
            if len(rs):
                ws = [w for w, k in zip(ws, kept_words(len(ws), rs).tolist()) if k]
            texts.append(b" ".join(ws).decode())
        return runs, texts

    def answer(rows: pa.RecordBatch, words: list[list[bytes]]) -> pa.RecordBatch:
        runs, texts = block(words)
        flat = np.concatenate(runs) if runs else np.empty((0, 3), np.int64)
        offsets = np.cumsum([0, *map(len, runs)])
        structs = pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(3)], fields=list(run_type))
        found = pa.StructArray.from_arrays(
            [pa.array(list(map(len, words)), pa.int64()),
             pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), structs), pa.array(texts, pa.string())],
            names=["n_words", "runs", "collapsed"],
        )
        return pa.RecordBatch.from_arrays([*rows.columns[:-1], found], names=[*others, out])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(others.index(id_col))
            words, size, first = [], 0, 0
            for i in range(batch.num_rows):
                body = batch.column(len(others))[i].as_py() or ""
                ws = body.encode().split()  # of bytes, at ASCII white space alone
                if prepare is not None:
                    ws = prepare(ids[i].as_py(), ws)
                words.append(ws)
                size += len(ws)
                if size >= BLOCK_WORDS:
                    yield answer(batch.slice(first, len(words)), words)
                    first, words, size = i + 1, [], 0
            if words:
                yield answer(batch.slice(first, len(words)), words)

    return table.mapInArrow(run, schema)
