"""Language-model scores from a log-frequency Bloom filter of quantised bigram counts.

Words are told apart by 64-bit hashes. The count of a bigram is quantised to its base-2
logarithm q, and the bigram enters the filter q times, as (bigram, 1) ... (bigram, q). A reader
probes (bigram, 1), (bigram, 2), ... until one is missing; a false answer can only raise a
count. With c^ the count that a level stands for and d^ = max(c^ - D, 0), let S(h) be the sum of
d^(hw) over the words w that were learnt after h; it is summed up when the filter is built and
held beside the exact count of h. The probability of w after h is

    (d^(hw) + (Z(h) - S(h)) * P1(w)) / Z(h),   Z(h) = max(c(h), S(h)) + MU

where P1 is the smoothed unigram probability, so the probabilities after any h add up to one. False
answers of the filter are all that can add to this (PROBES probes at BITS bits an entry: about 4 in
100 for each level); a word or context that was never learnt needs no probe, and no
probability is taken above one.

All counts cover all learnt documents. Tasks sum up words and bigrams in sorted arrays and send
them packed, by segment of the hash space; a segment's task adds them up, so a common word costs
one entry per task. The filter is built by segment, with bits in proportion to its entries, and
is broadcast in parts of at most PART_BYTES; each part scores the bigrams it holds, and the
partial sums of a document are added. Exact word counts reach a bucket of documents by a shuffle
that carries only the words that occur in other buckets too, with their S; that of the others
follows from the bucket's own bigrams.

A word's hash is a polynomial in its bytes, so the hashes of a whole run of texts come from
one running sum.

Defined results: a null or empty text has the end token alone; a null id hashes as an empty one;
repeated rows are learnt from, and scored, each; nothing learnt: N and V are 0 and the model is
the smoothing alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import stored

BITS = 7
PROBES = 4
PART_BYTES = 96 * 1024 * 1024
MU = 3.0
DISCOUNT = 0.75
LEVELS = 40
# Tokens that a task sums up at a time, and bytes of text that it hashes at a time.
FLUSH = 1 << 21
CHUNK = 1 << 20
SEGMENT_BYTES = 4 * 1024 * 1024
BUCKET_BYTES = 12 * 1024 * 1024

END, START = 0x9E3779B97F4A7C15, 0xD1B54A32D192ED03
# The polynomial's base, odd and so invertible modulo 2**64.
BASE = 0x5851F42D4C957F2D

_LOWER = bytes(b + 32 if 65 <= b <= 90 else 32 if 9 <= b <= 13 else b for b in range(256))

# Packed counts: ``part`` is the length of the n-grams, or the bucket that asks; bigrams have
# the word that they begin with in ``heads``.
_PACKED = "segment int, part int, keys binary, counts binary, heads binary"
_PACK = pa.schema(
    [("segment", pa.int32()), ("part", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary()), ("heads", pa.binary())]
)


def held_out(id_col: str = "doc_id", parts: int = 5, part: int = 1) -> Column:
    name = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    return F.crc32(name.cast("binary")) % parts == part


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


class Hasher:
    """Hashes of words, many texts at a time."""

    def __init__(self) -> None:
        values = np.random.default_rng(7).integers(1, 1 << 63, 256).astype(np.uint64)
        self.values = values
        self.up = self.down = np.zeros(0, np.uint64)

    def _room(self, n: int) -> None:
        if n > len(self.up):
            self.up = _powers(BASE, n)
            self.down = _powers(pow(BASE, -1, 1 << 64), n)

    def of(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of all texts in turn, each with its end, and the place behind each text's last."""
        raw = b" ".join(texts).translate(_LOWER) + b" "
        data = np.frombuffer(raw, np.uint8)
        self._room(len(data) + 1)
        solid = data != 32
        edges = np.flatnonzero(np.diff(np.r_[False, solid, False].astype(np.int8)))
        starts, ends = edges[::2], edges[1::2]
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.values[data] * self.up[: len(data)], out=sums[1:])
        words = (sums[ends] - sums[starts]) * self.down[starts] + (ends - starts).astype(np.uint64)
        sizes = np.array([len(t) for t in texts], np.int64)
        text_ends = np.cumsum(sizes + 1)
        owner = np.searchsorted(text_ends, starts, side="right")
        out = np.full(len(words) + len(texts), END, np.uint64)
        out[np.arange(len(words)) + owner] = _mixed(words)
        behind = np.cumsum(np.bincount(owner, minlength=len(texts)) + 1)
        return out, behind


def _chunks(texts: pa.Array) -> Iterator[tuple[int, list[bytes]]]:
    """Runs of texts of about CHUNK bytes with the number of the first; a longer text is one run."""
    held: list[bytes] = []
    size = first = 0
    for i, text in enumerate(texts):
        raw = (text.as_py() or "").encode("utf-8", "surrogatepass")
        if held and size + len(raw) > CHUNK:
            yield first, held
            held, size, first = [], 0, i
        held.append(raw)
        size += len(raw) + 1
    if held:
        yield first, held


def _before(tokens: np.ndarray, behind: np.ndarray, first) -> np.ndarray:
    """The value before each token; ``first`` before a text's first."""
    out = np.empty_like(tokens)
    out[1:] = tokens[:-1]
    out[np.r_[0, behind[:-1]]] = first
    return out


def pairs(tokens: np.ndarray, behind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the bigrams that end at each token, and the words that they begin with; a text's
    first follows the start mark."""
    before = _before(tokens, behind, np.uint64(START))
    return _mixed(before * np.uint64(0xBF58476D1CE4E5B9) ^ (tokens + np.uint64(0x94D049BB133111EB))), before


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _step(level: int) -> np.uint64:
    return np.uint64(level * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)


def _segment(keys: np.ndarray, segments: int) -> np.ndarray:
    return ((keys >> np.uint64(32)) % np.uint64(segments)).astype(np.int64)


def _packs(
    keys: np.ndarray, counts: np.ndarray, segments: int, part: int, heads: np.ndarray | None = None
) -> pa.RecordBatch:
    """One row per segment with the sorted keys and their counts."""
    segment = _segment(keys, segments)
    order = np.argsort(segment, kind="stable")
    keys, counts, segment = keys[order], counts[order].astype(np.uint32), segment[order]
    heads = None if heads is None else heads[order]
    starts = np.flatnonzero(np.r_[True, segment[1:] != segment[:-1]]) if len(keys) else []
    ends = [*starts[1:], len(keys)] if len(keys) else []
    return pa.RecordBatch.from_pydict(
        {"segment": pa.array(segment[starts] if len(keys) else [], pa.int32()),
         "part": pa.array([part] * len(starts), pa.int32()),
         "keys": pa.array([keys[a:b].tobytes() for a, b in zip(starts, ends)], pa.binary()),
         "counts": pa.array([counts[a:b].tobytes() for a, b in zip(starts, ends)], pa.binary()),
         "heads": pa.array([None if heads is None else heads[a:b].tobytes() for a, b in zip(starts, ends)], pa.binary())},
        schema=_PACK,
    )


def _summed(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.unique(np.concatenate(parts), return_counts=True)


def _summed_pairs(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct bigrams, how often each occurs, and the words that they begin with."""
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    keys, at, counts = np.unique(np.concatenate([k for k, _ in parts]), return_index=True, return_counts=True)
    return keys, counts, np.concatenate([h for _, h in parts])[at]


def _arrays(table: pa.Table) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    for part, keys, counts in zip(
        table["part"].to_pylist(), table["keys"].to_pylist(), table["counts"].to_pylist()
    ):
        yield part, np.frombuffer(keys, np.uint64), np.frombuffer(counts, np.uint32).astype(np.int64)


def _totals(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys of a segment and the sums of their counts."""
    rows = list(_arrays(table))
    keys, where = np.unique(np.concatenate([k for _, k, _ in rows]), return_inverse=True)
    return keys, np.bincount(where, np.concatenate([c for _, _, c in rows]), len(keys)).astype(np.int64)


def counted(texts: DataFrame, segments: int) -> DataFrame:
    """Packed counts of the words (part 1) and bigrams (part 2) of the only column of ``texts``."""

    def gram_packs(grams: list) -> pa.RecordBatch:
        keys, counts, heads = _summed_pairs(grams)
        return _packs(keys, counts, segments, 2, heads)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, words, grams, size = Hasher(), [], [], 0
        for batch in batches:
            for _, some in _chunks(batch.column(0)):
                tokens, behind = hasher.of(some)
                words.append(tokens)
                grams.append(pairs(tokens, behind))
                size += len(tokens)
                if size >= FLUSH:
                    yield _packs(*_summed(words), segments, 1)
                    yield gram_packs(grams)
                    words, grams, size = [], [], 0
        if size:
            yield _packs(*_summed(words), segments, 1)
            yield gram_packs(grams)

    return texts.mapInArrow(run, _PACKED)


def _place(x: np.ndarray, probe: int, size: np.ndarray) -> np.ndarray:
    """Bit positions of one probe, in segments of ``size`` bits (below 2**32)."""
    low, high = x & np.uint64(0xFFFFFFFF), x >> np.uint64(32) | np.uint64(1)
    return ((low + np.uint64(probe) * high & np.uint64(0xFFFFFFFF)) * size) >> np.uint64(32)


def levels_of(counts: np.ndarray) -> np.ndarray:
    return np.minimum(1 + np.floor(np.log2(np.maximum(counts, 1))).astype(np.int64), LEVELS)


def built(packed: DataFrame, segments: int, bits: int = BITS) -> DataFrame:
    """Sums of the packed counts by part and segment: part, segment, n (tokens), v (distinct), and for the
    bigrams size and body of the filter's segment.

    Rows of part 3 hold sums of d^ by the words that bigrams begin with, for the segment of the word.
    """

    def run(table: pa.Table) -> pa.Table:
        part, segment = table["part"][0].as_py(), table["segment"][0].as_py()
        rows = list(_arrays(table))
        keys, at, where = np.unique(np.concatenate([k for _, k, _ in rows]), return_index=True, return_inverse=True)
        counts = np.bincount(where, np.concatenate([c for _, _, c in rows]), len(keys)).astype(np.int64)
        row = {"part": part, "segment": segment, "n": int(counts.sum()), "v": len(keys)}
        if part == 1:
            return pa.Table.from_pylist([row], _BUILT)
        levels = levels_of(counts)
        size = min(max(64, int(levels.sum()) * bits), (1 << 32) - 1)
        on = np.zeros(size, bool)
        for level in range(1, int(levels.max()) + 1):
            x = _mixed(keys[levels >= level] + _step(level))
            for probe in range(PROBES):
                on[_place(x, probe, np.uint64(size))] = True
        row |= {"size": size, "body": np.packbits(on, bitorder="little").tobytes()}
        heads = np.concatenate([np.frombuffer(h, np.uint64) for h in table["heads"].to_pylist()])[at]
        words, which = np.unique(heads, return_inverse=True)
        sums = np.bincount(which, discounted(levels), len(words))
        to = _segment(words, segments)
        order = np.argsort(to, kind="stable")
        words, sums, to = words[order], sums[order], to[order]
        cuts = [0, *(np.flatnonzero(to[1:] != to[:-1]) + 1).tolist(), len(to)]
        found = [
            {"part": 3, "segment": int(to[a]), "n": 0, "v": 0, "keys": words[a:b].tobytes(), "sums": sums[a:b].tobytes()}
            for a, b in zip(cuts, cuts[1:])
        ]
        return pa.Table.from_pylist([row, *found], _BUILT)

    return packed.groupBy("part", "segment").applyInArrow(
        run, "part int, segment int, n long, v long, size long, body binary, keys binary, sums binary"
    )


_BUILT = pa.schema(
    [("part", pa.int32()), ("segment", pa.int32()), ("n", pa.int64()), ("v", pa.int64()), ("size", pa.int64()),
     ("body", pa.binary()), ("keys", pa.binary()), ("sums", pa.binary())]
)


class Filter:
    """Some segments of the filter as one array of bits."""

    def __init__(self, rows: list[tuple[int, int, bytes]], segments: int) -> None:
        self.segments = segments
        self.size = np.zeros(segments, np.uint64)
        self.start = np.zeros(segments, np.uint64)
        at = 0
        for segment, size, body in rows:
            self.size[segment], self.start[segment] = size, 8 * at
            at += len(body)
        self.bits = np.frombuffer(b"".join(r[2] for r in rows) or b"\0", np.uint8)

    def holds(self, keys: np.ndarray) -> np.ndarray:
        return self.size[_segment(keys, self.segments)] > 0

    def levels(self, keys: np.ndarray) -> np.ndarray:
        """Quantised counts by repeated probes; 0 for keys that are not held."""
        segment = _segment(keys, self.segments)
        out = np.zeros(len(keys), np.int64)
        left = np.flatnonzero(self.size[segment] > 0)
        for level in range(1, LEVELS + 1):
            x, own = _mixed(keys[left] + _step(level)), segment[left]
            for probe in range(PROBES):
                at = self.start[own] + _place(x, probe, self.size[own])
                on = (self.bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1) > 0
                left, x, own = left[on], x[on], own[on]
            if not len(left):
                break
            out[left] = level
        return out


def read_back(levels: np.ndarray) -> np.ndarray:
    """Counts for quantised ones: the geometric middle of 2**(q-1) .. 2**q - 1."""
    low = np.exp2(levels - 1.0)
    return np.where(levels > 0, np.sqrt(low * (2 * low - 1)), 0.0)


def discounted(levels: np.ndarray) -> np.ndarray:
    """What a bigram of each level counts for."""
    return np.maximum(read_back(levels) - DISCOUNT, 0)


def _tokens(table: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Runs of the rows of a bucket: tokens, places behind texts, and whether each text is held out."""
    hasher, held = Hasher(), np.array(table["held"].to_pylist(), bool)
    for first, some in _chunks(table["text"].combine_chunks()):
        tokens, behind = hasher.of(some)
        yield tokens, behind, held[first : first + len(some)]


def _own_counts(runs: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
    """Words of a bucket with their counts in learnt texts (0: in held-out ones only)."""
    learnt, seen = [], []
    for tokens, behind, held in runs:
        out = np.repeat(held, np.diff(np.r_[0, behind]))
        learnt.append(tokens[~out])
        seen.append(np.unique(tokens[out]))
    keys, counts = _summed(learnt)
    new = np.setdiff1d(np.concatenate(seen), keys)
    order = np.argsort(np.r_[keys, new])
    return np.r_[keys, new][order], np.r_[counts, np.zeros(len(new), np.int64)][order]


def _sums_by_word(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """The S of each word in packed sums."""
    if not table.num_rows:
        return np.zeros(0, np.uint64), np.zeros(0)
    keys = np.concatenate([np.frombuffer(k, np.uint64) for k in table["keys"].to_pylist()])
    sums = np.concatenate([np.frombuffer(s, np.float64) for s in table["sums"].to_pylist()])
    words, which = np.unique(keys, return_inverse=True)
    return words, np.bincount(which, sums, len(words))


def _found(words: np.ndarray, values: np.ndarray, asked: np.ndarray) -> np.ndarray:
    """The value of each word asked for; 0 for those that are not there."""
    if not len(words):
        return np.zeros(len(asked), values.dtype)
    at = np.minimum(np.searchsorted(words, asked), len(words) - 1)
    return np.where(words[at] == asked, values[at], 0)


def lookups(docs: DataFrame, sums: DataFrame, segments: int) -> DataFrame:
    """Packed exact counts and S by bucket, of the words whose count there differs from the whole one."""

    def ask(table: pa.Table) -> pa.Table:
        keys, counts = _own_counts(list(_tokens(table)))
        return pa.Table.from_batches([_packs(keys, counts, segments, table["bucket"][0].as_py())], _PACK)

    def answer(table: pa.Table, sums: pa.Table) -> pa.Table:
        out = []
        if table.num_rows:
            keys, totals = _totals(table)
            words, s = _sums_by_word(sums)
            for bucket, own, counts in _arrays(table):
                whole = totals[np.searchsorted(keys, own)]
                some = whole != counts
                out.append(
                    (bucket, own[some].tobytes(), whole[some].astype(np.uint64).tobytes(), _found(words, s, own[some]).tobytes())
                )
        names = [("bucket", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary()), ("sums", pa.binary())]
        return pa.table({name: pa.array([o[k] for o in out], t) for k, (name, t) in enumerate(names)})

    asked = docs.groupBy("bucket").applyInArrow(ask, _PACKED).groupBy("segment")
    return asked.cogroup(sums.groupBy("segment")).applyInArrow(
        answer, "bucket int, keys binary, counts binary, sums binary"
    )


SCORES = (
    "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"
)


def _scored(
    docs: pa.Table, words: pa.Table, filter_: Filter, n: int, v: int, starts: int, start_sum: float, mu: float
) -> pa.Table:
    """Scores of a bucket; ``score`` sums the tokens whose bigram the filter part holds."""
    runs = list(_tokens(docs))
    keys, counts = _own_counts(runs)
    own, sums = np.ones(len(keys), bool), np.zeros(len(keys))
    for k, c, s in zip(words["keys"].to_pylist(), words["counts"].to_pylist(), words["sums"].to_pylist()):
        at = np.searchsorted(keys, np.frombuffer(k, np.uint64))
        counts[at] = np.frombuffer(c, np.uint64).astype(np.int64)
        own[at], sums[at] = False, np.frombuffer(s, np.float64)
    grams = []
    for tokens, behind, held in runs:
        # Learnt bigrams of the words that occur in this bucket alone.
        learnt = np.repeat(~held, np.diff(np.r_[0, behind]))
        learnt[np.r_[0, behind[:-1]]] = False
        gram, head = pairs(tokens, behind)
        at = np.searchsorted(keys, head[learnt])
        mine = own[at]
        grams.append((gram[learnt][mine], at[mine].astype(np.uint64)))
    _, often, head = _summed_pairs(grams)
    sums += np.bincount(head.astype(np.int64), discounted(levels_of(often)), len(keys))
    weight = n + 0.5 * (v + 1)
    out: dict[str, list] = {"n_tokens": [], "n_known": [], "base_score": [], "score": []}
    for tokens, behind, _ in runs:
        word, which = np.unique(tokens, return_inverse=True)
        at = np.searchsorted(keys, word)
        c = counts[at][which]
        one = (c + 0.5) / weight
        before = _before(c, behind, starts)
        given = _before(sums[at][which], behind, start_sum)
        gram, which = np.unique(pairs(tokens, behind)[0], return_inverse=True)
        likely = np.where((c > 0) & (before > 0), discounted(filter_.levels(gram))[which], 0)
        whole = np.maximum(before, given) + mu
        score = np.log10(np.minimum((likely + (whole - given) * one) / whole, 1))
        begins = np.r_[0, behind[:-1]]
        out["n_tokens"] += np.diff(np.r_[0, behind]).tolist()
        out["n_known"] += np.add.reduceat((c > 0).astype(np.int64), begins).tolist()
        out["base_score"] += np.add.reduceat(np.log10(one), begins).tolist()
        out["score"] += np.add.reduceat(np.where(filter_.holds(gram)[which], score, 0.0), begins).tolist()
    return pa.table(
        {"row": docs["row"], "doc_id": docs["id"], "held_out": docs["held"],
         "n_tokens": pa.array(out["n_tokens"], pa.int64()), "n_known": pa.array(out["n_known"], pa.int64()),
         "base_score": pa.array(out["base_score"], pa.float64()), "score": pa.array(out["score"], pa.float64())}
    )


def _ranges(body: DataFrame, segments: int, most: int) -> int:
    """In how many even ranges of segments no range has more than ``most`` bytes of the filter."""
    total = body.agg(F.sum(F.ceil(F.col("size") / 8))).first()[0] or 0
    parts = max(1, -(-total // most))
    while parts < segments:
        part = F.floor(F.col("segment") * parts / segments)
        largest = body.groupBy(part.alias("part")).agg(F.sum(F.ceil(F.col("size") / 8)).alias("s")).agg(F.max("s"))
        if (largest.first()[0] or 0) <= most:
            break
        parts = min(segments, parts + max(1, parts // 10))
    return parts


def score(
    docs: DataFrame,
    held: Column,
    mu: float = MU,
    part_bytes: int = PART_BYTES,
    bits: int = BITS,
    id_col: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Learn from the rows where ``held`` is false and score every row: doc_id, held_out,
    n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"), F.col(text).alias("text"), held.alias("held"),
        F.monotonically_increasing_id().alias("row"),
    )
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    segments = max(64, -(-size // SEGMENT_BYTES))
    buckets = max(64, -(-size // BUCKET_BYTES))
    learnt = rows.filter(~F.col("held")).select("text")
    starts = learnt.count()
    body = stored(built(counted(learnt, segments), segments, bits), "ngram_filter")
    totals = body.groupBy("part").agg(F.sum("n").alias("n"), F.sum("v").alias("v"))
    n, v = next(((r["n"], r["v"]) for r in totals.collect() if r["part"] == 1), (0, 0))
    sums = body.filter("part = 3").select("segment", "keys", "sums")
    start_sum = _of_start(sums.filter(F.col("segment") == int(_segment(np.array([START], np.uint64), segments)[0])))
    body = body.filter("part = 2").select("segment", "size", "body")
    parts = _ranges(body, segments, part_bytes)
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("row"), F.lit(buckets)).cast("int"))
    if parts > 1:
        rows = stored(rows, "lm_docs")
    words = lookups(rows, sums, segments)
    if parts > 1:
        words = stored(words, "lm_words")
    found = None
    for part in range(parts):
        first, behind = -(-part * segments // parts), -(-(part + 1) * segments // parts)
        some = body.filter((F.col("segment") >= first) & (F.col("segment") < behind))
        filled = [tuple(r) for r in some.collect()]
        # Segments without an entry hold nothing.
        empty = [(s, 64, bytes(8)) for s in {*range(first, behind)} - {f[0] for f in filled}]
        sent = spark.sparkContext.broadcast({"rows": filled + empty, "made": None})
        scored = (
            rows.groupBy("bucket")
            .cogroup(words.groupBy("bucket"))
            .applyInArrow(_scorer(sent, segments, n, v, starts, start_sum, mu), SCORES)
        )
        if parts > 1:
            scored = stored(scored, "lm_scores")
        found = scored if found is None else found.unionByName(scored)
    if parts > 1:
        same = ["row", "doc_id", "held_out", "n_tokens", "n_known"]
        found = found.groupBy(*same).agg(F.max("base_score").alias("base_score"), F.sum("score").alias("score"))
    return found.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), "base_score", "score"
    )


def _of_start(sums: DataFrame) -> float:
    """The S of the start mark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, s = _sums_by_word(pa.Table.from_batches([batch]))
            yield pa.RecordBatch.from_pydict({"s": pa.array(_found(words, s, np.array([START], np.uint64)), pa.float64())})

    return sums.mapInArrow(run, "s double").agg(F.sum("s")).first()[0] or 0.0


def _scorer(sent, segments: int, n: int, v: int, starts: int, start_sum: float, mu: float):
    def run(docs: pa.Table, words: pa.Table) -> pa.Table:
        value = sent.value
        if value["made"] is None:
            # A worker joins the segments once and lets go of the parts.
            value["made"] = Filter(value.pop("rows"), segments)
        return _scored(docs, words, value["made"], n, v, starts, start_sum, mu)

    return run
