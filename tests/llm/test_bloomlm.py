from __future__ import annotations

import math
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pytest

from orderloom.llm import bloomlm
from orderloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def tokens(text: str | None) -> list[str]:
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", low), "</end>"]


def brute(rows: list[tuple]) -> dict:
    """Held out, n_tokens, n_known, N, base score by row number."""
    held = [crc32(str("" if i is None else i).encode()) % 5 == 1 for i, _ in rows]
    c = Counter(t for h, (_, text) in zip(held, rows) if not h for t in tokens(text))
    n, v = sum(c.values()), len(c)
    out = []
    for h, (i, text) in zip(held, rows):
        found = tokens(text)
        base = sum(math.log10((c[t] + 0.5) / (n + 0.5 * (v + 1))) for t in found)
        out.append((i, h, len(found), sum(c[t] > 0 for t in found), n, base))
    return out


def check(found, want):
    key = lambda r: (repr(r[0]), r[2], r[5])
    found = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in found), key=key)
    want = sorted(want, key=key)
    assert [f[:5] for f in found] == [w[:5] for w in want]
    assert [f[5] for f in found] == pytest.approx([w[5] for w in want], rel=1e-9)


def test_query_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    found = QUERIES["op3_bloom_lm"](spark, SF).collect()
    check(found, brute([(d.doc_id, d.text) for d in docs]))
    held = [r for r in found if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    assert all(r.score <= 0 for r in found)


def test_odd_rows_and_filter_parts(spark):
    rows = [(1, None), (2, ""), (3, "The THE the É é"), (3, "The THE the É é"), (None, "a b a b"), (None, None)]
    rows += [(i, f"word{i % 7} of the day {i}") for i in range(10, 90)] + [(7, "x y " * 30_000)]
    docs = spark.createDataFrame([(*r, "c", 1) for r in rows], "doc_id long, text string, held string, row int")
    whole = bloomlm.score(docs, bloomlm.held_out()).collect()
    check(whole, brute(rows))
    parts = bloomlm.score(docs, bloomlm.held_out(), part_bytes=40).collect()
    assert sorted(r.score for r in parts) == pytest.approx(sorted(r.score for r in whole), rel=1e-9)


def test_no_rows(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert bloomlm.score(docs, bloomlm.held_out()).count() == 0


def test_filter_never_reads_too_little():
    rng = np.random.default_rng(3)
    keys = rng.integers(0, 2**63, 5000).astype(np.uint64)
    counts = rng.geometric(0.3, 5000)
    import pyarrow as pa

    packs = pa.Table.from_batches([bloomlm._packs(keys, counts, 1, 2, keys)])
    made = {}

    class Fake:
        def groupBy(self, *_):
            return self

        def applyInArrow(self, run, _):
            made["t"] = run(packs)

    bloomlm.built(Fake(), 1)
    row = made["t"].to_pylist()[0]
    some = bloomlm.Filter([(0, row["size"], row["body"])], 1)
    levels = 1 + np.floor(np.log2(counts)).astype(int)
    assert (some.levels(keys) >= levels).all()
    assert (some.levels(keys) == levels).mean() > 0.9
    assert (some.levels(rng.integers(0, 2**63, 5000).astype(np.uint64)) == 0).mean() > 0.9
    near = bloomlm.read_back(levels) / counts
    assert 0.5 < near.min() and near.max() < 2


def test_hashes_tell_words_apart():
    texts = ["a b a", "", "ab a b", "É é ñ", "x" * 3000 + " y", "\t\x0b Ab \r\n", "ab ba aab aba baa"]
    found, behind = bloomlm.Hasher().of([t.encode() for t in texts])
    want = [t for text in texts for t in tokens(text)]
    assert len(found) == len(want) and behind.tolist() == np.cumsum([len(tokens(t)) for t in texts]).tolist()
    assert len(set(zip(found.tolist(), want))) == len(set(want)) == len(set(found.tolist()))


def brute_scores(rows: list[tuple]) -> list[tuple]:
    """(id, score) with the filter's quantised counts, without its false answers."""
    held = [crc32(str("" if i is None else i).encode()) % 5 == 1 for i, _ in rows]
    learnt = [tokens(text) for h, (_, text) in zip(held, rows) if not h]
    c = Counter(t for ts in learnt for t in ts)
    gram = Counter(p for ts in learnt for p in zip(["<start>", *ts], ts))
    n, v = sum(c.values()), len(c)
    c["<start>"] = len(learnt)

    def worth(count):
        low = 2.0 ** int(math.log2(count)) if count else 0.0
        return max(math.sqrt(low * (2 * low - 1)) - 0.75, 0) if count else 0.0

    s = Counter()
    for (h, _), count in gram.items():
        s[h] += worth(count)

    def p(h, w):
        one, whole = (c[w] + 0.5) / (n + 0.5 * (v + 1)), max(c[h], s[h]) + 3.0
        return (worth(gram[h, w]) + (whole - s[h]) * one) / whole

    vocabulary = [w for w in c if w != "<start>"]
    for h in ["<start>", *vocabulary[:20], "never learnt"]:
        # The words of the vocabulary and the one class of all others add up to one.
        assert sum(p(h, w) for w in vocabulary) + p(h, "\0") == pytest.approx(1)
    return [(i, sum(math.log10(p(h, w)) for h, w in zip(["<start>", *ts], ts))) for i, ts in ((i, tokens(t)) for i, t in rows)]


def test_scores_against_brute_force(spark):
    rows = [(1, None), (3, "The THE the É é"), (3, "The THE the É é"), (None, "a b a b")]
    rows += [(i, f"word{i % 7} of the day {i} word{i % 3} of") for i in range(10, 290)] + [(7, "x y " * 3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = bloomlm.score(docs, bloomlm.held_out(), bits=200).collect()
    order = lambda r: (repr(r[0]), r[1])
    got, want = sorted(((r.doc_id, r.score) for r in found), key=order), sorted(brute_scores(rows), key=order)
    assert [g[0] for g in got] == [w[0] for w in want]
    assert [g[1] for g in got] == pytest.approx([w[1] for w in want], rel=1e-9)


def test_scores_of_documents_with_the_filters_own_errors(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    want = dict(brute_scores([tuple(r) for r in docs.collect()]))
    found = {r.doc_id: (r.score, r.n_tokens) for r in bloomlm.score(docs, bloomlm.held_out()).collect()}
    # A false answer raises a token's probability; a few tokens in a hundred have one.
    apart = [(found[i][0] - want[i]) / found[i][1] for i in want]
    assert -1e-9 <= min(apart) and sum(apart) / len(apart) < 0.1


def test_no_token_is_more_than_certain(spark):
    rows = [(i, "a " * 27) for i in range(10)] + [(i, " ".join(f"w{i}x{k}" for k in range(27))) for i in range(10, 20)]
    rows += [(i, "a " * 1000) for i in range(20, 40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert all(r.score <= 0 for r in bloomlm.score(docs, bloomlm.held_out()).collect())
