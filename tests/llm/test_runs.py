from __future__ import annotations

import hashlib
import random
from zlib import crc32

import numpy as np
import pytest

from orderloom.llm import runs as R
from orderloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def brute(w, least=12):
    """Runs as (start, length, period), by comparing every word with that a period on."""
    n, best = len(w), {}
    for p in range(1, n // 2 + 1):
        i = 0
        while i + p < n:
            if w[i] != w[i + p]:
                i += 1
                continue
            s = i
            while i + p < n and w[i] == w[i + p]:
                i += 1
            if i - s + p >= max(least, 2 * p):
                best.setdefault((s, i - s + p), p)
    return sorted(((s, n, p) for (s, n), p in best.items()), key=lambda r: (r[0], r[2]))


def collapsed(w, runs):
    gone = {i for s, n, p in runs for i in range(s + p, s + n)}
    return [x for i, x in enumerate(w) if i not in gone]


def words_of(text):
    for c in "\t\n\x0b\x0c\r":
        text = text.replace(c, " ")
    return [w for w in text.split(" ") if w]


def test_cover_is_one():
    assert {(a - b) % R.V for a in R.COVER for b in R.COVER} == set(range(R.V))


def test_extensions_against_comparison():
    rng = random.Random(5)
    for _ in range(40):
        k, n = rng.choice([1, 2, 3]), rng.randint(2, 400)
        w = [rng.randrange(k) for _ in range(n)] + [k]
        i, j = np.array([rng.sample(range(n + 1), 2) for _ in range(200)]).T
        want = [next((m for m in range(n + 1) if w[a + m] != w[b + m]), 0) if max(a, b) <= n else 0
                for a, b in zip(i.tolist(), j.tolist())]
        assert R.Extensions(np.array(w, np.int32)).of(i, j).tolist() == want


def test_runs_against_brute_force():
    rng = random.Random(1)
    for _ in range(150):
        texts = []
        for _ in range(rng.randint(0, 6)):
            n, k = rng.choice([0, 1, 5, 20, 60, 200]), rng.choice([1, 2, 3, 50])
            w = [rng.randrange(k) for _ in range(n)]
            if n and rng.random() < 0.5:
                p, a = rng.randint(1, max(1, n // 3)), rng.randrange(n)
                for i in range(a + p, n):
                    w[i] = w[i - p]
            texts.append(w)
        least = rng.choice([2, 4, 12])
        got = R.runs_of([np.array(t, np.int32) for t in texts], least)
        assert [[tuple(r) for r in g.tolist()] for g in got] == [brute(t, least) for t in texts]


def test_pairs_in_blocks(monkeypatch):
    monkeypatch.setattr(R, "PAIRS", 7)
    w = [i % 3 for i in range(100)] + [i % 14 for i in range(60)]
    assert [tuple(r) for r in R.runs_of([np.array(w, np.int32)])[0].tolist()] == brute(w)


@pytest.mark.parametrize("n", [200_000])
def test_long_texts(n):
    assert R.runs_of([np.zeros(n, np.int32)])[0].tolist() == [[0, n, 1]]
    w = np.arange(n, dtype=np.int32) % (n // 3)
    assert R.runs_of([w])[0].tolist() == [[0, n, n // 3]]


def fold_brute(i, w):
    h = 1 if i is None else crc32(str(i).encode())
    n, g = len(w), h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        return [w[k] if k < a else w[a + (k - a) % p] for k in range(n)]
    return w


def test_query_against_brute_force(spark):
    want = []
    for d in spark.read.parquet(f"{SF}/documents.parquet").collect():
        w = fold_brute(d.doc_id, words_of(d.text or ""))
        found = brute(w)
        listed = "".join(f"{s},{n},{p}\n" for s, n, p in found)
        s, n, p = min(found, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
        text = " ".join(collapsed(w, found))
        want.append(
            (d.doc_id, len(found), s, n, p, n and 1000 * n // p,
             hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())
        )
    assert any(r[1] for r in want)
    got = [tuple(r) for r in QUERIES["op12_periodic_runs"](spark, SF).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_odd_rows(spark):
    rows = [
        (1, None), (2, ""), (3, " \n\t "), (4, "a " * 11), (5, "a " * 12), (5, "a " * 12), (None, "b c " * 9),
        (6, "ä ö " * 20), (7, "x\x0by\x0cz\rw " * 30), (8, "ab " * 30_000), (9, "a\x00b c " * 8),
    ]
    docs = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, runs string")
    got = R.find_runs(docs).collect()
    want = []
    for i, t in rows:
        w = words_of(t or "")
        found = brute(w) if len(w) < 1000 else [(0, len(w), 1)]
        want.append((i, "clash", len(w), found, " ".join(collapsed(w, found))))
    found = [(r.doc_id, r.runs, r.found.n_words, [tuple(x) for x in r.found.runs], r.found.collapsed) for r in got]
    assert sorted(found, key=repr) == sorted(want, key=repr)
    with pytest.raises(ValueError):
        R.find_runs(docs, out="runs")


def test_no_rows(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert R.find_runs(docs).count() == 0
