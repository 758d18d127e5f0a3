from __future__ import annotations

import hashlib
from collections import defaultdict

import numpy as np
import pytest

from orderloom.llm import linededup as L
from orderloom.llm.cuckoo import CuckooFilter, Full
from orderloom.llm.queries import QUERIES
from orderloom.session import run_dir

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def key(line):
    return line.translate(LOWER).strip(" \t\n\x0b\x0c\r")


def brute(rows, index=None, least=20, docs=3):
    """(id, n_lines, n_dropped, kept) of each (id, text); ``index`` holds the documents counted."""
    holds = defaultdict(set)
    for i, t in rows if index is None else index:
        for line in (t or "").split("\n"):
            holds[key(line)].add(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = []
        for line in lines:
            k = key(line)
            last = max((x for x in holds[k] if x is not None), default=None)
            if len(k) < least or len(holds[k]) < docs or i == last:
                kept.append(line)
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def got(df):
    return sorted(((r.doc_id, *r.cleaned) for r in df.collect()), key=repr)


def test_query_against_brute_force(spark):
    docs = [(d.doc_id, d.text) for d in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    want = [(i, n, g, hashlib.sha256(t.encode()).hexdigest()) for i, n, g, t in brute(docs)]
    found = [tuple(r) for r in QUERIES["op11_line_dedup"](spark, SF).collect()]
    assert any(r[2] for r in want)
    assert sorted(found, key=repr) == sorted(want, key=repr)


def some_docs(start, n, shared):
    """Documents with lines of their own, and shared lines every few ids."""
    out = []
    for i in range(start, start + n):
        lines = [f"a line of document {i} alone", "short"]
        lines += [f"  Shared LINE number {k} of them all\t" for k in range(1, shared) if i % k == 0]
        out.append((i, "\n".join(lines)))
    return out


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(3)


def test_insertions_and_deletions(spark):
    index = L.LineIndex(spark, run_dir(spark, "test_lines"), shard_keys=4)
    one, two, three = some_docs(0, 40, 9), some_docs(40, 30, 12), some_docs(100, 3, 12)
    now = []
    for batch in (one, two, three):
        index.add(frame(spark, batch))
        now += batch
        assert got(index.clean(frame(spark, batch))) == brute(batch, now)
    assert index.at["shards"] > L.LEAST_SHARDS
    before = {bytes(r.key): (r.n, r.last) for r in index.counts().collect()}

    index.add(frame(spark, two))  # known already
    assert {bytes(r.key): (r.n, r.last) for r in index.counts().collect()} == before

    more = some_docs(200, 25, 12)
    index.add(frame(spark, more))
    index.remove(frame(spark, more + [(999, "")]).select("doc_id"))
    assert {bytes(r.key): (r.n, r.last) for r in index.counts().collect()} == before
    assert got(index.clean(frame(spark, now))) == brute(now)

    index.remove(frame(spark, one + three).select("doc_id"))
    assert got(index.clean(frame(spark, two))) == brute(two)
    # A second reader finds the same; the index stays usable after merging.
    again = L.LineIndex(spark, index.path, shard_keys=4)
    for k in range(L.GENERATIONS):
        again.add(frame(spark, one[k : k + 1]))
    assert len(again.at["refs"]) <= L.GENERATIONS
    left = two + one[: L.GENERATIONS]
    assert got(again.clean(frame(spark, left))) == brute(left)


def test_filters_hold_what_the_counts_say(spark):
    index = L.LineIndex(spark, run_dir(spark, "test_lines"))
    index.add(frame(spark, some_docs(0, 60, 12)))
    index.remove(frame(spark, some_docs(10, 30, 12)).select("doc_id"))
    kept = {r.shard: CuckooFilter.read(bytes(r.body)) for r in index._filters().collect()}
    size, shards = 0, index.counts().withColumn("shard", index._shard(index.at["shards"])).collect()
    for r in shards:
        copies = min(r.n, 3)
        hashed = np.frombuffer(bytes(r.key), "<u8")[:1].astype(np.uint64)
        assert kept[r.shard].held(hashed)[0] >= copies
        size += copies
    assert sum(f.size for f in kept.values()) == size


def test_odd_rows(spark):
    line = "the same line in every document"
    rows = [
        (None, line), (None, f"{line}\nown"), (1, None), (2, ""), (3, f"{line}\n{line.upper()}\nx"), (3, f"{line}\r"),
        (4, "\n\n"), (5, f" {line} "), (5, f" {line} "), (6, "É" * 20), (7, "É" * 20), (8, "é" * 20),
        (9, "y" * 19 + "\n" + "z" * 20), (10, "y" * 19 + "\n" + "Z" * 20), (11, "y" * 19 + "\n" + "z" * 20 + "\x0b"),
        (12, "w\n" * 100_000), (-1, line),
    ]
    docs = spark.createDataFrame([(*r, "clash", 1) for r in rows], "doc_id long, text string, keys string, spread int")
    index = L.LineIndex(spark, run_dir(spark, "test_lines"))
    lines = index.add(docs)
    for found in (index.clean(docs), index.clean(docs, lines=lines)):
        assert found.columns == ["doc_id", "keys", "spread", "cleaned"]
        assert got(found) == brute(rows)
    with pytest.raises(ValueError):
        index.clean(docs, out="keys")


def test_no_rows(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    index = L.LineIndex(spark, run_dir(spark, "test_lines"))
    index.add(docs)
    assert index.clean(docs).count() == 0
    index.remove(docs)
    index.add(frame(spark, some_docs(0, 9, 4)))
    assert got(index.clean(frame(spark, some_docs(0, 9, 4)))) == brute(some_docs(0, 9, 4))


def test_another_rule_is_refused(spark):
    path = run_dir(spark, "test_lines")
    L.LineIndex(spark, path).add(frame(spark, some_docs(0, 3, 3)))
    with pytest.raises(ValueError):
        L.LineIndex(spark, path, min_docs=4)


def test_filter_put_take_and_full():
    rng = np.random.default_rng(0)
    keys = rng.integers(0, 2**64, 5000, np.uint64)
    f = CuckooFilter.for_entries(10_000)
    f.put(np.concatenate([keys, keys]))
    assert f.size == 10_000 and (f.held(keys) >= 2).all()
    others = rng.integers(0, 2**64, 20_000, np.uint64)
    assert (f.held(others) > 0).mean() < 0.002
    f.take(keys[:2500])
    assert CuckooFilter.read(f.body()).size == 7500
    assert (f.held(keys[:2500]) >= 1).all() and (f.held(keys[2500:]) >= 2).all()
    f.take(np.concatenate([keys[:2500], keys[2500:], keys[2500:]]))
    assert f.size == 0
    with pytest.raises(KeyError):
        f.take(keys[:1])
    small = CuckooFilter(2)
    small.put(keys[:3])
    before = small.slots.copy()
    with pytest.raises(Full):
        small.put(np.repeat(keys[9:10], 9))
    assert (small.slots != before).any()  # entries up to the full one are in
    with pytest.raises(ValueError):
        CuckooFilter(3)
