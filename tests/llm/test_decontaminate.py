from __future__ import annotations

import pytest
from brute import leaks

from orderloom.llm import decontaminate
from orderloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
WORDS = "zero one two three four five six seven eight nine ten eleven twelve".split()


def test_query_against_brute_force(spark):
    docs = [(d.doc_id, d.text) for d in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    items = [(b.item_id, b.text) for b in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    found = QUERIES["op7_decontaminate"](spark, SF).collect()
    assert sorted(map(tuple, found)) == sorted(leaks(docs, items))
    assert any(r.contaminated for r in found)


def odd():
    long = " ".join(WORDS)
    docs = [
        (1, None), (2, ""), (3, " .,! "), (4, long), (5, f"x {long.upper()}, {long}! x"), (5, "tiny"), (None, "a-b É-é"),
        (6, "one two three four five six seven eight nine"), (7, "filler " * 30_000 + long), (8, "tiny tiny, TINY"),
        (9, "one two three four five six seven eight nine ten " * 50),
    ]
    items = [(1, long), (1, long), (2, "Tiny"), (3, None), (4, ""), (None, "É é"), (5, " ".join(WORDS[1:11])), (6, "absent words here")]
    return docs, items


@pytest.mark.parametrize("block_words", [decontaminate.BLOCK_WORDS, 2])
def test_odd_rows_and_blocks(spark, block_words):
    docs, items = odd()
    d = spark.createDataFrame([(*r, 0, "c") for r in docs], "doc_id long, text string, n_words int, leak string")
    b = spark.createDataFrame([(*r, "c") for r in items], "item_id long, text string, doc_id string")
    found = decontaminate.find_leaks(d, b, block_words=block_words)
    assert found.columns == ["doc_id", "text", "n_words", "leak"]
    got = found.selectExpr("doc_id", "leak.n_words", "leak.n_hit", "size(leak.items)").collect()
    assert sorted(map(repr, (tuple(r) for r in got))) == sorted(repr(r[:4]) for r in leaks(docs, items))
    for r in found.collect():
        for s in r.leak.spans:
            words = decontaminate.words_of(r.text[s.start : s.end])
            assert words and len(words) <= r.leak.n_hit
    places = [(s.start, s.end) for r in found.collect() if r.doc_id == 5 and r.text != "tiny" for s in r.leak.spans]
    assert places == [(2, len(docs[4][1]) - 3)]
    kept = decontaminate.clean(d, b, block_words=block_words)
    assert kept.columns == d.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 3, 6]


def test_empty_tables(spark):
    docs, items = odd()
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert decontaminate.find_leaks(d.limit(0), b).count() == 0
    assert decontaminate.find_leaks(d, b.limit(0)).filter("leak.n_hit > 0").count() == 0
    assert decontaminate.clean(d, b.limit(0)).count() == len(docs)
