from __future__ import annotations

from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from orderloom.llm import quality
from orderloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def test_query_on_held_out_labels(spark):
    found = QUERIES["op9_quality"](spark, SF).collect()
    docs = {d.doc_id for d in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert {r.doc_id for r in found} == docs and len(found) == len(docs)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    held = [(r.score, labels[r.doc_id]) for r in found if r.held_out and r.doc_id in labels]
    assert all(r.held_out == (crc32(str(r.doc_id).encode()) % 5 == 0) for r in found)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in found)
    pairs = [(a, b) for a, x in held for b, y in held if x > y]
    assert sum(a > b for a, b in pairs) / len(pairs) > 0.97
    assert np.mean([(s >= 0.3) == (y == 1) for s, y in held]) > 0.93


def test_sum_of_squares_identity():
    rng = np.random.default_rng(1)
    x, w, v = rng.random((4, 12)), rng.normal(size=12), rng.normal(size=(12, 3))
    naive = [0.5 + r @ w + sum(v[i] @ v[j] * r[i] * r[j] for i in range(12) for j in range(i)) for r in x]
    assert quality._margin(x, 0.5, w, v)[0] == pytest.approx(naive)


@pytest.mark.parametrize("text", [None, "", " ", "\n\n", "a", "!!", "é" * 5, "😀 😀", "x" * 100_000, "w " * 100_000, "\x00\x01"])
def test_inputs_are_finite(text):
    at, x, stats = quality.inputs(text, quality.HASHED)
    assert len(stats) == quality.STATS and np.isfinite(stats).all() and np.isfinite(x).all()


def make(spark, n=300):
    docs = [(i, ("good plain words here. " if i % 3 else "BAD!! BAD!! ### ") * (3 + i % 5), "c") for i in range(n)]
    labels = [(i, int(i % 3 > 0)) for i in range(n)]
    return spark.createDataFrame(docs, "doc_id long, text string, score string"), labels


LABELS = "doc_id long, quality int"


def test_learns_only_from_the_allowed_rows(spark):
    docs, labels = make(spark)
    right = quality.train(docs, spark.createDataFrame(labels, LABELS))
    turned = [(i, y if crc32(str(i).encode()) % 5 else 1 - y) for i, y in labels]
    noise = [*turned, (1, None), (None, 0), (10**9, 0)]
    same = quality.train(docs, spark.createDataFrame(noise, LABELS))
    assert np.array_equal(right.linear, same.linear) and np.array_equal(right.factors, same.factors)
    found = quality.with_score(docs, right)
    assert found.columns == ["doc_id", "text", "score"]
    assert all((r.score > 0.5) == (r.doc_id % 3 > 0) for r in found.collect())


def test_the_sample_is_bounded_and_repeatable(spark):
    docs, labels = make(spark)
    table = spark.createDataFrame(labels, LABELS)
    first, second = (quality.train(docs.repartition(n), table.repartition(n), sample=60) for n in (1, 5))
    assert np.allclose(first.linear, second.linear)


def test_without_labels_and_without_rows(spark):
    docs, labels = make(spark, 20)
    none = spark.createDataFrame([], LABELS)
    assert quality.train(docs, none) is None
    assert {r.score for r in quality.with_score(docs, None).collect()} == {quality.PRIOR}
    model = quality.train(docs, spark.createDataFrame(labels, LABELS))
    odd = spark.createDataFrame([(1, None), (1, None), (None, "")], "doc_id long, text string")
    scores = [r.score for r in quality.with_score(odd, model).collect()]
    assert len(set(scores)) == 1 and 0 <= scores[0] <= 1
    assert quality.with_score(docs.limit(0), model).count() == 0
    assert quality.train(docs.limit(0), spark.createDataFrame(labels, LABELS)) is None


def test_null_ids_hash_as_empty_ones(spark):
    df = spark.createDataFrame([(None,), (0,), (3,)], "doc_id long").select("doc_id", quality.held_out().alias("h"))
    got = {r.doc_id: r.h for r in df.collect()}
    assert got == {None: True, 0: crc32(b"0") % 5 == 0, 3: crc32(b"3") % 5 == 0}
