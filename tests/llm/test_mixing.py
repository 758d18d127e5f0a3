from __future__ import annotations

from collections import Counter

import pytest
from brute import mixed
from pyspark.sql import functions as F

from orderloom.llm import mixing
from orderloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
DDL = "doc_id long, text string, source string"


def copies(rows):
    return Counter((r["doc_id"], r["text"], r["source"]) for r in rows)


def want(docs, **options):
    out = Counter()
    for d, n in zip(docs, mixed(docs, **options)):
        out[d] += n
    return +out


def test_query_against_brute_force(spark):
    docs = [(d.doc_id, d.text, d.source) for d in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    found = QUERIES["op5_poisson_mix"](spark, SF)
    rows = found.collect()
    assert copies(rows) == want(docs)
    for (i, text, source), n in copies(rows).items():
        assert sorted(r.copy for r in rows if (r.doc_id, r.text) == (i, text)) == list(range(1, n + 1))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


@pytest.mark.parametrize("small", [mixing.SMALL, 0])
def test_odd_rows(spark, monkeypatch, small):
    monkeypatch.setattr(mixing, "SMALL", small)
    docs = [(1, None, None), (2, "", ""), (None, "x" * 50, "a"), (3, "y" * 5000, "b"), (3, "y" * 5000, "b"), (4, "z", "c")]
    docs += [(i, "hot" * 10, "hot") for i in range(100, 400)]
    d = spark.createDataFrame([(*r, 7, "k") for r in docs], f"{DDL}, copy int, _key string")
    found = mixing.poisson_mix(d)
    assert found.columns == ["doc_id", "text", "source", "_key", "copy", "shuffle_key"]
    assert copies(found.collect()) == want(docs)


def test_large_means_and_weights(spark):
    docs = [(i, "text", "rare") for i in range(20)] + [(i, "text " * 100, "large") for i in range(100, 200)]
    d = spark.createDataFrame(docs, DDL)
    weights = {"rare": 1.0, "absent": 3.0}
    found = mixing.poisson_mix(d, weights=weights, total=2.0)
    rates = {r["key"]: r["rate"] for r in mixing.rates(d, weights, total=2.0).collect()}
    assert rates["+large"] == 0 and rates["+rare"] > 500
    assert copies(found.collect()) == want(docs, weights=weights, total=2.0)
    each = [r["count"] for r in found.groupBy("doc_id").count().collect()]
    assert abs(sum(each) / 20 / rates["+rare"] - 1) < 0.05


def test_shares_come_near_their_targets(spark):
    d = spark.range(6000).select(
        F.col("id").alias("doc_id"), F.lit("some text").alias("text"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 5)).alias("source"),
    )
    found = dict(map(tuple, mixing.poisson_mix(d, alpha=0.0).groupBy("source").count().collect()))
    assert all(abs(n / 1000 - 1) < 0.12 for n in found.values()) and len(found) == 6


def test_output_order_is_global_and_repeatable(spark):
    d = spark.createDataFrame([(i, "t" * i, f"s{i % 4}") for i in range(300)], DDL)
    first, second = (mixing.poisson_mix(d.repartition(n)).collect() for n in (1, 7))
    assert sorted(r.shuffle_key for r in first) == sorted(r.shuffle_key for r in second)
    assert len({r.shuffle_key for r in first}) == len(first)
    other = mixing.poisson_mix(d, seed=43).collect()
    assert copies(other) != copies(first)


def test_no_rows(spark):
    assert mixing.poisson_mix(spark.createDataFrame([], DDL)).count() == 0


def test_sources_of_the_least_weight_keep_it(spark):
    weights = {"a": 1.0, "b": 1e-7}
    d = spark.range(4000).select(
        F.col("id").alias("doc_id"), F.lit("x").alias("text"), F.when(F.col("id") < 2000, "a").otherwise("b").alias("source")
    )
    rates = {r["key"]: r["rate"] for r in mixing.rates(d, weights).collect()}
    assert rates["+b"] == pytest.approx(2e-7, rel=1e-6) and rates["+a"] == pytest.approx(2.0, rel=1e-6)
    # The source's documents are counted, and drawn by their own small mean.
    d = d.unionByName(spark.range(4000, 60_000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"), F.lit("b").alias("source")))
    found = mixing.poisson_mix(d, weights={"a": 1.0, "b": 1e-3})
    assert 20 < found.filter("source = 'b'").count() < 130


@pytest.mark.parametrize("small", [mixing.SMALL, 0])
def test_clashing_names(spark, monkeypatch, small):
    import corpus_pipeline

    monkeypatch.setattr(mixing, "SMALL", small)
    names = ["_salt", "_hot", "_key", "_parts", "_n", "copy", "shuffle_key", "n", "key"]
    rows = [(i, "text", f"s{i % 3}", *(f"{c}{i}" for c in names)) for i in range(3000)]
    d = spark.createDataFrame(rows, f"{DDL}, {', '.join(f'{c} string' for c in names)}")
    found = corpus_pipeline.mix(spark, d, "")
    assert found.columns == d.columns
    assert {tuple(r) for r in found.collect()} <= set(rows) and found.count() > 1000
