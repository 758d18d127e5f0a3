from __future__ import annotations

from collections import defaultdict

import pytest
import xxhash
from pyspark.sql import functions as F

from orderloom.llm import simhash
from orderloom.llm.graph import components
from orderloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def brute_fp(text: str | None) -> int:
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        low = low.replace(c, " ")
    words = [w for w in low.split(" ") if w]
    grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(rows: list[tuple]) -> list[tuple]:
    fps = {fp for _, fp in rows}
    root = {fp: fp for fp in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in fps:
        for b in fps:
            if a < b and (a ^ b).bit_count() <= 2:
                root[find(a)] = find(b)
    least = defaultdict(list)
    for i, fp in rows:
        if i is not None:
            least[find(fp)].append(i)
    return sorted(
        ((i, f"{fp:016x}", min(least[find(fp)], default=None)) for i, fp in rows), key=repr
    )


def got(df):
    found = df.select("doc_id", simhash.hex_of().alias("h"), "component_id").collect()
    return sorted((tuple(r) for r in found), key=repr)


def test_query_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    want = brute_groups([(d.doc_id, brute_fp(d.text)) for d in docs])
    found = QUERIES["op6_simhash_near_duplicates"](spark, SF).collect()
    assert sorted((tuple(r) for r in found), key=repr) == want


def test_odd_rows(spark):
    base = " ".join(f"w{i}" for i in range(400))
    rows = [
        (1, None), (2, ""), (3, " \n\t"), (4, "One two"), (5, "one  TWO"), (6, "É é x y"),
        (7, base), (8, base + " tail"), (8, base), (None, base), (None, "alone here"),
        (9, "z " * 50_000), (10, base.upper()),
    ]
    docs = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, fp string")
    want = brute_groups([(i, brute_fp(t)) for i, t in rows])
    assert got(simhash.near_duplicates(docs)) == want
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert kept.count() == len({w[2] for w in want if w[2] is not None}) + 1  # and "alone here"


def test_no_rows(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(docs).count() == 0
    assert simhash.keep_one(docs).count() == 0


def test_radius_is_even():
    with pytest.raises(ValueError):
        simhash.links(None, 3)


def test_long_chain_and_hub(spark):
    chain = spark.range(300).select(F.col("id").alias("u"), (F.col("id") + 1).alias("v"))
    hub = spark.range(1000, 6000).select(F.col("id").alias("u"), F.lit(6000).cast("long").alias("v"))
    found = components(chain.unionByName(hub)).groupBy("root").count().collect()
    assert sorted(tuple(r) for r in found) == [(0, 301), (1000, 5001)]
