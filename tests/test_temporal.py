from __future__ import annotations

import random
from datetime import timedelta
from pathlib import Path

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import SF_DIR, at, rows
from orderloom import session
from orderloom.operators import pieces, temporal
from orderloom.operators.changelog import history
from orderloom.operators.temporal import temporal_enrich
from orderloom.plans import derived as D
from orderloom.plans.catalog import QUERIES, SPLIT_ROWS
from orderloom.schemas import ENRICHED_ORDERS, ORDERS, PRODUCT_CHANGES

STRATEGIES = ["shuffle", "broadcast", "split"]
HISTORY = ["product_id", "product_name", "stock", "valid_from", "valid_to"]


def names(make, orders, changes, strategy):
    out = temporal_enrich(make.orders(*orders), make.changes(*changes), strategy, max_task_rows=1)
    return rows(out, "order_id", "product_name")


@pytest.mark.parametrize("strategy", STRATEGIES)
class TestRules:
    def test_exact_boundary(self, make, strategy):
        changes = [("p1", "v1", "00:00:00", "c", 0), ("p1", "v2", "00:00:10", "u", 1)]
        orders = [("a", "p1", "00:00:09.999"), ("b", "p1", "00:00:10")]
        assert names(make, orders, changes, strategy) == [("a", "v1"), ("b", "v2")]

    def test_no_version(self, make, strategy):
        changes = [("p1", "v1", "00:00:05", "c", 0)]
        orders = [("a", "p9", "00:00:09"), ("b", "p1", "00:00:04")]
        assert names(make, orders, changes, strategy) == []

    def test_version_of_the_neighbour_key_is_not_used(self, make, strategy):
        changes = [("p1", "v1", "00:00:05", "c", 0), ("p2", "v2", "00:00:08", "c", 1)]
        orders = [("a", "p2", "00:00:06"), ("b", "p2", "00:00:01"), ("c", "p1", "23:00:00")]
        assert names(make, orders, changes, strategy) == [("c", "v1")]

    def test_tie_goes_to_the_later_arrival(self, make, strategy):
        changes = [
            ("p1", "v3", "00:00:10", "u", 3),
            ("p1", "v1", "00:00:00", "c", 1),
            ("p1", "v2", "00:00:10", "u", 2),
        ]
        assert names(make, [("a", "p1", "00:00:10")], changes, strategy) == [("a", "v3")]

    def test_delete_ends_validity(self, make, strategy):
        changes = [
            ("p1", "x", "00:00:00", "c", 0),
            ("p1", None, "00:00:20", "d", 1),
            ("p1", "y", "00:00:30", "c", 2),
        ]
        orders = [(t, "p1", f"00:00:{t}") for t in ("10", "20", "25", "30")]
        assert names(make, orders, changes, strategy) == [("10", "x"), ("30", "y")]

    def test_duplicate_orders_all_match(self, make, strategy):
        changes = [("p1", "v1", "00:00:00", "c", 0)]
        orders = [("a", "p1", "00:00:01")] * 2
        assert names(make, orders, changes, strategy) == [("a", "v1"), ("a", "v1")]

    def test_nulls(self, make, strategy):
        changes = [("p1", "v1", "00:00:00", "c", 0), (None, "n", "00:00:00", "c", 1)]
        orders = [("a", None, "00:00:01"), ("b", "p1", None), (None, "p1", "00:00:01")]
        assert names(make, orders, changes, strategy) == [(None, "v1")]

    def test_null_name_is_still_a_match(self, make, strategy):
        changes = [("p1", "v1", "00:00:00", "c", 0), ("p1", None, "00:00:05", "u", 1)]
        assert names(make, [("a", "p1", "00:00:07")], changes, strategy) == [("a", None)]

    def test_null_op_counts_as_live(self, make, strategy):
        changes = [("p1", "v1", "00:00:00", None, 0)]
        assert names(make, [("a", "p1", "00:00:07")], changes, strategy) == [("a", "v1")]

    def test_empty_sides(self, make, strategy):
        assert names(make, [("a", "p1", "00:00:07")], [], strategy) == []
        assert names(make, [], [("p1", "v1", "00:00:00", "c", 0)], strategy) == []

    def test_schema(self, make, strategy):
        out = temporal_enrich(make.orders(), make.changes(), strategy)
        ENRICHED_ORDERS.conform(out)


def brute_force(orders, changes):
    def arrival(c):
        return (c[3], c[5] is not None, c[5] or 0, c[4] != "d", c[1] is not None, c[1] or "")

    out = []
    for order_id, product, _, ts in orders:
        fits = [c for c in changes if c[0] == product and c[3] <= ts]
        if fits:
            last = max(fits, key=arrival)
            if last[4] != "d":
                out.append((order_id, last[1]))
    return sorted(out, key=repr)


# Steps of 300 microseconds: several fall into one millisecond, and many are equal.
steps = st.integers(0, 40)
keys = st.sampled_from(["p1", "p1", "p1", "p2", "p3"])


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(st.tuples(keys, steps), min_size=1, max_size=60),
    st.lists(st.tuples(keys, steps, st.sampled_from("cuud"), st.booleans()), min_size=1, max_size=30),
)
def test_against_brute_force(spark, order_rows, change_rows):
    base = at("00:00:00")
    orders = [(str(i), k, 1, base + timedelta(microseconds=300 * s)) for i, (k, s) in enumerate(order_rows)]
    changes = [
        (k, f"n{i:02}", 1, base + timedelta(microseconds=300 * s), op, i if numbered else None)
        for i, (k, s, op, numbered) in enumerate(change_rows)
    ]
    expected = brute_force(orders, changes)
    o = spark.createDataFrame(orders, ORDERS.schema)
    c = spark.createDataFrame(changes, PRODUCT_CHANGES.schema)
    for strategy in STRATEGIES:
        out = temporal_enrich(o, c, strategy, max_task_rows=8)
        found = sorted(((r.order_id, r.product_name) for r in out.collect()), key=repr)
        assert found == expected, strategy
    plain = rows(history(c), *HISTORY)
    assert rows(history(c, max_task_rows=5), *HISTORY) == plain
    assert len({(r[0], r[3]) for r in plain}) == len(plain)


def test_a_version_never_matches_earlier_orders_of_its_millisecond(spark):
    base = at("00:00:00")
    order = [("a", "p1", 1, base + timedelta(microseconds=100)), ("b", "p1", 1, base + timedelta(microseconds=600))]
    change = [("p1", "v0", 1, base + timedelta(microseconds=500), "c", 0), ("p1", "v1", 1, base + timedelta(microseconds=600), "u", 1)]
    o, c = spark.createDataFrame(order, ORDERS.schema), spark.createDataFrame(change, PRODUCT_CHANGES.schema)
    for strategy in STRATEGIES:
        out = temporal_enrich(o, c, strategy, max_task_rows=1)
        assert rows(out, "order_id", "product_name") == [("b", "v1")], strategy


def test_one_instant_with_a_third_of_the_orders(spark):
    """Equal orders at one time are spread over pieces, with the plain strategy's rows."""
    base = at("00:00:00")
    rng = random.Random(3)
    orders = [("copy", "p1", 1, base + timedelta(seconds=100))] * 500
    orders += [(str(i), f"p{i % 5}", 1, base + timedelta(seconds=rng.randrange(300))) for i in range(1000)]
    changes = [
        (f"p{i % 5}", f"n{i}", 1, base + timedelta(seconds=rng.randrange(300)), "u", i) for i in range(200)
    ]
    changes += [("p1", f"tie{i}", 1, base + timedelta(seconds=100), "u", 1000 + i) for i in range(300)]
    o = spark.createDataFrame(orders, ORDERS.schema)
    c = spark.createDataFrame(changes, PRODUCT_CHANGES.schema)
    split = rows(temporal_enrich(o, c, "split", 100), *ENRICHED_ORDERS.columns)
    assert split == rows(temporal_enrich(o, c, "shuffle"), *ENRICHED_ORDERS.columns)
    assert sum(r[:3] == ("copy", "p1", "tie299") for r in split) == 500


def test_pieces_bound_the_rows_of_a_task(spark):
    """Any number of hot keys, one of them at a single instant."""
    many = spark.range(200_000).selectExpr("concat('k', id % 10000) AS k", "id AS t").unionAll(
        spark.range(20_000).selectExpr("'one' AS k", "0L AS t")
    )
    hot = pieces.hot_keys(many.select("k"), 15)
    assert hot.count() == 10_001
    placed = pieces.cut(many.join(hot.select("k"), "k", "left_semi"), ["k", "t"], 2000)
    sizes = [r["count"] for r in placed.groupBy("k", "piece").count().collect()]
    assert sum(sizes) == 220_000 and max(sizes) <= 2 * 2000
    assert max(r["count"] for r in placed.groupBy("piece").count().collect()) <= 2 * 2000


def test_small_pieces_share_a_task(spark):
    """Tasks follow from the rows, not from the number of pieces; pieces keep their size and order."""
    many = spark.range(0, 30_000, 1, 3).selectExpr("concat('k', id % 2) AS k", "id div 100 AS t")
    placed = pieces.cut(many, ["k", "t"], 20).withColumn("file", F.input_file_name())
    assert placed.select("file").distinct().count() <= int(spark.conf.get("spark.sql.shuffle.partitions"))
    spans = placed.groupBy("piece").agg(
        F.count("*").alias("n"), F.min(F.struct("k", "t")).alias("low"), F.max(F.struct("k", "t")).alias("high")
    ).orderBy("piece").collect()
    assert sum(s["n"] for s in spans) == 30_000 and max(s["n"] for s in spans) <= 20
    assert all(a["high"] <= b["low"] for a, b in zip(spans, spans[1:]))


# The queries that ask for pieces of a few hundred rows.
SMALL_PIECES = [
    "temporal_enrich_micros_broadcast",
    "products_history_hot_key",
    "product_window_counts_hot_key",
    "temporal_enrich_hot_key",
    "temporal_enrich_micros_split",
]


@pytest.mark.parametrize("name", SMALL_PIECES)
def test_queries_with_small_pieces_write_few_files(spark, monkeypatch, name):
    """A file, a task and a sample for every few hundred rows would swamp the driver."""
    made = []

    def run_dir(spark, label):
        made.append(session.run_dir(spark, label))
        return made[-1]

    monkeypatch.setattr(pieces, "run_dir", run_dir)
    monkeypatch.setattr(temporal, "BROADCAST_VERSIONS", 10)
    QUERIES[name](spark, "/root/testdata/sf0.1")
    (path,) = [p for p in made if "/pieces-" in p]
    assert len(list(Path(path).glob("part-*"))) <= int(spark.conf.get("spark.sql.shuffle.partitions"))
    most, pieces_cut = spark.read.parquet(path).groupBy("piece").count().agg(F.max("count"), F.count("*")).first()
    assert most <= SPLIT_ROWS and pieces_cut > 4


@pytest.mark.parametrize("source", ["events", "skewed", "lineitem"])
def test_strategies_agree(spark, source):
    orders, changes = {
        "events": (D.event_orders, D.event_changes_with_deletes),
        "skewed": (D.skewed_event_orders, D.skewed_event_changes),
        "lineitem": (D.line_orders, D.part_changes),
    }[source]
    o, c = orders(spark, SF_DIR), changes(spark, SF_DIR)
    plain = rows(temporal_enrich(o, c, "shuffle"), *ENRICHED_ORDERS.columns)
    assert plain
    assert rows(temporal_enrich(o, c, "split", 20), *ENRICHED_ORDERS.columns) == plain
    assert rows(temporal_enrich(o, c, "broadcast"), *ENRICHED_ORDERS.columns) == plain


def test_strategy_is_chosen_by_size(spark, make, monkeypatch):
    orders, versions = D.event_orders(spark, SF_DIR), D.event_changes(spark, SF_DIR)
    unknown = make.changes(("p1", "v1", "00:00:00", "c", 0))
    assert temporal._choose(orders, unknown) == "split"
    assert temporal._choose(orders, versions) == "shuffle"
    monkeypatch.setattr(temporal, "SMALL_BYTES", 0)
    assert temporal._choose(orders, versions) == "broadcast"
    monkeypatch.setattr(temporal, "BROADCAST_BYTES", 0)
    assert temporal._choose(orders, versions) == "split"


def test_history_over_the_limit_falls_back(spark, monkeypatch):
    o, c = D.event_orders(spark, SF_DIR), D.event_changes(spark, SF_DIR)
    plain = rows(temporal_enrich(o, c, "shuffle"), *ENRICHED_ORDERS.columns)
    monkeypatch.setattr(temporal, "BROADCAST_VERSIONS", 10)
    assert rows(temporal_enrich(o, c, "broadcast"), *ENRICHED_ORDERS.columns) == plain


def test_long_names_fall_back(spark, monkeypatch):
    o, c = D.event_orders(spark, SF_DIR), D.event_changes(spark, SF_DIR)
    wide = c.withColumn("product_name", F.repeat("product_name", 2000))
    plain = rows(temporal_enrich(o, wide, "shuffle"), "order_id", "product_name")
    monkeypatch.setattr(temporal, "BROADCAST_BYTES", 100_000)
    assert temporal._search_history(o, c.selectExpr("*", "true AS live"), c) is not None
    assert temporal._search_history(o, wide.selectExpr("*", "true AS live"), wide) is None
    assert rows(temporal_enrich(o, wide, "broadcast"), "order_id", "product_name") == plain


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans(spark):
    o, c = D.event_orders(spark, SF_DIR), D.event_changes(spark, SF_DIR)
    plain = plan_text(temporal_enrich(o, c, "shuffle"))
    assert plain.count("Exchange hashpartitioning") == 1
    assert plain.count("Window [") == 1
    shared = plan_text(temporal_enrich(o, c, "broadcast"))
    assert "Exchange hashpartitioning" not in shared and "SinglePartition" not in shared
    assert shared.count("ArrowEvalPython") == 1
    split = plan_text(temporal_enrich(o, c, "split", 20))
    for text in (plain, shared, split):
        assert "NestedLoop" not in text and "Cartesian" not in text
    assert "EvalPython" not in plain + split


def test_name_is_pruned_when_only_counts_are_read(spark):
    o, c = D.event_orders(spark, SF_DIR), D.event_changes(spark, SF_DIR)
    counts = temporal_enrich(o, c, "shuffle").groupBy("product_id").count()
    assert "AS version" not in plan_text(counts)
