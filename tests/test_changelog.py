from __future__ import annotations

import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from conftest import SF_DIR, at, rows
from orderloom.operators import changelog
from orderloom.plans import derived as D
from orderloom.plans.catalog import QUERIES
from orderloom.schemas import PRODUCT_CHANGES, PRODUCTS


def test_latest_orders_by_event_time_then_arrival(make):
    changes = make.changes(
        ("p1", "late", "00:00:01", "u", 9),
        ("p1", "new", "00:00:05", "u", 2),
        ("p1", "tie", "00:00:05", "u", 3),
        ("p2", "gone", "00:00:01", "c", 4),
        ("p2", None, "00:00:02", "d", 5),
        (None, "no key", "00:00:02", "c", 6),
    )
    assert rows(changelog.latest(changes), "product_id", "product_name") == [("p1", "tie")]


def test_fold_orders_by_arrival(make):
    changes = make.changes(
        ("p1", "late", "00:00:01", "u", 9),
        ("p1", "new", "00:00:05", "u", 2),
    )
    assert rows(changelog.fold(changes), "product_id", "product_name") == [("p1", "late")]


def test_snapshot_then_log(make):
    snapshot = PRODUCTS.conform(
        make.changes(("p1", "a", "00:00:00", "r", 0), ("p2", "b", "00:00:00", "r", 0))
    )
    log = make.changes(("p1", "updated", "00:00:05", "u", 0), ("p2", None, "00:00:06", "d", 1))
    changes = changelog.snapshot_plus_log(snapshot, log)
    assert rows(changelog.fold(changes), "product_id", "product_name") == [("p1", "updated")]
    spans = rows(changelog.history(changes), "product_id", "product_name", "valid_from", "valid_to")
    assert spans == [
        ("p1", "a", at("00:00:00"), at("00:00:05")),
        ("p1", "updated", at("00:00:05"), None),
        ("p2", "b", at("00:00:00"), at("00:00:06")),
    ]


def test_overlap_of_snapshot_and_log_is_harmless(make):
    log = make.changes(("p1", "a", "00:00:01", "c", 0), ("p1", "b", "00:00:02", "u", 1))
    snapshot = PRODUCTS.conform(make.changes(("p1", "b", "00:00:02", "r", 0)))
    both = changelog.fold(changelog.snapshot_plus_log(snapshot, log))
    assert rows(both, "product_id", "product_name") == [("p1", "b")]


def test_upsert_last_arrival_wins(make):
    target = PRODUCTS.conform(
        make.changes(("p1", "a", "00:00:09", "r", 0), ("p2", "b", "00:00:00", "r", 0))
    )
    batch = make.changes(
        ("p1", "c", "00:00:05", "u", 1),
        ("p1", "d", "00:00:02", "u", 2),
        ("p3", "e", "00:00:01", "c", 3),
    )
    out = changelog.upsert(target, batch)
    assert rows(out, "product_id", "product_name") == [("p1", "d"), ("p2", "b"), ("p3", "e")]
    assert out.groupBy("product_id").count().filter("count > 1").count() == 0


def test_apply_changes_removes_deleted_keys(make):
    target = PRODUCTS.conform(
        make.changes(("p1", "a", "00:00:00", "r", 0), ("p2", "b", "00:00:00", "r", 0))
    )
    batch = make.changes(("p1", None, "00:00:05", "d", 1), ("p3", "e", "00:00:01", "c", 3))
    out = changelog.apply_changes(target, batch)
    assert rows(out, "product_id", "product_name") == [("p2", "b"), ("p3", "e")]


def test_small_batch_does_not_shuffle_the_target(spark):
    target = PRODUCTS.conform(D.part_changes(spark, SF_DIR).filter("op = 'c'"))
    batch = D.event_changes(spark, SF_DIR)
    plan = changelog.upsert(target, batch)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "LeftAnti" in plan
    assert plan.count("Exchange hashpartitioning") == 2  # the batch, for either use


@pytest.mark.parametrize("name", ["upsert_new_parts", "upsert_parts"])
@pytest.mark.parametrize("limit", ["BROADCAST_KEYS", "BROADCAST_KEY_BYTES"])
def test_many_keys_are_not_broadcast(spark, monkeypatch, name, limit):
    """The estimate of a batch is far below its keys: every task would hold all of them."""
    plain = rows(QUERIES[name](spark, SF_DIR), *PRODUCTS.columns)
    # The 200 keys of the batch, of up to eleven bytes each.
    monkeypatch.setattr(changelog, limit, 150, raising=False)
    merged = QUERIES[name](spark, SF_DIR)
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    assert rows(merged, *PRODUCTS.columns) == plain


def test_many_keys_with_deletes_and_null_keys(make, monkeypatch):
    target = PRODUCTS.conform(
        make.changes(*[(k, "a", "00:00:00", "r", 0) for k in ("p1", "p2", "p2", "p4", None)])
    )
    batch = make.changes(
        ("p1", None, "00:00:05", "d", 1), ("p3", "e", "00:00:01", "c", 3), ("p4", "f", "00:00:01", "u", 4), (None, "g", "00:00:01", "u", 5)
    )
    plain = [rows(f(target, batch), *PRODUCTS.columns) for f in (changelog.upsert, changelog.apply_changes)]
    assert len(plain[1]) == 5  # p2 twice, the row without a key, p3 and p4
    monkeypatch.setattr(changelog, "BROADCAST_KEYS", 0)
    assert [rows(f(target, batch), *PRODUCTS.columns) for f in (changelog.upsert, changelog.apply_changes)] == plain


@pytest.mark.parametrize("name", ["upsert_new_parts", "upsert_parts"])
def test_parts_are_dealt_out_before_they_become_versions(spark, monkeypatch, name):
    """A task makes about as many change rows as allowed, however the table lies in its file."""
    sf_dir, columns = "/root/testdata/sf0.01", PRODUCTS.columns
    plain = rows(QUERIES[name](spark, sf_dir), *columns)
    monkeypatch.setattr(D, "MADE_ROWS", 2000, raising=False)
    made = D.part_changes(spark, sf_dir).groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in made) == 16_000 and max(r["count"] for r in made) <= 2 * 2000
    assert rows(QUERIES[name](spark, sf_dir), *columns) == plain


def test_history_rules(make):
    changes = make.changes(
        ("p1", "v1", "00:00:00", "c", 0),
        ("p1", "v2", "00:00:10", "u", 1),
        ("p1", "v3", "00:00:10", "u", 2),
        ("p1", None, "00:00:20", "d", 3),
        ("p1", "v4", "00:00:30", "c", 4),
    )
    spans = rows(changelog.history(changes), "product_name", "valid_from", "valid_to")
    assert spans == [
        ("v1", at("00:00:00"), at("00:00:10")),
        ("v3", at("00:00:10"), at("00:00:20")),
        ("v4", at("00:00:30"), None),
    ]


@pytest.mark.parametrize("seed", range(3))
def test_history_in_pieces_equals_plain(spark, seed):
    rng = random.Random(seed)
    base = at("00:00:00")
    data = [
        (rng.choice(["p1"] * 6 + ["p2", "p3"]), f"n{i}", i, base + timedelta(seconds=rng.randrange(200)),
         rng.choice("cuud"), i)
        for i in range(600)
    ]
    data += [("p1", f"t{i}", i, base + timedelta(seconds=50), "u", 1000 + i) for i in range(300)]
    changes = spark.createDataFrame(data, PRODUCT_CHANGES.schema)
    columns = ["product_id", "product_name", "stock", "valid_from", "valid_to"]
    plain = rows(changelog.history(changes), *columns)
    assert rows(changelog.history(changes, max_task_rows=40), *columns) == plain


def chunk(spark, *rows):
    from orderloom.schemas import SNAPSHOT_CHUNKS

    return spark.createDataFrame([(p, name, 1, at("00:00:00"), low, high) for p, name, low, high in rows], SNAPSHOT_CHUNKS.schema)


def test_chunks_lie_behind_their_low_position(spark, make):
    log = make.changes(
        ("a", "log", "00:00:01", "u", 10), ("b", "log", "00:00:01", "u", 10), ("c", "log", "00:00:01", "u", 12),
        ("d", None, "00:00:01", "d", 11), ("e", None, "00:00:01", "d", 10), ("f", "only", "00:00:01", "c", 5),
    )
    chunks = chunk(spark, *[(p, "chunk", 10, 12) for p in "abcdeg"], ("a", "later", 20, 20), (None, "x", 1, 1))
    out = changelog.fold(changelog.incremental_snapshot(chunks, log))
    assert rows(out, "product_id", "product_name") == [
        ("a", "later"), ("b", "chunk"), ("c", "log"), ("e", "chunk"), ("f", "only"), ("g", "chunk")
    ]
    # Chunks that may show more than the log has are held back.
    out = changelog.fold(changelog.incremental_snapshot(chunks, log, read_to=12))
    assert ("a", "chunk") in rows(out, "product_id", "product_name")
    assert changelog.incremental_snapshot(chunks, log, read_to=11).count() == 6 + 1


def test_chunks_without_positions_are_refused(spark, make):
    for bad in [("a", "x", None, 1), ("a", "x", 2, 1), ("a", "x", 1, None)]:
        with pytest.raises(Exception, match="snapshot chunk"):
            changelog.incremental_snapshot(chunk(spark, bad), make.changes()).collect()
