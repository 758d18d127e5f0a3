"""New generations of a job's state: layout records, rebuild, hand-over, heat, accounts."""

from __future__ import annotations

import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from conftest import at, rows
from orderloom.operators import heat
from orderloom.operators.temporal import temporal_enrich
from orderloom.schemas import ENRICHED_ORDERS, PRODUCT_CHANGES, PRODUCT_WINDOW_COUNTS
from orderloom.sources.csv_orders import write_csv_orders
from orderloom.sources.logs import append_log, read_log
from orderloom.streaming import accounts, enrich, layout
from orderloom.streaming import pipeline as S

ENRICHED = tuple(ENRICHED_ORDERS.columns)
COUNTS = tuple(PRODUCT_WINDOW_COUNTS.columns)


@pytest.fixture
def job(tmp_path):
    return S.Job(str(tmp_path / "in"), str(tmp_path / "changes"), str(tmp_path / "job"))


def span(rng, first, last, products=5, n=80):
    """Orders and changes of some minutes of an hour."""

    def when():
        return f"00:{rng.randrange(first, last):02d}:{rng.randrange(60):02d}"

    orders = [(f"o{first}-{i}", f"p{rng.randrange(products)}", when()) for i in range(n)]
    changes = [(f"p{rng.randrange(products)}", f"v{first}-{i}", when(), rng.choice("uuud"), 1000 * first + i) for i in range(n // 2)]
    return orders, changes


def log(make, job, orders, changes):
    S.append_orders(job, make.orders(*orders).coalesce(2))
    append_log(make.changes(*changes).coalesce(2), PRODUCT_CHANGES, job.log(PRODUCT_CHANGES))


def enriched_now(spark, job):
    S.start_enriched(spark, job, S.AVAILABLE_NOW).awaitTermination()
    return rows(S.read_enriched(spark, job), *ENRICHED)


def wanted(make, orders, changes):
    """The batch result up to where the streams' watermark stands."""
    end = min(max(o[2] for o in orders), max(c[2] for c in changes))
    done = temporal_enrich(make.orders(*orders), make.changes(*changes))
    return rows(done.filter(F.col("order_ts") <= F.lit(at(end)) - F.expr("INTERVAL 1 SECOND")), *ENRICHED)


def test_another_window_size_is_refused_and_rebuilt(spark, make, job):
    def enriched(*orders):
        named = make.orders(*orders).withColumn("product_name", F.lit("n")).select(*ENRICHED)
        append_log(named.coalesce(1), ENRICHED_ORDERS, job.log(ENRICHED_ORDERS))

    enriched(("a", "p1", "00:01:00"), ("b", "p1", "00:02:00"), ("c", "p1", "00:07:00"))
    job = replace(job, window_minutes=5)
    S.start_counts(spark, job, S.AVAILABLE_NOW).awaitTermination()
    other = replace(job, window_minutes=10)
    with pytest.raises(layout.LayoutChanged, match="window_minutes"):
        S.start_counts(spark, other, S.AVAILABLE_NOW)
    enriched(("d", "p1", "00:08:00"), ("e", "p1", "00:09:00"), ("f", "p1", "00:20:05"))
    S.start_counts(spark, job, S.AVAILABLE_NOW).awaitTermination()
    assert rows(S.read_counts(spark, job), "order_count") == [(2,), (3,)]
    S.rebuild_counts(spark, other)
    S.start_counts(spark, other, S.AVAILABLE_NOW).awaitTermination()
    assert rows(S.read_counts(spark, other), *COUNTS) == [("p1", 5, at("00:00:00"), at("00:10:00"))]
    with pytest.raises(layout.LayoutChanged):
        S.start_counts(spark, job, S.AVAILABLE_NOW)


def test_another_spread_is_refused_and_state_is_rebuilt(spark, make, job):
    rng = random.Random(1)
    spans = [span(rng, a, a + 10) for a in (0, 10, 20, 30)]
    job = replace(job, spread=4)
    all_orders, all_changes = [], []
    for number, (orders, changes) in enumerate(spans):
        log(make, job, orders, changes)
        all_orders += orders
        all_changes += changes
        if number == 1:
            with pytest.raises(layout.LayoutChanged, match="spread"):
                S.start_enriched(spark, replace(job, spread=8), S.AVAILABLE_NOW)
            S.rebuild_enriched(spark, job, spread=8)
            job = replace(job, spread=8)
        if number == 2:
            S.rebuild_enriched(spark, job)  # by heat now
            job = replace(job, spread=None)
        assert enriched_now(spark, job) == wanted(make, all_orders, all_changes)
    held = layout.read(job.base, "enriched_orders")
    assert held.generation == 2 and held.settings["spread"] == "by heat"
    groups = spark.read.format("statestore").option("stateVarName", "waiting_index").load(job.checkpoint("enriched_orders@1"))
    assert groups.select("key.spread").distinct().count() > 4


def test_counts_go_on_over_generations(spark, make, job):
    rng = random.Random(2)
    (orders, changes), (more, later) = span(rng, 0, 20), span(rng, 20, 50)
    log(make, job, orders, changes)
    enriched_now(spark, job)
    S.start_counts(spark, job, S.AVAILABLE_NOW).awaitTermination()
    S.rebuild_enriched(spark, job, spread=3)
    with pytest.raises(layout.LayoutChanged, match="inputs"):
        S.start_counts(spark, job, S.AVAILABLE_NOW)
    S.rebuild_counts(spark, job)
    log(make, job, more, later)
    done = enriched_now(spark, job)
    S.start_counts(spark, job, S.AVAILABLE_NOW).awaitTermination()
    last = max(r[4] for r in done)
    found = {r[2:]: 0 for r in rows(S.read_counts(spark, job), *COUNTS)}
    for r in rows(S.read_counts(spark, job), *COUNTS):
        found[r[2:]] += r[1]
    for (begin, end), n in found.items():
        assert end <= last and n == sum(begin <= r[4] < end for r in done)
    assert len(found) >= 8


def test_a_backlog_is_handed_over(spark, make, job):
    rng = random.Random(3)
    first, second, third = (span(rng, a, a + 15) for a in (0, 15, 30))
    log(make, job, *first)
    held = S.hand_over(spark, job)
    assert held.generation == 1 and rows(S.read_enriched(spark, job), *ENRICHED) == wanted(make, *first)
    with pytest.raises(layout.LayoutChanged):
        S.hand_over(spark, job)
    # Rows behind the hand-over are late, as in a stream that had read the backlog.
    late = [("late", "p1", "00:00:01")], [("p1", "late", "00:00:00", "u", 1)]
    log(make, job, second[0] + late[0], second[1] + late[1])
    assert enriched_now(spark, job) == wanted(make, first[0] + second[0], first[1] + second[1])
    log(make, job, *third)
    every = [sum((s[k] for s in (first, second, third)), []) for k in (0, 1)]
    assert enriched_now(spark, job) == wanted(make, *every)
    # The join could not read the first files again: its state began from what they left.
    state = spark.read.parquet(held.state)
    assert state.filter("kind <> 0").count() < len(first[1])


def test_hand_over_in_another_zone(spark, make, job):
    first, second = ([("a", "p1", "02:10:00"), ("b", "p1", "02:30:00")], [("p1", "v1", "02:00:00", "c", 0), ("p1", "v2", "02:20:00", "u", 1)]), (
        [("c", "p1", "02:50:00")], [("p1", "v3", "02:25:00", "u", 2), ("p9", "x", "02:45:00", "c", 3)]
    )
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        log(make, job, *first)
        S.hand_over(spark, job)
        log(make, job, *second)
        found = enriched_now(spark, job)
        assert [(r[0], r[2], r[4]) for r in found] == [("a", "v1", at("02:10:00")), ("b", "v3", at("02:30:00"))]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_hand_over_of_empty_logs(spark, make, job):
    rng = random.Random(4)
    log(make, job, [], [])
    assert S.hand_over(spark, job).generation == 0
    orders, changes = span(rng, 0, 20)
    log(make, job, orders, changes)
    assert enriched_now(spark, job) == wanted(make, orders, changes)


def test_spread_by_heat(spark, make, job):
    rng = random.Random(5)
    orders, changes = span(rng, 0, 30, products=30, n=300)
    orders += [(f"hot{i}", "hot", f"00:{i % 29:02d}:{i % 60:02d}") for i in range(150)]
    changes += [("hot", f"v{i}", f"00:{i:02d}:00", "u", 90_000 + i) for i in range(30)]
    log(make, job, orders, changes)
    assert enriched_now(spark, job) == wanted(make, orders, changes)
    held = layout.read(job.base, "enriched_orders")
    shares = held.settings["shares"]
    assert held.spreads["hot"] == -(-150 * shares // 450) and len(held.spreads) <= shares
    # No group gets over twice its share of the orders.
    dealt = enrich._dealt(make.orders(*orders).select(*enrich._order_columns()), held.spreads)
    most = dealt.groupBy("product_id", "spread").count().agg(F.max("count")).first()[0]
    assert most <= 2 * 450 / shares
    # Changes of the others are not copied.
    copies = enrich._dealt(make.changes(*changes).select(*enrich._version_columns()), held.spreads)
    assert copies.count() == len(changes) + 30 * (held.spreads["hot"] - 1)
    # A restart keeps the measured layout, whatever the log holds by then.
    more = [(f"m{i}", "p1", "00:40:00") for i in range(500)], [("p1", "new", "00:45:00", "u", 99_000)]
    log(make, job, *more)
    assert enriched_now(spark, job) == wanted(make, orders + more[0], changes + more[1])
    assert layout.read(job.base, "enriched_orders") == held


def test_sketches_merge(spark):
    def keys(n, hot):
        return spark.range(n).select(F.when(F.col("id") % 2 == 0, hot).otherwise(F.col("id").cast("string")).alias("k"))

    parts = heat.sketch(keys(4000, "a"), "k").unionByName(heat.sketch(keys(8000, "b"), "k"))
    assert heat.spreads(heat.merge(parts), 12) == {"a": 2, "b": 4}
    assert heat.spreads(heat.sketch(keys(0, "a"), "k"), 12) == {}


def test_chained_layout_is_held(spark, make, job):
    rng = random.Random(6)
    log(make, job, *span(rng, 0, 20))
    S.start_chained(spark, job, S.AVAILABLE_NOW).awaitTermination()
    with pytest.raises(layout.LayoutChanged):
        S.start_chained(spark, replace(job, window_minutes=7), S.AVAILABLE_NOW)


def test_accounts_add_up(spark, make, job):
    write_csv_orders(make.orders(("a", "p1", "00:01:00"), ("b", "p9", "00:02:00"), ("c", None, "00:01:00"), ("w", "p1", "00:09:00")), job.order_files)
    append_log(make.changes(("p1", "v", "00:00:00", "c", 0), ("p2", "x", "00:09:00", "c", 1)), PRODUCT_CHANGES, job.change_files)
    S.run_available(spark, job)
    write_csv_orders(make.orders(("late", "p1", "00:01:30"), ("d", "p1", "00:19:00")), job.order_files)
    append_log(make.changes(("p2", "x", "00:20:00", "c", 2)), PRODUCT_CHANGES, job.change_files)
    S.run_available(spark, job)
    found = dict(rows(accounts.totals(accounts.read(spark, job.accounts)), "part", "n"))
    lines = spark.read.option("recursiveFileLookup", "true").text(job.order_files).count()
    assert found["lines"] == lines and found["refused"] == lines - 6
    assert {k: v for k, v in found.items() if k not in ("lines", "refused")} == {
        "unkeyed": 1, "late": 1, "matched": 2, "unmatched": 1, "waiting": 1
    }
    assert found["matched"] == S.read_enriched(spark, job).count()


def test_accounts_of_running_queries(spark, make, job):
    import time

    write_csv_orders(make.orders(("a", "p1", "00:01:00")), job.order_files)
    append_log(make.changes(("p1", "v", "00:00:00", "c", 0)), PRODUCT_CHANGES, job.change_files)
    listener = accounts.Accounts(job.accounts)
    spark.streams.addListener(listener)
    try:
        query = S.start_orders(spark, job, S.AVAILABLE_NOW)
        query.awaitTermination()
        for _ in range(100):
            batches = accounts.read(spark, job.accounts)
            if batches.count():
                break
            time.sleep(0.1)
        accounts.keep(job.accounts, query)  # again: the same files
        assert dict(rows(accounts.totals(accounts.read(spark, job.accounts)), "part", "n"))["lines"] >= 1
        assert accounts.read(spark, job.accounts).count() == batches.count()
    finally:
        spark.streams.removeListener(listener)
    assert accounts.read(spark, f"{job.base}/none").count() == 0


def test_orders_are_not_put_beside_a_stream(spark, make, job):
    write_csv_orders(make.orders(("a", "p1", "00:01:00")), job.order_files)
    S.start_orders(spark, job, S.AVAILABLE_NOW).awaitTermination()
    with pytest.raises(ValueError):
        S.append_orders(job, make.orders(("b", "p1", "00:01:00")))


def test_read_files_move_to_the_archive(spark, make, job, tmp_path):
    job = replace(job, archive=str(tmp_path / "done"))
    for i in range(3):
        write_csv_orders(make.orders((f"o{i}", "p1", "00:01:00")).coalesce(1), f"{job.order_files}/{i}")
        S.start_orders(spark, job, S.AVAILABLE_NOW).awaitTermination()
    assert S.read_intake(spark, job).orders.count() == 3
    moved = list((tmp_path / "done").rglob("part-*.csv"))
    assert 1 <= len(moved) and len(moved) + len(list((tmp_path / "in").rglob("part-*.csv"))) == 3
    assert read_log(spark, ENRICHED_ORDERS, str(tmp_path / "in")) is not None
