from __future__ import annotations

import pytest

from conftest import at, rows
from orderloom.operators.windows import tumbling_counts

OUT = ("product_id", "order_count", "window_start", "window_end")


def test_edges_are_half_open(make):
    orders = make.orders(("a", "p1", "00:04:59.999"), ("b", "p1", "00:05:00"))
    assert rows(tumbling_counts(orders), *OUT) == [
        ("p1", 1, at("00:00:00"), at("00:05:00")),
        ("p1", 1, at("00:05:00"), at("00:10:00")),
    ]


def test_counts_rows_not_distinct_ids_and_skips_null_ids(make):
    orders = make.orders(("a", "p1", "00:00:01"), ("a", "p1", "00:00:01"), (None, "p1", "00:00:02"))
    assert rows(tumbling_counts(orders), "order_count") == [(2,)]


def test_only_null_ids_give_a_zero(make):
    assert rows(tumbling_counts(make.orders((None, "p1", "00:00:02"))), "order_count") == [(0,)]


def test_windows_are_aligned_to_the_epoch(make):
    # 2024-01-01 00:00 is 28,401,120 minutes after the epoch, 6 past a multiple of 7.
    out = rows(tumbling_counts(make.orders(("a", "p1", "00:03:00")), 7), "window_start")
    assert out == [(at("00:01:00"),)]


def test_zone_of_the_session_does_not_matter(spark, make):
    from orderloom.session import session_confs

    with session_confs(spark, {"spark.sql.session.timeZone": "Asia/Kolkata"}):
        out = rows(tumbling_counts(make.orders(("a", "p1", "01:10:00")), 60), "window_start")
    assert out == [(at("01:00:00"),)]


def test_size_must_be_positive(make):
    with pytest.raises(ValueError):
        tumbling_counts(make.orders(), 0)


def test_aggregates_before_the_exchange(make):
    plan = tumbling_counts(make.orders())._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan
