from __future__ import annotations

import random

import pytest

from conftest import rows
from orderloom.operators.temporal import temporal_enrich
from orderloom.schemas import ENRICHED_ORDERS, ORDERS, PRODUCT_CHANGES
from orderloom.sources.keyed import KeyedLog

ENRICHED = tuple(ENRICHED_ORDERS.columns)


def some(rng, products, n):
    def when():
        return rng.choice([f"00:{rng.randrange(60):02d}:{rng.randrange(60):02d}", "00:30:00"])

    orders = [(f"o{i}", rng.choice(products), when()) for i in range(n)]
    changes = [(rng.choice(products), rng.choice([f"v{i}", None]), when(), rng.choice("uuud"), rng.choice([i, None])) for i in range(n)]
    return orders + [(None, "p1", "00:59:00"), ("x", None, "00:01:00"), ("y", "p1", None)], changes


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_buckets_are_joined_in_place(spark, make, tmp_path):
    rng = random.Random(2)
    products = [f"p{i}" for i in range(40)]
    log = KeyedLog(spark, str(tmp_path / "log"), buckets=4)
    all_orders, all_changes = [], []
    for _ in range(3):
        orders, changes = some(rng, products, 120)
        log.append(make.orders(*orders), ORDERS)
        log.append(make.changes(*changes), PRODUCT_CHANGES)
        all_orders += orders
        all_changes += changes
        want = rows(temporal_enrich(make.orders(*all_orders), make.changes(*all_changes)), *ENRICHED)
        assert rows(log.enriched(), *ENRICHED) == want
        assert "Exchange" not in plan_of(log.enriched())
    many = log.files_of()
    log.compact()
    assert log.files_of() <= 4 < many
    again = KeyedLog(spark, log.path, buckets=4)
    assert rows(again.enriched(), *ENRICHED) == want and again.at["version"] == 1
    assert "Exchange" not in plan_of(again.enriched()) and again.at["hot"] == []
    assert rows(again.read(ORDERS), *ORDERS.columns) == rows(make.orders(*all_orders), *ORDERS.columns)
    assert rows(again.read(PRODUCT_CHANGES), *PRODUCT_CHANGES.columns) == rows(make.changes(*all_changes), *PRODUCT_CHANGES.columns)
    again.clear_old()
    assert not (tmp_path / "log" / "version=0").exists()
    assert rows(again.enriched(), *ENRICHED) == want


def test_hot_keys_leave_the_buckets(spark, make, tmp_path):
    rng = random.Random(3)
    log = KeyedLog(spark, str(tmp_path / "log"), buckets=8)
    products = ["hot"] * 30 + [f"p{i}" for i in range(60)]
    orders, changes = some(rng, products, 400)
    log.append(make.orders(*orders), ORDERS)
    log.append(make.changes(*changes), PRODUCT_CHANGES)
    log.compact()
    assert log.at["hot"] == ["hot"]
    more_orders, more_changes = some(rng, products, 60)
    log.append(make.orders(*more_orders), ORDERS)
    log.append(make.changes(*more_changes), PRODUCT_CHANGES)
    kept = spark.read.parquet(f"{log.path}/version=1/keyed")
    assert kept.filter("product_id = 'hot'").count() == 0
    want = rows(temporal_enrich(make.orders(*orders, *more_orders), make.changes(*changes, *more_changes)), *ENRICHED)
    for limit in (10, 10_000):
        assert rows(log.enriched(max_task_rows=limit), *ENRICHED) == want


def test_an_empty_log_and_another_number_of_buckets(spark, make, tmp_path):
    log = KeyedLog(spark, str(tmp_path / "log"), buckets=4)
    assert log.enriched().count() == 0
    log.append(make.orders(), ORDERS)
    log.compact()
    assert log.enriched().count() == 0
    with pytest.raises(ValueError):
        KeyedLog(spark, log.path, buckets=8)
