from __future__ import annotations

import os
import sys

from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from orderloom.functions.time import epoch_micros, truncate_ms
from orderloom.functions.wire import frame, frame_schema_id, key_text, raw_key, unframe
from orderloom.schemas import ENRICHED_ORDERS, ORDERS
from orderloom import session
from orderloom.session import session_confs

TIMES = [
    "2024-01-01 00:00:00.123456",
    "2024-03-10 02:30:59.999999",  # does not exist on New York clocks
    "2024-11-03 01:30:00.000999",  # happens twice on New York clocks
    "1969-12-31 23:59:59.999999",
    "1995-06-17 00:00:00",
]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_times_do_not_depend_on_the_zone(spark, zone):
    df = spark.createDataFrame([(t,) for t in TIMES], "s string").select(
        "s", F.col("s").cast("timestamp_ntz").alias("ts")
    )
    with session_confs(spark, {"spark.sql.session.timeZone": zone}):
        got = df.select("s", truncate_ms("ts").alias("cut"), epoch_micros("ts").alias("us")).collect()
    for r in got:
        exact = datetime.fromisoformat(r.s)
        assert r.cut == exact.replace(microsecond=exact.microsecond // 1000 * 1000)
        whole = int(exact.replace(microsecond=0, tzinfo=timezone.utc).timestamp())
        assert r.us == whole * 1_000_000 + exact.microsecond


def test_truncate_keeps_the_type(spark):
    df = spark.sql("SELECT timestamp_ntz'2024-01-01' AS a, timestamp'2024-01-01' AS b")
    out = df.select(truncate_ms("a").alias("a"), truncate_ms("b").alias("b"))
    assert [t for _, t in out.dtypes] == ["timestamp_ntz", "timestamp"]


def test_frame(spark):
    df = spark.createDataFrame([(bytearray(b"payload"),), (bytearray(b""),)], "p binary")
    framed = df.select("p", frame(F.col("p"), 70000).alias("m"))
    got = framed.select("p", "m", unframe(F.col("m")).alias("u"), frame_schema_id(F.col("m")).alias("i"))
    for r in got.collect():
        assert bytes(r.m) == b"\x00\x00\x01\x11\x70" + bytes(r.p)
        assert bytes(r.u) == bytes(r.p) and r.i == 70000


def test_not_a_frame(spark):
    df = spark.createDataFrame([(bytearray(b"\x01abcdef"),), (bytearray(b"\x00a"),)], "m binary")
    got = df.select(unframe(F.col("m")).alias("u"), frame_schema_id(F.col("m")).alias("i")).collect()
    assert [tuple(r) for r in got] == [(None, None)] * 2


def test_key_round_trip(spark):
    df = spark.createDataFrame([("product-1",), ("größe",), (None,)], "k string")
    got = df.select("k", raw_key("k").alias("b")).select("k", "b", key_text("b").alias("t")).collect()
    for r in got:
        assert r.t == r.k and (r.k is None or bytes(r.b) == r.k.encode())


def test_conform_checks_names_types_and_order(make):
    orders = make.orders(("a", "p1", "00:00:01"))
    mixed = orders.select("order_ts", "quantity", "product_id", "order_id")
    assert ORDERS.conform(mixed).columns == ORDERS.columns
    with pytest.raises(ValueError):
        ENRICHED_ORDERS.conform(orders)
    with pytest.raises(TypeError):
        ORDERS.conform(orders.withColumn("quantity", F.col("quantity").cast("bigint")))


def test_old_run_folders_are_removed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "shared_dir", lambda _: f"file://{tmp_path}")
    path = session.run_dir(spark, "kept")
    spark.range(3).write.parquet(path)
    assert session.clear_runs(spark, older_than_hours=1) == 0
    assert spark.read.parquet(path).count() == 3
    assert session.clear_runs(spark, older_than_hours=0) == 1
    assert session.clear_runs(spark) == 0


def test_the_entry_does_without_the_operators_packages():
    """A package that only the training-data operators need is missing: the order queries stay."""
    import subprocess

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = "import sys; sys.modules['regex'] = None; import __spark_entry__ as e; print(*e.queries(), *e.oracle_sql())"
    done = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    assert "temporal_enrich" in done.stdout and "op2_" not in done.stdout
