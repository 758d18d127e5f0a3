"""Orders and product changes derived from the given tables, in Spark and in SQL.

``events``: most events are orders, sign-ups and errors are product changes.
``lineitem``: line items are orders, eight dated versions of every part.
The SQL text of each derivation is the independent form for the result check.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.functions.time import truncate_ms

VERSIONS_PER_PART = 8
# Change rows that one task makes of its parts; what follows may sort them.
MADE_ROWS = 1_000_000
HOT_PRODUCT = "product-1"

# Declared columns of the given tables: no job is run to look them up.
TABLES = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def _product_of_user() -> Column:
    return F.concat(F.lit("product-"), (F.col("user_id") % 50 + 1).cast("string"))


def event_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = read_table(spark, sf_dir, "events").filter(~F.col("event_type").isin("signup", "error"))
    return events.select(
        F.col("event_id").cast("string").alias("order_id"),
        _product_of_user().alias("product_id"),
        (F.col("event_id") % 10 + 1).cast("int").alias("quantity"),
        truncate_ms("ts").alias("order_ts"),
    )


def event_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product changes: sign-ups create, errors update; no deletes."""
    events = read_table(spark, sf_dir, "events").filter(F.col("event_type").isin("signup", "error"))
    return events.select(
        _product_of_user().alias("product_id"),
        F.concat(F.lit("name-"), F.col("event_id").cast("string")).alias("product_name"),
        (F.lit(100) + F.col("event_id") % 901).cast("int").alias("stock"),
        truncate_ms("ts").alias("last_updated_ts"),
        F.when(F.col("event_type") == "signup", "c").otherwise("u").alias("op"),
        F.col("event_id").alias("seq"),
    )


def event_changes_with_deletes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same changes, with every tenth event a delete of its product."""
    op = F.when(F.col("seq") % 10 == 0, "d").otherwise(F.col("op"))
    return event_changes(spark, sf_dir).withColumn("op", op)


def snapshot_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five chunks of the products by their number, each read at another position of the log.

    Positions are eighths of the log; ``low`` and ``high`` lie a sixteenth to either side.
    """
    changes = event_changes_with_deletes(spark, sf_dir)
    end = changes.agg(F.max("seq").alias("end"))
    chunk = F.substring_index("product_id", "-", -1).cast("int") % 5
    cut = F.floor(F.col("end") * (chunk + 2) / 8).cast("bigint")
    seen = changes.crossJoin(F.broadcast(end)).withColumn("cut", cut).filter("seq <= cut")
    step = F.floor(F.col("end") / 16).cast("bigint")
    row = F.struct("product_name", "stock", "last_updated_ts", "op", (F.col("cut") - step).alias("low"), (F.col("cut") + step).alias("high"))
    held = seen.groupBy("product_id").agg(F.max_by(row, "seq").alias("r")).select("product_id", "r.*")
    return held.filter("op <> 'd'").drop("op")


def log_from_start(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The changes with deletes behind the first sixteenth of the log: before that it was not kept."""
    changes = event_changes_with_deletes(spark, sf_dir)
    end = changes.agg(F.max("seq").alias("end"))
    return changes.crossJoin(F.broadcast(end)).filter("seq > floor(end / 16)").drop("end")


def skewed_event_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event orders with a third of them on one product, all at midnight of their day."""
    hot = F.col("order_id").cast("bigint") % 3 == 0
    return event_orders(spark, sf_dir).select(
        "order_id",
        F.when(hot, HOT_PRODUCT).otherwise(F.col("product_id")).alias("product_id"),
        "quantity",
        F.when(hot, F.col("order_ts").cast("date").cast("timestamp_ntz"))
        .otherwise(F.col("order_ts"))
        .alias("order_ts"),
    )


def skewed_event_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes with a third on one product, all at midnight of their day; with deletes."""
    hot = F.col("seq") % 3 == 0
    return event_changes_with_deletes(spark, sf_dir).select(
        F.when(hot, HOT_PRODUCT).otherwise(F.col("product_id")).alias("product_id"),
        "product_name",
        "stock",
        F.when(hot, F.col("last_updated_ts").cast("date").cast("timestamp_ntz"))
        .otherwise(F.col("last_updated_ts"))
        .alias("last_updated_ts"),
        "op",
        "seq",
    )


def _folded(name: str, span: int, step: int = 1) -> Column:
    """The microseconds of a time modulo ``span``, in whole steps, on one day."""
    # Zone offsets are whole seconds, so the part is the same in any zone.
    micros = F.pmod(F.unix_micros(F.col(name).cast("timestamp")), F.lit(span))
    day = F.lit("2024-01-01").cast("timestamp_ntz")
    return F.timestamp_add("MICROSECOND", F.floor(micros / F.lit(step)) * F.lit(step), day)


def dense_event_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event orders with all times folded into 20 milliseconds, exact to the microsecond."""
    events = read_table(spark, sf_dir, "events").filter(~F.col("event_type").isin("signup", "error"))
    return events.select(
        F.col("event_id").cast("string").alias("order_id"),
        _product_of_user().alias("product_id"),
        (F.col("event_id") % 10 + 1).cast("int").alias("quantity"),
        _folded("ts", 20_000).alias("order_ts"),
    )


def _dense_changes(spark: SparkSession, sf_dir: str, time: Column, seq: Column) -> DataFrame:
    events = read_table(spark, sf_dir, "events").filter(F.col("event_type").isin("signup", "error"))
    return events.select(
        _product_of_user().alias("product_id"),
        F.concat(F.lit("name-"), F.col("event_id").cast("string")).alias("product_name"),
        (F.lit(100) + F.col("event_id") % 901).cast("int").alias("stock"),
        time.alias("last_updated_ts"),
        F.when(F.col("event_id") % 10 == 0, "d").when(F.col("event_type") == "signup", "c").otherwise("u").alias("op"),
        seq.alias("seq"),
    )


def dense_event_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes, with deletes, folded like the dense orders."""
    return _dense_changes(spark, sf_dir, _folded("ts", 20_000), F.col("event_id"))


def unnumbered_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes at twenty instants of one millisecond, a third without an arrival number."""
    seq = F.when(F.col("event_id") % 3 > 0, F.col("event_id"))
    return _dense_changes(spark, sf_dir, _folded("ts", 1000, 50), seq)


def line_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "lineitem").select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias(
            "order_id"
        ),
        F.concat(F.lit("product-"), F.col("l_partkey").cast("string")).alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_shipdate").alias("order_ts"),  # whole days
    )


def part_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = read_table(spark, sf_dir, "part").select("p_partkey", "p_name")
    # Read tasks go by bytes of the file, not by rows: a large table is dealt out before every part
    # becomes several rows.
    tasks = -(-parts.count() * VERSIONS_PER_PART // MADE_ROWS)
    if tasks > 1:
        parts = parts.repartition(tasks, "p_partkey", "p_name")
    versions = F.explode(F.sequence(F.lit(0), F.lit(VERSIONS_PER_PART - 1)))
    parts = parts.select("p_partkey", "p_name", versions.alias("v"))
    days = F.col("v") * 330 + F.col("p_partkey") % 97
    return parts.select(
        F.concat(F.lit("product-"), F.col("p_partkey").cast("string")).alias("product_id"),
        F.concat(F.col("p_name"), F.lit(" v"), F.col("v").cast("string")).alias("product_name"),
        (F.lit(100) + (F.col("p_partkey") * 7 + F.col("v") * 131) % 901).cast("int").alias("stock"),
        F.timestamp_add("DAY", days, F.lit("1995-01-01").cast("timestamp_ntz")).alias("last_updated_ts"),
        F.when(F.col("v") == 0, "c").otherwise("u").alias("op"),
        (F.col("p_partkey") * VERSIONS_PER_PART + F.col("v")).cast("bigint").alias("seq"),
    )


# The same derivations as SQL common table expressions.

EVENT_ORDERS_SQL = """
ev_orders AS (
  SELECT CAST(event_id AS VARCHAR) AS order_id,
         'product-' || CAST(user_id % 50 + 1 AS VARCHAR) AS product_id,
         CAST(event_id % 10 + 1 AS INTEGER) AS quantity,
         date_trunc('millisecond', ts) AS order_ts
  FROM events WHERE event_type NOT IN ('signup', 'error'))"""

EVENT_CHANGES_SQL = """
ev_changes AS (
  SELECT 'product-' || CAST(user_id % 50 + 1 AS VARCHAR) AS product_id,
         'name-' || CAST(event_id AS VARCHAR) AS product_name,
         CAST(100 + event_id % 901 AS INTEGER) AS stock,
         date_trunc('millisecond', ts) AS last_updated_ts,
         CASE WHEN event_type = 'signup' THEN 'c' ELSE 'u' END AS op,
         event_id AS seq
  FROM events WHERE event_type IN ('signup', 'error'))"""

DELETES_SQL = """
del_changes AS (
  SELECT product_id, product_name, stock, last_updated_ts,
         CASE WHEN seq % 10 = 0 THEN 'd' ELSE op END AS op, seq
  FROM ev_changes)"""

SKEWED_ORDERS_SQL = """
skew_orders AS (
  SELECT order_id,
         CASE WHEN CAST(order_id AS BIGINT) % 3 = 0 THEN 'product-1' ELSE product_id END AS product_id,
         quantity,
         CASE WHEN CAST(order_id AS BIGINT) % 3 = 0 THEN date_trunc('day', order_ts)
              ELSE order_ts END AS order_ts
  FROM ev_orders)"""

SKEWED_CHANGES_SQL = """
skew_changes AS (
  SELECT CASE WHEN seq % 3 = 0 THEN 'product-1' ELSE product_id END AS product_id,
         product_name, stock,
         CASE WHEN seq % 3 = 0 THEN date_trunc('day', last_updated_ts)
              ELSE last_updated_ts END AS last_updated_ts,
         op, seq
  FROM del_changes)"""

DENSE_SQL = """
dense_orders AS (
  SELECT CAST(event_id AS VARCHAR) AS order_id,
         'product-' || CAST(user_id % 50 + 1 AS VARCHAR) AS product_id,
         CAST(event_id % 10 + 1 AS INTEGER) AS quantity,
         TIMESTAMP '2024-01-01' + to_microseconds(epoch_us(ts) % 20000) AS order_ts
  FROM events WHERE event_type NOT IN ('signup', 'error')),
dense_changes AS (
  SELECT 'product-' || CAST(user_id % 50 + 1 AS VARCHAR) AS product_id,
         'name-' || CAST(event_id AS VARCHAR) AS product_name,
         CAST(100 + event_id % 901 AS INTEGER) AS stock,
         TIMESTAMP '2024-01-01' + to_microseconds(epoch_us(ts) % 20000) AS last_updated_ts,
         CASE WHEN event_id % 10 = 0 THEN 'd' WHEN event_type = 'signup' THEN 'c' ELSE 'u' END AS op,
         event_id AS seq
  FROM events WHERE event_type IN ('signup', 'error'))"""

UNNUMBERED_SQL = """
unnumbered AS (
  SELECT 'product-' || CAST(user_id % 50 + 1 AS VARCHAR) AS product_id,
         'name-' || CAST(event_id AS VARCHAR) AS product_name,
         CAST(100 + event_id % 901 AS INTEGER) AS stock,
         TIMESTAMP '2024-01-01' + to_microseconds(epoch_us(ts) % 1000 // 50 * 50) AS last_updated_ts,
         CASE WHEN event_id % 10 = 0 THEN 'd' WHEN event_type = 'signup' THEN 'c' ELSE 'u' END AS op,
         CASE WHEN event_id % 3 > 0 THEN event_id END AS seq
  FROM events WHERE event_type IN ('signup', 'error'))"""

LINE_ORDERS_SQL = """
li_orders AS (
  SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS order_id,
         'product-' || CAST(l_partkey AS VARCHAR) AS product_id,
         CAST(l_quantity AS INTEGER) AS quantity,
         date_trunc('millisecond', CAST(l_shipdate AS TIMESTAMP)) AS order_ts
  FROM lineitem)"""

PART_CHANGES_SQL = """
part_changes AS (
  SELECT 'product-' || CAST(p_partkey AS VARCHAR) AS product_id,
         p_name || ' v' || CAST(v AS VARCHAR) AS product_name,
         CAST(100 + (p_partkey * 7 + v * 131) % 901 AS INTEGER) AS stock,
         TIMESTAMP '1995-01-01' + to_days(CAST(v * 330 + p_partkey % 97 AS INTEGER)) AS last_updated_ts,
         CASE WHEN v = 0 THEN 'c' ELSE 'u' END AS op,
         CAST(p_partkey * 8 + v AS BIGINT) AS seq
  FROM part, range(8) AS r(v))"""
