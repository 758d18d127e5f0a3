"""Event-time temporal join: each order with the product version valid at its time.

Three ways to the same rows; ``temporal_enrich`` picks by checked size:

* ``shuffle``: orders and versions in one stream per product, sorted by time, the
  last version carried forward. One exchange, one sort, linear.
* ``split``: the same, but keys too large for one task are cut into pieces of their
  time order (see ``pieces``), each opened by the version carried in from those before.
* ``broadcast``: a version history of checked size is searched on the map side;
  the orders are not shuffled at all.

All three compare times as exactly as the columns hold them.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderloom.functions.time import epoch_micros
from orderloom.operators import pieces as P
from orderloom.operators.changelog import history, is_live
from orderloom.operators.locate import Starts, locate
from orderloom.operators.sizes import SMALL_BYTES, plan_bytes
from orderloom.schemas import ENRICHED_ORDERS

# Limits of the broadcast strategy, in versions and in bytes.
BROADCAST_VERSIONS = 500_000
BROADCAST_BYTES = 256 * 1024 * 1024

_VERSION, _ORDER = 0, 1

# Time order of the rows of a product; versions come before the orders of their time.
_ORDERED = ["t", "side", "seq", "live", "tie"]


def temporal_enrich(
    orders: DataFrame,
    changes: DataFrame,
    strategy: str = "auto",
    max_task_rows: int = P.MAX_TASK_ROWS,
) -> DataFrame:
    """Inner as-of join of orders to product changes on ``product_id``.

    The version with the greatest ``last_updated_ts <= order_ts`` matches; equal
    times go to the later ``seq`` (no ``seq`` is the earliest; of several without,
    a live version and the greater name win); an order under a delete, before the
    first version, or with a null key or time gives no row.
    ``strategy``: ``auto``, ``shuffle``, ``split`` or ``broadcast``.
    """
    orders = orders.filter(F.col("product_id").isNotNull() & F.col("order_ts").isNotNull())
    versions = changes.filter(
        F.col("product_id").isNotNull() & F.col("last_updated_ts").isNotNull()
    ).select(
        "product_id",
        "product_name",
        "last_updated_ts",
        "seq",
        is_live().alias("live"),
    )

    if strategy == "auto":
        strategy = _choose(orders, versions)
    if strategy == "shuffle":
        out = _carry_forward(_rows(orders, versions), ["product_id"])
    elif strategy == "broadcast":
        out = _search_history(orders, versions, changes)
        if out is None:
            out = _enrich_split(orders, versions, max_task_rows)
    elif strategy == "split":
        out = _enrich_split(orders, versions, max_task_rows)
    else:
        raise ValueError(f"unknown strategy {strategy!r}")
    return out.select(*ENRICHED_ORDERS.columns)


def _choose(orders: DataFrame, versions: DataFrame) -> str:
    version_bytes = plan_bytes(versions)
    if plan_bytes(orders) + version_bytes <= SMALL_BYTES:
        return "shuffle"
    return "broadcast" if version_bytes <= BROADCAST_BYTES else "split"


def _rows(orders: DataFrame, versions: DataFrame) -> DataFrame:
    """Orders and versions as rows of one table."""
    order_rows = orders.select(
        "product_id",
        F.col("order_ts").alias("t"),
        F.lit(_ORDER).alias("side"),
        F.lit(None).cast("bigint").alias("seq"),
        F.lit(None).cast("boolean").alias("live"),
        F.lit(None).cast("string").alias("tie"),
        F.lit(None).cast("struct<product_name: string>").alias("version"),
        "order_id",
        "quantity",
    )
    version_rows = versions.select(
        "product_id",
        F.col("last_updated_ts").alias("t"),
        F.lit(_VERSION).alias("side"),
        "seq",
        "live",
        # Only versions without an arrival number need their name to be told apart.
        F.when(F.col("seq").isNull(), F.col("product_name")).alias("tie"),
        F.struct("product_name").alias("version"),
        F.lit(None).cast("string").alias("order_id"),
        F.lit(None).cast("int").alias("quantity"),
    )
    return order_rows.unionByName(version_rows)


def enrich_log(rows: DataFrame, max_task_rows: int | None = None) -> DataFrame:
    """The join of the orders and changes in one table: product_id, t (the time of either), side
    (0 a change, 1 an order), order_id, quantity, product_name, op, seq.

    The table is taken as it lies and must have each product's rows in one partition; with
    ``max_task_rows`` given, products are instead cut into pieces of their time order.
    """
    change = F.col("side") == _VERSION
    joined = rows.filter(F.col("product_id").isNotNull() & F.col("t").isNotNull()).select(
        "product_id", "t", "side",
        F.when(change, F.col("seq")).alias("seq"),
        F.when(change, is_live()).alias("live"),
        F.when(change & F.col("seq").isNull(), F.col("product_name")).alias("tie"),
        F.when(change, F.struct("product_name")).alias("version"),
        "order_id", "quantity",
    )
    if max_task_rows is None:
        return _carry_forward(joined, ["product_id"], exchange=False)
    return _carry_in_pieces(joined, max_task_rows)


def _carry_forward(rows: DataFrame, by: list[str], exchange: bool = True) -> DataFrame:
    """Last version at or before each order, within the groups ``by``."""
    # Keys often share a long prefix. With their hash in front, most comparisons of
    # the sort end at the first eight bytes. The rows are exchanged by the key
    # itself, so a count per product needs no second exchange.
    rows = (rows.repartition(*by) if exchange else rows).withColumn("h", F.xxhash64(*by))
    so_far = (
        Window.partitionBy("h", *by)
        .orderBy(*_ORDERED)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    # ``live`` is set on version rows only and decides the match. The name sits in
    # its own struct, so a null name still replaces the one before, and a query
    # that does not read the name drops it before the exchange.
    return (
        rows.select(
            "*",
            F.last("live", ignorenulls=True).over(so_far).alias("matched"),
            F.last("version", ignorenulls=True).over(so_far).alias("current"),
        )
        .filter((F.col("side") == _ORDER) & F.col("matched"))
        .select(
            "order_id",
            "product_id",
            F.col("current.product_name").alias("product_name"),
            "quantity",
            F.col("t").alias("order_ts"),
        )
    )


def _enrich_split(orders: DataFrame, versions: DataFrame, max_task_rows: int) -> DataFrame:
    hot = P.hot_keys(orders.select("product_id").unionAll(versions.select("product_id")), max_task_rows)
    rows = _rows(orders, versions)
    if hot.isEmpty():
        return _carry_forward(rows, ["product_id"])
    keys = hot.select("product_id")
    cold = _carry_forward(rows.join(keys, "product_id", "left_anti"), ["product_id"])
    return cold.unionByName(_carry_in_pieces(rows.join(keys, "product_id", "left_semi"), max_task_rows))


def _carry_in_pieces(rows: DataFrame, max_task_rows: int) -> DataFrame:
    split = P.cut(rows, ["product_id", *_ORDERED], max_task_rows)
    return _carry_forward(split.unionByName(_openings(split)), ["product_id", "piece"])


def _openings(split: DataFrame) -> DataFrame:
    """Per piece and product: the last version in the pieces before, as a row of the piece."""
    version = F.struct("t", "seq", "live", "tie", "version")
    own = split.groupBy("product_id", "piece").agg(F.max(F.when(F.col("side") == _VERSION, version)).alias("own"))
    before = Window.partitionBy("product_id").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    carried = own.withColumn("own", F.last("own", ignorenulls=True).over(before)).filter("own is not null")
    return carried.select(
        "product_id",
        "own.*",
        F.lit(_VERSION).alias("side"),
        F.lit(None).cast("string").alias("order_id"),
        F.lit(None).cast("int").alias("quantity"),
        "piece",
    )


def _search_history(orders: DataFrame, versions: DataFrame, changes: DataFrame) -> DataFrame | None:
    """Binary search of each order in a version history small enough to broadcast.

    None when there are more changes, or more bytes of them, than the limits.
    """
    text = F.coalesce(F.octet_length("product_id"), F.lit(0)) + F.coalesce(F.octet_length("product_name"), F.lit(0))
    count, size = versions.agg(F.count(F.lit(1)), F.sum(text + F.lit(24))).first()
    if count > BROADCAST_VERSIONS or (size or 0) > BROADCAST_BYTES:
        return None
    table = (
        history(changes)
        .select("product_id", "product_name", epoch_micros("valid_from").alias("micros"), "valid_to")
        .toArrow()
    )
    table = table.sort_by([("product_id", "ascending"), ("micros", "ascending")])
    starts = Starts(table["product_id"].combine_chunks(), table["micros"].to_numpy())
    found = orders.sparkSession.createDataFrame(
        pa.table({
            "slot": pa.array(range(table.num_rows), pa.int32()),
            "product_name": table["product_name"],
            "valid_to": table["valid_to"],
        }),
        "slot int, product_name string, valid_to timestamp_ntz",
    )
    return (
        locate(orders, "product_id", "order_ts", starts, "slot")
        .join(F.broadcast(found), "slot")
        .filter(F.col("valid_to").isNull() | (F.col("order_ts") < F.col("valid_to")))
        .select("order_id", "product_id", "product_name", "quantity", "order_ts")
    )
