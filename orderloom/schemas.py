"""Declared relations: column types, keys and event-time attributes.

Everything at rest uses ``timestamp_ntz`` with millisecond values; streams turn
the event-time column into ``timestamp`` on entry (watermarks need that type)
and back into ``timestamp_ntz`` before a sink.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T

WATERMARK_DELAY = "1 second"

_NTZ = T.TimestampNTZType()


def _struct(*columns: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns])


@dataclass(frozen=True)
class Relation:
    """A declared table. ``primary_key`` is a promise by the writer, not a check."""

    name: str
    schema: T.StructType
    primary_key: tuple[str, ...] = ()
    event_time: str | None = None
    message_key: str | None = None

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()

    def conform(self, df: DataFrame) -> DataFrame:
        """Project ``df`` to the declared columns in declared order, or fail.

        This is the check before every sink: an insert matches by position, so
        the column order and types must be exactly the declared ones.
        """
        missing = [c for c in self.columns if c not in df.columns]
        if missing:
            raise ValueError(f"{self.name}: missing columns {missing}")
        out = df.select(*self.columns)
        for want, got in zip(self.schema.fields, out.schema.fields):
            if want.dataType != got.dataType:
                raise TypeError(
                    f"{self.name}.{want.name}: expected {want.dataType.simpleString()}, "
                    f"got {got.dataType.simpleString()}"
                )
        return out


ORDERS = Relation(
    "orders",
    _struct(
        ("order_id", T.StringType()),
        ("product_id", T.StringType()),
        ("quantity", T.IntegerType()),
        ("order_ts", _NTZ),
    ),
    event_time="order_ts",
    message_key="product_id",
)

# What an order file holds: orders, and the lines refused with the reason.
INTAKE = Relation(
    "orders",
    T.StructType(
        ORDERS.schema.fields
        + [T.StructField(c, T.StringType(), True) for c in ("path", "member", "line", "error")]
        + [T.StructField("refused", T.BooleanType(), True)]
    ),
    event_time="order_ts",
    message_key="product_id",
)

PRODUCTS = Relation(
    "products",
    _struct(
        ("product_id", T.StringType()),
        ("product_name", T.StringType()),
        ("stock", T.IntegerType()),
        ("last_updated_ts", _NTZ),
    ),
    primary_key=("product_id",),
    event_time="last_updated_ts",
    message_key="product_id",
)

# A product change: the row after the change, what happened, and its arrival order.
# op: r = snapshot row, c = insert, u = update, d = delete.
PRODUCT_CHANGES = Relation(
    "product_changes",
    T.StructType(
        PRODUCTS.schema.fields
        + [T.StructField("op", T.StringType(), True), T.StructField("seq", T.LongType(), True)]
    ),
    event_time="last_updated_ts",
    message_key="product_id",
)

# Product rows of a snapshot read in chunks, with the log positions around the reading.
SNAPSHOT_CHUNKS = Relation(
    "snapshot_chunks",
    T.StructType(
        PRODUCTS.schema.fields
        + [T.StructField("low", T.LongType(), True), T.StructField("high", T.LongType(), True)]
    ),
    primary_key=("product_id",),
    event_time="last_updated_ts",
    message_key="product_id",
)

ENRICHED_ORDERS = Relation(
    "enriched_orders",
    _struct(
        ("order_id", T.StringType()),
        ("product_id", T.StringType()),
        ("product_name", T.StringType()),
        ("quantity", T.IntegerType()),
        ("order_ts", _NTZ),
    ),
    event_time="order_ts",
    message_key="product_id",
)

PRODUCT_WINDOW_COUNTS = Relation(
    "product_window_counts",
    _struct(
        ("product_id", T.StringType()),
        ("order_count", T.LongType()),
        ("window_start", _NTZ),
        ("window_end", _NTZ),
    ),
    message_key="product_id",
)
