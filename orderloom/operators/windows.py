"""Tumbling event-time windows and the count per product."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_WINDOW_MINUTES = 5


def tumbling_counts(enriched: DataFrame, window_minutes: int = DEFAULT_WINDOW_MINUTES) -> DataFrame:
    """Orders per product and window ``[window_start, window_end)``.

    Windows start at whole multiples of the size since 1970-01-01 00:00. Rows
    with a null ``order_id`` open a window but are not counted. Works on batch
    and on a watermarked stream.
    """
    size = int(window_minutes)
    if size < 1:
        raise ValueError("window_minutes must be at least 1")
    return (
        enriched.groupBy("product_id", F.window("order_ts", f"{size} minutes").alias("w"))
        .agg(F.count("order_id").alias("order_count"))
        .select(
            "product_id",
            "order_count",
            F.col("w.start").alias("window_start"),
            F.col("w.end").alias("window_end"),
        )
    )
