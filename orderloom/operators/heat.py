"""Which keys are hot: a mergeable sketch of the most frequent ones, and how far to spread each.

The sketch holds a bounded number of keys however many rows it has seen. Sketches of parts of a
table can be kept and merged; a key with more than about 1/``tracked`` of the rows is never missed.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Keys that a sketch tracks.
TRACKED = 10_000


def sketch(rows: DataFrame, key: str, tracked: int = TRACKED) -> DataFrame:
    """One row: ``sketch`` of the keys, and ``rows``, the number of rows with a key."""
    return rows.filter(F.col(key).isNotNull()).agg(
        F.expr(f"approx_top_k_accumulate(`{key}`, {tracked})").alias("sketch"), F.count(F.lit(1)).alias("rows")
    )


def merge(sketches: DataFrame, tracked: int = TRACKED) -> DataFrame:
    """The sketch of all rows behind several sketches."""
    return sketches.agg(
        F.expr(f"approx_top_k_combine(sketch, {tracked})").alias("sketch"), F.sum("rows").alias("rows")
    )


def spreads(sketched: DataFrame, shares: int) -> dict[str, int]:
    """For each key with more than one of ``shares`` equal shares of the rows, the groups to spread it over.

    No group of a key then has more than a share. At most ``shares`` keys are listed.
    """
    found = sketched.filter("rows > 0").select(
        "rows", F.expr(f"approx_top_k_estimate(sketch, {shares})").alias("top")
    ).first()
    if found is None:
        return {}
    fair = found["rows"] / shares
    return {t["item"]: math.ceil(t["count"] / fair) for t in found["top"] if t["count"] > fair}
