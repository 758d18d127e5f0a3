"""Size checks that pick a strategy before any data moves."""

from __future__ import annotations

from pyspark.sql import DataFrame

# Input up to this size (all keys together) may be sorted by one task.
SMALL_BYTES = 128 * 1024 * 1024
UNKNOWN_BYTES = 2**62


def plan_bytes(df: DataFrame) -> int:
    """The optimizer's size estimate of ``df`` after pruning; no job is run.

    Where the session gives no estimate (a remote client), the input counts as large.
    """
    try:
        return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except AttributeError:
        return UNKNOWN_BYTES
