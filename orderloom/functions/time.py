"""Event-time column expressions, independent of the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def truncate_ms(name: str) -> Column:
    """Cut a timestamp column to whole milliseconds, keeping its type.

    ``date_trunc`` would turn ``timestamp_ntz`` into ``timestamp`` and so pass
    through the session time zone; this only subtracts the sub-millisecond part.
    """
    return F.timestamp_add("MICROSECOND", -F.pmod(_micros(name), F.lit(1000)), F.col(name))


def epoch_micros(name: str) -> Column:
    """Microseconds since 1970-01-01 00:00 on the column's own clock."""
    seconds = (
        F.datediff(name, F.lit("1970-01-01").cast("date")) * F.lit(86_400).cast("bigint")
        + F.hour(name) * F.lit(3_600)
        + F.minute(name) * F.lit(60)
        + F.second(name)
    )
    return seconds * F.lit(1_000_000) + F.pmod(_micros(name), F.lit(1_000_000))


def _micros(name: str) -> Column:
    # Zone offsets are whole seconds, so the part below a second is the same in any zone.
    return F.unix_micros(F.col(name).cast("timestamp"))


def as_event_time(name: str) -> Column:
    """``timestamp_ntz`` to ``timestamp`` for use with watermarks (session zone UTC)."""
    return F.col(name).cast("timestamp")


def as_naive(name: str) -> Column:
    """Back to ``timestamp_ntz`` at a table boundary (session zone UTC)."""
    return F.col(name).cast("timestamp_ntz")
