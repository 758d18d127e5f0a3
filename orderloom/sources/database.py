"""Deployment edge: the product snapshot from its database, read in parallel.

Needs a JDBC driver on the cluster; not covered by tests. The rows go into
``snapshot_plus_log`` together with the change log.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from orderloom.schemas import PRODUCTS


def read_snapshot(
    spark: SparkSession, url: str, table: str, key_bounds: list[str], properties: dict[str, str]
) -> DataFrame:
    """Read ``table`` in one task per key range; ``key_bounds`` are the inner bounds."""
    key = PRODUCTS.primary_key[0]
    quoted = ["'" + b.replace("'", "''") + "'" for b in sorted(key_bounds)]
    ranges = [
        " AND ".join(
            ([f"{key} >= {low}"] if low else []) + ([f"{key} < {high}"] if high else [])
        ) or f"{key} IS NOT NULL"
        for low, high in zip([None, *quoted], [*quoted, None])
    ]
    rows = spark.read.jdbc(url, table, predicates=ranges, properties=properties)
    return rows.select(*[rows[f.name].cast(f.dataType) for f in PRODUCTS.schema.fields])
