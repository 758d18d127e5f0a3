"""Helpers shared by the operators: stored steps, skew-safe lookups, files of any store."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.functions.stores import store_of
from orderloom.session import run_dir

# A key is hot when it has more than 1/HOT_SHARE of all rows (and more than HOT_ROWS),
# so there are never more than HOT_SHARE hot keys.
HOT_SHARE = 500
HOT_ROWS = 2000
SALTS = 64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back: cuts lineage and survives lost executors."""
    path = run_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def attach(rows: DataFrame, lookup: DataFrame, key: str, weight: str, total: int, how: str = "inner") -> DataFrame:
    """Join ``lookup`` (one row per ``key``) to ``rows``, of which any key may hold a large share.

    ``weight`` is the column of ``lookup`` with the number of rows of its key, ``total`` the
    number of all rows. The rows of a hot key are spread over SALTS groups; its lookup row is
    copied to each. Hot keys number at most HOT_SHARE, which bounds the broadcast list.
    ``lookup`` should be stored: it is read twice. The group of a row follows from its values
    and its task, so that even equal rows are spread, and a task that runs again agrees.
    """
    bar = max(HOT_ROWS, total // HOT_SHARE)
    is_hot, taken = F.col(weight) > bar, [*rows.columns, *lookup.columns]
    mark, salt = fresh(taken, "_hot"), fresh(taken, "_salt")
    hot = lookup.filter(is_hot).select(key, F.lit(True).alias(mark))
    spread = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns]) + F.spark_partition_id(), F.lit(SALTS))
    left = rows.join(F.broadcast(hot), key, "left").withColumn(
        salt, F.when(F.col(mark), spread).otherwise(F.lit(0).cast("long"))
    )
    copies = F.when(is_hot, F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long")))
    salts = F.explode(F.coalesce(copies, F.array(F.lit(0).cast("long"))))
    right = lookup.withColumn(salt, salts).drop(weight)
    return left.drop(mark).join(right, [key, salt], how).drop(salt)


def put_file(uri: str, body: bytes, attempt: str) -> None:
    """Write a whole file under its final name; a repeated task leaves the same bytes."""
    store, inner = store_of(uri)
    folder, _, name = inner.rpartition("/")
    store.create_dir(folder, recursive=True)
    aside = f"{folder}/_{attempt}-{name}"
    with store.open_output_stream(aside, compression=None) as out:
        out.write(body)
    store.move(aside, inner)


def fresh(df: DataFrame | list[str], name: str) -> str:
    """``name``, with underscores appended until no column of ``df`` has it."""
    columns = df if isinstance(df, list) else df.columns
    while name.lower() in (c.lower() for c in columns):
        name += "_"
    return name
