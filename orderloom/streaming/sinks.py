"""Streaming sinks: append logs and the upserted latest table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from orderloom.functions.stores import newest_batch, store_of
from orderloom.functions.time import as_naive
from orderloom.operators.changelog import KEY, fold, is_live, newest_per_key
from orderloom.schemas import PRODUCT_CHANGES, PRODUCTS, Relation
from orderloom.session import STREAM_CONFS, session_confs

# Runs of one level that are merged into one of the next.
FAN = 8
_LIST = "run string, level int, top long, floor long"


def start_log(
    df: DataFrame,
    relation: Relation,
    path: str,
    checkpoint: str,
    trigger: dict,
    by: str | None = None,
) -> StreamingQuery:
    """Append a stream to a Parquet log, exactly once, in declared column order.

    ``by`` names a column to partition the files by.
    """
    naive = df.select(
        *[
            as_naive(f.name).alias(f.name) if f.dataType.typeName() == "timestamp_ntz" else f.name
            for f in relation.schema.fields
        ]
    )
    with session_confs(df.sparkSession, STREAM_CONFS):
        writer = (
            relation.conform(naive)
            .writeStream.format("parquet")
            .outputMode("append")
            .option("path", path)
            .option("checkpointLocation", checkpoint)
            .queryName(f"{relation.name} at {checkpoint}")
            .trigger(**trigger)
        )
        return (writer.partitionBy(by) if by else writer).start()


def start_latest(
    df: DataFrame, path: str, checkpoint: str, trigger: dict, settled: int | None = None
) -> StreamingQuery:
    """Keep the latest table under ``path`` up to date with a stream of product changes."""
    with session_confs(df.sparkSession, STREAM_CONFS):
        return (
            df.writeStream.foreachBatch(upsert_latest(path, settled))
            .option("checkpointLocation", checkpoint)
            .queryName(f"latest at {checkpoint}")
            .trigger(**trigger)
            .start()
        )


def upsert_latest(path: str, settled: int | None = None, fan: int = FAN):
    """``foreachBatch`` function that keeps the latest product rows under ``path``.

    The table is a set of runs. Batch ``n`` adds one: the last arrival of each key in it, with its
    position (``seq``) and deletes as rows of their own, so changes may come in any order and
    cut, and the table is still what ``fold`` gives of all of them. ``fan`` runs of a level are merged
    into one of the next, so a row is written again a logarithmic number of times, whatever the size
    of a batch. The list of runs is written last, as ``list/batch=n``; a batch that is repeated starts
    from list ``n - 1`` and gives the same. Runs in neither list are removed.

    Deletes are kept, as an older row of their key may still come. With ``settled``, positions further
    than that behind the greatest one seen count as complete: a delete there goes when the
    whole table is merged, and rows that come for such positions after all are refused, so
    set it only once any snapshot has been read. With a table format that has MERGE, use
    ``merge_latest`` instead, which takes batches in order of arrival only.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = _runs(spark, path, batch_id - 1)
        floor = max((r["floor"] for r in before if r["floor"] is not None), default=None)
        rows = batch if floor is None else batch.filter(F.coalesce(F.col("seq") > floor, F.lit(False)))
        run = f"{batch_id}-0"
        PRODUCT_CHANGES.conform(newest_per_key(rows)).write.mode("overwrite").parquet(f"{path}/data/run={run}")
        top = _read(spark, path, [run]).agg(F.max("seq"), F.count(F.lit(1))).first()
        now = before
        if top[1]:
            now = [*before, {"run": run, "level": 0, "top": top[0], "floor": floor}]
        level = 0
        while len(mine := [r for r in now if r["level"] == level]) >= fan:
            rest = [r for r in now if r["level"] != level]
            tops = [r["top"] for r in now if r["top"] is not None]
            if settled is not None and tops and not rest:
                floor = max(tops) - settled
            merged = newest_per_key(_read(spark, path, [r["run"] for r in mine]))
            if floor is not None and not rest:
                merged = merged.filter(is_live() | (F.col("seq") > floor))
            level += 1
            run = f"{batch_id}-{level}"
            PRODUCT_CHANGES.conform(merged).write.mode("overwrite").parquet(f"{path}/data/run={run}")
            now = [*rest, {"run": run, "level": level, "top": max(tops, default=None), "floor": floor}]
        listed = spark.createDataFrame([(r["run"], r["level"], r["top"], r["floor"]) for r in now], _LIST)
        listed.coalesce(1).write.mode("overwrite").parquet(f"{path}/list/batch={batch_id}")
        _remove_old(path, {r["run"] for r in [*now, *before]}, {batch_id - 1, batch_id})

    return apply


def _runs(spark: SparkSession, path: str, batch_id: int) -> list[dict]:
    """The runs of the table after a batch; a number logarithmic in the batches."""
    if batch_id < 0:
        return []
    return [r.asDict() for r in spark.read.schema(_LIST).parquet(f"{path}/list/batch={batch_id}").collect()]


def _read(spark: SparkSession, path: str, runs: list[str]) -> DataFrame:
    if not runs:
        return spark.createDataFrame([], PRODUCT_CHANGES.schema)
    return spark.read.schema(PRODUCT_CHANGES.schema).parquet(*[f"{path}/data/run={r}" for r in runs])


def _remove_old(path: str, runs: set[str], lists: set[int]) -> None:
    from pyarrow import fs

    store, inner = store_of(path)
    for folder, needed in (("data", runs), ("list", {str(n) for n in lists})):
        for info in store.get_file_info(fs.FileSelector(f"{inner}/{folder}", allow_not_found=True)):
            if "=" in info.base_name and info.base_name.partition("=")[2] not in needed:
                store.delete_dir(info.path)


def merge_latest(table: str):
    """``foreachBatch`` function for a catalog table whose format supports MERGE."""

    def apply(batch: DataFrame, batch_id: int) -> None:
        newest = newest_per_key(batch).alias("s")
        on_key = F.expr(f"{table}.{KEY} = s.{KEY}")
        columns = {c: F.col(f"s.{c}") for c in PRODUCTS.columns}
        (
            newest.mergeInto(table, on_key)
            .whenMatched(F.expr("s.op = 'd'")).delete()
            .whenMatched().update(columns)
            .whenNotMatched(F.expr("coalesce(s.op <> 'd', true)")).insert(columns)
            .merge()
        )

    return apply


def read_latest(spark: SparkSession, path: str, batch_id: int | None = None) -> DataFrame:
    """The latest product rows, as of the last finished batch or the one before it."""
    if batch_id is None:
        batch_id = newest_batch(f"{path}/list")
    runs = [r["run"] for r in _runs(spark, path, batch_id)]
    rows = _read(spark, path, runs)
    return (rows.filter(is_live()).select(*PRODUCTS.columns)) if len(runs) == 1 else fold(rows)
