"""The version history as a table that a stream of changes keeps up to date.

The table is cut into slots by key hash and time slice. A slot holds one row per key and time, the
change that holds at that time with deletes among them, and ``valid_to``, the time of the key's next
change. An index holds, per key and slice, the first time in it.

A batch merges its changes into the slots of their times, however late they are: a change in the
middle of an interval splits it. The index tells which earlier versions, in whatever slice, now
end at another time; only slots that hold a new change or such a version are written again. The
list of slots is written last, so a repeated batch starts from the same table and gives the same.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from orderloom.functions.stores import newest_batch, store_of
from orderloom.functions.time import epoch_micros
from orderloom.operators.changelog import KEY, TIME, current_spans, last_at_each_time, spans_of
from orderloom.schemas import PRODUCT_CHANGES
from orderloom.session import STREAM_CONFS, session_confs

# Key buckets of the table, and the time span of a slice.
BUCKETS = 16
SLICE_HOURS = 24

_LIST = "kind string, bucket int, slice long, version long"
_NTZ = T.TimestampNTZType()
_PLACE = [T.StructField("bucket", T.IntegerType()), T.StructField("slice", T.LongType())]
_DATA = T.StructType([*PRODUCT_CHANGES.schema.fields, T.StructField("valid_to", _NTZ), *_PLACE])
_INDEX = T.StructType(
    [T.StructField(KEY, T.StringType()), T.StructField("slice", T.LongType()), T.StructField("first", _NTZ), _PLACE[0]]
)

Slots = dict[tuple, int]


def start_history(df: DataFrame, path: str, checkpoint: str, trigger: dict, **layout: int) -> StreamingQuery:
    """Keep the history under ``path`` up to date with a stream of product changes."""
    with session_confs(df.sparkSession, STREAM_CONFS):
        return (
            df.writeStream.foreachBatch(merge_history(path, **layout))
            .option("checkpointLocation", checkpoint)
            .queryName(f"history at {checkpoint}")
            .trigger(**trigger)
            .start()
        )


def merge_history(path: str, buckets: int = BUCKETS, slice_hours: int = SLICE_HOURS, max_task_rows: int | None = None):
    """``foreachBatch`` function that merges change rows into the history under ``path``.

    ``buckets`` and ``slice_hours`` belong to the table: keep them for its life. ``max_task_rows`` is
    that of ``history``. Rows without key or time are left out, as there.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = _slots(spark, path, batch_id - 1)
        rows = batch.filter(F.col(KEY).isNotNull() & F.col(TIME).isNotNull())
        new = PRODUCT_CHANGES.conform(last_at_each_time(rows)).withColumns(
            {"bucket": _bucket(buckets), "slice": _slice(slice_hours)}
        )
        staged = f"{path}/staged/batch={batch_id}"
        new.write.mode("overwrite").parquet(staged)
        new = spark.read.schema(_DATA).parquet(staged).drop("valid_to")

        hit = {tuple(r) for r in new.select("bucket", "slice").distinct().collect()}
        in_hit = sorted({b for b, _ in hit})
        old_index = _index(spark, path, before, in_hit)
        firsts = new.groupBy(KEY, "bucket", "slice").agg(F.min(TIME).alias("first"))
        both = old_index.withColumn("old", F.lit(True)).unionByName(firsts.withColumn("old", F.lit(False)))
        by_key = Window.partitionBy(KEY).orderBy("slice")
        index = both.groupBy(KEY, "bucket", "slice").agg(
            F.min("first").alias("first"), F.min(F.when(F.col("old"), F.col("first"))).alias("was")
        )
        # The next change of a key behind a slice, and what it was before: the next known first time.
        behind = Window.partitionBy(KEY).orderBy(F.col("slice").desc()).rowsBetween(Window.unboundedPreceding, -1)
        was_next = F.last("was", ignorenulls=True).over(behind)
        index = index.withColumns({"next": F.lead("first").over(by_key), "was_next": was_next})
        index_at = f"{path}/index/version={batch_id}"
        index.write.mode("overwrite").partitionBy("bucket").parquet(index_at)
        kept = T.StructType([*_INDEX.fields[:3], T.StructField("was", _NTZ), T.StructField("next", _NTZ),
                             T.StructField("was_next", _NTZ), _PLACE[0]])
        index = spark.read.schema(kept).parquet(index_at)
        moved = index.filter(F.col("was").isNotNull() & ~F.col("next").eqNullSafe(F.col("was_next")))
        touched = hit | {tuple(r) for r in moved.select("bucket", "slice").distinct().collect()}

        old = _data(spark, path, {s: v for s, v in before.items() if s[0] == "data" and s[1:] in touched})
        merged = last_at_each_time(PRODUCT_CHANGES.conform(old).unionByName(PRODUCT_CHANGES.conform(new)))
        spans = spans_of(PRODUCT_CHANGES.conform(merged), max_task_rows).withColumns(
            {"bucket": _bucket(buckets), "slice": _slice(slice_hours)}
        )
        # A slot's last change of a key ends with the first one of a later slice.
        ends = index.select(KEY, "slice", "next")
        spans = spans.join(ends, [KEY, "slice"], "left").withColumn("valid_to", F.least("valid_to", "next"))
        spans.select(*_DATA.fieldNames()).write.mode("overwrite").partitionBy("bucket", "slice").parquet(
            f"{path}/data/version={batch_id}"
        )
        now = {**before, **{("data", *s): batch_id for s in touched}}
        now.update({("index", b, None): batch_id for b in in_hit})
        listed = spark.createDataFrame([(*k, v) for k, v in now.items()], _LIST)
        listed.coalesce(1).write.mode("overwrite").parquet(f"{path}/list/batch={batch_id}")
        _remove_old(path, {*now.values(), *before.values()}, batch_id)

    return apply


def read_history(spark: SparkSession, path: str, batch_id: int | None = None) -> DataFrame:
    """The versions with their intervals, like ``history``, as of the last batch or the one before it."""
    if batch_id is None:
        batch_id = newest_batch(f"{path}/list")
    slots = _slots(spark, path, batch_id)
    return current_spans(_data(spark, path, {s: v for s, v in slots.items() if s[0] == "data"}))


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64(KEY), F.lit(buckets)).cast("int")


def _slice(hours: int) -> Column:
    return F.floor(epoch_micros(TIME) / F.lit(hours * 3_600_000_000)).cast("long")


def _slots(spark: SparkSession, path: str, batch_id: int) -> Slots:
    """The version of every slot and index bucket after a batch; a row for each, not for their rows."""
    if batch_id < 0:
        return {}
    listed = spark.read.schema(_LIST).parquet(f"{path}/list/batch={batch_id}").collect()
    return {(r["kind"], r["bucket"], r["slice"]): r["version"] for r in listed}


def _data(spark: SparkSession, path: str, slots: Slots) -> DataFrame:
    if not slots:
        return spark.createDataFrame([], _DATA)
    paths = [f"{path}/data/version={v}/bucket={b}/slice={s}" for (_, b, s), v in sorted(slots.items())]
    return spark.read.schema(_DATA).option("basePath", f"{path}/data").parquet(*paths).select(*_DATA.fieldNames())


def _index(spark: SparkSession, path: str, slots: Slots, buckets: list[int]) -> DataFrame:
    held = [(b, slots[("index", b, None)]) for b in buckets if ("index", b, None) in slots]
    paths = [f"{path}/index/version={v}/bucket={b}" for b, v in held]
    if not paths:
        return spark.createDataFrame([], _INDEX)
    return spark.read.schema(_INDEX).option("basePath", f"{path}/index").parquet(*paths).select(*_INDEX.fieldNames())


def _remove_old(path: str, versions: set[int], batch_id: int) -> None:
    from pyarrow import fs

    store, inner = store_of(path)
    needed = {"data": versions, "index": versions, "list": {batch_id - 1, batch_id}, "staged": {batch_id}}
    for folder, numbers in needed.items():
        for info in store.get_file_info(fs.FileSelector(f"{inner}/{folder}", allow_not_found=True)):
            number = info.base_name.rpartition("=")[2]
            if number.isdigit() and int(number) not in numbers:
                store.delete_dir(info.path)
