"""Keyed change rows: fold to the latest row, version history, bulk upsert."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderloom.operators import pieces as P
from orderloom.operators.sizes import SMALL_BYTES, plan_bytes
from orderloom.schemas import PRODUCT_CHANGES, PRODUCTS, SNAPSHOT_CHUNKS

KEY = PRODUCTS.primary_key[0]
TIME = PRODUCTS.event_time

# Arrival position of snapshot rows: before every log row (log positions are >= 0).
SNAPSHOT_SEQ = -1

# Limits of a batch whose keys Spark may broadcast, in keys and in bytes of them.
BROADCAST_KEYS = 500_000
BROADCAST_KEY_BYTES = 32 * 1024 * 1024


def is_live(op: str = "op") -> Column:
    """False for a delete row; any other change leaves a live row behind."""
    return F.coalesce(F.col(op) != F.lit("d"), F.lit(True))


def snapshot_plus_log(snapshot: DataFrame, log: DataFrame) -> DataFrame:
    """A change stream that starts with a table snapshot and goes on with its log.

    Snapshot rows come before the log, so a change that is in both ends up with
    the log's value: reading an overlap is harmless.
    """
    first = snapshot.select(
        *PRODUCTS.columns,
        F.lit("r").alias("op"),
        F.lit(SNAPSHOT_SEQ).cast("bigint").alias("seq"),
    )
    return PRODUCT_CHANGES.conform(first).unionByName(PRODUCT_CHANGES.conform(log))


def incremental_snapshot(chunks: DataFrame, log: DataFrame, read_to: int | None = None) -> DataFrame:
    """A change stream from a snapshot that was read in chunks while the log went on.

    ``chunks`` holds rows of SNAPSHOT_CHUNKS: product rows with the log positions ``low`` and ``high``
    from before and after their chunk was read. A chunk shows every change up to ``low`` and perhaps
    some after it, so its rows take the place right behind ``low``: they beat the log up to
    there, and any log row behind ``low`` beats them, deletes included. Reading a chunk twice, or a log
    that overlaps it, is harmless.

    Chunks whose ``high`` lies behind ``read_to`` are held back: the log has not caught up with
    what they may show. Without ``read_to`` all chunks count as caught up with.
    """
    held = chunks if read_to is None else chunks.filter(F.col("high") <= read_to)
    bad = F.col("low").isNull() | F.col("high").isNull() | (F.col("high") < F.col("low"))
    fault = F.raise_error(F.lit("a snapshot chunk needs positions low <= high")).cast("bigint")
    rows = SNAPSHOT_CHUNKS.conform(held).select(
        *PRODUCTS.columns, F.lit("r").alias("op"), F.when(bad, fault).otherwise(F.col("low")).alias("seq")
    )
    return PRODUCT_CHANGES.conform(rows).unionByName(PRODUCT_CHANGES.conform(log))


def _last_per_key(changes: DataFrame, order: Sequence[str | Column]) -> DataFrame:
    # max_by combines on the map side: a hot key sends one row per task.
    row = F.struct(*[c for c in changes.columns if c != KEY])
    return (
        changes.filter(F.col(KEY).isNotNull())
        .groupBy(KEY)
        .agg(F.max_by(row, F.struct(*order, *_ties())).alias("r"))
        .select(KEY, "r.*")
    )


def _ties() -> list[Column]:
    """Order of rows of one position: a snapshot taken there shows it; then any fixed order."""
    snapshot = F.coalesce(F.col("op") == "r", F.lit(False))
    return [snapshot.alias("_r"), F.col(TIME).alias("_t"), is_live().alias("_l"), F.col("product_name"), F.col("stock")]


def latest(changes: DataFrame) -> DataFrame:
    """The newest row per key by event time, then arrival; deleted keys are gone."""
    kept = _last_per_key(changes, (TIME, "seq")).filter(is_live())
    return kept.select(*PRODUCTS.columns)


def fold(changes: DataFrame) -> DataFrame:
    """Apply change rows in arrival order: the table as its database holds it."""
    kept = newest_per_key(changes).filter(is_live())
    return kept.select(*PRODUCTS.columns)


def upsert(target: DataFrame, batch: DataFrame) -> DataFrame:
    """Insert the batch into ``target``; an existing key gets all its columns replaced.

    Within the batch the last arrival (``seq``) wins; event time is not compared.
    A small batch is broadcast by Spark on its size estimate, so the target does
    not shuffle for it; a batch of many keys is not, whatever the estimate.
    """
    newest = newest_per_key(batch).select(*target.columns)
    return _replace(target, batch, newest, newest)


def apply_changes(target: DataFrame, batch: DataFrame) -> DataFrame:
    """Like ``upsert``, for change rows: a delete removes its key."""
    newest = newest_per_key(batch)
    return _replace(target, batch, newest, newest.filter(is_live()).select(*target.columns))


def newest_per_key(changes: DataFrame) -> DataFrame:
    """The last arrival per key, deletes included; no position is the earliest."""
    return _last_per_key(changes, ("seq",))


def _replace(target: DataFrame, batch: DataFrame, touched: DataFrame, rows: DataFrame) -> DataFrame:
    keys = touched.select(KEY)
    if not _few_keys(batch):
        keys = keys.hint("merge")
    kept = target.join(keys, KEY, "left_anti")
    return kept.select(*target.columns).unionByName(rows)


def _few_keys(batch: DataFrame) -> bool:
    """Whether the keys of ``batch`` are within the limits of a broadcast.

    The optimizer's estimate goes by the bytes of the files, not by what they unpack or explode to.
    """
    count, longest = batch.agg(F.approx_count_distinct(KEY), F.max(F.octet_length(KEY))).first()
    return count <= BROADCAST_KEYS and count * (longest or 0) <= BROADCAST_KEY_BYTES


def history(changes: DataFrame, max_task_rows: int | None = None) -> DataFrame:
    """Versions with the interval ``[valid_from, valid_to)`` in which each is current.

    A delete ends the version before it; of several changes at one instant the
    last arrival holds (no ``seq`` is the earliest; of several without, a live row and
    the greater name and stock). ``valid_to`` is null for a version still current.
    With a given ``max_task_rows``, or when the input is large, keys with more
    rows than that are split over tasks.
    """
    rows = changes.filter(F.col(KEY).isNotNull() & F.col(TIME).isNotNull())
    return current_spans(spans_of(rows, max_task_rows))


def spans_of(rows: DataFrame, max_task_rows: int | None = None) -> DataFrame:
    """Change rows, all with key and time, with ``valid_to``: the time of the key's next change."""
    hot = None
    if max_task_rows is not None or plan_bytes(rows) > SMALL_BYTES:
        hot = P.hot_keys(rows.select(KEY), max_task_rows or P.MAX_TASK_ROWS)
    if hot is None or hot.isEmpty():
        return _spans(rows, [KEY])
    keys = hot.select(KEY)
    return _spans(rows.join(keys, KEY, "left_anti"), [KEY]).unionByName(
        _spans_in_pieces(rows.join(keys, KEY, "left_semi"), max_task_rows or P.MAX_TASK_ROWS)
    )


def current_spans(spans: DataFrame) -> DataFrame:
    """Of rows with ``valid_to``, the live versions that were current at any time."""
    return (
        spans.filter(is_live())
        .filter(F.col("valid_to").isNull() | (F.col(TIME) < F.col("valid_to")))
        .select(KEY, "product_name", "stock", F.col(TIME).alias("valid_from"), "valid_to")
    )


def last_at_each_time(changes: DataFrame) -> DataFrame:
    """One change per key and time: the one that holds, by the rules of ``history``."""
    row = F.struct(*[c for c in changes.columns if c not in (KEY, TIME)])
    order = F.struct(*[c.alias(f"o{n}") for n, c in enumerate(_in_order()[1:])])
    return changes.groupBy(KEY, TIME).agg(F.max_by(row, order).alias("r")).select(KEY, TIME, "r.*")


def _in_order() -> list[Column]:
    return [F.col(TIME), F.col("seq"), is_live(), F.col("product_name"), F.col("stock"), F.col("op")]


def _spans(rows: DataFrame, by: list[str]) -> DataFrame:
    by_time = Window.partitionBy(*by).orderBy(*_in_order())
    return rows.withColumn("valid_to", F.lead(TIME).over(by_time))


def _spans_in_pieces(rows: DataFrame, max_task_rows: int) -> DataFrame:
    order = ["_live", "product_name", "stock", "op"]
    split = P.cut(rows.withColumn("_live", is_live()), [KEY, TIME, "seq", *order], max_task_rows).drop("_live")
    # The first change time after each piece of a key; one row per key and piece.
    firsts = split.groupBy(KEY, "piece").agg(F.min(TIME).alias("first_ts"))
    after = Window.partitionBy(KEY).orderBy("piece").rowsBetween(1, 1)
    following = firsts.select(KEY, "piece", F.first("first_ts").over(after).alias("after_ts"))
    return (
        _spans(split, [KEY, "piece"])
        .join(following, [KEY, "piece"])
        .withColumn("valid_to", F.coalesce("valid_to", "after_ts"))
        .drop("piece", "after_ts")
    )
