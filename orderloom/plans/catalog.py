"""Every query by name: the Spark form and, for the result check, its SQL form."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.functions.time import epoch_micros
from orderloom.functions.wire import key_text, raw_key
from orderloom.operators import changelog
from orderloom.operators.sizes import plan_bytes
from orderloom.operators.temporal import temporal_enrich
from orderloom.operators.windows import tumbling_counts
from orderloom.plans import derived as D
from orderloom.plans import files
from orderloom.schemas import (
    ENRICHED_ORDERS,
    ORDERS,
    PRODUCT_CHANGES,
    PRODUCT_WINDOW_COUNTS,
    PRODUCTS,
    SNAPSHOT_CHUNKS,
    Relation,
)
from orderloom.session import STREAM_CONFS, run_dir, session_confs
from orderloom.sources.csv_orders import ORDER_TS_TEXT, read_csv_orders, write_csv_orders
from orderloom.sources.keyed import KeyedLog
from orderloom.sources.logs import append_log, read_log
from orderloom.sources.zip_orders import read_zip_orders
from orderloom.streaming import accounts
from orderloom.streaming import pipeline as S
from orderloom.streaming.enrich import STATE
from orderloom.streaming.history import read_history, start_history
from orderloom.streaming.sinks import read_latest

Query = Callable[[SparkSession, str], DataFrame]

# When the snapshot of the change-capture queries was taken.
CUT = "2024-01-15 00:00:00"

# Rows per task used by the hot-key queries, small so that they split at any size
# of the given tables.
SPLIT_ROWS = 500

# Streaming queries replay the tables in consecutive runs: at least this many, and
# so many that one run takes no more than about this much input.
RUNS = 2
RUN_BYTES = 32 * 1024**3
STREAM_WINDOW = 60


# ---- logs -----------------------------------------------------------------


def orders_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = run_dir(spark, "orders_log")
    append_log(D.event_orders(spark, sf_dir), ORDERS, path)
    return read_log(spark, ORDERS, path)


def enriched_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = run_dir(spark, "enriched_log")
    append_log(temporal_enrich_events(spark, sf_dir), ENRICHED_ORDERS, path)
    return read_log(spark, ENRICHED_ORDERS, path)


def order_message_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = D.event_orders(spark, sf_dir).select(raw_key("product_id").alias("key"))
    return (
        messages.groupBy("key")
        .agg(F.count(F.lit(1)).alias("messages"))
        .select(F.hex("key").alias("key_hex"), key_text("key").alias("product_id"), "messages")
    )


# ---- change rows ----------------------------------------------------------


def products_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changelog.latest(D.event_changes(spark, sf_dir))


def products_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changelog.history(D.event_changes_with_deletes(spark, sf_dir))


def products_history_hot_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changelog.history(D.skewed_event_changes(spark, sf_dir), max_task_rows=SPLIT_ROWS)


def products_history_null_seq(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changelog.history(D.unnumbered_changes(spark, sf_dir), max_task_rows=SPLIT_ROWS // 25)


def _before_cut() -> Column:
    return F.col("last_updated_ts") < F.lit(CUT).cast("timestamp_ntz")


def _capture(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = D.event_changes_with_deletes(spark, sf_dir)
    snapshot = changelog.fold(changes.filter(_before_cut()))
    return changelog.snapshot_plus_log(snapshot, changes.filter(~_before_cut()))


def cdc_snapshot_plus_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _capture(spark, sf_dir)


def cdc_upsert_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changelog.fold(_capture(spark, sf_dir))


def cdc_incremental_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A snapshot in chunks, each taken at another position while the log went on."""
    chunks, log = D.snapshot_chunks(spark, sf_dir), D.log_from_start(spark, sf_dir)
    return changelog.fold(changelog.incremental_snapshot(chunks, log))


def upsert_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = D.event_changes(spark, sf_dir)
    target = changelog.fold(changes.filter(_before_cut()))
    return changelog.upsert(target, changes.filter(~_before_cut()))


def upsert_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = D.part_changes(spark, sf_dir)
    first = F.col("op") == "c"
    target = PRODUCTS.conform(changes.filter(first))
    return changelog.upsert(target, changes.filter(~first))


def upsert_new_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch of which half the keys are not in the table yet."""
    changes = D.part_changes(spark, sf_dir)
    first = F.col("op") == "c"
    target = PRODUCTS.conform(changes.filter(first & (F.col("stock") % 2 == 0)))
    return changelog.upsert(target, changes.filter(~first))


# ---- temporal join --------------------------------------------------------


def temporal_enrich_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return temporal_enrich(D.event_orders(spark, sf_dir), D.event_changes(spark, sf_dir))


def temporal_enrich_deletes(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = D.event_changes_with_deletes(spark, sf_dir)
    return temporal_enrich(D.event_orders(spark, sf_dir), changes)


def temporal_enrich_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return temporal_enrich(D.line_orders(spark, sf_dir), D.part_changes(spark, sf_dir))


def temporal_enrich_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = D.event_changes_with_deletes(spark, sf_dir)
    return temporal_enrich(D.event_orders(spark, sf_dir), changes, strategy="broadcast")


def temporal_enrich_hot_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return temporal_enrich(
        D.skewed_event_orders(spark, sf_dir),
        D.skewed_event_changes(spark, sf_dir),
        strategy="split",
        max_task_rows=SPLIT_ROWS,
    )


def temporal_enrich_keyed_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders and changes from a log in buckets of their key, appended in parts and compacted."""
    log = KeyedLog(spark, run_dir(spark, "keyed_log"), buckets=8)
    orders, changes = D.event_orders(spark, sf_dir), D.event_changes_with_deletes(spark, sf_dir)
    early = F.col("order_ts") < F.lit(CUT).cast("timestamp_ntz")
    for part in (early, ~early):
        log.append(orders.filter(part), ORDERS)
    for part in (_before_cut(), ~_before_cut()):
        log.append(changes.filter(part), PRODUCT_CHANGES)
    log.compact()
    return log.enriched()


def temporal_enrich_keyed_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with a third of the rows on one product, which leaves the buckets."""
    log = KeyedLog(spark, run_dir(spark, "keyed_log"), buckets=8)
    log.append(D.skewed_event_orders(spark, sf_dir), ORDERS)
    log.append(D.skewed_event_changes(spark, sf_dir), PRODUCT_CHANGES)
    log.compact()
    return log.enriched(max_task_rows=SPLIT_ROWS)


def _micros(strategy: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        orders, changes = D.dense_event_orders(spark, sf_dir), D.dense_event_changes(spark, sf_dir)
        return temporal_enrich(orders, changes, strategy, max_task_rows=SPLIT_ROWS)

    return run


# ---- window counts --------------------------------------------------------


def _counts(minutes: int) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return PRODUCT_WINDOW_COUNTS.conform(
            tumbling_counts(temporal_enrich_events(spark, sf_dir), minutes)
        )

    return run


def product_window_counts_hot_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tumbling_counts(temporal_enrich_hot_key(spark, sf_dir), 1440)


def product_window_counts_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tumbling_counts(temporal_enrich_lineitem(spark, sf_dir), 7 * 1440)


# ---- file ingest ----------------------------------------------------------


def _order_files(spark: SparkSession, sf_dir: str) -> str:
    path = run_dir(spark, "csv_orders")
    bad = files.bad_lines(D.event_changes(spark, sf_dir))
    files.write_order_files(D.event_orders(spark, sf_dir), bad, path)
    return path


def csv_orders_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_csv_orders(spark, _order_files(spark, sf_dir)).orders


def csv_orders_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_csv_orders(spark, _order_files(spark, sf_dir)).quarantine.select("line", "error")


def zip_orders_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = run_dir(spark, "zip_orders")
    files.write_zip_batches(D.event_orders(spark, sf_dir), path)
    return read_zip_orders(spark, path).orders


def zip_orders_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = run_dir(spark, "damaged_zips")
    files.write_damaged_zips(D.event_changes(spark, sf_dir), path)
    return _refused_of_zips(spark, path)


def _refused_of_zips(spark: SparkSession, path: str) -> DataFrame:
    refused = read_zip_orders(spark, path).quarantine
    archive = F.regexp_extract("path", files.ARCHIVE_NAME, 1)
    # What a codec says of damaged data is its own affair.
    error = F.regexp_replace("error", "lines: .*", "lines")
    return refused.select(archive.alias("archive"), "member", "line", error.alias("error"))


# ---- streams --------------------------------------------------------------


def _edges(df: DataFrame, ts: str, size: int) -> list[datetime]:
    """Inner bounds of the consecutive time spans to replay, with about as many rows in each."""
    runs = max(RUNS, -(-size // RUN_BYTES))
    shares = F.lit([i / runs for i in range(1, runs)])
    cuts = df.agg(F.percentile_approx(epoch_micros(ts), shares, 10_000)).first()[0]
    return [datetime(1970, 1, 1) + timedelta(microseconds=c) for c in sorted({*(cuts or [])})]


def _staged(df: DataFrame, relation: Relation, edges: list[datetime], path: str) -> list[DataFrame]:
    """``df`` written once, a folder per time span, and read back span by span."""
    # Rows without a time go with the first span.
    late = [F.col(relation.event_time) >= F.lit(e).cast("timestamp_ntz") for e in edges]
    number = sum((F.when(x, 1).otherwise(0) for x in late), F.lit(0))
    relation.conform(df).withColumn("span", number).write.partitionBy("span").parquet(path)
    with_span = T.StructType([*relation.schema.fields, T.StructField("span", T.IntegerType())])
    spans = df.sparkSession.read.schema(with_span).parquet(path)
    return [spans.filter(F.col("span") == i).drop("span") for i in range(len(edges) + 1)]


def _stream_confs(spark: SparkSession) -> dict[str, str]:
    """Stream settings, with a state partition for every core of the cluster."""
    return STREAM_CONFS | {"spark.sql.shuffle.partitions": str(spark.sparkContext.defaultParallelism)}


def _event_spans(spark: SparkSession, sf_dir: str, base: str) -> list[tuple[DataFrame, DataFrame]]:
    orders, changes = D.event_orders(spark, sf_dir), D.event_changes(spark, sf_dir)
    edges = _edges(orders, "order_ts", plan_bytes(orders) + plan_bytes(changes))
    return list(
        zip(
            _staged(orders, ORDERS, edges, f"{base}/staged_orders"),
            _staged(changes, PRODUCT_CHANGES, edges, f"{base}/staged_changes"),
        )
    )


def stream_window_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = run_dir(spark, "stream_window_counts")
    job = S.Job("", "", f"{base}/job", window_minutes=STREAM_WINDOW)
    enriched = enriched_log(spark, sf_dir)
    edges = _edges(enriched, "order_ts", plan_bytes(enriched))
    with session_confs(spark, _stream_confs(spark)):
        for span in _staged(enriched, ENRICHED_ORDERS, edges, f"{base}/staged"):
            append_log(span, ENRICHED_ORDERS, job.log(ENRICHED_ORDERS))
            S.start_counts(spark, job, S.AVAILABLE_NOW).awaitTermination()
    return read_log(spark, PRODUCT_WINDOW_COUNTS, job.log(PRODUCT_WINDOW_COUNTS))


def _replay(spark: SparkSession, sf_dir: str, name: str, start: Callable) -> S.Job:
    """Feed the event tables span by span to one query of the job."""
    base = run_dir(spark, name)
    job = S.Job("", "", f"{base}/job", window_minutes=STREAM_WINDOW)
    with session_confs(spark, _stream_confs(spark)):
        for orders, changes in _event_spans(spark, sf_dir, base):
            S.append_orders(job, orders)
            append_log(changes, PRODUCT_CHANGES, job.log(PRODUCT_CHANGES))
            start(spark, job, S.AVAILABLE_NOW).awaitTermination()
    return job


def stream_temporal_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    job = _replay(spark, sf_dir, "stream_temporal_enrich", S.start_enriched)
    return S.read_enriched(spark, job)


def _replay_in_two(spark: SparkSession, base: str, job: S.Job, orders: DataFrame, changes: DataFrame, between: Callable) -> DataFrame:
    """Feed tables span by span to the join; ``between`` follows the first span."""
    edges = _edges(orders, "order_ts", plan_bytes(orders) + plan_bytes(changes))
    spans = zip(
        _staged(orders, ORDERS, edges, f"{base}/staged_orders"),
        _staged(changes, PRODUCT_CHANGES, edges, f"{base}/staged_changes"),
    )
    with session_confs(spark, _stream_confs(spark)):
        for number, (some_orders, some_changes) in enumerate(spans):
            S.append_orders(job, some_orders)
            append_log(some_changes, PRODUCT_CHANGES, job.log(PRODUCT_CHANGES))
            if number == 0:
                between(spark, job)
            else:
                S.start_enriched(spark, job, S.AVAILABLE_NOW).awaitTermination()
    return S.read_enriched(spark, job)


def stream_enrich_handover(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A backlog enriched as a batch, whose results a stream goes on from."""
    base = run_dir(spark, "stream_enrich_handover")
    orders, changes = D.event_orders(spark, sf_dir), D.event_changes(spark, sf_dir)
    return _replay_in_two(spark, base, S.Job("", "", f"{base}/job"), orders, changes, S.hand_over)


def join_state_handed_over(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the join must still know behind a backlog: waiting orders, and versions an order can need."""
    job = S.Job("", "", f"{run_dir(spark, 'join_state_handed_over')}/job")
    S.append_orders(job, D.event_orders(spark, sf_dir))
    append_log(D.event_changes_with_deletes(spark, sf_dir), PRODUCT_CHANGES, job.log(PRODUCT_CHANGES))
    held = S.hand_over(spark, job)
    state = spark.read.schema(STATE).parquet(held.state)
    return state.select(
        "product_id", "kind", "order_id", "product_name", F.when(F.col("numbered"), F.col("number")).alias("number"),
        F.timestamp_add("MICROSECOND", F.col("us"), F.lit("1970-01-01").cast("timestamp_ntz")).alias("ts"),
    )


def stream_enrich_rebuilt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A join whose state is laid out anew on the way, from four groups a product to eight."""
    base = run_dir(spark, "stream_enrich_rebuilt")

    def rebuild(spark: SparkSession, job: S.Job) -> None:
        S.start_enriched(spark, replace(job, spread=4), S.AVAILABLE_NOW).awaitTermination()
        S.rebuild_enriched(spark, job, spread=8)

    orders, changes = D.event_orders(spark, sf_dir), D.event_changes(spark, sf_dir)
    return _replay_in_two(spark, base, S.Job("", "", f"{base}/job"), orders, changes, rebuild)


def stream_enrich_hot_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of the orders on one product: it alone is spread, by the heat measured at the start."""
    base = run_dir(spark, "stream_enrich_hot_key")

    def start(spark: SparkSession, job: S.Job) -> None:
        S.start_enriched(spark, job, S.AVAILABLE_NOW).awaitTermination()

    orders, changes = D.skewed_event_orders(spark, sf_dir), D.skewed_event_changes(spark, sf_dir)
    return _replay_in_two(spark, base, S.Job("", "", f"{base}/job"), orders, changes, start)


def stream_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    job = _replay(spark, sf_dir, "stream_pipeline", S.start_chained)
    return read_log(spark, PRODUCT_WINDOW_COUNTS, job.log(PRODUCT_WINDOW_COUNTS))


def pipeline_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = run_dir(spark, "pipeline_counts")
    job = S.Job(f"{base}/orders_in", f"{base}/changes_in", f"{base}/job", window_minutes=STREAM_WINDOW)
    with session_confs(spark, _stream_confs(spark)):
        for orders, changes in _event_spans(spark, sf_dir, base):
            write_csv_orders(orders, job.order_files)
            append_log(changes, PRODUCT_CHANGES, job.change_files)
            S.run_available(spark, job)
    return S.read_counts(spark, job)


def pipeline_products_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest table of the job: a snapshot, then the changes in two runs, with deletes."""
    base = run_dir(spark, "pipeline_products_latest")
    job = S.Job("", f"{base}/changes_in", f"{base}/job", snapshot=f"{base}/snapshot")
    changes = D.event_changes_with_deletes(spark, sf_dir)
    append_log(changelog.fold(changes.filter(_before_cut())), PRODUCTS, job.snapshot)
    rest = changes.filter(~_before_cut())
    edges = _edges(rest, "last_updated_ts", 0)
    with session_confs(spark, _stream_confs(spark)):
        for span in _staged(rest, PRODUCT_CHANGES, edges, f"{base}/staged"):
            append_log(span, PRODUCT_CHANGES, job.change_files)
            S.start_products(spark, job, S.AVAILABLE_NOW).awaitTermination()
            S.start_latest_products(spark, job, S.AVAILABLE_NOW).awaitTermination()
    return read_latest(spark, job.latest)


# Files that the out-of-order queries are read in.
PARTS = 4


def _scrambled(df: DataFrame, key: str, path: str, append: Callable[[DataFrame], None]) -> None:
    """``df`` in PARTS appends, dealt by a number so that each holds rows of all times."""
    part = F.pmod(F.xxhash64(key), F.lit(PARTS)).cast("int")
    df.withColumn("part", part).write.partitionBy("part").parquet(path)
    for i in range(PARTS):
        append(df.sparkSession.read.schema(df.schema).parquet(f"{path}/part={i}").coalesce(1))


def pipeline_latest_out_of_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest table from a snapshot and changes in files of no order, one file at a time."""
    base = run_dir(spark, "pipeline_latest_out_of_order")
    job = S.Job("", f"{base}/changes_in", f"{base}/job", snapshot=f"{base}/snapshot", max_files=1)
    changes = D.event_changes_with_deletes(spark, sf_dir)
    snapshot, rest = changelog.fold(changes.filter(_before_cut())), changes.filter(~_before_cut())
    _scrambled(snapshot, "product_id", f"{base}/staged_rows", lambda df: append_log(df, PRODUCTS, job.snapshot))
    _scrambled(rest, "seq", f"{base}/staged_changes", lambda df: append_log(df, PRODUCT_CHANGES, job.change_files))
    with session_confs(spark, _stream_confs(spark)):
        S.start_products(spark, job, S.AVAILABLE_NOW).awaitTermination()
        S.start_latest_products(spark, job, S.AVAILABLE_NOW).awaitTermination()
    return read_latest(spark, job.latest)


def pipeline_chunked_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest table of the job from a snapshot in chunks beside the log, one file at a time."""
    base = run_dir(spark, "pipeline_chunked_snapshot")
    job = S.Job("", f"{base}/changes_in", f"{base}/job", chunks=f"{base}/chunks", max_files=1)
    chunks, log = D.snapshot_chunks(spark, sf_dir), D.log_from_start(spark, sf_dir)
    _scrambled(chunks, "product_id", f"{base}/staged_rows", lambda df: append_log(df, SNAPSHOT_CHUNKS, job.chunks))
    _scrambled(log, "seq", f"{base}/staged_changes", lambda df: append_log(df, PRODUCT_CHANGES, job.change_files))
    with session_confs(spark, _stream_confs(spark)):
        S.start_products(spark, job, S.AVAILABLE_NOW).awaitTermination()
        S.start_latest_products(spark, job, S.AVAILABLE_NOW).awaitTermination()
    return read_latest(spark, job.latest)


def stream_products_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The history kept up to date with changes that come late and at equal times."""
    base = run_dir(spark, "stream_products_history")
    log, path = f"{base}/changes", f"{base}/history"
    changes = D.skewed_event_changes(spark, sf_dir)
    _scrambled(changes, "seq", f"{base}/staged", lambda df: append_log(df, PRODUCT_CHANGES, log))
    with session_confs(spark, _stream_confs(spark)):
        stream = spark.readStream.schema(PRODUCT_CHANGES.schema).option("maxFilesPerTrigger", 2).parquet(log)
        start_history(stream, path, f"{base}/checkpoint", S.AVAILABLE_NOW).awaitTermination()
    return read_history(spark, path)


def pipeline_accounting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What became of every line, in two runs of the job: refused, without a key, late and so on.

    Every fortieth order has no product; every fiftieth of the first run comes in the second.
    """
    base = run_dir(spark, "pipeline_accounting")
    job = S.Job(f"{base}/orders_in", f"{base}/changes_in", f"{base}/job", window_minutes=STREAM_WINDOW)
    orders, changes = D.event_orders(spark, sf_dir), D.event_changes_with_deletes(spark, sf_dir)
    number = F.col("order_id").cast("bigint")
    early = F.col("order_ts") < F.lit(CUT).cast("timestamp_ntz")
    product = F.when(number % 40 == 3, "").otherwise(F.col("product_id"))
    time = F.date_format("order_ts", ORDER_TS_TEXT)
    lines = orders.select(
        F.concat_ws(",", "order_id", product, "quantity", time).alias("line"), (early & (number % 50 != 7)).alias("first")
    ).unionByName(
        changes.select(F.concat_ws(",", "seq", "product_id").alias("line"), _before_cut().alias("first"))
    )
    with session_confs(spark, _stream_confs(spark)):
        for first in (True, False):
            lines.filter(F.col("first") == first).select("line").write.mode("append").text(job.order_files)
            append_log(changes.filter(_before_cut() == first), PRODUCT_CHANGES, job.change_files)
            S.run_available(spark, job)
    return accounts.totals(accounts.read(spark, job.accounts))


QUERIES: dict[str, Query] = {
    "orders_log": orders_log,
    "order_message_keys": order_message_keys,
    "products_latest": products_latest,
    "products_history": products_history,
    "products_history_hot_key": products_history_hot_key,
    "products_history_null_seq": products_history_null_seq,
    "cdc_snapshot_plus_log": cdc_snapshot_plus_log,
    "cdc_upsert_fold": cdc_upsert_fold,
    "cdc_incremental_snapshot": cdc_incremental_snapshot,
    "upsert_products": upsert_products,
    "upsert_parts": upsert_parts,
    "upsert_new_parts": upsert_new_parts,
    "temporal_enrich": temporal_enrich_events,
    "temporal_enrich_deletes": temporal_enrich_deletes,
    "temporal_enrich_lineitem": temporal_enrich_lineitem,
    "temporal_enrich_history": temporal_enrich_history,
    "temporal_enrich_hot_key": temporal_enrich_hot_key,
    "temporal_enrich_micros": _micros("shuffle"),
    "temporal_enrich_micros_split": _micros("split"),
    "temporal_enrich_micros_broadcast": _micros("broadcast"),
    "temporal_enrich_keyed_logs": temporal_enrich_keyed_logs,
    "temporal_enrich_keyed_hot": temporal_enrich_keyed_hot,
    "enriched_log": enriched_log,
    "product_window_counts": _counts(5),
    "product_window_counts_7m": _counts(7),
    "product_window_counts_60m": _counts(60),
    "product_window_counts_1d": _counts(1440),
    "product_window_counts_lineitem": product_window_counts_lineitem,
    "product_window_counts_hot_key": product_window_counts_hot_key,
    "csv_orders_ingest": csv_orders_ingest,
    "csv_orders_quarantine": csv_orders_quarantine,
    "zip_orders_ingest": zip_orders_ingest,
    "zip_orders_quarantine": zip_orders_quarantine,
    "stream_window_counts": stream_window_counts,
    "stream_temporal_enrich": stream_temporal_enrich,
    "stream_pipeline": stream_pipeline,
    "pipeline_counts": pipeline_counts,
    "pipeline_products_latest": pipeline_products_latest,
    "pipeline_latest_out_of_order": pipeline_latest_out_of_order,
    "pipeline_chunked_snapshot": pipeline_chunked_snapshot,
    "stream_products_history": stream_products_history,
    "stream_enrich_handover": stream_enrich_handover,
    "stream_enrich_rebuilt": stream_enrich_rebuilt,
    "join_state_handed_over": join_state_handed_over,
    "stream_enrich_hot_key": stream_enrich_hot_key,
    "pipeline_accounting": pipeline_accounting,
}
