"""The whole job: four inserts over file logs, each a restartable streaming query.

    snapshot, product changes ─► products log ─┬─► latest table
    order files ─► orders log ─────────────────┴─► enriched log ─► window counts

An order file is decoded once: orders and refused lines go to one log, told apart by
its partitions. A stream takes all files that are new at a trigger as one batch, or
``max_files`` of them, oldest first. Files that cover the same times must be read together,
or the watermark of the first would make rows of the next late.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, replace
from datetime import datetime, timedelta
from functools import reduce

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from orderloom.functions.stores import store_of
from orderloom.functions.time import truncate_ms
from orderloom.operators import heat
from orderloom.operators.changelog import incremental_snapshot, snapshot_plus_log
from orderloom.operators.temporal import temporal_enrich
from orderloom.operators.windows import DEFAULT_WINDOW_MINUTES, tumbling_counts
from orderloom.schemas import (
    ENRICHED_ORDERS,
    INTAKE,
    ORDERS,
    PRODUCT_CHANGES,
    PRODUCT_WINDOW_COUNTS,
    PRODUCTS,
    SNAPSHOT_CHUNKS,
    Relation,
)
from orderloom.session import STREAM_CONFS, session_confs
from orderloom.sources.csv_orders import Ingest, split_lines, stream_csv_intake
from orderloom.sources.logs import append_log, read_log, with_event_time
from orderloom.sources.zip_orders import stream_zip_intake
from orderloom.streaming import accounts, layout
from orderloom.streaming.enrich import DEFAULT_SPREAD, STATE, kept_state, state_of, temporal_enrich_stream
from orderloom.streaming.layout import Layout, LayoutChanged
from orderloom.streaming.sinks import start_latest, start_log

AVAILABLE_NOW = {"availableNow": True}

WATERMARK_SECONDS = timedelta(seconds=1)

# Seconds between looks for new files.
POLL = {"processingTime": "10 seconds"}


@dataclass(frozen=True)
class Job:
    """Where the job reads and writes, and its parameters.

    ``order_files`` holds CSV files, or zip archives with ``zipped=True``.
    ``change_files`` holds product change rows as Parquet, and ``snapshot``, if given,
    the product rows as they were before the first change; ``chunks`` holds a snapshot that was
    read in chunks while changes went on (SNAPSHOT_CHUNKS). They may be read in any order and cut: the
    latest table goes by position. ``settled`` is that of ``upsert_latest``. Logs and
    checkpoints go under ``base``, which all executors must reach.

    ``archive`` names a folder, outside that of the order files, to which order files move once they
    are logged, so that the input folder stays bounded; ``delete`` removes them instead.

    ``spread`` gives every product so many state groups. Without it, the join's first start measures
    in the orders log which products are hot and spreads these; later starts keep that. State
    is laid out for ``spread`` and ``window_minutes``: a start with others is refused.
    """

    order_files: str
    change_files: str
    base: str
    zipped: bool = False
    window_minutes: int = DEFAULT_WINDOW_MINUTES
    spread: int | None = None
    snapshot: str | None = None
    chunks: str | None = None
    settled: int | None = None
    archive: str | None = None
    max_files: int | None = None

    def log(self, relation: Relation, generation: int = 0) -> str:
        return f"{self.base}/{relation.name}" + (f"@{generation}" if generation else "")

    @property
    def accounts(self) -> str:
        return f"{self.base}/accounts"

    @property
    def latest(self) -> str:
        return f"{self.base}/latest"

    def checkpoint(self, name: str) -> str:
        return f"{self.base}/_checkpoints/{name}"


def start_products(spark: SparkSession, job: Job, trigger: dict) -> StreamingQuery:
    """Insert 1: the snapshot, then product changes, into the keyed products log."""
    with session_confs(spark, STREAM_CONFS):
        changes = _files(spark, PRODUCT_CHANGES, job.change_files, job)
        if job.snapshot:
            changes = snapshot_plus_log(_files(spark, PRODUCTS, job.snapshot, job), changes)
        if job.chunks:
            changes = incremental_snapshot(_files(spark, SNAPSHOT_CHUNKS, job.chunks, job), changes)
        time = PRODUCT_CHANGES.event_time
        return _to_log(job, changes.withColumn(time, truncate_ms(time)), PRODUCT_CHANGES, trigger)


def start_latest_products(spark: SparkSession, job: Job, trigger: dict) -> StreamingQuery:
    """Insert 1, the upserted table: the latest row of every product in the log."""
    with session_confs(spark, STREAM_CONFS):
        changes = _files(spark, PRODUCT_CHANGES, job.log(PRODUCT_CHANGES), job)
        return start_latest(changes, job.latest, job.checkpoint("latest"), trigger, job.settled)


def start_orders(spark: SparkSession, job: Job, trigger: dict) -> StreamingQuery:
    """Insert 2: order files into the orders log, refused lines in a partition of their own."""
    with session_confs(spark, STREAM_CONFS):
        read = stream_zip_intake if job.zipped else stream_csv_intake
        intake = read(spark, job.order_files, job.max_files, job.archive).observe(
            accounts.INTAKE, F.count(F.lit(1)).alias("lines"), F.count_if(F.col("refused")).alias("refused")
        )
        return start_log(intake, INTAKE, job.log(ORDERS), job.checkpoint(ORDERS.name), trigger, by="refused")


def append_orders(job: Job, orders: DataFrame) -> None:
    """Put orders into the log directly; not beside ``start_orders``, whose readers follow its list of files."""
    store, inner = store_of(f"{job.log(ORDERS)}/_spark_metadata")
    if store.get_file_info(inner).type != fs.FileType.NotFound:
        raise ValueError("the orders log belongs to a stream, and files put beside its own are not read")
    others = {f.name: F.lit(None).cast(f.dataType) for f in INTAKE.schema.fields[len(ORDERS.columns):]}
    rows = ORDERS.conform(orders).withColumns(others | {"refused": F.lit(False)})
    rows.write.mode("append").partitionBy("refused").parquet(job.log(ORDERS))


def read_intake(spark: SparkSession, job: Job) -> Ingest:
    """The orders and the refused lines in the log."""
    return split_lines(spark.read.schema(INTAKE.schema).parquet(job.log(ORDERS)))


def _files(spark: SparkSession, relation: Relation, path: str, job: Job) -> DataFrame:
    reader = spark.readStream.schema(relation.schema)
    if job.max_files:
        reader = reader.option("maxFilesPerTrigger", job.max_files)
    return reader.parquet(path)


def enriched_layout(spark: SparkSession, job: Job) -> Layout:
    """The join's layout: the recorded one, or at the first start one that is recorded now."""
    name = ENRICHED_ORDERS.name
    held = layout.read(job.base, name)
    if held is not None:
        return layout.check(name, held, {"spread": job.spread})
    return layout.write(job.base, name, _measured(spark, job, Layout({})))


def _measured(spark: SparkSession, job: Job, held: Layout, spread: int | None = None) -> Layout:
    """``held`` with the asked spread, or else that of the heat of the orders logged so far."""
    spread = spread or job.spread
    if spread:
        return replace(held, settings={"spread": spread}, spreads={})
    shares = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sketched = heat.sketch(read_orders(spark, job), "product_id") if _holds_files(job.log(ORDERS)) else None
    if sketched is None or not sketched.first()["rows"]:
        return replace(held, settings={"spread": DEFAULT_SPREAD}, spreads={})
    return replace(held, settings={"spread": "by heat", "shares": shares}, spreads=heat.spreads(sketched, shares))


def _holds_files(path: str) -> bool:
    store, inner = store_of(path)
    return bool(store.get_file_info(fs.FileSelector(inner, allow_not_found=True)))


def _spread(held: Layout) -> int | dict[str, int]:
    spread = held.settings["spread"]
    return spread if isinstance(spread, int) else held.spreads


def read_orders(spark: SparkSession, job: Job) -> DataFrame:
    """The orders in the log, without refused lines."""
    return read_intake(spark, job).orders


def _unseen(df: DataFrame, held: Layout, source: str, time: str) -> DataFrame:
    """A log's stream without the files and times that an earlier generation has dealt with."""
    if held.seen:
        seen = df.sparkSession.read.schema("path string").parquet(f"{held.seen}/{source}")
        df = df.withColumn("_path", F.col("_metadata.file_path"))
        df = df.join(F.broadcast(seen.withColumnRenamed("path", "_path")), "_path", "left_anti").drop("_path")
    if held.after is not None:
        df = df.filter(F.unix_micros(F.col(time).cast("timestamp")) > held.after)
    return df


def _joined(spark: SparkSession, job: Job, held: Layout) -> DataFrame:
    intake = _unseen(_files(spark, INTAKE, job.log(ORDERS), job), held, "orders", "order_ts")
    changes = _files(spark, PRODUCT_CHANGES, job.log(PRODUCT_CHANGES), job)
    changes = _unseen(changes, held, "changes", "last_updated_ts")
    state = spark.read.schema(STATE).parquet(held.state) if held.state else None
    orders = split_lines(intake).orders
    keyed = F.col("product_id").isNotNull() & F.col("order_ts").isNotNull()
    orders = orders.observe(accounts.ENTERED, F.count(F.lit(1)).alias("orders"), F.count_if(keyed).alias("keyed"))
    return temporal_enrich_stream(
        with_event_time(orders, ORDERS),
        with_event_time(changes, PRODUCT_CHANGES),
        _spread(held),
        state,
        accounts.JOINED,
    )


def start_enriched(spark: SparkSession, job: Job, trigger: dict) -> StreamingQuery:
    """Insert 3: orders joined with the product version of their time."""
    with session_confs(spark, STREAM_CONFS):
        held = enriched_layout(spark, job)
        return _to_log(job, _joined(spark, job, held), ENRICHED_ORDERS, trigger, held.generation)


def read_enriched(spark: SparkSession, job: Job) -> DataFrame:
    """The enriched orders of all generations."""
    held = layout.read(job.base, ENRICHED_ORDERS.name) or Layout({})
    logs = [job.log(ENRICHED_ORDERS, g) for g in range(held.generation + 1)]
    found = [read_log(spark, ENRICHED_ORDERS, path) for path in logs if _holds_files(path)]
    return reduce(DataFrame.unionByName, found, spark.createDataFrame([], ENRICHED_ORDERS.schema))


def _counts_settings(job: Job) -> dict:
    enriched = layout.read(job.base, ENRICHED_ORDERS.name)
    return {"window_minutes": job.window_minutes, "inputs": enriched.generation + 1 if enriched else 1}


def start_counts(spark: SparkSession, job: Job, trigger: dict) -> StreamingQuery:
    """Insert 4: final counts of closed windows from the enriched log."""
    with session_confs(spark, STREAM_CONFS):
        name, settings = PRODUCT_WINDOW_COUNTS.name, _counts_settings(job)
        held = layout.read(job.base, name) or layout.write(job.base, name, Layout(settings))
        layout.check(name, held, settings)
        logs = [job.log(ENRICHED_ORDERS, g) for g in range(held.settings["inputs"])]
        enriched = reduce(DataFrame.unionByName, [_files(spark, ENRICHED_ORDERS, path, job) for path in logs])
        counts = tumbling_counts(with_event_time(enriched, ENRICHED_ORDERS), job.window_minutes)
        return _to_log(job, counts, PRODUCT_WINDOW_COUNTS, trigger, held.generation)


def read_counts(spark: SparkSession, job: Job) -> DataFrame:
    """The window counts of the last generation."""
    held = layout.read(job.base, PRODUCT_WINDOW_COUNTS.name) or Layout({})
    return read_log(spark, PRODUCT_WINDOW_COUNTS, job.log(PRODUCT_WINDOW_COUNTS, held.generation))


def start_chained(spark: SparkSession, job: Job, trigger: dict) -> StreamingQuery:
    """Inserts 3 and 4 as one query, without the log in between."""
    with session_confs(spark, STREAM_CONFS):
        name = "chained"
        held = layout.read(job.base, name)
        if held is None:
            made = _measured(spark, job, Layout({}))
            made.settings["window_minutes"] = job.window_minutes
            held = layout.write(job.base, name, made)
        layout.check(name, held, {"spread": job.spread, "window_minutes": job.window_minutes})
        counts = tumbling_counts(_joined(spark, job, held), job.window_minutes)
        return _to_log(job, counts, PRODUCT_WINDOW_COUNTS, trigger)


# ---- new generations ------------------------------------------------------


def hand_over(spark: SparkSession, job: Job, spread: int | None = None) -> Layout:
    """Enrich the backlog in the logs as a batch, and let the stream go on from there.

    The orders that a stream would have put out after reading the logs, those up to a second before the
    slower side's last time, are joined as a batch into the enriched log. Later orders and the versions
    still needed become the first state of the stream, which reads only what is logged from
    now on. Nothing may write to the logs meanwhile, and the join must not have run yet.
    """
    name = ENRICHED_ORDERS.name
    if layout.read(job.base, name) is not None:
        raise LayoutChanged(f"{name} has state already; rebuild it instead")
    with session_confs(spark, STREAM_CONFS):
        orders, changes = read_orders(spark, job), read_log(spark, PRODUCT_CHANGES, job.log(PRODUCT_CHANGES))
        cut = _reached(orders, changes)
        made = _measured(spark, job, Layout({}), spread)
        if cut is not None:
            # As text, the time is the same in any zone.
            at = F.lit(cut.isoformat(sep=" ")).cast("timestamp_ntz")
            done = temporal_enrich(orders.filter(F.col("order_ts") <= at), changes)
            append_log(done, ENRICHED_ORDERS, job.log(ENRICHED_ORDERS))
            made = _generation(spark, job, made, state_of(orders, changes, at), cut)
        return layout.write(job.base, name, made)


def rebuild_enriched(spark: SparkSession, job: Job, spread: int | None = None) -> Layout:
    """Lay the join's state out anew: for ``spread``, or for the heat of the orders logged so far.

    Its query, and those that write its input, must be stopped. It first takes what is logged with
    its old layout; its state is then read from the checkpoint, dealt anew, and
    becomes the first state of a new generation with a log of its own (``read_enriched`` reads all).
    Counts that were started on the old generations alone need ``rebuild_counts``.
    """
    name = ENRICHED_ORDERS.name
    held = layout.read(job.base, name)
    if held is None:
        raise LayoutChanged(f"{name} has no state to rebuild")
    start_enriched(spark, replace(job, spread=None), AVAILABLE_NOW).awaitTermination()
    with session_confs(spark, STREAM_CONFS):
        orders, changes = read_orders(spark, job), read_log(spark, PRODUCT_CHANGES, job.log(PRODUCT_CHANGES))
        state = kept_state(spark, job.checkpoint(held.name(name)))
        made = _measured(spark, replace(job, spread=None), held, spread)
        return layout.write(job.base, name, _generation(spark, job, made, state, _reached(orders, changes)))


def rebuild_counts(spark: SparkSession, job: Job) -> Layout:
    """Count the enriched log anew, for the job's window size and all generations of the log.

    The next start of the counts has a checkpoint and a log of its own; the log keeps all orders, so no
    count is lost. ``read_counts`` reads the new log.
    """
    name, settings = PRODUCT_WINDOW_COUNTS.name, _counts_settings(job)
    held = layout.read(job.base, name)
    made = Layout(settings) if held is None else layout.next_of(held, settings=settings)
    return layout.write(job.base, name, made)


def _reached(orders: DataFrame, changes: DataFrame) -> datetime | None:
    """Where the watermark stands once all is read: a second before the slower side's last time."""
    last = [
        df.filter(F.col("product_id").isNotNull()).agg(F.max(r.event_time)).first()[0]
        for df, r in ((orders, ORDERS), (changes, PRODUCT_CHANGES))
    ]
    return None if None in last else min(last) - WATERMARK_SECONDS


def _generation(spark: SparkSession, job: Job, held: Layout, state: DataFrame, cut: datetime | None) -> Layout:
    """The generation after ``held``, from a state, with the logs' files of now listed as seen."""
    made = layout.next_of(held)
    at = f"{job.base}/_layouts/{made.name(ENRICHED_ORDERS.name)}-{uuid.uuid4().hex}"
    state.write.parquet(f"{at}/state")
    logs = {"orders": (INTAKE, job.log(ORDERS)), "changes": (PRODUCT_CHANGES, job.log(PRODUCT_CHANGES))}
    for source, (relation, path) in logs.items():
        rows = spark.read.schema(relation.schema).parquet(path)
        rows.select(F.col("_metadata.file_path").alias("path")).distinct().write.parquet(f"{at}/seen/{source}")
    after = None if cut is None else round((cut - datetime(1970, 1, 1)) / timedelta(microseconds=1))
    return replace(made, state=f"{at}/state", seen=f"{at}/seen", after=after)


def _to_log(job: Job, df: DataFrame, relation: Relation, trigger: dict, generation: int = 0) -> StreamingQuery:
    name = Layout({}, generation).name(relation.name)
    return start_log(df, relation, job.log(relation, generation), job.checkpoint(name), trigger)


def start_all(spark: SparkSession, job: Job) -> list[StreamingQuery]:
    """Start every insert and keep them running; wait with ``awaitAnyTermination``.

    Row accounts are written under ``job.accounts`` while they run.
    """
    spark.streams.addListener(accounts.Accounts(job.accounts))
    return [
        start_products(spark, job, POLL),
        start_orders(spark, job, POLL),
        start_latest_products(spark, job, POLL),
        start_enriched(spark, job, POLL),
        start_counts(spark, job, POLL),
    ]


def run_available(spark: SparkSession, job: Job) -> None:
    """Bring every log up to date with the files that are there now, then stop."""
    for starts in ([start_products, start_orders], [start_latest_products, start_enriched], [start_counts]):
        for query in [start(spark, job, AVAILABLE_NOW) for start in starts]:
            query.awaitTermination()
            accounts.keep(job.accounts, query)
