"""Session settings and the shared working folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import time
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import SparkSession

from orderloom.functions.stores import store_of

BATCH_CONFS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

STREAM_CONFS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    # Write deltas instead of full state snapshots with every batch.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # An order waits for the slower of the two inputs.
    "spark.sql.streaming.multipleWatermarkPolicy": "min",
}


# Folders of local sessions that name none, by application.
_LOCAL_DIRS: dict[str, str] = {}


def get_spark(app_name: str = "orderloom", master: str | None = None, **confs: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**BATCH_CONFS, **STREAM_CONFS, **confs}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def session_confs(spark: SparkSession, confs: Mapping[str, str]) -> Iterator[None]:
    """Set runtime settings and put the caller's back on exit.

    A streaming query copies the session settings when it starts, so they only
    need to hold around ``start()``.
    """
    before = {key: spark.conf.get(key, None) for key in confs}
    for key, value in confs.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by the cluster.

    In local mode, as in tests, a missing setting is filled with a folder that goes when the
    process ends. On a cluster it must be set.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    context = spark.sparkContext
    if context.master.split("[")[0] == "local":
        if context.applicationId not in _LOCAL_DIRS:
            made = tempfile.mkdtemp(prefix="orderloom-")
            atexit.register(shutil.rmtree, made, ignore_errors=True)
            _LOCAL_DIRS[context.applicationId] = made
        return _LOCAL_DIRS[context.applicationId]
    raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")


def run_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder under the shared folder; never reused between runs."""
    return f"{shared_dir(spark)}/orderloom/{label}-{uuid.uuid4().hex}"


def clear_runs(spark: SparkSession, older_than_hours: float = 24.0) -> int:
    """Remove the run folders last written so long ago; results read from them are lost.

    Results are read when they are used, so no query can remove its own folders.
    """
    from pyarrow import fs

    store, inner = store_of(f"{shared_dir(spark)}/orderloom")
    gone = 0
    for info in store.get_file_info(fs.FileSelector(inner, allow_not_found=True)):
        files = store.get_file_info(fs.FileSelector(info.path, recursive=True))
        written = max((f.mtime_ns or 0 for f in [info, *files]), default=0) / 1e9
        if time.time() - written >= older_than_hours * 3600:
            store.delete_dir(info.path)
            gone += 1
    return gone
