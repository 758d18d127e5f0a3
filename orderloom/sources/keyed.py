"""Orders and product changes in one log, its files shaped by the message key.

Rows lie in buckets by the hash of the key, so the temporal join reads each bucket where it is and
shuffles nothing. Appends add small files to the buckets; ``compact`` writes one file a bucket
into a new version of the log, and a record names the version that holds.

A bucket is the work of one task. Keys that would fill more than their share of it are hot: a sketch
of the rows finds them, compaction moves their rows to a part without buckets, later appends put
them there, and the join splits them over tasks by time.
"""

from __future__ import annotations

import hashlib
import json
import uuid

from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.functions.stores import store_of
from orderloom.operators import heat
from orderloom.operators.pieces import MAX_TASK_ROWS
from orderloom.operators.temporal import enrich_log
from orderloom.schemas import ENRICHED_ORDERS, ORDERS, PRODUCT_CHANGES, Relation

BUCKETS = 64
KEY = "product_id"
_CHANGE, _ORDER = 0, 1
_DDL = (
    "product_id string, t timestamp_ntz, side int, order_id string, quantity int, product_name string, "
    "stock int, op string, seq bigint"
)
_NAMES = [c.split(" ")[0] for c in _DDL.split(", ")]


class KeyedLog:
    """A log under a shared folder. Appends and compaction are for one writer at a time."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self.at = self._record() or {"version": 0, "buckets": buckets, "hot": []}
        if self.at["buckets"] != buckets:
            raise ValueError(f"the log has {self.at['buckets']} buckets")

    def _record(self) -> dict | None:
        store, inner = store_of(f"{self.path}/current.json")
        if store.get_file_info(inner).type != fs.FileType.File:
            return None
        with store.open_input_stream(inner) as body:
            return json.loads(body.read())

    def _write_record(self, at: dict) -> None:
        store, inner = store_of(f"{self.path}/current.json")
        store.create_dir(inner.rpartition("/")[0], recursive=True)
        aside = f"{inner}.{uuid.uuid4().hex}"
        with store.open_output_stream(aside, compression=None) as out:
            out.write(json.dumps(at).encode())
        store.move(aside, inner)
        self.at = at

    def _table(self, version: int) -> str:
        """The catalog's name of a version's buckets; only there can Spark learn how files are bucketed."""
        name = f"keyed_{hashlib.md5(self.path.encode()).hexdigest()[:16]}_{version}"
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({_DDL}) USING parquet CLUSTERED BY ({KEY}) SORTED BY (t) "
            f"INTO {self.at['buckets']} BUCKETS LOCATION '{self.path}/version={version}/keyed'"
        )
        return name

    def _hot_path(self, version: int) -> str:
        return f"{self.path}/version={version}/hot"

    def _is_hot(self, hot: list[str]) -> Column:
        return F.col(KEY).isin(hot) if hot else F.lit(False)

    def _put(self, rows: DataFrame, version: int, hot: list[str]) -> None:
        is_hot = F.coalesce(self._is_hot(hot), F.lit(False))
        # Partitions by key hash are the buckets: a file for each.
        cold = rows.filter(~is_hot).repartition(self.at["buckets"], KEY).sortWithinPartitions(KEY, "t")
        cold.write.insertInto(self._table(version))
        if hot:
            rows.filter(is_hot).write.mode("append").parquet(self._hot_path(version))

    def append(self, df: DataFrame, relation: Relation) -> None:
        """Add orders or product changes, as declared."""
        rows = relation.conform(df).withColumnRenamed(relation.event_time, "t")
        rows = rows.withColumn("side", F.lit(_ORDER if relation is ORDERS else _CHANGE))
        kinds = {f.name: f.dataType for f in self._empty().schema.fields}
        rows = rows.select(*[F.col(c) if c in rows.columns else F.lit(None).cast(kinds[c]).alias(c) for c in _NAMES])
        self._put(rows, self.at["version"], self.at["hot"])
        if self._record() is None:
            self._write_record(self.at)
        self.spark.catalog.refreshTable(self._table(self.at["version"]))

    def _empty(self) -> DataFrame:
        return self.spark.createDataFrame([], _DDL)

    def _parts(self) -> tuple[DataFrame, DataFrame]:
        """The bucketed rows, and the hot ones."""
        cold = self.spark.table(self._table(self.at["version"]))
        store, inner = store_of(self._hot_path(self.at["version"]))
        there = store.get_file_info(fs.FileSelector(inner, allow_not_found=True))
        hot = self.spark.read.schema(_DDL).parquet(self._hot_path(self.at["version"])) if there else self._empty()
        return cold, hot

    def read(self, relation: Relation) -> DataFrame:
        """The orders or the product changes in the log."""
        cold, hot = self._parts()
        rows = cold.unionByName(hot).filter(F.col("side") == (_ORDER if relation is ORDERS else _CHANGE))
        return relation.conform(rows.withColumnRenamed("t", relation.event_time))

    def compact(self) -> None:
        """Write one file a bucket into a new version; the version before stays for its readers."""
        cold, hot = self._parts()
        rows = cold.unionByName(hot)
        found = heat.spreads(heat.sketch(rows, KEY), self.at["buckets"])
        now = {**self.at, "version": self.at["version"] + 1, "hot": sorted(found)}
        self._put(rows, now["version"], now["hot"])
        self._write_record(now)

    def clear_old(self) -> None:
        """Remove the versions that no longer hold."""
        store, inner = store_of(self.path)
        for info in store.get_file_info(fs.FileSelector(inner)):
            name, _, number = info.base_name.partition("=")
            if name == "version" and int(number) < self.at["version"]:
                self.spark.sql(f"DROP TABLE IF EXISTS {self._table(int(number))}")
                store.delete_dir(info.path)

    def files_of(self) -> int:
        """How many files the buckets have."""
        store, inner = store_of(f"{self.path}/version={self.at['version']}/keyed")
        return sum(i.base_name.startswith("part-") for i in store.get_file_info(fs.FileSelector(inner, allow_not_found=True)))

    def enriched(self, max_task_rows: int = MAX_TASK_ROWS) -> DataFrame:
        """Every order joined with the product version of its time, like ``temporal_enrich``.

        The buckets are joined in place, with no exchange; hot keys are split over tasks.
        """
        cold, hot = self._parts()
        is_hot = self._is_hot(self.at["hot"])
        out = enrich_log(cold.filter(~is_hot))
        if self.at["hot"]:
            out = out.unionByName(enrich_log(hot.unionByName(cold.filter(is_hot)), max_task_rows))
        return out.select(*ENRICHED_ORDERS.columns)
