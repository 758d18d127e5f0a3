"""Accounts of the rows that the job's queries handle, batch by batch.

The queries observe their rows on the way: lines read and refused at the intake, orders that enter the
join, and orders that it took, matched and did not match. ``keep`` writes what a query reports of
its batches, one small file each, named by query and batch, so a batch that is reported twice counts
once. ``Accounts`` does so as a listener while the queries run. From these,

    lines = refused + orders,  orders = unkeyed + entered,  entered = late + taken,
    taken = matched + unmatched + waiting

where an unkeyed order has no product or no time, a late one came behind the watermark, and a waiting
one is in the join's state.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from orderloom.functions.stores import store_of

# Names of the observations.
INTAKE, ENTERED, JOINED = "intake", "entered", "joined"

PARTS = ("lines", "refused", "orders", "keyed", "taken", "matched", "unmatched")
_SCHEMA = "query string, batch bigint, " + ", ".join(f"{p} bigint" for p in PARTS)


def _rows(name: str, batch: int, metrics: dict) -> dict:
    row: dict = {"query": name, "batch": batch}
    for observed in (INTAKE, ENTERED, JOINED):
        found = metrics.get(observed)
        if found is not None:
            row.update((k, v or 0) for k, v in (found if isinstance(found, dict) else found.asDict()).items())
    return row


def _put(path: str, row: dict) -> None:
    if len(row) == 2:
        return
    store, inner = store_of(path)
    store.create_dir(inner, recursive=True)
    name = row["query"].rsplit("/", 1)[-1]
    aside = f"{inner}/_{uuid.uuid4().hex}"
    with store.open_output_stream(aside, compression=None) as out:
        out.write(json.dumps(row).encode())
    store.move(aside, f"{inner}/{name}-{row['batch']}.json")


def keep(path: str, query: StreamingQuery) -> None:
    """Write the accounts of a stopped query's batches; of the last hundred, as Spark keeps them."""
    for p in query.recentProgress:
        _put(path, _rows(query.name, p.batchId, p.observedMetrics))


class Accounts(StreamingQueryListener):
    """Writes the accounts of all queries that observe rows, as their batches end."""

    def __init__(self, path: str) -> None:
        self.path = path

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        _put(self.path, _rows(p.name, p.batchId, p.observedMetrics))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def read(spark: SparkSession, path: str) -> DataFrame:
    """A row for each batch: query, batch, and the parts that the query observes."""
    store, inner = store_of(path)
    if not store.get_file_info(fs.FileSelector(inner, allow_not_found=True)):
        return spark.createDataFrame([], _SCHEMA)
    return spark.read.schema(_SCHEMA).option("pathGlobFilter", "*.json").json(path)


def totals(batches: DataFrame) -> DataFrame:
    """(part, n): all lines split into what became of them. ``waiting`` is what no batch has put out yet."""
    sums = {p: F.coalesce(F.sum(p), F.lit(0)) for p in PARTS}
    parts = {
        "lines": sums["lines"],
        "refused": sums["refused"],
        "unkeyed": sums["orders"] - sums["keyed"],
        "late": sums["keyed"] - sums["taken"],
        "matched": sums["matched"],
        "unmatched": sums["unmatched"],
        "waiting": sums["taken"] - sums["matched"] - sums["unmatched"],
    }
    row = batches.agg(F.array(*[F.struct(F.lit(k).alias("part"), v.alias("n")) for k, v in parts.items()]).alias("p"))
    return row.select(F.inline("p"))
