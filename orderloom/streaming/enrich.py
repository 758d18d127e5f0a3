"""The temporal join on streams.

An order waits in state until the watermark (the slower of orders and product
changes) reaches its time; then the version valid at that time is known, however
the two inputs interleaved. Versions are kept only as far back as a waiting or
still acceptable order can need them.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

from orderloom.operators.changelog import KEY, TIME, is_live, last_at_each_time

# State groups per product, if no heat was measured. Orders of one product are spread over
# this many groups; its (far fewer) changes are copied to each of them.
DEFAULT_SPREAD = 4

# Rows per state entry, and version entries after which they are merged.
CHUNK = 10_000
MERGE = 16

_OUTPUT = (
    "order_id string, product_id string, product_name string, quantity int, order_ts timestamp, part int, n bigint"
)

_ORDER, _LIVE, _DEAD = 0, 1, 2
# Parts of the output: orders with a version, without one, and how many orders came in.
MATCHED, UNMATCHED, TAKEN = 0, 1, 2
STATE = "product_id string, kind int, us bigint, numbered boolean, number bigint, order_id string, product_name string"
_ORDERS = ["us", "order_id", "numbered", "number"]
_VERSIONS = ["us", "numbered", "number", "kind", "product_name"]


class _Entries:
    """Tables kept in a map state, some rows per entry, with the time range of each.

    The ranges live in one small value, so that only the entries asked for are read.
    """

    def __init__(self, handle: StatefulProcessorHandle, name: str, columns: list[str], ddl: str) -> None:
        self.columns = columns
        self.index = handle.getValueState(f"{name}_index", "next bigint, id array<bigint>, low array<bigint>, high array<bigint>")
        self.rows = handle.getMapState(name, "id bigint", ddl)

    def load(self) -> None:
        self.next, ids, low, high = self.index.get() or (0, [], [], [])
        self.ranges = {i: (a, b) for i, a, b in zip(ids, low, high)}

    def save(self) -> None:
        ids = list(self.ranges)
        self.index.update((self.next, ids, [self.ranges[i][0] for i in ids], [self.ranges[i][1] for i in ids]))

    def add(self, table: pd.DataFrame) -> None:
        """Keep rows, sorted by time, in entries of at most CHUNK."""
        for at in range(0, len(table), CHUNK):
            part = table.iloc[at : at + CHUNK]
            self.rows.updateValue((self.next,), tuple(part[c].tolist() for c in self.columns))
            self.ranges[self.next] = int(part["us"].iloc[0]), int(part["us"].iloc[-1])
            self.next += 1

    def read(self, ids: list[int]) -> pd.DataFrame:
        parts = [self.rows.getValue((i,)) for i in ids]
        columns = {c: [v for p in parts for v in p[n]] for n, c in enumerate(self.columns)}
        return pd.DataFrame(columns, columns=self.columns).astype({"us": "int64", "number": "int64"})

    def drop(self, ids: list[int]) -> None:
        for i in ids:
            self.rows.removeKey((i,))
            del self.ranges[i]

    def oldest(self) -> int | None:
        return min((a for a, _ in self.ranges.values()), default=None)


class TemporalJoin(StatefulProcessor):
    """State of one (product, spread) group: waiting orders and needed versions.

    A firing reads the waiting entries that have a due order, and the version entries that
    such orders can need; entries of later orders are not touched.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = _Entries(
            handle, "waiting", _ORDERS,
            "us array<bigint>, order_id array<string>, numbered array<boolean>, number array<bigint>",
        )
        self.versions = _Entries(
            handle, "versions", _VERSIONS,
            "us array<bigint>, numbered array<boolean>, number array<bigint>, kind array<int>, product_name array<string>",
        )

    def handleInitialState(self, key: Any, initialState: pd.DataFrame, timerValues: Any) -> None:
        self._take(iter([initialState]))

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        taken, changed = self._take(rows)
        if changed:
            self._prune(timerValues.getCurrentWatermarkInMs())
            self.versions.save()
        if taken:
            # A row that is put out must lie behind the watermark.
            now = (timerValues.getCurrentWatermarkInMs() + 1) * 1000
            yield _output(key[0], pd.DataFrame({"us": [now]}), TAKEN, taken)

    def _take(self, rows: Iterator[pd.DataFrame]) -> tuple[int, bool]:
        """Keep orders and versions; the number of orders, and whether there was a version."""
        self.waiting.load()
        self.versions.load()
        taken, changed = 0, False
        for frame in rows:
            orders = frame[frame["kind"] == _ORDER]
            if len(orders):
                taken += len(orders)
                self.waiting.add(orders.sort_values("us", kind="stable"))
                self._wake(int(orders["us"].min()))
            changes = frame[frame["kind"] != _ORDER]
            if len(changes):
                changed = True
                self.versions.add(_in_order(changes))
        self.waiting.save()
        if changed:
            self.versions.save()
        return taken, changed

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        self.waiting.load()
        mark = _micros(timerValues.getCurrentWatermarkInMs())
        due = [i for i, (low, _) in self.waiting.ranges.items() if low <= mark]
        if not due:
            return  # an earlier timer of this batch already did the work
        orders = self.waiting.read(due).sort_values("us", kind="stable")
        ready = orders[orders["us"] <= mark]
        self.waiting.drop(due)
        self.waiting.add(orders[orders["us"] > mark])
        self.waiting.save()
        oldest = self.waiting.oldest()
        if oldest is not None:
            self._wake(oldest)
        self.versions.load()
        found, lost = self._matched(ready)
        self._prune(timerValues.getCurrentWatermarkInMs())
        self.versions.save()
        if len(found):
            yield _output(key[0], found, MATCHED, 1)
        if lost:
            yield _output(key[0], ready[:1], UNMATCHED, lost)

    def _wake(self, us: int) -> None:
        """A timer at the first millisecond that is not before a time."""
        self.handle.registerTimer(-(-us // 1000))

    def _matched(self, orders: pd.DataFrame) -> tuple[pd.DataFrame, int]:
        """The orders under a live version, with its name; the number of the others."""
        low, high = int(orders["us"].iloc[0]), int(orders["us"].iloc[-1])
        ranges = self.versions.ranges
        # Before the first order only the latest entry can hold its version.
        floor = max((b for a, b in ranges.values() if b < low), default=None)
        needed = [i for i, (a, b) in ranges.items() if a <= high and (b >= low or b == floor or a <= low)]
        versions = _in_order(self.versions.read(needed))
        at = np.searchsorted(versions["us"].to_numpy(), orders["us"].to_numpy(), side="right") - 1
        kinds = versions["kind"].to_numpy()
        on = (at >= 0) & (kinds[at] == _LIVE) if len(versions) else np.zeros(len(orders), bool)
        names = versions["product_name"].to_numpy()
        return orders[on].assign(product_name=names[at[on]]), int(len(orders) - on.sum())

    def _prune(self, watermark: int) -> None:
        """Forget version entries that no waiting or acceptable order can need.

        No order before the horizon is waiting, and none will be accepted later: of the
        versions before it only the last is needed. Many small entries are merged into one.
        """
        self.waiting.load()
        oldest = self.waiting.oldest()
        horizon = _micros(watermark) if oldest is None else min(_micros(watermark), oldest)
        ranges = self.versions.ranges
        last = max((a for a, _ in ranges.values() if a <= horizon), default=None)
        if last is not None:
            self.versions.drop([i for i, (_, b) in ranges.items() if b < last])
        if len(ranges) > MERGE:
            ids = list(ranges)
            table = _in_order(self.versions.read(ids)).drop_duplicates("us", keep="last")
            first = max(int(np.searchsorted(table["us"].to_numpy(), horizon, side="right")) - 1, 0)
            self.versions.drop(ids)
            self.versions.add(table.iloc[first:])

    def close(self) -> None:
        pass


def _output(product: str, rows: pd.DataFrame, part: int, n: int) -> pd.DataFrame:
    """Rows of the output: orders, or one row that stands for ``n`` of them."""
    whole = part == MATCHED
    return pd.DataFrame(
        {
            "order_id": rows["order_id"] if whole else None,
            "product_id": product,
            "product_name": rows["product_name"] if whole else None,
            "quantity": (rows["number"].where(rows["numbered"].astype(bool)) if whole else rows["us"] * 0).astype("Int32"),
            "order_ts": pd.to_datetime(rows["us"], unit="us", utc=True),
            "part": part,
            "n": n,
        }
    )


def _micros(watermark_ms: int) -> int:
    """The last microsecond that a watermark has reached."""
    return watermark_ms * 1000


def _in_order(versions: pd.DataFrame) -> pd.DataFrame:
    """By time, then arrival; without an arrival number by life and name, before all others."""
    tie = versions["product_name"].where(~versions["numbered"].astype(bool)).fillna("")
    keyed = versions.assign(_live=versions["kind"] == _LIVE, _named=versions["product_name"].notna(), _tie=tie)
    order = ["us", "numbered", "number", "_live", "_named", "_tie"]
    return keyed.sort_values(order, kind="stable")[_VERSIONS]


def groups_of(spread: int | dict[str, int]) -> Column:
    """State groups of a product: the same for all, or those of the listed ones, and one else."""
    if isinstance(spread, int):
        return F.lit(spread)
    listed = F.create_map(*[F.lit(x) for pair in sorted(spread.items()) for x in pair]) if spread else None
    return F.lit(1) if listed is None else F.coalesce(F.try_element_at(listed, F.col("product_id")), F.lit(1))


def _dealt(rows: DataFrame, spread: int | dict[str, int]) -> DataFrame:
    """State rows with ``spread``, their group of the product: an order is in one, a version in each."""
    groups = groups_of(spread)
    # The task number spreads even equal orders; both terms give the same value
    # when a task is run again.
    one = F.pmod(F.xxhash64("order_id", "us") + F.spark_partition_id(), groups).cast("int")
    places = F.when(F.col("kind") == _ORDER, F.array(one)).otherwise(F.sequence(F.lit(0), groups - 1))
    return rows.withColumn("spread", F.explode(places))


def _order_columns() -> list[Column]:
    """An order as a state row. Whole numbers go to Python without nulls: ``number`` is the quantity
    of an order or the arrival number of a change, and ``numbered`` tells whether there is one."""
    return [
        F.col("product_id"),
        F.lit(_ORDER).alias("kind"),
        F.unix_micros(F.col("order_ts").cast("timestamp")).alias("us"),
        F.col("quantity").isNotNull().alias("numbered"),
        F.coalesce("quantity", F.lit(0)).cast("bigint").alias("number"),
        F.col("order_id"),
        F.lit(None).cast("string").alias("product_name"),
    ]


def _version_columns() -> list[Column]:
    """A change as a state row."""
    return [
        F.col("product_id"),
        F.when(is_live(), _LIVE).otherwise(_DEAD).alias("kind"),
        F.unix_micros(F.col("last_updated_ts").cast("timestamp")).alias("us"),
        F.col("seq").isNotNull().alias("numbered"),
        F.coalesce("seq", F.lit(0).cast("bigint")).alias("number"),
        F.lit(None).cast("string").alias("order_id"),
        F.col("product_name"),
    ]


def state_of(orders: DataFrame, changes: DataFrame, cut: Column) -> DataFrame:
    """The state of a join that has put out all orders up to ``cut``: later orders, needed versions.

    Of a product's versions up to the cut only the last is needed.
    """
    early = last_at_each_time(changes.filter(F.col(TIME) <= cut).filter(F.col(KEY).isNotNull()))
    last = early.groupBy(KEY).agg(F.max_by(F.struct(*[c for c in early.columns if c != KEY]), TIME).alias("r"))
    needed = last.select(KEY, "r.*").select(changes.columns).unionByName(changes.filter(F.col(TIME) > cut))
    waiting = orders.filter((F.col("order_ts") > cut) & F.col("product_id").isNotNull())
    return waiting.select(*_order_columns()).unionByName(
        needed.filter(F.col("product_id").isNotNull()).select(*_version_columns())
    )


def kept_state(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The state rows that a stopped join left in its checkpoint, each version once."""

    def rows(name: str, columns: list[str]) -> DataFrame:
        state = spark.read.format("statestore").option("stateVarName", name).load(checkpoint)
        zipped = F.arrays_zip(*[F.col(f"user_map_value.{c}").alias(c) for c in columns])
        return state.select(F.col("key.product_id").alias("product_id"), F.inline(zipped))

    waiting = rows("waiting", _ORDERS).withColumns(
        {"kind": F.lit(_ORDER), "product_name": F.lit(None).cast("string")}
    )
    versions = rows("versions", _VERSIONS).dropDuplicates().withColumn("order_id", F.lit(None).cast("string"))
    names = [f.name for f in StructType.fromDDL(STATE)]
    return waiting.select(names).unionByName(versions.select(names))


def temporal_enrich_stream(
    orders: DataFrame,
    changes: DataFrame,
    spread: int | dict[str, int] = DEFAULT_SPREAD,
    state: DataFrame | None = None,
    account: str | None = None,
) -> DataFrame:
    """Enrich a watermarked order stream from a watermarked product-change stream.

    Output ``order_ts`` is again an event time with the join's watermark, so a
    window count can follow in the same query. ``spread`` is part of the state
    layout: keep it for the life of a checkpoint. ``state`` (rows of STATE) is what the join
    starts from. With ``account`` given, the orders that came in, matched and did
    not match are observed under that name.
    """
    # The event time goes beside the state row, as the watermark hangs on it.
    ordered = orders.filter(F.col("product_id").isNotNull()).select(
        F.col("order_ts").alias("event_ts"), *_order_columns()
    )
    changed = changes.filter(F.col("product_id").isNotNull()).select(
        F.col("last_updated_ts").alias("event_ts"), *_version_columns()
    )
    grouped = _dealt(ordered, spread).unionByName(_dealt(changed, spread)).groupBy("product_id", "spread")
    initial = None if state is None else _dealt(state, spread).groupBy("product_id", "spread")
    out = grouped.transformWithStateInPandas(
        statefulProcessor=TemporalJoin(),
        outputStructType=StructType.fromDDL(_OUTPUT),
        outputMode="append",
        timeMode="EventTime",
        initialState=initial,
        eventTimeColumnName="order_ts",
    )
    if account:
        parts = {"taken": TAKEN, "matched": MATCHED, "unmatched": UNMATCHED}
        out = out.observe(account, *[F.sum(F.when(F.col("part") == p, F.col("n"))).alias(n) for n, p in parts.items()])
    return out.filter(F.col("part") == MATCHED).drop("part", "n")
