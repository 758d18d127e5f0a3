"""Dropping of repeated lines, kept up to date while documents come and go.

A line's key is the line without white space at its ends, A-Z in lower case. Keys of at least
``min_chars`` code points that are found in at least ``min_docs`` documents are repeated: their lines
go, except in the greatest document id that holds the key.

``LineIndex`` keeps, under a shared folder,

* references: a row for each key (a 128-bit digest) and document id, live or removed;
* counts: per key the number of live documents and the greatest of their ids, exact;
* filters: a cuckoo filter for each shard of the key space, with ``min(documents, min_docs)`` entries
  a key.

``add`` looks up in the exact counts only what the filters may hold already; ``clean`` asks them only
for keys of which the filters hold ``min_docs`` entries or more. ``remove`` takes documents out again:
references are marked, counts go down, entries leave the filters, so that adding documents and
removing them leaves the index as it was. Each call writes a generation; its manifest comes last, so a
call that fails, or a task that runs again, changes nothing. Generations are merged when there are
many; shards double with the keys.

Work is shuffled by key and document together, or by key after counting, so no line or document
gathers in a task; a shard's keys are bounded in number. A hot key meets its documents by a salted join.

Defined results: documents are told apart by id, and rows of one id, or without one, are one document;
no id counts as less than any other. A null or empty text is one empty line. Repeated rows are
cleaned each. No rows give no rows. Other columns stay.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.functions.stores import store_of
from orderloom.llm.common import attach, fresh, put_file, stored
from orderloom.llm.cuckoo import LOAD, SLOTS, CuckooFilter, Full

MIN_CHARS = 20
MIN_DOCS = 3
# Keys of a shard on average; there are at least LEAST_SHARDS.
SHARD_KEYS = 50_000
LEAST_SHARDS = 16
# Generations that are read side by side before they are merged.
GENERATIONS = 8

_BLANK = " \t\n\x0b\x0c\r"


def line_keys(text: str | None, min_chars: int) -> list[bytes | None]:
    """The digest of each line's key; None for a key that is too short."""
    low = (text or "").encode().lower().decode()  # of bytes: A-Z alone
    out = []
    for line in low.split("\n"):
        key = line.strip(_BLANK)
        long = len(key) >= min_chars
        out.append(hashlib.blake2b(key.encode(), digest_size=16).digest() if long else None)
    return out


def _hashes(keys: pa.ChunkedArray) -> np.ndarray:
    """The unsigned 64-bit hashes that the filters take: the first half of each digest."""
    raw = b"".join(keys.to_pylist())
    return np.frombuffer(raw, "<u8").reshape(-1, 2)[:, 0].astype(np.uint64)


def _same_ref():
    """References a and b are of one key and document."""
    return (F.col("a.key") == F.col("b.key")) & F.col("a.doc").eqNullSafe(F.col("b.doc"))


class LineIndex:
    def __init__(
        self, spark: SparkSession, path: str, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS,
        shard_keys: int = SHARD_KEYS,
    ) -> None:
        """The index under ``path``; a new one if there is none."""
        if min_docs < 1 or min_docs > 2 * SLOTS:
            raise ValueError("a filter can tell 1 to 8 documents apart")
        self.spark, self.path, self.shard_keys = spark, path.rstrip("/"), shard_keys
        self.min_chars, self.min_docs = min_chars, min_docs
        self.at = self._newest()
        if (kept := self.at.get("rule")) and kept != [min_chars, min_docs]:
            raise ValueError(f"the index was made with min_chars, min_docs = {kept}")

    def _newest(self) -> dict:
        store, inner = store_of(self.path)
        found = store.get_file_info(fs.FileSelector(inner, allow_not_found=True))
        names = sorted(f.path for f in found if f.base_name.startswith("manifest-"))
        if not names:
            return {"gen": 0, "keys": 0, "shards": LEAST_SHARDS, "refs": [], "counts": [], "filters": None}
        with store.open_input_stream(names[-1]) as body:
            return json.loads(body.read())

    def _finish(self, **changed) -> None:
        at = {**self.at, **changed, "gen": self.at["gen"] + 1, "rule": [self.min_chars, self.min_docs]}
        name = f"{self.path}/manifest-{at['gen']:08d}.json"
        put_file(name, json.dumps(at).encode(), uuid.uuid4().hex)
        self.at = at
        if max(len(at["refs"]), len(at["counts"])) > GENERATIONS:
            self._merge()

    def _write(self, df: DataFrame, kind: str) -> str:
        folder = f"{self.path}/{kind}-{self.at['gen'] + 1:08d}-{uuid.uuid4().hex}"
        df.write.parquet(folder)
        return folder

    def _all(self, folders: list[str], schema: str) -> DataFrame:
        """The rows of all generations, numbered by ``gen``."""
        out = self.spark.createDataFrame([], f"{schema}, gen int")
        for gen, folder in enumerate(folders):
            out = out.unionByName(self.spark.read.schema(schema).parquet(folder).withColumn("gen", F.lit(gen)))
        return out

    def _refs(self, keys: DataFrame | None = None, ids: DataFrame | None = None) -> DataFrame:
        """The live references: key, doc; of some keys (key) or documents (doc) if these are given."""
        rows = self._all(self.at["refs"], f"key binary, doc {self._type()}, live boolean")
        if keys is not None:
            rows = rows.join(keys, "key", "left_semi")
        if ids is not None:
            rows = rows.alias("a").join(ids.alias("b"), F.col("a.doc").eqNullSafe(F.col("b.doc")), "left_semi")
        return rows.groupBy("key", "doc").agg(F.max_by("live", "gen").alias("live")).filter("live").drop("live")

    def counts(self, keys: DataFrame | None = None, folders: list[str] | None = None) -> DataFrame:
        """Per key with live documents: key, n (documents), last (the greatest id; null without ids).

        Of some keys if ``keys`` is given: then the others are not shuffled.
        """
        rows = self._all(folders or self.at["counts"], f"key binary, n bigint, last {self._type()}")
        if keys is not None:
            rows = rows.join(keys, "key", "left_semi")
        newest = rows.groupBy("key").agg(F.max_by(F.struct("n", "last"), "gen").alias("r"))
        return newest.select("key", "r.*").filter("n > 0")

    def _type(self) -> str:
        return self.at.get("id_type", "bigint")

    def _shard(self, shards: int):
        return F.pmod(F.xxhash64("key"), F.lit(shards)).cast("int").alias("shard")

    def _filters(self) -> DataFrame:
        return self.spark.read.schema("shard int, body binary").parquet(self.at["filters"])

    def lines(self, docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
        """The distinct keys of every document, stored: key, doc, spread (a hash of the text)."""
        rows = docs.select(F.col(id_col).alias("doc"), F.xxhash64(text).alias("spread"), F.col(text).alias("t"))
        id_type, least = rows.schema["doc"].dataType.simpleString(), self.min_chars

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                at, keys = [], []
                for i, t in enumerate(batch.column(2)):
                    found = {*line_keys(t.as_py(), least)} - {None}
                    at += [i] * len(found)
                    keys += found
                there = pa.array(at, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.binary()), batch.column(0).take(there), batch.column(1).take(there)],
                    names=["key", "doc", "spread"],
                )

        return stored(rows.mapInArrow(run, f"key binary, doc {id_type}, spread bigint").distinct(), "lines")

    def _held(self, keys: DataFrame) -> DataFrame:
        """``keys`` with ``held``, the entries that the shard's filter has for the key."""
        if self.at["filters"] is None:
            return keys.withColumn("held", F.lit(0))
        schema = ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in keys.schema.fields), "held int"])

        def run(rows: pa.Table, filters: pa.Table) -> pa.Table:
            rows = rows.drop_columns("shard")
            if not rows.num_rows or not filters.num_rows:
                held = np.zeros(rows.num_rows, np.int32)
            else:
                kept = CuckooFilter.read(filters["body"][0].as_py())
                held = kept.held(_hashes(rows["key"])).astype(np.int32)
            return rows.append_column("held", pa.array(held))

        sharded = keys.withColumn("shard", self._shard(self.at["shards"])).groupBy("shard")
        return sharded.cogroup(self._filters().groupBy("shard")).applyInArrow(run, schema)

    def add(self, docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
        """Take documents in; their ``lines``. Documents that are there already change nothing."""
        lines = self.lines(docs, id_col, text)
        self.at["id_type"] = lines.schema["doc"].dataType.simpleString()
        refs = lines.select("key", "doc").distinct()
        if self.at["refs"]:
            # Only what a filter may hold can be there already.
            keys = stored(self._held(refs.select("key").distinct()), "held")
            seen = self._refs(keys=keys.filter("held > 0"))
            refs = refs.alias("a").join(seen.alias("b"), _same_ref(), "left_anti")
        refs = stored(refs, "refs")
        new = refs.groupBy("key").agg(F.count(F.lit(1)).alias("more"), F.max("doc").alias("top"))
        self._change(self._write(refs.withColumn("live", F.lit(True)), "refs"), stored(new, "new_keys"))
        return lines

    def remove(self, ids: DataFrame, id_col: str = "doc_id") -> None:
        """Take documents out again, by id; ids that are not there change nothing."""
        gone_ids = ids.select(F.col(id_col).alias("doc")).distinct()
        gone = stored(self._refs(ids=gone_ids), "gone")
        less = gone.groupBy("key").agg((-F.count(F.lit(1))).alias("more"))
        # The greatest id that is left, for the keys that lose a document.
        left = self._refs(keys=less).alias("a").join(gone.alias("b"), _same_ref(), "left_anti")
        top = left.groupBy("key").agg(F.max("doc").alias("top"))
        changed = stored(less.join(top, "key", "left"), "less_keys")
        self._change(self._write(gone.withColumn("live", F.lit(False)), "refs"), changed)

    def _change(self, refs: str, keys: DataFrame) -> None:
        """Bring counts and filters up to date; ``keys``: key, more (documents), top (greatest id)."""
        shards = self._grown(keys.count())
        known = stored(self._held(keys), "probed")
        before = self.counts(keys=known.filter("held > 0")).withColumnRenamed("last", "before")
        there = known.filter("held > 0").join(before, "key", "left")
        new = known.filter("held = 0").select("*", F.lit(0).cast("bigint").alias("n"), F.lit(None).cast(self._type()).alias("before"))
        n = F.coalesce("n", F.lit(0))
        last = F.when(F.col("more") < 0, F.col("top")).otherwise(F.greatest("top", "before"))
        now = stored(
            there.select(new.columns).unionByName(new).select(
                "key", (n + F.col("more")).alias("n"), last.alias("last"), n.alias("was")
            ),
            "changed",
        )
        counts = self._write(now.select("key", "n", "last"), "counts")
        all_counts = [*self.at["counts"], counts]
        filters = self._updated(now, shards, all_counts)
        keys_now = self.at["keys"] + (now.agg(F.sum((F.col("n") > 0).cast("int") - (F.col("was") > 0).cast("int"))).first()[0] or 0)
        self._finish(refs=[*self.at["refs"], refs], counts=all_counts, filters=filters, keys=keys_now, shards=shards)

    def _grown(self, more: int) -> int:
        shards = self.at["shards"]
        while self.at["keys"] + more > shards * self.shard_keys:
            shards *= 2
        return shards

    def _updated(self, now: DataFrame, shards: int, counts: list[str]) -> str:
        """The filters after a change; those that are full, or all if shards split, are built anew."""
        most = self.min_docs

        def entries(keys: np.ndarray, copies: np.ndarray) -> np.ndarray:
            return np.repeat(keys, copies)

        def build(rows: pa.Table) -> pa.Table:
            keys = entries(_hashes(rows["key"]), np.minimum(rows["n"].to_numpy(), most))
            size = max(1, len(keys))
            while True:
                made = CuckooFilter.for_entries(size)
                try:
                    made.put(keys)
                    break
                except Full:
                    size = made.buckets * SLOTS
            return pa.table({"shard": rows["shard"][:1].cast(pa.int32()), "body": pa.array([made.body()], pa.binary())})

        def change(rows: pa.Table, filters: pa.Table) -> pa.Table:
            if not filters.num_rows:
                return build(rows)
            shard = filters["shard"][:1].cast(pa.int32())
            kept = CuckooFilter.read(filters["body"][0].as_py())
            if rows.num_rows:
                keys = _hashes(rows["key"])
                step = np.minimum(rows["n"].to_numpy(), most) - np.minimum(rows["was"].to_numpy(), most)
                try:
                    if kept.size + step.sum() > LOAD * kept.buckets * SLOTS:
                        raise Full
                    kept.take(entries(keys, np.maximum(-step, 0)))
                    kept.put(entries(keys, np.maximum(step, 0)))
                except Full:
                    return pa.table({"shard": shard, "body": pa.array([None], pa.binary())})
            return pa.table({"shard": shard, "body": pa.array([kept.body()], pa.binary())})

        schema, by_shard = "shard int, body binary", self._shard(shards)
        if self.at["filters"] is None or shards != self.at["shards"]:
            exact = self.counts(folders=counts).select("key", "n", by_shard)
            return self._write(exact.groupBy("shard").applyInArrow(build, schema), "filters")
        sharded = now.select("key", "n", "was", by_shard).groupBy("shard")
        made = stored(sharded.cogroup(self._filters().groupBy("shard")).applyInArrow(change, schema), "filters")
        full = made.filter("body is null").select("shard")
        if not full.isEmpty():
            exact = self.counts(folders=counts).select("key", "n", by_shard)
            anew = exact.join(F.broadcast(full), "shard", "left_semi").groupBy("shard").applyInArrow(build, schema)
            made = made.filter("body is not null").unionByName(anew)
        return self._write(made, "filters")

    def _merge(self) -> None:
        refs = self._write(self._refs().withColumn("live", F.lit(True)), "refs")
        counts = self._write(self.counts(), "counts")
        self._finish(refs=[refs], counts=[counts])

    def repeated(self, lines: DataFrame) -> DataFrame:
        """Of keys in ``lines``, those that are repeated in the index, stored: key, n, last."""
        keys = lines.select("key").distinct()
        likely = self._held(keys).filter(F.col("held") >= self.min_docs).select("key")
        return stored(self.counts(keys=likely).filter(F.col("n") >= self.min_docs), "repeated")

    def clean(
        self, docs: DataFrame, id_col: str = "doc_id", text: str = "text", lines: DataFrame | None = None,
        out: str = "cleaned",
    ) -> DataFrame:
        """``docs`` without ``text``, with a struct ``out``: n_lines, n_dropped, kept (the text left).

        ``lines`` may be what ``add`` returned for the same documents, which saves reading them again.
        """
        others = [c for c in docs.columns if c != text]
        if out.lower() in (c.lower() for c in others):
            raise ValueError(f"{out} is a column already")
        lines = self.lines(docs, id_col, text) if lines is None else lines
        repeated = self.repeated(lines)
        found = attach(lines, repeated, "key", "n", lines.count())
        drop = found.filter(~F.col("doc").eqNullSafe(F.col("last")))
        mine = drop.groupBy("doc", "spread").agg(F.collect_set("key").alias("keys"))
        # A row is the work of one task whatever its id: ids and texts are joined together.
        spread, doc, keys = fresh(docs, "spread"), fresh(docs, "doc"), fresh(docs, "keys")
        mine = mine.select(F.col("doc").alias(doc), F.col("spread").alias(spread), F.col("keys").alias(keys))
        rows = docs.withColumn(spread + "_of", F.xxhash64(text))
        same = rows[id_col].eqNullSafe(mine[doc]) & (rows[spread + "_of"] == mine[spread])
        joined = rows.join(mine, same, "left").select(*others, text, keys)
        least, at = self.min_chars, len(others)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                sizes, gone, kept = [], [], []
                for t, keys in zip(batch.column(at), batch.column(at + 1)):
                    body, keys = t.as_py() or "", keys.as_py()
                    parts = body.split("\n")
                    sizes.append(len(parts))
                    if keys:
                        drop = {*keys}
                        left = [p for p, k in zip(parts, line_keys(body, least)) if k not in drop]
                        gone.append(len(parts) - len(left))
                        body = "\n".join(left)
                    else:
                        gone.append(0)
                    kept.append(body)
                made = pa.StructArray.from_arrays(
                    [pa.array(sizes, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string())],
                    names=["n_lines", "n_dropped", "kept"],
                )
                yield pa.RecordBatch.from_arrays([*batch.columns[:at], made], names=[*others, out])

        types = [f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in others]
        result = f"`{out}` struct<n_lines: bigint, n_dropped: bigint, kept: string>"
        return joined.mapInArrow(run, ", ".join([*types, result]))
