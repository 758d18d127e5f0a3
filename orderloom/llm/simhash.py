"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Every distinct fingerprint emits all variants within half the radius. Two fingerprints
within the radius share a variant, so a shuffle on variants brings them together; the
links are checked, and components of links are the groups.

Defined results: a null or empty text, or one without words, has fingerprint zero and is
linked like any other; a null id never names a group (the least non-null id does; none: null);
repeated rows share a fingerprint and a group. Every input row gives one output row, no rows none;
other columns, under whatever names, have no effect and stay where rows are kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.llm.common import attach, fresh, stored
from orderloom.llm.graph import components

SEED = 42
CHUNK = 1 << 16
BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)


def words_of(text: str | None) -> list[bytes]:
    """Words between ASCII white space, with A-Z lowered; other letters stay as they are."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def fingerprint(words: list[bytes], k: int) -> int:
    """64-bit SimHash of the k-word shingles, as a signed number."""
    if not words:
        return 0
    n = max(1, len(words) - k + 1)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, CHUNK):
        part = words[at : at + CHUNK + k - 1]
        grams = zip(*(part[i:] for i in range(k))) if len(words) >= k else [part]
        digest = b"".join([xxhash.xxh64_digest(b" ".join(g), SEED) for g in grams])
        columns = np.frombuffer(digest, np.uint8).reshape(-1, 8)
        if len(columns) < 200:
            ones += np.unpackbits(columns, axis=1).sum(axis=0, dtype=np.int64)
        else:
            for i in range(8):
                ones[8 * i : 8 * i + 8] += np.bincount(columns[:, i], minlength=256) @ BITS
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big", signed=True)


def with_fingerprint(docs: DataFrame, k: int, text: str = "text", name: str = "fp") -> DataFrame:
    """``docs`` with the fingerprint of the whole text as a long column, which replaces any of that name."""
    docs = docs.drop(name)
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(text)
            values = [fingerprint(words_of(x.as_py()), k) for x in batch.column(at)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(values, pa.int64())], [*batch.schema.names, name]
            )

    return docs.mapInArrow(run, schema)


def ball(bits: int) -> list[int]:
    """Masks of all numbers with at most ``bits`` of 64 bits set, as signed numbers."""
    masks = (sum(1 << b for b in c) for n in range(bits + 1) for c in combinations(range(64), n))
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def links(fps: DataFrame, radius: int) -> DataFrame:
    """Links (u, v) that connect all distinct values of ``fp`` within ``radius`` bits.

    All members of a variant's group are within half the radius of the variant, so they are
    linked to one another; a chain through the sorted members connects them all. A group has
    no more members than the ball has points, whatever the number of copies.
    """
    if radius < 0 or radius % 2 or radius > 6:
        raise ValueError("the radius is an even number of bits, at most 6")
    masks = F.lit(ball(radius // 2)).cast("array<bigint>")
    variants = fps.select("fp").distinct().select("fp", F.explode(masks).alias("mask"))
    variants = variants.select("fp", F.col("fp").bitwiseXOR(F.col("mask")).alias("variant"))
    last = F.lag("fp").over(Window.partitionBy("variant").orderBy("fp"))
    pairs = variants.select(F.col("fp").alias("u"), last.alias("v")).filter("v is not null")
    close = F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= radius
    return pairs.distinct().filter(close)


def groups(rows: DataFrame, radius: int, id_col: str = "doc_id") -> DataFrame:
    """One row per distinct fingerprint of the stored ``rows``: fp, root, component_id, n."""
    stats = stored(
        rows.groupBy("fp").agg(F.min(id_col).alias("least_id"), F.count(F.lit(1)).alias("n")), "fps"
    )
    nodes = components(links(stats, radius)).withColumnRenamed("node", "fp")
    rooted = stored(
        stats.join(nodes, "fp", "left").withColumn("root", F.coalesce("root", "fp")), "rooted"
    )
    named = stored(
        rooted.groupBy("root").agg(
            F.min("least_id").alias("component_id"), F.count(F.lit(1)).alias("fps")
        ),
        "named",
    )
    total = stats.count()
    return stored(attach(rooted.select("fp", "root", "n"), named, "root", "fps", total), "groups")


def near_duplicates(
    docs: DataFrame, shingle: int = 3, radius: int = 2, id_col: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per row of ``docs``: id, fp (long), root (fp that names the group), component_id."""
    rows = stored(with_fingerprint(docs.select(id_col, text), shingle, text).select(id_col, "fp"), "fp")
    return attach(rows, groups(rows, radius, id_col), "fp", "n", rows.count())


def keep_one(
    docs: DataFrame, shingle: int = 3, radius: int = 2, id_col: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``docs`` with one row of each group: that of the least id (of equal ones, any one)."""
    fp, row = fresh(docs, "_fp"), fresh(docs, "_row")
    numbered = with_fingerprint(docs, shingle, text, fp).withColumn(row, F.monotonically_increasing_id())
    whole = stored(numbered, "fp_docs")
    rows = whole.select(F.col(row).alias("row"), F.col(id_col).alias("id"), F.col(fp).alias("fp"))
    found = attach(rows, groups(rows, radius, "id"), "fp", "n", rows.count())
    first = found.filter(F.col("id").eqNullSafe(F.col("component_id")))
    chosen = first.groupBy("root").agg(F.min("row").alias(row)).select(row)
    return whole.join(chosen, row, "left_semi").select(docs.columns)


def hex_of(fp: str = "fp"):
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
