"""Benchmark decontamination: one Aho-Corasick automaton over the normalised benchmark.

The letters of the automaton are words, so that a match is a run of whole words and its place
maps to characters of the original text. Spark makes the table of distinct windows with their items; a
text is scanned once for all windows of a block of it. A block has about ``block_words`` words of the
benchmark, which bounds the driver's part, the broadcast and the automaton. For a larger benchmark a
scan for each block leaves only the hits of rows that have some, and these are put together once.

Defined results: a null text, or one without words, has no words and no hits; a benchmark text
without words has no window; a null item id is listed as an empty string; repeated items count
once; every input row gives one output row, and an empty table none; an empty benchmark has no hits.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.llm.common import fresh, stored

WINDOW = 10
BLOCK_WORDS = 100_000

# A word is a run of ASCII letters, digits and all non-ASCII characters.
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_SPACES = bytes(
    b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)
)
_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
LEAK = (
    "n_words long, n_hit long, items array<string>, "
    "runs array<struct<start:long,end:long>>, spans array<struct<start:long,end:long>>"
)
_LEAK = pa.struct(
    [("n_words", pa.int64()), ("n_hit", pa.int64()), ("items", pa.list_(pa.string())),
     ("runs", _RUNS), ("spans", _RUNS)]
)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().translate(_SPACES).split()


def windows_of(words: list[bytes], size: int) -> list[tuple[bytes, ...]]:
    if not words:
        return []
    return [tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))]


def windows_table(benchmark: DataFrame, size: int, id_col: str, text: str) -> DataFrame:
    """The distinct windows of the benchmark, stored: words (joined by spaces), n, h, items."""
    rows = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, body in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = {*windows_of(words_of(body.as_py()), size)}
                yield pa.RecordBatch.from_arrays(
                    [pa.array([b" ".join(w) for w in found], pa.binary()), pa.array([item] * len(found), pa.string()),
                     pa.array([len(w) for w in found], pa.int32())],
                    names=["words", "item", "n"],
                )

    made = rows.mapInArrow(run, "words binary, item string, n int").distinct()
    one = made.groupBy("words").agg(F.max("n").alias("n"), F.array_sort(F.collect_list("item")).alias("items"))
    return stored(one.withColumn("h", F.xxhash64("words")), "windows")


def blocks(windows: DataFrame, size: int, block_words: int) -> Iterator[list]:
    """The windows in even parts by hash, each of about ``block_words * size`` words at most."""
    letters = windows.agg(F.sum("n")).first()[0] or 0
    parts = max(1, -(-letters // (block_words * size)))
    part = F.pmod(F.col("h"), F.lit(parts))
    for number in range(parts):
        found = windows.filter(part == number).select("words", "items").collect()
        if found:
            yield [(tuple(bytes(r["words"]).split(b" ")), r["items"]) for r in found]


def _index(held: list) -> dict:
    return {"windows": held, "made": None}


def _automaton(value: dict):
    """The automaton of a broadcast block, made once in each worker."""
    if value["made"] is None:
        import ahocorasick

        ids: dict[bytes, int] = {}
        made = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for window, items in value["windows"]:
            key = tuple(ids.setdefault(w, len(ids) + 1) for w in window)
            made.add_word(key, (len(key), items))
        made.make_automaton()
        value["made"] = ids, made
    return value["made"]


def _scan(words: list[bytes], ids: dict, automaton) -> tuple[list[tuple[int, int]], set]:
    """Matched word ranges [start, end) and the items found."""
    get = ids.get
    found, items = [], set()
    for last, (n, of) in automaton.iter(tuple([get(w, 0) for w in words])):
        found.append((last - n + 1, last + 1))
        items.update(of)
    return found, items


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(ranges):
        if out and start <= out[-1][1]:
            out[-1] = out[-1][0], max(end, out[-1][1])
        else:
            out.append((start, end))
    return out


def _spans(text: str, runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Character ranges of the original text for ranges of words."""
    places = [m.span() for m in WORD.finditer(text)]
    return [(places[a][0], places[b - 1][1]) for a, b in runs]


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    block_words: int = BLOCK_WORDS,
    text: str = "text",
    out: str = "leak",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """``docs`` with a struct column ``out``: n_words, n_hit, items, and the hit places as
    ranges of words (``runs``) and of characters of the original (``spans``). An input column
    of that name is replaced.
    """
    docs = docs.drop(out)
    spark, columns = docs.sparkSession, docs.columns
    fields = T.StructField(out, T.StructType.fromDDL(LEAK))
    parts = blocks(windows_table(benchmark, window, item_id, item_text), window, block_words)
    first, second = next(parts, None), next(parts, None)
    if second is None:
        return docs.mapInArrow(
            _marker(columns, text, out, _sent(spark, first)), T.StructType([*docs.schema.fields, fields])
        )
    # Several blocks: a scan for each leaves the hits of the rows that have some; they meet once.
    row, hits = fresh(docs, "_row"), fresh(docs, "_hits")
    whole = stored(docs.withColumn(row, F.monotonically_increasing_id()), "leak_docs")
    texts, found = whole.select(F.col(row).alias("row"), F.col(text).alias("text")), None
    for held in itertools.chain([first, second], parts):
        some = stored(texts.mapInArrow(_hits(_sent(spark, held)), HITS), "hits")
        found = some if found is None else found.unionByName(some)
    one = found.groupBy("row").agg(
        F.struct(F.flatten(F.collect_list("runs")).alias("runs"), F.flatten(F.collect_list("items")).alias("items")).alias(hits)
    )
    joined = whole.join(one.withColumnRenamed("row", row), row, "left").select(*columns, hits)
    return joined.mapInArrow(_marker(columns, text, out, None, hits), T.StructType([*docs.schema.fields, fields]))


HITS = "row long, runs array<struct<start:long,end:long>>, items array<string>"
_HITS = pa.schema([("row", pa.int64()), ("runs", _RUNS), ("items", pa.list_(pa.string()))])


def _sent(spark: SparkSession, held: list | None):
    return spark.sparkContext.broadcast(_index(held)) if held else None


def _pairs(runs: list[tuple[int, int]]) -> list[dict]:
    return [{"start": a, "end": b} for a, b in runs]


def _hits(index):
    """Scans texts (row, text) for a block: the merged hits and the items of rows that have some."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, automaton = _automaton(index.value)
        for batch in batches:
            rows = []
            for row, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                found, items = _scan(words_of(value.as_py()), ids, automaton)
                if found:
                    rows.append({"row": row, "runs": _pairs(merged(found)), "items": sorted(items)})
            yield pa.RecordBatch.from_pylist(rows, schema=_HITS)

    return run


def _marker(columns: list[str], text: str, out: str, index, hits: str | None = None):
    """Adds the struct ``out`` from a scan of the text, or from ``hits`` that were found before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, automaton = _automaton(index.value) if index else ({}, None)
        for batch in batches:
            names = batch.schema.names
            before = batch.column(names.index(hits)).to_pylist() if hits else None
            rows = []
            for i, value in enumerate(batch.column(names.index(text))):
                whole = value.as_py() or ""
                words = words_of(whole)
                found, items = _scan(words, ids, automaton) if words and automaton else ([], set())
                if before and before[i]:
                    found = [(r["start"], r["end"]) for r in before[i]["runs"]]
                    items = {*before[i]["items"]}
                runs = merged(found)
                spans = _pairs(_spans(whole, runs)) if runs else []
                rows.append(
                    {"n_words": len(words), "n_hit": sum(b - a for a, b in runs),
                     "items": sorted(items), "runs": _pairs(runs), "spans": spans}
                )
            kept = [batch.column(names.index(c)) for c in columns]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(rows, _LEAK)], [*columns, out])

    return run


def clean(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` without those that hold a passage of the benchmark."""
    out = fresh(docs, "leak")
    return find_leaks(docs, benchmark, out=out, **options).filter(F.col(f"{out}.n_hit") == 0).drop(out)


def items_digest(items: str) -> Column:
    return F.sha2(F.concat_ws(",", F.array_sort(items)).cast("binary"), 256)
