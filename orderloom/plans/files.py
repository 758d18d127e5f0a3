"""Write derived orders as the files an ingest reads: CSV with bad lines, zips."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.functions.stores import store_of
from orderloom.operators.pieces import cut
from orderloom.schemas import ORDERS
from orderloom.sources.csv_orders import ORDER_TS_TEXT

HEADER = ",".join(ORDERS.columns)

# Order files are cut by the last digit of the order number, so their number does not
# depend on the tasks that write them.
ORDER_FILES = 10


def order_line() -> F.Column:
    ts = F.date_format("order_ts", ORDER_TS_TEXT)
    return F.concat_ws(",", "order_id", "product_id", F.col("quantity").cast("string"), ts)


def bad_line() -> F.Column:
    """A line that is too short for an order."""
    return F.concat_ws(",", F.col("seq").cast("string"), "product_id")


def bad_lines(changes: DataFrame) -> DataFrame:
    """Three lines per change row that are no orders: text quantity, too short, too long."""
    ts = F.date_format("last_updated_ts", ORDER_TS_TEXT)
    key = F.col("seq").cast("string")
    return changes.select(
        F.explode(
            F.array(
                F.concat_ws(",", key, "product_id", F.lit("x"), ts),
                F.concat_ws(",", key, "product_id"),
                F.concat_ws(",", key, "product_id", F.lit("1"), ts, F.lit("more")),
            )
        ).alias("value")
    )


def write_order_files(orders: DataFrame, bad: DataFrame, path: str) -> None:
    """Order files, one with a header line for every last digit of the order numbers; bad lines beside."""
    digit = F.col("order_id").cast("bigint") % ORDER_FILES
    lines = orders.select(digit.alias("digit"), order_line().alias("value"))
    headers = lines.select("digit").distinct().withColumn("value", F.lit(HEADER))
    headers.unionByName(lines).write.partitionBy("digit").mode("append").text(path)
    bad.withColumn("digit", F.lit(-1)).write.partitionBy("digit").mode("append").text(path)


# The most lines of an archive, which one task holds to write it.
ARCHIVE_LINES = 10_000

# Name of an archive: its piece of the lines, then the product they are of.
ARCHIVE_NAME = r"/\d+_([^/]*)\.zip$"


def write_damaged_zips(changes: DataFrame, path: str, lines_per_archive: int = ARCHIVE_LINES) -> None:
    """Per product a member with damaged data, then one of a header and lines that are no orders.

    A product's lines beyond ``lines_per_archive`` go on in more archives of its name, which have
    nothing else in them: the lines of a large product go to many tasks.
    """

    def archive(lines: list[str], first: bool) -> bytes:
        body = io.BytesIO()
        with zipfile.ZipFile(body, "w", zipfile.ZIP_DEFLATED) as z:
            if first:
                z.writestr("damaged.csv", f"{HEADER}\n" * 50)
            z.writestr("whole.csv", "\n".join([HEADER, *lines] if first else lines) + "\n")
        data = bytearray(body.getvalue())
        if first:
            start = data.index(b"damaged.csv") + len(b"damaged.csv")
            data[start : start + 8] = b"\xff" * 8
        return bytes(data)

    def write(key: tuple, table: pa.Table) -> pa.Table:
        store, folder = store_of(path)
        store.create_dir(folder, recursive=True)
        product, piece = (k.as_py() for k in key)
        lines = table["value"].drop_null().to_pylist()
        name = f"{piece}_{product}"
        aside = f"{folder}/_{name}-{TaskContext.get().taskAttemptId()}"
        with store.open_output_stream(aside, compression=None) as out:
            out.write(archive(sorted(lines), first=len(lines) < table.num_rows))
        store.move(aside, f"{folder}/{name}.zip")
        return pa.table({"archives": pa.array([1], pa.int32())})

    lines = changes.select("product_id", bad_line().alias("value"))
    split = cut(lines, ["product_id", "value"], lines_per_archive)
    # A row without a line marks the first archive of a product.
    first = split.groupBy("product_id").agg(F.min("piece").alias("piece"))
    marked = split.unionByName(first.withColumn("value", F.lit(None).cast("string")))
    marked.groupBy("product_id", "piece").applyInArrow(write, "archives int").agg(F.sum("archives")).collect()


def write_zip_batches(
    orders: DataFrame, path: str, members: int = 4, lines_per_member: int = 1000
) -> None:
    """Write orders as zip archives of CSV members, plus one broken archive per task."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = store_of(path)
        store.create_dir(folder, recursive=True)
        part = TaskContext.get().partitionId()

        def put(name: str, body) -> None:
            # Write aside, then move: the folder only ever shows whole archives.
            with store.open_output_stream(f"{folder}/_{name}", compression=None) as out:
                body(out)
            store.move(f"{folder}/_{name}", f"{folder}/{name}")

        def archive(number: int, lines: list[str]) -> None:
            def body(out) -> None:
                with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
                    for m in range(members):
                        text = "\n".join([HEADER, *lines[m::members]]) + "\n"
                        z.writestr(f"part{m}.csv", text)

            put(f"{part:05d}-{number:05d}.zip", body)

        number, held = 0, []
        for batch in batches:
            held.extend(batch["line"].to_pylist())
            while len(held) >= members * lines_per_member:
                archive(number, held[: members * lines_per_member])
                held = held[members * lines_per_member:]
                number += 1
        if held:
            archive(number, held)
            number += 1
        put(f"broken_{part}.zip", lambda out: out.write(b"this is not an archive"))
        yield pa.RecordBatch.from_arrays([pa.array([number], pa.int32())], ["archives"])

    orders.select(order_line().alias("line")).mapInArrow(write, "archives int").agg(
        F.sum("archives")
    ).collect()
