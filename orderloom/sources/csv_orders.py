"""Order CSV lines: one decoder for files and for lines out of zip archives.

A line that is not four fields of the declared types is never an order. That
covers the header line each file starts with. Such lines go to quarantine.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamReader

from orderloom.functions.time import truncate_ms
from orderloom.schemas import INTAKE, ORDERS

BAD_LINE = "_corrupt_record"

# Fixed values of the file format.
CSV_OPTIONS = {
    "sep": ",",
    "header": "false",
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": BAD_LINE,
    "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss[.SSSSSSSSS]",
}
ORDER_TS_TEXT = "yyyy-MM-dd HH:mm:ss.SSS"

LINE_DDL = ", ".join(
    [f"{f.name} {f.dataType.simpleString()}" for f in ORDERS.schema.fields] + [f"{BAD_LINE} string"]
)


class Ingest(NamedTuple):
    """The two outputs of an ingest: valid orders and everything refused."""

    orders: DataFrame
    quarantine: DataFrame


def split_lines(decoded: DataFrame) -> Ingest:
    """Separate the rows of a decoded intake."""
    return Ingest(
        ORDERS.conform(decoded.filter(~F.col("refused"))),
        decoded.filter("refused").select("path", "member", "line", "error"),
    )


def _file_lines(text: DataFrame) -> DataFrame:
    return text.select(
        F.col("_metadata.file_path").alias("path"),
        F.lit(None).cast("string").alias("member"),
        F.col("value").alias("line"),
        F.lit(None).cast("string").alias("error"),
    )


def read_csv_orders(spark: SparkSession, path: str) -> Ingest:
    """All CSV files under a folder.

    Lines are read as text and decoded whole: the CSV reader would skip checking
    the columns a query does not use and so let bad lines through a ``count``.
    """
    return decode_lines(_file_lines(spark.read.option("recursiveFileLookup", "true").text(path)))


def bounded(reader: DataStreamReader, archive: str | None) -> DataStreamReader:
    """A file stream that moves files it is done with to the folder ``archive``, or with the word
    ``delete`` removes them. A file is done with when the batch after its own is."""
    if archive is None:
        return reader
    if archive == "delete":
        return reader.option("cleanSource", "delete")
    return reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)


def stream_csv_orders(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None
) -> Ingest:
    """A folder watched for new CSV files. Producers must move finished files in."""
    return split_lines(stream_csv_intake(spark, path, max_files_per_trigger))


def stream_csv_intake(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None, archive: str | None = None
) -> DataFrame:
    """The same, as one stream of decoded rows. ``archive`` as in ``bounded``."""
    reader = bounded(spark.readStream.option("recursiveFileLookup", "true"), archive)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return decode(_file_lines(reader.text(path)))


def decode_lines(lines: DataFrame) -> Ingest:
    """Decode ``(path, member, line, error)`` rows into orders and refused lines."""
    return split_lines(decode(lines))


def decode(lines: DataFrame) -> DataFrame:
    """Every line decoded once, as a row of ``INTAKE``; blank lines are skipped."""
    # As a generator the parser runs once per line; as a plain column it would run
    # again in the filter that separates good from bad.
    parsed = lines.filter(F.col("error").isNotNull() | (F.trim("line") != "")).select(
        "path", "member", "error", F.inline(F.array(F.from_csv("line", LINE_DDL, CSV_OPTIONS)))
    )
    refused = F.col(BAD_LINE).isNotNull() | F.col("error").isNotNull()
    good = [
        F.when(~refused, truncate_ms(f.name) if f.name == "order_ts" else F.col(f.name)).alias(f.name)
        for f in ORDERS.schema.fields
    ]
    return INTAKE.conform(
        parsed.select(
            *good,
            "path",
            "member",
            F.col(BAD_LINE).alias("line"),
            F.when(refused, F.coalesce("error", F.lit("malformed line"))).alias("error"),
            refused.alias("refused"),
        )
    )


def write_csv_orders(orders: DataFrame, path: str) -> None:
    """Write orders in the file format, each file with a header line."""
    orders.select(
        "order_id", "product_id", "quantity", F.date_format("order_ts", ORDER_TS_TEXT).alias("order_ts")
    ).write.mode("append").option("header", "true").csv(path)
