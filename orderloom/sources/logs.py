"""Append logs as Parquet folders: the tables between the stages of the pipeline."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.functions.time import as_event_time
from orderloom.schemas import WATERMARK_DELAY, Relation


def read_log(spark: SparkSession, relation: Relation, path: str) -> DataFrame:
    return spark.read.schema(relation.schema).parquet(path)


def append_log(df: DataFrame, relation: Relation, path: str) -> None:
    relation.conform(df).write.mode("append").parquet(path)


def stream_log(
    spark: SparkSession,
    relation: Relation,
    path: str,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Read a log from its first file on; new files become new rows.

    With an event time declared, the column becomes ``timestamp``, rows without
    one are left out (a null would count as 1970) and the watermark is set.
    """
    reader = spark.readStream.schema(relation.schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return with_event_time(reader.parquet(path), relation)


def with_event_time(df: DataFrame, relation: Relation) -> DataFrame:
    ts = relation.event_time
    if ts is None:
        return df
    return (
        df.filter(F.col(ts).isNotNull())
        .withColumn(ts, as_event_time(ts))
        .withWatermark(ts, WATERMARK_DELAY)
    )


def register_log(spark: SparkSession, relation: Relation, path: str) -> DataFrame:
    """Make a log known to SQL under its declared name."""
    df = read_log(spark, relation, path)
    df.createOrReplaceTempView(relation.name)
    return df
