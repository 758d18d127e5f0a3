"""Deployment edge: the same logs as message topics instead of folders.

Needs the Kafka and Avro packages on the cluster (``spark.jars.packages``); they
are not part of a plain Spark install, so this module is not covered by tests.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from orderloom.functions.wire import frame, key_text, raw_key, unframe
from orderloom.operators.changelog import is_live
from orderloom.schemas import PRODUCTS, Relation
from orderloom.sources.logs import with_event_time


def stream_topic(
    spark: SparkSession, relation: Relation, servers: str, topic: str, avro_schema: str
) -> DataFrame:
    """An append log from its earliest offset."""
    return with_event_time(_decoded(_messages(spark, servers, topic), relation, avro_schema), relation)


def stream_product_topic(
    spark: SparkSession, servers: str, topic: str, avro_schema: str
) -> DataFrame:
    """A keyed upsert topic as change rows: a null value deletes its key.

    The arrival order ``seq`` is the partition offset, which is comparable within
    a key because a key stays in one partition. A delete takes the message time,
    as it carries no row.
    """
    from pyspark.sql.avro.functions import from_avro

    is_delete = F.col("value").isNull()
    rows = _messages(spark, servers, topic).select(
        key_text("key").alias("product_id"),
        from_avro(unframe(F.col("value")), avro_schema).alias("r"),
        F.when(is_delete, "d").otherwise("u").alias("op"),
        F.col("offset").alias("seq"),
        F.col("timestamp").alias("message_ts"),
    )
    changes = rows.select(
        "product_id",
        "r.product_name",
        "r.stock",
        F.coalesce("r.last_updated_ts", "message_ts").alias("last_updated_ts"),
        "op",
        "seq",
    )
    return with_event_time(changes, PRODUCTS)


def start_topic(
    df: DataFrame,
    relation: Relation,
    servers: str,
    topic: str,
    avro_schema: str,
    schema_id: int,
    checkpoint: str,
    trigger: dict,
) -> StreamingQuery:
    """Append rows to a topic, keyed by the relation's message key.

    The rows must have the declared columns. A change row with ``op`` d goes out without a
    value: readers of a keyed topic take that as a delete.
    """
    from pyspark.sql.avro.functions import to_avro

    missing = [c for c in relation.columns if c not in df.columns]
    if missing:
        raise ValueError(f"{relation.name}: missing columns {missing}")
    value = frame(to_avro(F.struct(*relation.columns), avro_schema), schema_id)
    if "op" in df.columns and "op" not in relation.columns:
        value = F.when(is_live(), value)
    return (
        df.select(raw_key(relation.message_key).alias("key"), value.alias("value"))
        .writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def _messages(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .load()
    )


def _decoded(messages: DataFrame, relation: Relation, avro_schema: str) -> DataFrame:
    from pyspark.sql.avro.functions import from_avro

    rows = messages.select(from_avro(unframe(F.col("value")), avro_schema).alias("r"))
    return rows.select(*[F.col(f"r.{c}").alias(c) for c in relation.columns])
