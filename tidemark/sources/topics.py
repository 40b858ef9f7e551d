"""Topics of JSON messages: Kafka connectors, and the encoding on its own.

The encoding works on any frame with the columns ``topic``, ``key`` and ``value``, so the
same code runs on Kafka, on landed files and in tests.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from tidemark import schemas
from tidemark.functions.casts import iso_text
from tidemark.operators.once import with_once
from tidemark.schemas import CORRUPT

# Topic names.
TEXT_TOPIC = "text-topic"
IMAGES_TOPIC = "images-topic"
TOPICS = f"{TEXT_TOPIC},{IMAGES_TOPIC}"

# Columns of a Kafka record that say where a message came from.
POSITION = ("topic", "key", "partition", "offset")


def read_topics(
    spark: SparkSession, servers: str, topics: str = TOPICS, starting: str = "earliest"
) -> DataFrame:
    """Everything in the topics, as a batch."""
    return (
        spark.read.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topics)
        .option("startingOffsets", starting)
        .load()
    )


def stream_topics(
    spark: SparkSession,
    servers: str,
    topics: str = TOPICS,
    starting: str = "latest",
    per_trigger: int | None = None,
) -> DataFrame:
    """The topics as a stream, at most ``per_trigger`` messages per batch if given."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topics)
        .option("startingOffsets", starting)
    )
    if per_trigger is not None:
        reader = reader.option("maxOffsetsPerTrigger", per_trigger)
    return reader.load()


def decode(
    records: DataFrame,
    schema: StructType = schemas.MESSAGE,
    fields: Sequence[str] | None = None,
) -> DataFrame:
    """Topic, key and position of each record and the fields of its JSON value.

    Only ``fields`` are parsed, if given.  Values that are no JSON object keep their text in the
    corrupt column.
    """
    if fields is not None:
        schema = StructType([field for field in schema.fields if field.name in fields])
    value = F.col("value").cast("string")
    # The key is taken from the record; a message's own fields follow.
    place = [
        F.col(name).cast("string").alias(name) if name == "key" else F.col(name)
        for name in POSITION
        if name in records.columns
    ]
    wide = StructType([*schema.fields, StructField(CORRUPT, StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    placed = records.select(*place, value.alias("value"))
    parsed = with_once(placed, "message", F.from_json("value", wide, options))
    return parsed.select(*[name for name in POSITION if name in records.columns], "message.*")


def split_corrupt(decoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(readable messages, unreadable values)."""
    bad = F.col(CORRUPT).isNotNull()
    place = [name for name in POSITION if name in decoded.columns]
    return decoded.where(~bad).drop(CORRUPT), decoded.where(bad).select(*place, CORRUPT)


def with_envelope(
    messages: DataFrame, topic: Column | str, sent_at: Column | None = None
) -> DataFrame:
    """Adds the topic and the send time."""
    sent = iso_text(F.current_timestamp()) if sent_at is None else sent_at
    name = F.lit(topic) if isinstance(topic, str) else topic
    return messages.withColumns(
        {"kafka_topic": name, "sent_to_kafka_at": sent.cast("string")}
    )


def encode(
    messages: DataFrame, topic: Column | str, sent_at: Column | None = None
) -> DataFrame:
    """Messages as ``topic``, ``key`` (the id) and ``value`` (JSON, UTF-8) columns.

    The topic is a name, or a column when the rows go to several topics.
    """
    sealed = with_envelope(messages, topic, sent_at)
    fields = [name for name in sealed.columns if name != "topic"]
    return sealed.select(
        F.col("kafka_topic").alias("topic"),
        F.col("id").cast("string").alias("key"),
        F.to_json(F.struct(*fields)).alias("value"),
    )


def send(messages: DataFrame, servers: str, topic: str) -> None:
    """Publish a batch; rows are keyed by id."""
    (
        encode(messages, topic)
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .save()
    )


def send_stream(
    messages: DataFrame, servers: str, topic: str, checkpoint: str
) -> StreamingQuery:
    """Publish a stream; rows are keyed by id."""
    return (
        encode(messages, topic)
        .writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("checkpointLocation", checkpoint)
        .start()
    )


def newest_messages(records: DataFrame, limit: int = 50) -> DataFrame:
    """The last ``limit`` records of the topics, newest first."""
    return records.orderBy(F.desc("timestamp"), F.desc("offset"), "topic", "partition").limit(
        limit
    )
