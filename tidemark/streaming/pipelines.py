"""Streams of topic messages: landing, running totals, windowed counts, publishing.

The transformations take and return streaming frames; the ``start_*`` functions attach a sink
and a checkpoint.  ``once=True`` drains what is there and stops; otherwise a batch runs every
five minutes.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.types import StructType

from tidemark.functions.casts import parse_iso
from tidemark.operators import limits
from tidemark.operators.preprocess import preprocess_news
from tidemark.sources import versions
from tidemark.sources.topics import IMAGES_TOPIC, TEXT_TOPIC

CYCLE = "300 seconds"
LATENESS = "1 hour"
BUCKET = "5 minutes"
# Versions of the current values that are kept side by side.
VERSIONS = 4


# --- sources ---


def stream_parquet(
    spark: SparkSession, path: str, schema: StructType, files_per_trigger: int | None = None
) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def stream_values(
    spark: SparkSession, path: str, topic: str, files_per_trigger: int | None = None
) -> DataFrame:
    """Lines of landed files as the records of a topic."""
    reader = spark.readStream.format("text")
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path).select(F.lit(topic).alias("topic"), "value")


# --- transformations ---


def with_event_time(messages: DataFrame, when: Column | str = "scraped_at") -> DataFrame:
    """Messages with ``event_time``; unreadable times are NULL and stay out of windows."""
    moment = parse_iso(when) if isinstance(when, str) else when
    return messages.withColumn("event_time", moment.cast("timestamp"))


def deduplicated(messages: DataFrame, delay: str = LATENESS, key: str = "id") -> DataFrame:
    """Each id once within ``delay``, which must exceed the time between two re-sends.

    Rows behind the watermark are dropped first, so a late copy never hides a fresh one: nothing
    may be dropped before that.  A message without an id is a copy only of one that is equal in
    every column.  All copies of an id go to the task that keeps its state, as rows that stream
    by; the state is one row per id.
    """
    named = F.concat(F.lit("id:"), F.col(key).cast("string"))
    unnamed = F.concat(F.lit("row:"), F.xxhash64(*messages.columns).cast("string"))
    keyed = messages.withColumn("_copy_of", F.coalesce(named, unnamed))
    kept = keyed.withWatermark("event_time", delay).dropDuplicatesWithinWatermark(["_copy_of"])
    return kept.drop("_copy_of")


def running_totals(messages: DataFrame) -> DataFrame:
    """Articles and images so far, per source and category.

    State is one row per (topic, source, category), not per message.
    """
    return messages.groupBy(
        "topic",
        F.coalesce("source", F.lit("unknown")).alias("source"),
        F.coalesce("category", F.lit("general")).alias("category"),
    ).agg(F.count("*").alias("n"))


def hourly_windows(messages: DataFrame, delay: str = LATENESS) -> DataFrame:
    """Messages per hour; later than ``delay`` is not counted, which bounds the state."""
    return (
        messages.withWatermark("event_time", delay)
        .groupBy(F.window("event_time", "1 hour").alias("w"))
        .agg(F.count("*").alias("n"))
        .select(F.col("w.start").alias("hour"), "n")
    )


def bucket_counts(
    messages: DataFrame, bucket: str = BUCKET, delay: str = LATENESS
) -> DataFrame:
    """Messages per bucket of time.  Each message is one row of one bucket."""
    return (
        messages.withWatermark("event_time", delay)
        .groupBy(F.window("event_time", bucket).alias("w"))
        .agg(F.count("*").alias("n"))
        .select(F.col("w.start").alias("bucket"), "n")
    )


def last_hour_counts(buckets: DataFrame, bucket: str = BUCKET) -> DataFrame:
    """Messages of the hour before the end of each bucket, from the current bucket counts."""
    step = F.expr(f"INTERVAL {bucket}")
    ends = F.sequence(F.col("bucket") + step, F.col("bucket") + F.expr("INTERVAL 1 HOUR"), step)
    return (
        buckets.select(F.explode(ends).alias("as_of"), "n")
        .groupBy("as_of")
        .agg(F.sum("n").alias("n"))
    )


def cycle_counters(corrupt: str) -> list[Column]:
    """Aggregates over the messages of a cycle."""
    bad = F.col(corrupt).isNotNull()
    return [
        F.count_if(~bad).alias("total_scraped"),
        F.count_if(~bad & (F.col("topic") == TEXT_TOPIC)).alias("text_articles"),
        F.count_if(~bad & (F.col("topic") == IMAGES_TOPIC)).alias("image_metadata"),
        F.count_if(bad).alias("errors"),
    ]


def with_cycle_counters(decoded: DataFrame, corrupt: str, name: str = "cycle") -> DataFrame:
    """Counts per batch, reported in the query's progress under ``name``."""
    return decoded.observe(name, *cycle_counters(corrupt))


# --- sinks ---


def _triggered(writer: DataStreamWriter, once: bool) -> DataStreamWriter:
    return writer.trigger(availableNow=True) if once else writer.trigger(processingTime=CYCLE)


def start_parquet(
    df: DataFrame, path: str, checkpoint: str, once: bool = False, by: Sequence[str] = ()
) -> StreamingQuery:
    """Append a stream to a Parquet folder, exactly once, partitioned ``by`` columns if any."""
    writer = df.writeStream.format("parquet").outputMode("append")
    if by:
        writer = writer.partitionBy(*by)
    return _triggered(writer.option("checkpointLocation", checkpoint), once).start(path)


def start_landing(
    news: DataFrame, path: str, checkpoint: str, once: bool = False, now: Column | None = None
) -> StreamingQuery:
    """Clean and gate a news stream and land it."""
    return start_parquet(preprocess_news(news, now), path, checkpoint, once)


def _newest(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The row of the last epoch of every group, with its epoch."""
    values = [name for name in rows.columns if name not in (*keys, "epoch")]
    best = F.max_by(F.struct(*values), "epoch").alias("best")
    return rows.groupBy(*keys).agg(best, F.max("epoch").alias("epoch")).select(
        *keys, "best.*", "epoch"
    )


Merge = Callable[[DataFrame | None, DataFrame], DataFrame]


def _commit_epoch(
    batch: DataFrame, epoch: int, path: str, merge: Merge, retention: float
) -> None:
    """Commit ``merge`` of the last version (None at first) and the batch, once for each epoch."""
    spark = batch.sparkSession
    at = versions.version(spark, path)
    if at is not None and at.mark >= epoch:
        return  # a repeated batch that was committed before the restart
    known = None if at is None else versions.read(spark, path, at)
    versions.replace(merge(known, batch), path, mark=epoch)
    versions.vacuum(spark, path, VERSIONS, retention)


def _merge_epoch(
    path: str, keys: list[str], retention: float
) -> Callable[[DataFrame, int], None]:
    def write(batch: DataFrame, epoch: int) -> None:
        def merge(known: DataFrame | None, rows: DataFrame) -> DataFrame:
            return rows if known is None else _newest(known.unionByName(rows), keys)

        rows = batch.withColumn("epoch", F.lit(epoch).cast("long"))
        _commit_epoch(rows, epoch, path, merge, retention)

    return write


def start_updates(
    df: DataFrame,
    path: str,
    checkpoint: str,
    keys: list[str],
    once: bool = False,
    retention: float = versions.RETENTION,
) -> StreamingQuery:
    """Keep the current row of every group (``keys``) below ``path``.

    Each batch merges its changed groups into the last version and commits the next, under the
    batch's number, so a repeated batch counts once.  Readers are never disturbed: a version is
    immutable, and goes once VERSIONS newer ones exist and the next one is ``retention`` seconds
    old, so the folder holds a bounded number of rows per group however long it runs.  A new
    checkpoint needs a new path.
    """
    writer = df.writeStream.outputMode("update").foreachBatch(_merge_epoch(path, keys, retention))
    return _triggered(writer.option("checkpointLocation", checkpoint), once).start()


def current_values(spark: SparkSession, path: str, keys: list[str] | None = None) -> DataFrame:
    """The latest row of every group that :func:`start_updates` wrote: its newest version.

    The frame keeps to this version, whatever is written while it is used.
    """
    return versions.read(spark, path).drop("epoch")


def start_newest(
    rows: DataFrame,
    path: str,
    checkpoint: str,
    key: str,
    order: list[Column],
    limit: int,
    once: bool = False,
    retention: float = versions.RETENTION,
) -> StreamingQuery:
    """Keep the first ``limit`` rows of every key in ``order``, whatever batch they come in.

    A batch is cut to ``limit`` rows per key in salted parts before it meets the rows kept so far,
    so a key may hold most of it.  Read with :func:`current_values`.  ``order`` must tell any two
    different rows apart.
    """

    def merge(known: DataFrame | None, batch: DataFrame) -> DataFrame:
        best = limits.newest_per_key(batch, key, order, limit)
        if known is None:
            return best
        return limits.newest_per_key(known.unionByName(best), key, order, limit)

    def write(batch: DataFrame, epoch: int) -> None:
        _commit_epoch(batch, epoch, path, merge, retention)

    writer = rows.writeStream.foreachBatch(write)
    return _triggered(writer.option("checkpointLocation", checkpoint), once).start()


def start_split(
    decoded: DataFrame,
    corrupt: str,
    good_path: str,
    bad_path: str,
    checkpoint: str,
    once: bool = False,
    prepare: Callable[[DataFrame], DataFrame] = lambda good: good,
    statistics_path: str | None = None,
    retention: float = versions.RETENTION,
) -> StreamingQuery:
    """Land readable messages as ``prepare`` makes them, and unreadable ones next to them.

    Both come from one read of the topic; a repeated batch replaces its own folders.  With
    ``statistics_path`` the batch's counts (:func:`cycle_counters`) are kept there, a row with
    its number, time and seconds for every batch, once however often it was repeated; read them
    with :func:`current_values`.
    """

    def keep_statistics(batch: DataFrame, epoch: int, began: float) -> None:
        seconds = F.lit(time.time() - began)
        row = batch.agg(*cycle_counters(corrupt)).select(
            F.lit(epoch).cast("long").alias("batch"),
            F.current_timestamp().alias("ended"),
            seconds.alias("seconds"),
            "*",
        )

        def add(known: DataFrame | None, new: DataFrame) -> DataFrame:
            return new if known is None else known.unionByName(new).coalesce(1)

        _commit_epoch(row, epoch, statistics_path, add, retention)

    def write(batch: DataFrame, epoch: int) -> None:
        began = time.time()
        batch.persist()
        try:
            bad = F.col(corrupt).isNotNull()
            good_rows = prepare(batch.where(~bad).drop(corrupt))
            good_rows.write.mode("overwrite").parquet(f"{good_path}/epoch={epoch}")
            batch.where(bad).select("topic", corrupt).write.mode("overwrite").parquet(
                f"{bad_path}/epoch={epoch}"
            )
            if statistics_path is not None:
                keep_statistics(batch, epoch, began)
        finally:
            batch.unpersist()

    writer = decoded.writeStream.foreachBatch(write)
    return _triggered(writer.option("checkpointLocation", checkpoint), once).start()
