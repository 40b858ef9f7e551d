"""Requests to a model, scoring on executors, and the results table.

A scorer is a function from a list of request dicts to a list of reply dicts of the same
length and order, each ``{"status": "success", "result": {...}}`` or an error.  It runs inside
tasks, on slices of a partition, so the queue never passes through the driver.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from datetime import datetime, timezone

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.sources import versions
from tidemark.sources.session import run_folder

Scorer = Callable[[list[dict]], list[dict]]

BATCH_SIZE = 10
SUCCESS = "success"


# --- requests ---


def analysis_of(kind: Column) -> Column:
    """Analysis for a data type: text or image."""
    return F.when(kind == "text", "text").otherwise("image")


def single_requests(news: DataFrame) -> DataFrame:
    """One request per news row: the title with its source and time."""
    kind = F.lit("text")
    return news.select(
        F.col("id").cast("string").alias("id"),
        kind.alias("type"),
        analysis_of(kind).alias("analysis_type"),
        F.col("title").alias("content"),
        F.struct("source", "timestamp").alias("metadata"),
    )


def batch_requests(reviews: DataFrame, source: str, task: str = "sentiment") -> DataFrame:
    """Review texts as batch requests; the id is made from the review's own id.

    ``source`` names where the reviews come from.
    """
    return reviews.select(
        F.lit("text").alias("data_type"),
        F.col("review_text").alias("content"),
        F.lit(task).alias("task"),
        F.struct(
            F.concat(F.lit("review_"), F.col("review_id")).alias("id"),
            F.lit(source).alias("source"),
        ).alias("metadata"),
    )


def queue_requests(queue: DataFrame, task: str = "sentiment") -> DataFrame:
    """Rows of the API queue (or any id, data_type, content) as scorer input."""
    return queue.select(
        F.col("id").cast("string").alias("id"), "data_type", "content", F.lit(task).alias("task")
    )


# --- scoring ---


def _confidence(result: dict) -> float | None:
    value = (result.get("sentiment") or {}).get("confidence")
    return None if value is None else float(value)


def _reply_row(request: dict, reply: object, moment: str, failure: str | None) -> dict:
    reply = reply if isinstance(reply, dict) else {}
    good = reply.get("status") == SUCCESS and isinstance(reply.get("result"), dict)
    result = reply["result"] if good else None
    reason = failure or reply.get("error") or f"reply with status {reply.get('status')}"
    return {
        "original_id": request["id"],
        "analysis_type": request["task"],
        "result": json.dumps(result, ensure_ascii=False) if good else None,
        "confidence": _confidence(result) if good else None,
        "processed_at": moment,
        "status": SUCCESS if good else "error",
        "error": None if good else str(reason),
    }


def _scoring(scorer: Scorer, batch_size: int, now: str | None):
    names = schemas.SCORED.names

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            requests = batch.to_dict("records")
            rows = []
            for start in range(0, len(requests), batch_size):
                part = requests[start : start + batch_size]
                failure = None
                try:
                    replies = list(scorer(part))
                except Exception as error:
                    replies, failure = [None] * len(part), f"{type(error).__name__}: {error}"
                # A short or missing answer cannot be told apart by position.
                if len(replies) != len(part):
                    failure = f"{len(replies)} replies to {len(part)} requests"
                    replies = [None] * len(part)
                moment = now or datetime.now(timezone.utc).replace(tzinfo=None).isoformat()
                rows += [_reply_row(a, b, moment, failure) for a, b in zip(part, replies)]
            yield pd.DataFrame(rows, columns=names)

    return run


def score(
    requests: DataFrame,
    scorer: Scorer,
    batch_size: int = BATCH_SIZE,
    partitions: int | None = None,
    now: str | None = None,
) -> DataFrame:
    """Score ``requests`` (id, data_type, content, task) in slices of ``batch_size``.

    Every request yields one row, failures with ``status='error'`` and the reason.  Scoring is the slow part,
    so ``partitions`` may spread a queue that lies in few files over more tasks.
    """
    frame = requests.select("id", "data_type", "content", "task")
    if partitions is not None:
        frame = frame.repartition(partitions)
    return frame.mapInPandas(_scoring(scorer, batch_size, now), schemas.SCORED)


def successes(scored: DataFrame) -> DataFrame:
    """Rows of the results table: successful ones, without the status."""
    return scored.where(F.col("status") == SUCCESS).select(*schemas.IA_RESULTS.names)


def failures(scored: DataFrame) -> DataFrame:
    """Requests that were not scored, with the reason."""
    return scored.where(F.col("status") != SUCCESS).select(
        "original_id", "analysis_type", "error", "processed_at"
    )


def batch_success(scored: DataFrame) -> DataFrame:
    """One row: processed and successful requests."""
    return scored.agg(
        F.count("*").alias("total_processed"),
        F.count_if(F.col("status") == SUCCESS).alias("successful"),
    )


def read_results(spark: SparkSession, path: str) -> DataFrame:
    """The results table as of now; empty before the first run."""
    if versions.version(spark, path) is not None:
        return versions.read(spark, path)
    try:
        return spark.read.schema(schemas.IA_RESULTS).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schemas.IA_RESULTS)


def pending(requests: DataFrame, results: DataFrame) -> DataFrame:
    """Requests without a stored result for their task; a missing id or task is one like others.

    Ids are made distinct on the map side, so that a result stored many times is shuffled
    once per task.
    """
    done = results.select(
        F.col("original_id").alias("done_id"), F.col("analysis_type").alias("done_task")
    ).distinct()
    same = F.col("id").eqNullSafe(F.col("done_id")) & F.col("task").eqNullSafe(F.col("done_task"))
    return requests.join(done, same, "left_anti")


def score_pending(
    requests: DataFrame,
    scorer: Scorer,
    path: str,
    batch_size: int = BATCH_SIZE,
    partitions: int | None = None,
    now: str | None = None,
    failed_path: str | None = None,
    run: str | None = None,
) -> DataFrame:
    """Score what has no result for its task yet and append the successes; safe to run again.

    Replies are written once; the successes go on to ``path``, the failures with their reasons to
    ``failed_path`` if given, each as a run that is there whole or not at all.  A run that died is
    repeated with the same ``run`` id: it does not score again what it has replies for, and
    neither table takes a run twice.  Without an id every call is a run of its own.  Returns the
    replies of this run.
    """
    spark = requests.sparkSession
    replies = f"{path.rstrip('/')}/replies-{run}" if run else run_folder(spark, "replies")
    if not (run and versions.written(spark, replies)):
        todo = pending(requests, read_results(spark, path))
        # What a run that died has left is not whole.
        score(todo, scorer, batch_size, partitions, now).write.mode("overwrite").parquet(replies)
    scored = spark.read.schema(schemas.SCORED).parquet(replies)
    versions.append(successes(scored), path, run)
    if failed_path is not None:
        versions.append(failures(scored), failed_path, run)
    return scored


# --- results ---


def newest_results(results: DataFrame) -> DataFrame:
    """One result per input and task: the latest.  Combined on the map side."""
    keys = ["original_id", "analysis_type"]
    fields = [name for name in results.columns if name not in keys]
    best = F.max_by(F.struct(*fields), F.struct("processed_at", "result"))
    return results.groupBy(*keys).agg(best.alias("best")).select(*keys, "best.*")


def queue_with_results(
    queue: DataFrame, results: DataFrame, task: str | None = None
) -> DataFrame:
    """Queue rows with the latest result of each task, NULL where there is none yet.

    With ``task`` every queue row shows the result of that task; without it a queue row comes
    once for every task it has a result of.
    """
    if task is not None:
        results = results.where(F.col("analysis_type") == task)
    found = newest_results(results).withColumnRenamed("original_id", "id")
    return queue.join(found, "id", "left")


def with_analysis(results: DataFrame) -> DataFrame:
    """Results with sentiment, topic and object count read out of their JSON."""
    parsed = results.withColumn("analysis", F.from_json("result", schemas.ANALYSIS))
    return parsed.select(
        *results.columns,
        F.col("analysis.sentiment.label").alias("sentiment"),
        F.col("analysis.sentiment.confidence").alias("sentiment_confidence"),
        F.col("analysis.classification.category").alias("topic"),
        F.col("analysis.object_detection.objects_count").alias("objects_count"),
    )


# --- detections ---

Detector = Callable[[bytes], list[dict] | None]


def _detecting(detector: Detector):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found, reasons = [], []
            for content in batch["content"]:
                try:
                    found.append(detector(content))
                    reasons.append("unreadable" if found[-1] is None else None)
                except Exception as error:
                    found.append(None)
                    reasons.append(f"{type(error).__name__}: {error}")
            yield pd.DataFrame(
                {
                    "path": batch["path"],
                    "detections": pd.Series(found, dtype=object),
                    "status": ["error" if item is None else SUCCESS for item in found],
                    "error": reasons,
                }
            )

    return run


def detect(images: DataFrame, detector: Detector) -> DataFrame:
    """Detections of each image (path, content); unreadable images have status ``error``."""
    detections = schemas.DETECTIONS.simpleString()
    schema = f"path string, detections {detections}, status string, error string"
    return images.select("path", "content").mapInPandas(_detecting(detector), schema)


def object_counts(detected: DataFrame) -> DataFrame:
    """Objects found per image."""
    return detected.select("path", F.size("detections").alias("objects_count"), "status")


def detection_rows(detected: DataFrame) -> DataFrame:
    """One row per detected object."""
    return detected.select("path", F.inline("detections"))
