"""Requests, scoring on executors, stored results and detections."""

import fixtures
import pytest
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators import preprocess, scoring
from tidemark.sources import versions

NOW = "2025-06-24T12:00:00"


def scorer(requests):
    if any(r["content"] == "crash" for r in requests):
        raise RuntimeError("service down")
    if any(r["content"] == "short" for r in requests):
        return []
    replies = []
    for request in requests:
        if request["content"] == "bad":
            replies.append({"status": "error", "error": "too bad"})
        elif request["task"] == "classification":
            result = {"classification": {"category": "té"}}
            replies.append({"status": "success", "result": result})
        else:
            result = {"sentiment": {"label": "POSITIVE", "confidence": 0.75}}
            replies.append({"status": "success", "result": result})
    return replies


def requests(spark, *contents, task="sentiment"):
    rows = [(str(i), "text", content, task) for i, content in enumerate(contents)]
    return spark.createDataFrame(rows, "id string, data_type string, content string, task string")


def test_scores_keep_ids_and_failures(spark):
    frame = requests(spark, "a", "bad", "c")
    rows = scoring.score(frame, scorer, now=NOW).orderBy("original_id").collect()
    assert [(r.original_id, r.status, r.confidence) for r in rows] == [
        ("0", "success", 0.75),
        ("1", "error", None),
        ("2", "success", 0.75),
    ]
    assert [r.original_id for r in scoring.successes(
        scoring.score(frame, scorer)).orderBy("original_id").collect()] == ["0", "2"]
    assert tuple(scoring.batch_success(scoring.score(frame, scorer)).first()) == (3, 2)


def test_failing_batch_marks_only_its_own_rows(spark):
    frame = requests(spark, *["ok"] * 10, "crash", *["ok"] * 9, "short").coalesce(1)
    scored = scoring.score(frame, scorer, batch_size=10)
    assert tuple(scoring.batch_success(scored).first()) == (21, 10)
    assert {r.error for r in scoring.failures(scored).collect()} == {
        "RuntimeError: service down",
        "0 replies to 1 requests",
    }


def test_each_task_is_scored_and_shown(spark, tmp_path):
    path, failed = str(tmp_path / "results"), str(tmp_path / "failed")
    for task in ("sentiment", "classification"):
        frame = requests(spark, "a", "bad", task=task)
        assert scoring.pending(frame, scoring.read_results(spark, path)).count() == 2
        scored = scoring.score_pending(frame, scorer, path, now=NOW, failed_path=failed)
        assert scored.count() == 2
    results = scoring.read_results(spark, path)
    queue = frame.select("id")
    rows = scoring.queue_with_results(queue, scoring.with_analysis(results)).collect()
    assert sorted((r.id, str(r.analysis_type), r.sentiment, r.topic) for r in rows) == [
        ("0", "classification", None, "té"),
        ("0", "sentiment", "POSITIVE", None),
        ("1", "None", None, None),
    ]
    one = scoring.queue_with_results(queue, results, "classification").collect()
    assert sorted((r.id, r.analysis_type) for r in one if r.analysis_type) == [
        ("0", "classification")
    ]
    assert [r.error for r in versions.read(spark, failed).collect()] == ["too bad", "too bad"]


def test_partitions_spread_the_queue(spark):
    frame = requests(spark, *["x"] * 40).coalesce(1)
    scored = scoring.score(frame, scorer, partitions=4)
    assert scored.rdd.getNumPartitions() == 4
    assert scored.count() == 40


def test_rerun_scores_only_what_is_missing(spark, tmp_path):
    path = str(tmp_path / "results")
    scoring.score_pending(requests(spark, "a", "bad"), scorer, path, now=NOW)
    scoring.score_pending(requests(spark, "a", "b", "c"), scorer, path, now=NOW)
    results = scoring.read_results(spark, path)
    assert sorted(r.original_id for r in results.collect()) == ["0", "1", "2"]
    assert results.schema == schemas.IA_RESULTS


def test_fields_of_results(spark):
    both = scoring.score(requests(spark, "a"), scorer).unionByName(
        scoring.score(requests(spark, "b", task="classification"), scorer)
    )
    rows = scoring.with_analysis(both).collect()
    assert [(r.sentiment, r.sentiment_confidence, r.topic) for r in rows] == [
        ("POSITIVE", 0.75, None),
        (None, None, "té"),
    ]


def test_queue_shows_latest_result(spark):
    queue = preprocess.api_queue(preprocess.preprocess_news(fixtures.news(spark)))
    results = spark.createDataFrame(
        [
            ("item-1", "text", "old", 0.1, "2025-01-01T00:00:00"),
            ("item-1", "text", "new", 0.2, "2025-01-02T00:00:00"),
            ("other", "text", "gone", 0.3, "2025-01-01T00:00:00"),
        ],
        schemas.IA_RESULTS,
    )
    joined = scoring.queue_with_results(queue, results).collect()
    assert sorted((r.id, r.result) for r in joined) == [
        (row[0], "new" if row[0] == "item-1" else None) for row in fixtures.NEWS
    ]


def test_requests(spark):
    single = scoring.single_requests(fixtures.news(spark)).orderBy("id").first()
    assert (single.type, single.analysis_type) == ("text", "text")
    assert single.metadata.asDict() == {
        "source": fixtures.NEWS[0][3],
        "timestamp": fixtures.NEWS[0][2],
    }
    batch = scoring.batch_requests(fixtures.existing_reviews(spark), "lake").first()
    assert (batch.data_type, batch.task) == ("text", "sentiment")
    assert batch.metadata.asDict() == {"id": "review_1", "source": "lake"}
    kinds = spark.createDataFrame([("text",), ("image",), ("video",)], "t string")
    assert [r[0] for r in kinds.select(scoring.analysis_of(F.col("t"))).collect()] == [
        "text",
        "image",
        "image",
    ]
    queue = preprocess.api_queue(preprocess.preprocess_news(fixtures.news(spark)))
    assert scoring.score(scoring.queue_requests(queue), scorer).count() == len(fixtures.NEWS)


def detector(content):
    if content == b"broken":
        raise ValueError("invalid image")
    if content == b"none":
        return []
    return [{"class": 2, "confidence": 0.5, "bbox": [[1.0, 2.0, 3.0, 4.0]]}] * len(content)


def test_detections(spark):
    frame = spark.createDataFrame(
        [("a", b"xy"), ("b", b"broken"), ("c", b"none")], "path string, content binary"
    )
    found = scoring.detect(frame, detector)
    assert [tuple(r) for r in scoring.object_counts(found).orderBy("path").collect()] == [
        ("a", 2, "success"),
        ("b", None, "error"),
        ("c", 0, "success"),
    ]
    rows = scoring.detection_rows(found).collect()
    assert [(r["class"], r.confidence, r.bbox) for r in rows] == [
        (2, 0.5, [[1.0, 2.0, 3.0, 4.0]])
    ] * 2


def test_batch_of_texts_and_images(spark):
    items = spark.createDataFrame(
        [
            ("1", "text", "Hello, World!", None),
            ("2", "image", None, "p1"),
            ("3", "image", None, "lost"),
            ("4", "video", "x", None),
            ("5", "text", "", None),
        ],
        "id string, type string, content string, path string",
    )
    pictures = spark.createDataFrame([("p1", b"ab")], "path string, content binary")
    rows = preprocess.preprocess_batch(items, pictures, resize=False).orderBy("id").collect()
    assert [(r.id, r.content, r.tokens, r.token_count, r.format) for r in rows] == [
        ("1", "hello world", ["hello", "world"], 2, None),
        ("2", "YWI=", None, None, "base64"),
        ("5", "", [], 0, None),
    ]


def test_resizing_drops_unreadable_images(spark):
    pytest.importorskip("PIL")
    from tidemark.sources.images import encode_images

    frame = spark.createDataFrame([("a", b"no image")], "path string, content binary")
    assert encode_images(frame, resize=True).count() == 0


def test_bucketed_tables_join_without_a_shuffle(spark, plan, tmp_path):
    from tidemark.sources.catalog import save_bucketed

    queue = preprocess.api_queue(preprocess.preprocess_news(fixtures.news(spark)))
    stored = scoring.successes(scoring.score(scoring.queue_requests(queue), scorer, now=NOW))
    save_bucketed(queue, "queue_by_id", str(tmp_path / "queue"), "id", 4)
    save_bucketed(stored, "results_by_id", str(tmp_path / "results"), "original_id", 4)
    bound = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = scoring.queue_with_results(
            spark.table("queue_by_id"), spark.table("results_by_id")
        )
        text = plan(joined)
        assert "SortMergeJoin" in text and "Exchange" not in text
        asked = scoring.queue_requests(spark.table("queue_by_id"))
        todo = scoring.pending(asked, spark.table("results_by_id"))
        assert (joined.count(), todo.count()) == (len(fixtures.NEWS), 0)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", bound)
        spark.sql("DROP TABLE queue_by_id")
        spark.sql("DROP TABLE results_by_id")


def test_result_stored_many_times_counts_once(spark):
    copies = spark.range(0, 20_000, numPartitions=4).selectExpr(
        "CASE WHEN id < 15000 THEN '0' ELSE CAST(id AS STRING) END original_id",
        "'sentiment' analysis_type",
        "CAST(id AS STRING) result",
        "0.5D confidence",
        "lpad(CAST(id AS STRING), 6, '0') processed_at",
    )
    queue = requests(spark, "a", "b")
    assert [r.id for r in scoring.pending(queue, copies).collect()] == ["1"]
    joined = scoring.queue_with_results(queue, copies).orderBy("id").collect()
    assert [(r.id, r.result) for r in joined] == [("0", "14999"), ("1", None)]


def test_missing_ids_are_scored_once(spark, tmp_path):
    path = str(tmp_path / "results")
    rows = [(None, "text", "a", "sentiment"), ("1", "text", "b", None), ("2", "text", "c", "sentiment")]
    frame = spark.createDataFrame(rows, "id string, data_type string, content string, task string")
    for _ in range(3):
        scoring.score_pending(frame, scorer, path, now=NOW)
    stored = [(r.original_id, r.analysis_type) for r in scoring.read_results(spark, path).collect()]
    assert sorted(stored, key=str) == [("1", None), ("2", "sentiment"), (None, "sentiment")]


def test_a_run_that_died_is_repeated_without_harm(spark, tmp_path, monkeypatch):
    path, failed = str(tmp_path / "results"), str(tmp_path / "failed")
    frame = requests(spark, "a", "bad", "b")
    append = versions.append

    def dying(rows, to, run=None):
        if to == failed:
            raise OSError("killed between the two writes")
        return append(rows, to, run)

    monkeypatch.setattr(versions, "append", dying)
    with pytest.raises(OSError, match="killed"):
        scoring.score_pending(frame, scorer, path, now=NOW, failed_path=failed, run="monday")
    monkeypatch.setattr(versions, "append", append)
    for _ in range(2):
        again = scoring.score_pending(frame, scorer, path, now=NOW, failed_path=failed, run="monday")
        assert again.count() == 3
    assert sorted(r.original_id for r in scoring.read_results(spark, path).collect()) == ["0", "2"]
    assert [r.original_id for r in versions.read(spark, failed).collect()] == ["1"]
