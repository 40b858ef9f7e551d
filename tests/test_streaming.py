"""Streams over landed files, drained with one trigger."""

import json
import time

import fixtures
import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.schemas import CORRUPT
from tidemark.sources import topics, versions
from tidemark.streaming import pipelines, silence


@pytest.fixture
def topic(tmp_path):
    """A folder of message lines, one file per call of ``add``."""
    folder = tmp_path / "topic"
    folder.mkdir()
    count = iter(range(1000))

    def add(*messages):
        lines = [m if isinstance(m, str) else json.dumps(m) for m in messages]
        (folder / f"{next(count):04}.json").write_text("\n".join(lines) + "\n")
        time.sleep(0.01)

    add.path = str(folder)
    return add


def message(ident, at, source="s", category="c"):
    return {"id": ident, "source": source, "category": category, "scraped_at": at}


def decoded(spark, topic, name=topics.TEXT_TOPIC, **options):
    return topics.decode(pipelines.stream_values(spark, topic.path, name, **options))


def drain(query):
    query.awaitTermination(120)
    assert query.exception() is None
    return query


def test_landing_matches_batch(spark, tmp_path):
    source, out, check = (str(tmp_path / name) for name in ("in", "out", "check"))
    fixtures.news(spark).write.parquet(source)
    for _ in range(2):
        stream = pipelines.stream_parquet(spark, source, schemas.NEWS)
        drain(pipelines.start_landing(stream, out, check, once=True))
    landed = spark.read.parquet(out)
    assert landed.count() == len(fixtures.NEWS)
    assert set(landed.columns) == set(schemas.NEWS_PREPROCESSED.names)


def test_running_totals_continue_after_restart(spark, topic, tmp_path):
    out, check = str(tmp_path / "totals"), str(tmp_path / "check")
    topic(message("1", "", "a"), message("2", "", "a"), message("3", "", None))

    def run():
        totals = pipelines.running_totals(decoded(spark, topic))
        keys = ["topic", "source", "category"]
        drain(pipelines.start_updates(totals, out, check, keys, once=True))
        rows = pipelines.current_values(spark, out, keys).collect()
        return {r.source: r.n for r in rows}

    assert run() == {"a": 2, "unknown": 1}
    topic(message("4", "", "b"), message("5", "", "a"))
    assert run() == {"a": 3, "b": 1, "unknown": 1}


def test_hourly_windows_close_behind_the_watermark(spark, topic, tmp_path):
    out, check = str(tmp_path / "hours"), str(tmp_path / "check")
    topic(*[message(str(h), f"2025-06-24T{h:02}:10:00") for h in range(8)], message("x", "?"))
    topic(message("next", "2025-06-24T08:10:00"))
    # The watermark of a batch holds from the batch after the next.
    topic(message("late", "2025-06-24T00:20:00"))
    topic(message("end", "2025-06-24T12:00:00"))
    timed = pipelines.with_event_time(decoded(spark, topic, files_per_trigger=1))
    drain(pipelines.start_parquet(pipelines.hourly_windows(timed), out, check, once=True))
    rows = spark.read.parquet(out).orderBy("hour").collect()
    assert [(r.hour.hour, r.n) for r in rows] == [(h, 1) for h in range(9)]


def test_last_hour_windows(spark, topic, tmp_path):
    out, check = str(tmp_path / "sliding"), str(tmp_path / "check")
    topic(message("1", "2025-06-24T10:02:00"), message("2", "2025-06-24T10:58:00"))
    timed = pipelines.with_event_time(decoded(spark, topic))
    buckets = pipelines.bucket_counts(timed)
    drain(pipelines.start_updates(buckets, out, check, ["bucket"], once=True))
    current = pipelines.current_values(spark, out, ["bucket"])
    rows = pipelines.last_hour_counts(current).collect()
    counts = {r.as_of.strftime("%H:%M"): r.n for r in rows}
    assert counts["11:00"] == 2
    assert counts["10:05"] == counts["11:55"] == 1


def test_resent_messages_land_once(spark, topic, tmp_path):
    out, check = str(tmp_path / "unique"), str(tmp_path / "check")
    cycle = [message("1", "2025-06-24T10:00:00"), message("2", "2025-06-24T10:01:00")]
    topic(*cycle)
    topic(*cycle, message("3", "2025-06-24T10:06:00"))
    timed = pipelines.with_event_time(decoded(spark, topic, files_per_trigger=1))
    unique = pipelines.deduplicated(timed).select("id")
    drain(pipelines.start_parquet(unique, out, check, once=True))
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == ["1", "2", "3"]


def test_one_id_sent_very_often_lands_once(spark, topic, tmp_path):
    out, check = str(tmp_path / "unique"), str(tmp_path / "check")
    topic(*[message("hot", "2025-06-24T10:00:00")] * 30_000, message("2", ""))
    timed = pipelines.with_event_time(decoded(spark, topic))
    unique = pipelines.deduplicated(timed)
    drain(pipelines.start_parquet(unique.select("id"), out, check, once=True))
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == ["2", "hot"]


@pytest.mark.parametrize("size", ["1", "10000"])
def test_a_late_copy_does_not_hide_a_fresh_one(spark, topic, tmp_path, size):
    out, check = str(tmp_path / "unique"), str(tmp_path / "check")
    topic(message("0", "2025-06-24T11:00:00"))
    # The watermark of a batch holds from the batch after the next.
    topic(message("1", "2025-06-24T11:00:00"))
    topic(message("a", "2025-06-24T07:00:00"), message("a", "2025-06-24T10:30:00"))
    batch = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
    try:
        timed = pipelines.with_event_time(decoded(spark, topic, files_per_trigger=1))
        unique = pipelines.deduplicated(timed).select("id", "scraped_at")
        drain(pipelines.start_parquet(unique, out, check, once=True))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    assert sorted(tuple(r) for r in spark.read.parquet(out).collect()) == [
        ("0", "2025-06-24T11:00:00"),
        ("1", "2025-06-24T11:00:00"),
        ("a", "2025-06-24T10:30:00"),
    ]


def test_messages_without_id_are_copies_only_of_equal_ones(spark, topic, tmp_path):
    out, check = str(tmp_path / "unique"), str(tmp_path / "check")
    at = "2025-06-24T10:00:00"
    topic(message(None, at, "a"), message(None, at, "b"), message(None, at, "a"))
    unique = pipelines.deduplicated(pipelines.with_event_time(decoded(spark, topic)))
    drain(pipelines.start_parquet(unique.select("id", "source"), out, check, once=True))
    rows = spark.read.parquet(out).collect()
    assert sorted((r.id, r.source) for r in rows) == [(None, "a"), (None, "b")]


def test_current_values_stay_bounded(spark, topic, tmp_path):
    out, check = tmp_path / "totals", str(tmp_path / "check")
    keys = ["topic", "source", "category"]
    for number in range(7):
        topic(message(str(number), "", f"s{number % 2}"))
        totals = pipelines.running_totals(decoded(spark, topic))
        drain(pipelines.start_updates(totals, str(out), check, keys, once=True, retention=0))
    assert len(list(out.glob("data-*"))) <= pipelines.VERSIONS
    rows = pipelines.current_values(spark, str(out), keys).collect()
    assert {r.source: r.n for r in rows} == {"s0": 4, "s1": 3}


def test_bad_messages_go_to_a_side_table(spark, topic, tmp_path):
    good, bad, check = (str(tmp_path / name) for name in ("good", "bad", "check"))
    topic(message("1", ""), "not json", message("2", ""))
    stream = decoded(spark, topic)
    drain(pipelines.start_split(stream, CORRUPT, good, bad, check, once=True))
    assert spark.read.parquet(good).count() == 2
    assert [r[CORRUPT] for r in spark.read.parquet(bad).collect()] == ["not json"]


def test_cycle_counters(spark, topic, tmp_path):
    topic(message("1", ""), "not json", message("2", ""))
    counted = pipelines.with_cycle_counters(decoded(spark, topic), CORRUPT)
    query = drain(
        pipelines.start_parquet(
            counted.select("id"), str(tmp_path / "out"), str(tmp_path / "check"), once=True
        )
    )
    observed = [p.observedMetrics["cycle"] for p in query.recentProgress if p.observedMetrics]
    assert observed[0].asDict() == {
        "total_scraped": 2,
        "text_articles": 2,
        "image_metadata": 0,
        "errors": 1,
    }


def test_published_stream_has_keys(spark, topic, tmp_path):
    topic(message("1", ""))
    stream = decoded(spark, topic).select("id", "source")
    encoded = topics.encode(stream, topics.TEXT_TOPIC, F.lit("now"))
    drain(
        pipelines.start_parquet(
            encoded, str(tmp_path / "out"), str(tmp_path / "check"), once=True
        )
    )
    row = spark.read.parquet(str(tmp_path / "out")).first()
    assert (row.topic, row.key) == ("text-topic", "1")
    assert json.loads(row.value)["source"] == "s"


def events(spark, folder, *batches):
    """Write a file per batch of (source, seconds) and stream them, a file a batch."""
    for number, rows in enumerate(batches):
        frame = spark.createDataFrame(rows, "source string, s long")
        frame = frame.select("source", F.timestamp_seconds("s").alias("event_time"))
        frame.coalesce(1).write.parquet(f"{folder}/part={number}")
        time.sleep(0.01)
    return pipelines.stream_parquet(spark, f"{folder}/part=*", frame.schema, 1)


def transitions(spark, folder, *batches):
    stream = silence.transitions(events(spark, f"{folder}/in", *batches), quiet=600, delay="100 seconds")
    with silence.rocks_state(spark):
        query = pipelines.start_parquet(stream, f"{folder}/out", f"{folder}/check", once=True)
    drain(query)
    rows = spark.read.parquet(f"{folder}/out").select("source", F.unix_seconds("at").alias("at"), "state")
    return sorted(tuple(r) for r in rows.collect())


def test_silence_is_told_once_whatever_the_batches(spark, tmp_path):
    rows = [("a", 1000), ("a", 1500), ("a", 3000), (None, 1200), ("a", 1600), ("b", 9000), ("b", 9600)]
    expected = [
        ("a", 1000, "active"),
        ("a", 2200, "slowed"),
        ("a", 3000, "active"),
        ("a", 3600, "slowed"),
        ("b", 9000, "active"),
        ("unknown", 1200, "active"),
        ("unknown", 1800, "slowed"),
    ]
    assert transitions(spark, tmp_path / "one", rows) == expected
    # a's event at 1600 is out of order, but not late.
    late_but_in_time = [[rows[0], rows[1]], [("b", 1650), rows[4]], rows[2:4], rows[5:]]
    got = transitions(spark, tmp_path / "four", *late_but_in_time)
    assert [r for r in got if r[0] == "a"] == expected[:4]


def test_intervals_are_merged():
    rows = np.array([[5, 9], [1, 3], [3, 4], [6, 7], [20, 30]])
    assert silence.merged(rows).tolist() == [[1, 4], [5, 9], [20, 30]]
    assert silence.merged(np.empty((0, 2), np.int64)).tolist() == []


def test_statistics_count_a_repeated_batch_once(spark, topic, tmp_path, monkeypatch):
    good, bad, check, kept = (str(tmp_path / name) for name in ("good", "bad", "check", "kept"))
    topic(message("1", ""), "not json", message("2", ""))

    def run():
        query = pipelines.start_split(
            decoded(spark, topic), CORRUPT, good, bad, check, once=True, statistics_path=kept
        )
        query.awaitTermination(120)
        return query

    replace = versions.replace

    def dying(*args, **options):
        replace(*args, **options)
        raise OSError("killed after the statistics")

    monkeypatch.setattr(versions, "replace", dying)
    with pytest.raises(Exception, match="killed after"):
        run()
    monkeypatch.setattr(versions, "replace", replace)
    run()
    topic("bad again")
    run()
    rows = pipelines.current_values(spark, kept).orderBy("batch").collect()
    assert [(r.batch, r.total_scraped, r.errors) for r in rows] == [(0, 2, 1), (1, 0, 1)]
    assert all(r.seconds > 0 and r.ended is not None for r in rows)


def test_newest_messages_are_kept_over_batches(spark, topic, tmp_path):
    out, check = str(tmp_path / "out"), str(tmp_path / "check")
    order = [F.col("scraped_at").desc(), F.col("id")]
    sent = []
    for number in range(4):
        batch = [message(f"{number}-{i:02}", f"2025-01-0{(i * 5 + number) % 9}") for i in range(20)]
        sent += [(m["scraped_at"], m["id"]) for m in batch]
        topic(*batch)
        rows = decoded(spark, topic).select("topic", "id", "scraped_at")
        drain(pipelines.start_newest(rows, out, check, "topic", order, 7, once=True))
    kept = pipelines.current_values(spark, out).collect()
    best = sorted(sorted(sent, key=lambda s: s[1]), key=lambda s: s[0], reverse=True)[:7]
    assert sorted(r.id for r in kept) == sorted(i for _, i in best)


def test_reader_is_not_disturbed_by_an_update(spark, topic, tmp_path):
    out, check = str(tmp_path / "totals"), str(tmp_path / "check")
    keys = ["topic", "source", "category"]
    held = []
    for number in range(pipelines.VERSIONS + 2):
        topic(message(str(number), ""))
        totals = pipelines.running_totals(decoded(spark, topic))
        drain(pipelines.start_updates(totals, out, check, keys, once=True))
        held.append(pipelines.current_values(spark, out))
    assert [frame.first().n for frame in held] == list(range(1, pipelines.VERSIONS + 3))
