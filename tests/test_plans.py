"""What the physical plans must and must not contain."""

import re

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from tidemark.operators import scoring
from tidemark.plans import live, tables
from tidemark.plans.queries import QUERIES

# Building these runs jobs, so their plans are not interesting here.
JOBS = ("stream_", "landed_", "catalog_", "rollup_", "ingest_all", "corrupt_feeds", "verified_")
EAGER = {name for name in QUERIES if name.startswith(JOBS)} | {
    "changed_files",
    "cycle_statistics",
    "incremental_reports",
    "live_totals_under_update",
    "quarantined_orders",
    "replaced_zone",
    "rescored_once",
    "scored_tasks",
    "silent_sources",
}
LAZY = sorted(set(QUERIES) - EAGER)

# The only work that leaves the JVM: HTML parsing, user-supplied models, keyword automata.
PYTHON = {
    "articles_by_source",
    "articles_fallback",
    "articles_host",
    "articles_news",
    "articles_title_wc",
    "articles_truncated",
    "batch_success",
    "categorize_many",
    "clean_html",
    "detections",
    "failed_requests",
    "image_cards",
    "image_events",
    "latest_images",
    "score_results",
    "scored_successes",
}


def built(spark, name):
    return QUERIES[name](spark, SMALL)


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_join_and_no_row_at_a_time_python(spark, plan, name):
    text = plan(built(spark, name))
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text
    assert "BatchEvalPython" not in text
    assert ("Python" in text or "InPandas" in text) <= (name in PYTHON)


@pytest.mark.parametrize("name", LAZY)
def test_no_unbounded_window_partition(spark, plan, name):
    for line in plan(built(spark, name)).splitlines():
        if re.search(r"\bWindow \[", line):
            assert "], [], [" not in line


def test_columns_are_pruned_and_filters_pushed(spark, plan):
    text = plan(built(spark, "hourly_counts_of_day"))
    assert "ReadSchema: struct<ts:timestamp_ntz>" in text
    assert "GreaterThanOrEqual(ts,2024-01-15T00:00), LessThan(ts,2024-01-16T00:00)" in text
    assert "GreaterThanOrEqual(ts,2024-01-30T23:00)" in plan(built(spark, "last_hour_count"))
    assert "ReadSchema: struct<p_size:int>" in plan(built(spark, "metric_summary"))


def test_satisfaction_scans_once_without_a_keyed_shuffle(spark, plan):
    text = plan(built(spark, "satisfaction"))
    assert text.count("FileScan") == 2  # one per data source
    assert "hashpartitioning" not in text


def test_aggregates_combine_before_the_shuffle(spark, plan):
    for name in ("reviews_by_source", "source_performance", "topic_stats", "top_products"):
        assert "partial_count" in plan(built(spark, name))
    assert "TakeOrderedAndProject" in plan(built(spark, "top_products"))


def test_hot_source_is_cut_before_the_shuffle(spark, plan):
    text = plan(built(spark, "first_n_per_source"))
    assert text.index("WindowGroupLimit") < text.index("Exchange hashpartitioning")
    assert "Partial" in text[text.index("Exchange hashpartitioning") :]


def test_costly_columns_are_computed_once(spark, plan):
    assert plan(built(spark, "preprocess_news")).count("regexp_replace(regexp_replace") <= 1
    assert plan(built(spark, "preprocess_stats")).count("[^\\p{L}\\p{N}_]+") == 1
    assert plan(built(spark, "topic_stats")).count("from_json(") == 1
    assert plan(built(spark, "rss_items")).count("from_xml(") == 1


def test_newest_rows_are_taken_without_a_full_sort(spark, plan):
    for name in ("latest_articles", "latest_images"):
        text = plan(built(spark, name))
        assert "TakeOrderedAndProject" in text and "Exchange rangepartitioning" not in text


def test_large_sides_are_joined_by_key_not_broadcast(spark, plan):
    """Beyond the broadcast bound the joins stay correct and shuffle on the id."""
    bound = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("queue_with_results", "pending_requests"):
            assert "SortMergeJoin" in plan(built(spark, name))
        queue = tables.score_requests(spark, SMALL)
        results = tables.stored_results(spark, SMALL)
        todo = scoring.pending(queue, results).count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", bound)
    assert todo == scoring.pending(queue, results).count() > 0


def test_one_hot_source_gives_the_same_counts(spark):
    hot = spark.range(0, 60_000, numPartitions=8).select(
        F.lit("text-topic").alias("topic"),
        F.when(F.col("id") < 40_000, "hot").otherwise(F.col("id").cast("string")).alias("source"),
        F.lit(None).cast("string").alias("category"),
        F.lit("2024-01-30T23:30:00").alias("scraped_at"),
    )
    counts = live.topic_stats(hot, tables.as_of()).where("dimension = 'source'")
    assert counts.count() == 20_001
    assert tuple(counts.where("key = 'hot'").first())[1:] == ("hot", 40_000)


def test_payloads_are_parsed_once_and_branches_read_their_part(spark, plan, tmp_path):
    from tidemark.plans import jobs

    columns = "source string, feed_url string, payload string"
    feed = "<rss><channel><item><title>t</title></item></channel></rss>"
    rss = spark.createDataFrame([("s", "u", feed)], columns)
    post = '{"data": {"children": [{"data": {"id": "1"}}]}}'
    listings = spark.createDataFrame([("s", post)], "source string, payload string")
    cycle = jobs.ingest(rss, listings)
    text = plan(cycle.articles)
    assert "from_xml" not in text and "from_json" not in text
    for name in ("hackernews", "bbc_technology", "techcrunch", "reddit_technology"):
        assert "PartitionFilters: [isnotnull(branch" in text and f"= {name})" in text
    assert "Exchange" not in text and "from_json" not in plan(cycle.images)


def test_only_wanted_message_fields_are_parsed(spark, plan):
    text = plan(built(spark, "topic_stats"))
    parsed = text[text.index("from_json(") :].splitlines()[0]
    assert "StructField(scraped_at" in parsed and "StructField(title" not in parsed


def test_each_event_is_one_row_of_one_bucket(spark, plan):
    from tidemark.streaming import pipelines

    timed = pipelines.with_event_time(tables.event_messages(spark, SMALL))
    assert "Expand" not in plan(pipelines.bucket_counts(timed))


def test_an_image_that_many_items_name_is_encoded_once(spark, plan):
    from tidemark.operators import preprocess

    items = spark.range(3).selectExpr(
        "CAST(id AS STRING) id", "'image' type", "CAST(NULL AS STRING) content", "CONCAT('p', id) path"
    )
    images = spark.createDataFrame([("p", b"xy")], "path string, content binary")
    text = plan(preprocess.preprocess_batch(items, images, resize=False))
    # The bytes are encoded below the join that brings the ids.
    assert text.count("LeftSemi") == 1 and text.index("Join") < text.index("Base64.encode")


def test_words_are_counted_without_arrays(spark, plan):
    assert "split(" not in plan(built(spark, "preprocess_stats"))


def test_large_caps_are_ranked_in_parts_first(spark, plan):
    assert plan(built(spark, "first_n_large_cap")).count("row_number()") >= 2
