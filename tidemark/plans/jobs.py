"""Whole jobs over a lake: read the zones, compute, write the results.

Each job parses its input once, writes what several steps share, and goes on from the written
table, so nothing costly is computed twice and a lost executor costs one stage at most.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark import schemas
from tidemark.operators import articles, limits, preprocess, scoring, unify
from tidemark.plans import reports
from tidemark.schemas import CORRUPT
from tidemark.sources import feeds, files, topics
from tidemark.sources.session import run_folder
from tidemark.streaming import pipelines

REVIEW_REPORTS: dict[str, Callable[..., DataFrame]] = {
    "reviews_by_source": reports.reviews_by_source,
    "reviews_daily": reports.reviews_daily,
    "satisfaction": reports.satisfaction,
    "compare_sources": reports.compare_sources,
    "source_performance": reports.source_performance,
}


def analyse(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """All reports over the landed reviews and images; the metric summary is written as CSV.

    The zones are scanned once, into a rollup and the image report; the rest reads those.
    """
    files.load_existing_data(spark, root)
    files.load_scraped_data(spark, root)
    unify.create_unified_views(spark)

    rollup_path = files.zone_path(root, "processed", "rollup")
    files.write_parquet(reports.review_rollup(spark.table("all_reviews")), rollup_path)
    rollup = files.read_parquet(spark, rollup_path)
    images_path = files.zone_path(root, "processed", "images")
    files.write_parquet(reports.image_categories(spark.table("all_images")), images_path)
    image_report = files.read_parquet(spark, images_path)

    results = {name: build(rollup, rollup=True) for name, build in REVIEW_REPORTS.items()}
    results["image_categories"] = image_report
    results["metric_summary"] = reports.metric_summary(rollup, image_report, rollup=True)
    files.write_csv(results["metric_summary"], files.zone_path(root, "results", "summary"))
    return results


# Sources whose entries have a branch of their own: three feeds, and the listing of texts.
OWN_BRANCH = ["hackernews", "bbc_technology", "techcrunch", "reddit_technology"]


class Cycle(NamedTuple):
    """What one cycle of fetched payloads gave; ``failures`` has source, kind and reason."""

    articles: DataFrame
    images: DataFrame
    failures: DataFrame


def ingest(
    rss: DataFrame,
    listings: DataFrame,
    seen_at: Column | None = None,
    cap: Column | None = None,
    content_limit: int | None = None,
    tag_limit: int | None = None,
) -> Cycle:
    """Articles, image events and unreadable payloads of one cycle.

    ``rss`` has source, feed_url and payload, ``listings`` has source and payload; the source
    of an image listing is its board.  Payloads are parsed once, into a run folder partitioned by
    branch, and each branch reads its own part.  Every payload gives its entries or is a failure;
    without a source, its entries go with the other feeds or boards.  Every entry is kept; ``cap``
    (:func:`limits.feed_cap`) keeps the first ones of a feed, ``content_limit`` and ``tag_limit``
    cut long content and tags.
    """
    spark = rss.sparkSession
    keep = F.lit(True) if cap is None else F.col("position") < cap
    folder = run_folder(spark, "cycle")

    def parsed(decoded: DataFrame, rows: Callable[[DataFrame], DataFrame], name: str):
        path = f"{folder}/{name}"
        files.write_parquet(decoded.drop("payload"), f"{path}-decoded")
        stored = spark.read.schema(decoded.drop("payload").schema).parquet(f"{path}-decoded")
        # The branch is a column of its own: as a folder name an empty source would turn NULL.
        branch = F.when(F.col("source").isin(*OWN_BRANCH), F.col("source")).otherwise("other")
        items = rows(stored).withColumn("branch", F.coalesce(branch, F.lit("other")))
        files.write_parquet(items, path, by=["branch"])
        failed = stored.where(F.col("problem").isNotNull()).select(
            "source", F.lit(name).alias("kind"), F.col("problem").alias("reason")
        )
        return spark.read.schema(items.schema).parquet(path), failed

    items, broken_feeds = parsed(feeds.decode_rss(rss), feeds.feed_items, "rss")
    posts, broken_lists = parsed(feeds.decode_listing(listings), feeds.post_rows, "listing")
    branch = F.col("branch")
    own = OWN_BRANCH[:3]
    items, texts = items.where(keep), posts.where(branch == OWN_BRANCH[3])
    collected = articles.collect_cycle(
        articles.short_title_articles(items.where(branch == own[0]), seen_at=seen_at),
        articles.listing_articles(texts.where(keep), seen_at=seen_at),
        articles.news_articles(items.where(branch == own[1]), seen_at=seen_at),
        articles.long_content_articles(
            items.where(branch == own[2]),
            seen_at=seen_at,
            content_limit=content_limit,
            tag_limit=tag_limit,
        ),
        articles.aggregated_articles(
            items.where(~branch.isin(own)), seen_at=seen_at
        ),
    )
    boards = posts.where(branch != OWN_BRANCH[3])
    pictures = articles.image_events(boards, "source", seen_at)
    return Cycle(collected, pictures, broken_feeds.unionByName(broken_lists))


def prepare(
    spark: SparkSession, root: str, news: DataFrame, now: Column | None = None
) -> DataFrame:
    """Clean and gate news, write them and the scoring queue; returns their statistics."""
    processed_path = files.zone_path(root, "processed", "news")
    files.write_parquet(preprocess.preprocess_news(news, now), processed_path)
    processed = files.read_parquet(spark, processed_path)
    files.write_parquet(
        preprocess.api_queue(processed), files.zone_path(root, "processed", "queue")
    )
    return preprocess.preprocess_stats(processed)


def analyse_queue(
    spark: SparkSession,
    root: str,
    scorer: scoring.Scorer,
    task: str = "sentiment",
    partitions: int | None = None,
) -> DataFrame:
    """Score what is queued and has no result for the task; the queue with its results.

    Failed requests are stored with their reasons and are tried again by the next run.
    """
    queue = files.read_parquet(
        spark, files.zone_path(root, "processed", "queue"), schemas.API_QUEUE
    )
    results_path = files.zone_path(root, "results", "ia")
    requests = scoring.queue_requests(queue, task)
    scoring.score_pending(
        requests,
        scorer,
        results_path,
        partitions=partitions,
        failed_path=files.zone_path(root, "results", "failed"),
    )
    return scoring.queue_with_results(queue, scoring.read_results(spark, results_path), task)


def land_topic(
    records: DataFrame, root: str, checkpoint: str, once: bool = False
) -> StreamingQuery:
    """Keep landing a topic's articles as cleaned news, ready for the queue.

    Unreadable messages are landed next to them, and the counts of every batch are kept.
    """

    def news(messages: DataFrame) -> DataFrame:
        texts = messages.where(F.col("topic") == topics.TEXT_TOPIC)
        return preprocess.preprocess_news(texts.select(*schemas.NEWS.names))

    return pipelines.start_split(
        topics.decode(records),
        CORRUPT,
        files.zone_path(root, "streaming", "news"),
        files.zone_path(root, "streaming", "unreadable"),
        checkpoint,
        once,
        news,
        files.zone_path(root, "streaming", "statistics"),
    )


def live_figures(
    records: DataFrame, root: str, checkpoint: str, once: bool = False
) -> list[StreamingQuery]:
    """Keep the totals per source and category and the five-minute counts of a topic.

    Both figures are read with :func:`pipelines.current_values`,
    the last hour with :func:`pipelines.last_hour_counts` on top of it.  Each figure keeps its own
    state, so each is a query with a checkpoint of its own.
    """
    fields = ["id", "source", "category", "scraped_at"]
    messages, _ = topics.split_corrupt(topics.decode(records, fields=fields))
    timed = pipelines.with_event_time(messages)
    return [
        pipelines.start_updates(
            pipelines.running_totals(timed),
            files.zone_path(root, "live", "totals"),
            f"{checkpoint}/totals",
            ["topic", "source", "category"],
            once,
        ),
        pipelines.start_updates(
            pipelines.bucket_counts(timed),
            files.zone_path(root, "live", "buckets"),
            f"{checkpoint}/buckets",
            ["bucket"],
            once,
        ),
    ]
