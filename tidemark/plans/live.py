"""Live figures over decoded topic messages, and the cards a dashboard shows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.casts import parse_iso
from tidemark.functions.categories import DEFAULT_CATEGORY
from tidemark.functions.text import preview
from tidemark.operators.limits import latest
from tidemark.sources.topics import IMAGES_TOPIC, TEXT_TOPIC

ACTIVE_BELOW_SECONDS = 600


def _recent(moment: Column, as_of: Column, hours: int) -> Column:
    return moment >= as_of - F.make_interval(hours=F.lit(hours))


def topic_stats(messages: DataFrame, as_of: Column) -> DataFrame:
    """Totals, last-hour count and counts per source and category, as rows.

    Columns: ``dimension`` (total, source or category), ``key``, ``n``.  Messages are counted
    once per (topic, source, category) on the map side; the figures are sums over those few
    rows.  Counts stay rows instead of one map, so no task holds every key.
    """
    is_text = F.col("topic") == TEXT_TOPIC
    source = F.when(is_text, F.coalesce("source", F.lit("unknown")))
    category = F.when(is_text, F.coalesce("category", F.lit(DEFAULT_CATEGORY)))
    fresh = is_text & _recent(parse_iso("scraped_at"), as_of, 1)
    grouped = (
        messages.where(F.col("topic").isin(TEXT_TOPIC, IMAGES_TOPIC))
        .groupBy("topic", source.alias("source"), category.alias("category"))
        .agg(F.count("*").alias("n"), F.count_if(fresh).alias("fresh"))
    )

    def cell(dimension: str, key: Column, n: Column) -> Column:
        return F.struct(
            F.lit(dimension).alias("dimension"), key.alias("key"), n.alias("n")
        )

    article = F.col("topic") == TEXT_TOPIC
    n, zero = F.col("n"), F.lit(0).cast("bigint")
    cells = F.array(
        cell("total", F.lit("articles"), F.when(article, n).otherwise(zero)),
        cell("total", F.lit("images"), F.when(article, zero).otherwise(n)),
        cell("total", F.lit("last_hour"), F.col("fresh")),
        cell("source", F.col("source"), n),
        cell("category", F.col("category"), n),
    )
    return (
        grouped.select(F.inline(cells))
        .where("key IS NOT NULL")
        .groupBy("dimension", "key")
        .agg(F.sum("n").alias("n"))
        .orderBy("dimension", F.desc("n"), "key")
    )


def last_hour_count(events: DataFrame, when: str, as_of: Column, hours: int = 1) -> DataFrame:
    """Number of events of the last hours; the bound reaches the scan of ``when``."""
    return events.where(_recent(F.col(when), as_of, hours)).agg(F.count("*").alias("n"))


def ingest_counters(messages: DataFrame, failed: Column | None = None) -> DataFrame:
    """One row: messages sent, articles, images and failures."""
    bad = F.lit(False) if failed is None else F.coalesce(failed, F.lit(False))
    return messages.agg(
        F.count_if(~bad).alias("total_scraped"),
        F.count_if(~bad & (F.col("topic") == TEXT_TOPIC)).alias("text_articles"),
        F.count_if(~bad & (F.col("topic") == IMAGES_TOPIC)).alias("image_metadata"),
        F.count_if(bad).alias("errors"),
    )


def articles_by_source(articles: DataFrame) -> DataFrame:
    return (
        articles.groupBy("source")
        .agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), "source")
    )


def feed_freshness(events: DataFrame, when: Column, as_of: Column) -> DataFrame:
    """One row: last activity, its age and whether the feed is active, slowed or starting."""
    newest = events.agg(F.max(when).alias("last_update"))
    age = F.timestamp_diff("SECOND", F.col("last_update"), as_of)
    return newest.select("last_update", age.alias("age_seconds")).select(
        "last_update",
        "age_seconds",
        F.when(F.col("age_seconds").isNull(), "starting")
        .when(F.col("age_seconds") < ACTIVE_BELOW_SECONDS, "active")
        .otherwise("slowed")
        .alias("status"),
        F.when(
            F.col("age_seconds") < ACTIVE_BELOW_SECONDS,
            F.concat(F.col("age_seconds").cast("string"), F.lit("s")),
        )
        .otherwise(
            F.concat(F.floor(F.col("age_seconds") / 60).cast("string"), F.lit("min"))
        )
        .alias("age"),
    )


def hourly_counts(events: DataFrame, when: str, day: Column | None = None) -> DataFrame:
    """Events per hour, of one day if given; the day's bounds reach the scan."""
    if day is not None:
        start = day.cast("timestamp_ntz")
        end = start + F.make_interval(days=F.lit(1))
        events = events.where((F.col(when) >= start) & (F.col(when) < end))
    return (
        events.groupBy(F.date_trunc("hour", F.col(when)).alias("hour"))
        .agg(F.count("*").alias("n"))
        .orderBy("hour")
    )


def articles_per_day(articles: DataFrame, source: str, when: str = "scraped_at") -> DataFrame:
    """Articles of one source per day."""
    return (
        articles.where(F.col("source") == source)
        .groupBy(F.col(when).try_cast("date").alias("date"))
        .agg(F.count("*").alias("n"))
        .orderBy("date")
    )


# --- cards ---


def article_cards(articles: DataFrame) -> DataFrame:
    """Display fields of articles, with defaults and cut to size."""
    present = set(articles.columns)

    def text(name: str, default: str) -> Column:
        value = F.col(name) if name in present else F.lit(None).cast("string")
        return F.coalesce(value, F.lit(default))

    def number(name: str) -> Column:
        return F.col(name) if name in present else F.lit(None).cast("int")

    return articles.select(
        "id",
        preview(text("title", "Untitled"), 60, "").alias("title"),
        text("source", "Unknown").alias("source"),
        text("category", DEFAULT_CATEGORY).alias("category"),
        preview(text("content", "No content"), 200, "").alias("content"),
        F.nullif(text("url", ""), F.lit("")).alias("url"),
        F.substring(text("scraped_at", "Unknown"), 1, 19).alias("scraped_at"),
        F.coalesce(number("word_count"), F.lit(0)).alias("word_count"),
        number("upvotes").alias("upvotes"),
    )


def usable_thumbnail(name: str = "thumbnail_url") -> Column:
    """The thumbnail is a link, not empty and not the ``self`` marker."""
    return F.coalesce(~F.col(name).isin("", "self"), F.lit(False))


def image_cards(images: DataFrame) -> DataFrame:
    """Display fields of images; an unusable thumbnail is NULL."""
    return images.select(
        "id",
        F.substring(F.coalesce("title", F.lit("Untitled")), 1, 40).alias("title"),
        F.coalesce("source", F.lit("Unknown")).alias("source"),
        F.coalesce("category", F.lit(DEFAULT_CATEGORY)).alias("category"),
        F.when(usable_thumbnail(), F.col("thumbnail_url")).alias("thumbnail_url"),
        F.col("upvotes"),
        F.coalesce("comments", F.lit(0)).alias("comments"),
        F.substring(F.coalesce("scraped_at", F.lit("Unknown")), 1, 19).alias("scraped_at"),
    )


def latest_articles(articles: DataFrame, limit: int = 10) -> DataFrame:
    """The newest articles as cards; the cards are built for those rows alone."""
    return article_cards(latest(articles, "scraped_at", limit, "id"))


def latest_images(images: DataFrame, limit: int = 8) -> DataFrame:
    return image_cards(latest(images, "scraped_at", limit, "id"))
