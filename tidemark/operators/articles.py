"""Feed items and listing posts as article and image events.

Input rows come from :mod:`tidemark.sources.feeds`.  ``seen_at`` is the collection time as an
ISO text column; it fills both time fields of an event.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.casts import iso_text
from tidemark.functions.categories import categorize_content, categorize_image
from tidemark.functions.html import clean_html
from tidemark.functions.text import (
    host,
    is_image_link,
    plain_word_count,
    stable_id,
    truncate,
)

CONTENT_LIMIT = 500
TAG_LIMIT = 3
# What names an entry without a link.
_NAMED_BY = ("title", "published")


def _seen(seen_at: Column | None) -> Column:
    return iso_text(F.current_timestamp()) if seen_at is None else seen_at


def _both(first: str, second: str) -> Column:
    return F.concat_ws(" ", first, second)


def _words(*names: str) -> Column:
    """Words of cleaned texts, joined by spaces."""
    total = plain_word_count(names[0])
    for name in names[1:]:
        total = total + plain_word_count(name)
    return total


def _events(
    cleaned: DataFrame, seen_at: Column | None, data_type: str, **fields: Column
) -> DataFrame:
    moment = _seen(seen_at)
    return cleaned.select(
        *[column.alias(name) for name, column in fields.items()],
        moment.alias("timestamp"),
        moment.alias("scraped_at"),
        F.lit(data_type).alias("data_type"),
    )


def short_title_articles(
    items: DataFrame, source: str = "hackernews", prefix: str = "hn_", seen_at=None
) -> DataFrame:
    """Feed whose word count covers the title alone."""
    cleaned = items.withColumns(
        {"title": clean_html("title"), "content": clean_html("description")}
    )
    return _events(
        cleaned,
        seen_at,
        "text",
        id=stable_id(prefix, "link", *_NAMED_BY),
        title=F.col("title"),
        content=F.col("content"),
        url=F.col("link"),
        source=F.lit(source),
        category=F.lit("technology"),
        word_count=_words("title"),
    )


def news_articles(
    items: DataFrame, source: str = "bbc_technology", prefix: str = "bbc_", seen_at=None
) -> DataFrame:
    """Feed with publication times; the word count covers title and description."""
    cleaned = items.withColumns(
        {"title": clean_html("title"), "content": clean_html("description")}
    )
    return _events(
        cleaned,
        seen_at,
        "text",
        id=stable_id(prefix, "link", *_NAMED_BY),
        title=F.col("title"),
        content=F.col("content"),
        url=F.col("link"),
        source=F.lit(source),
        category=F.lit("technology"),
        published=F.coalesce("published", F.lit("")),
        word_count=_words("title", "content"),
    )


def long_content_articles(
    items: DataFrame,
    source: str = "techcrunch",
    prefix: str = "tc_",
    seen_at=None,
    content_limit: int | None = CONTENT_LIMIT,
    tag_limit: int | None = TAG_LIMIT,
) -> DataFrame:
    """Feed with full content, counted uncut.

    The content is cut to ``content_limit`` characters and the first ``tag_limit`` tags stay;
    with None all of it does.
    """
    body = F.coalesce("content", "description")
    tags = F.coalesce("tags", F.array().cast("array<string>"))
    cleaned = items.withColumns({"title": clean_html("title"), "body": clean_html(body)})
    return _events(
        cleaned,
        seen_at,
        "text",
        id=stable_id(prefix, "link", *_NAMED_BY),
        title=F.col("title"),
        content=F.col("body") if content_limit is None else truncate("body", content_limit),
        url=F.col("link"),
        source=F.lit(source),
        category=F.lit("technology"),
        tags=tags if tag_limit is None else F.slice(tags, 1, tag_limit),
        published=F.coalesce("published", F.lit("")),
        word_count=_words("title", "body"),
    )


def aggregated_articles(items: DataFrame, feed_url: str = "feed_url", seen_at=None) -> DataFrame:
    """Items of many feeds: the feed's host is the source, keywords give the category.

    A feed address without a host is itself the source.
    """
    cleaned = items.withColumns(
        {
            "title": clean_html("title"),
            "content": clean_html("description"),
            "host": F.coalesce(host(feed_url), F.col(feed_url), F.lit("unknown")),
        }
    )
    return _events(
        cleaned,
        seen_at,
        "text",
        id=stable_id(F.concat("host", F.lit("_")), "link", *_NAMED_BY),
        title=F.col("title"),
        content=F.col("content"),
        url=F.col("link"),
        source=F.col("host"),
        category=categorize_content(_both("title", "content")),
        published=F.coalesce("published", F.lit("")),
        word_count=_words("title", "content"),
    )


def has_text() -> Column:
    """The post has a body or a title."""
    return (F.coalesce("selftext", F.lit("")) != "") | (F.coalesce("title", F.lit("")) != "")


def listing_articles(
    posts: DataFrame, source: str = "reddit_technology", prefix: str = "reddit_", seen_at=None
) -> DataFrame:
    """Text posts.  An empty body shows the title, but is counted as empty."""
    cleaned = posts.where(has_text()).withColumns(
        {"title": clean_html("title"), "body": clean_html("selftext")}
    )
    return _events(
        cleaned,
        seen_at,
        "text",
        id=F.concat(F.lit(prefix), "id"),
        title=F.col("title"),
        content=F.coalesce(F.nullif("body", F.lit("")), "title"),
        url=F.concat(F.lit("https://reddit.com"), F.coalesce("permalink", F.lit(""))),
        source=F.lit(source),
        category=F.lit("technology"),
        upvotes=F.coalesce("ups", F.lit(0)),
        comments=F.coalesce("num_comments", F.lit(0)),
        word_count=_words("title", "body"),
    )


def image_events(posts: DataFrame, subreddit: str = "subreddit", seen_at=None) -> DataFrame:
    """Posts that link to an image."""
    cleaned = posts.where(is_image_link("url")).withColumn("clean_title", clean_html("title"))
    return _events(
        cleaned,
        seen_at,
        "image_metadata",
        id=F.concat(F.lit("reddit_img_"), "id"),
        title=F.col("clean_title"),
        image_url=F.col("url"),
        thumbnail_url=F.coalesce("thumbnail", F.lit("")),
        source=F.concat(F.lit("reddit_"), F.col(subreddit)),
        category=categorize_image(F.coalesce("title", F.lit(""))),
        upvotes=F.coalesce("ups", F.lit(0)),
        comments=F.coalesce("num_comments", F.lit(0)),
        subreddit=F.col(subreddit),
        author=F.coalesce("author", F.lit("unknown")),
    )


def collect_cycle(*feeds: DataFrame) -> DataFrame:
    """All articles of a cycle; fields a feed does not have are NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), feeds)
