"""Cleaning, gating and queueing of texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import (
    clean_ascii,
    clean_keep_dots,
    clean_words,
    spaced_word_count,
    tokenize,
)
from tidemark.operators.once import with_once
from tidemark.sources.images import encode_images

MIN_WORDS = 3


def with_clean_titles(news: DataFrame, now: Column | None = None) -> DataFrame:
    """News with cleaned title, its word count, lengths and the readiness flag."""
    moment = F.current_timestamp() if now is None else now
    originals = news.withColumn("title_original", F.col("title"))
    counted = with_once(originals, "title_cleaned", clean_words("title")).withColumns(
        {
            "word_count": spaced_word_count("title_cleaned"),
            "title_length": F.length("title_original"),
            "processed_time": moment,
            "data_type": F.lit("text"),
        }
    )
    return counted.withColumn("ready_for_ia", F.col("word_count") >= MIN_WORDS)


def preprocess_news(news: DataFrame, now: Column | None = None) -> DataFrame:
    """Cleaned news that pass the quality gate."""
    return with_clean_titles(news, now).where("ready_for_ia")


def preprocess_stats(processed: DataFrame) -> DataFrame:
    """One row: rows, mean and largest word count, distinct sources."""
    return processed.agg(
        F.count("*").alias("total"),
        F.avg("word_count").alias("avg_words"),
        F.max("word_count").alias("max_words"),
        F.countDistinct("source").alias("sources"),
    )


def with_clean_sentences(texts: DataFrame, text: str = "text") -> DataFrame:
    """Texts cleaned with dots kept, with tokens, token count and readiness flag."""
    cleaned = with_once(texts, "cleaned", clean_keep_dots(text))
    return cleaned.withColumns(
        {"tokens": tokenize("cleaned"), "word_count": spaced_word_count("cleaned")}
    ).withColumn("ready_for_ia", F.col("word_count") >= MIN_WORDS)


def cleaning_stats(cleaned: DataFrame) -> DataFrame:
    """One row: rows, rows that pass the gate, mean word count."""
    return cleaned.agg(
        F.count("*").alias("total"),
        F.count_if("ready_for_ia").alias("ready"),
        F.avg("word_count").alias("avg_words"),
    )


def api_queue(processed: DataFrame) -> DataFrame:
    """Rows queued for scoring: id, type, content and nested metadata."""
    return processed.select(
        "id",
        "data_type",
        F.col("title_cleaned").alias("content"),
        F.struct("source", "title_original", "word_count", "processed_time").alias("metadata"),
    )


def preprocess_texts(items: DataFrame) -> DataFrame:
    """The text items of a batch: cleaned content, tokens and their number."""
    cleaned = items.where(F.col("type") == "text").select(
        "id", "type", clean_ascii("content").alias("content")
    )
    return cleaned.withColumns(
        {"tokens": tokenize("content"), "token_count": spaced_word_count("content")}
    )


def preprocess_batch(
    items: DataFrame, images: DataFrame, resize: bool, side: int = 800
) -> DataFrame:
    """Text and image items ready for scoring; other types and unreadable images drop.

    ``items`` has id, type, content and path; ``images`` has path and content bytes.  An image
    that many items name is encoded once.
    """
    wanted = items.where(F.col("type") == "image").select("id", "type", "path")
    named = images.select("path", "content").join(wanted.select("path"), "path", "left_semi")
    encoded = wanted.join(encode_images(named, resize, side), "path")
    encoded = encoded.select("id", "type", "content", "format")
    return preprocess_texts(items).unionByName(encoded, allowMissingColumns=True)
