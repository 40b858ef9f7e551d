"""Existing and scraped data under one schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.schemas import ALL_IMAGES, ALL_REVIEWS
from tidemark.sources.layouts import images_layout, reviews_layout


def review_rows(reviews: DataFrame, data_source: str) -> DataFrame:
    """Canonical review columns, a category that is never NULL, and the origin."""
    return (
        reviews_layout(reviews)
        .withColumn("category", F.coalesce("product_category", F.lit("unknown")))
        .withColumn("data_source", F.lit(data_source))
        .select(*ALL_REVIEWS.names)
    )


def image_rows(images: DataFrame, data_source: str) -> DataFrame:
    return (
        images_layout(images)
        .withColumn("data_source", F.lit(data_source))
        .select(*ALL_IMAGES.names)
    )


def all_reviews(existing: DataFrame, scraped: DataFrame) -> DataFrame:
    return review_rows(existing, "existing").unionByName(review_rows(scraped, "scraped"))


def all_images(existing: DataFrame, scraped: DataFrame) -> DataFrame:
    return image_rows(existing, "existing").unionByName(image_rows(scraped, "scraped"))


def create_unified_views(spark: SparkSession) -> None:
    """Views ``all_reviews`` and ``all_images`` over the four registered scans."""
    all_reviews(
        spark.table("existing_reviews"), spark.table("scraped_reviews")
    ).createOrReplaceTempView("all_reviews")
    all_images(
        spark.table("existing_images"), spark.table("scraped_images")
    ).createOrReplaceTempView("all_images")
