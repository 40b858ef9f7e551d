"""Reports over the unified reviews and images.

Each is one scan with partial aggregation; what is shuffled and sorted is one row per group.
Shares of a total come from the same aggregate, so nothing is scanned twice.

The review reports take the unified reviews, or a rollup of them from :func:`review_rollup`:
a far smaller table in which a row stands for ``n`` reviews.  A job that wants several
reports makes the rollup first and reads the reviews once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.casts import rating_column, source_column, to_double, to_int
from tidemark.operators.limits import top_keys

SATISFIED_FROM = 4
NEUTRAL = 3


def review_rollup(reviews: DataFrame) -> DataFrame:
    """Reviews counted per source, origin, category, day and rating, with their time span."""
    return reviews.groupBy(
        "source",
        "data_source",
        "category",
        _day(False).alias("date"),
        to_double("rating").alias("rating"),
    ).agg(
        F.count("*").alias("n"),
        F.min("timestamp").alias("first_at"),
        F.max("timestamp").alias("last_at"),
    )


# --- measures of reviews, or of a rollup of them where ``rollup`` says so ---


def _rated(reviews: DataFrame) -> DataFrame:
    """Ratings as numbers, so that each text is parsed once for all measures."""
    return reviews.withColumn("rating", to_double("rating"))


def review_day() -> Column:
    """The day of a review, NULL if its time cannot be read."""
    return F.col("timestamp").try_cast("date")


def _day(rollup: bool) -> Column:
    return F.col("date") if rollup else review_day()


def _rows(rollup: bool) -> Column:
    return F.coalesce(F.sum("n"), F.lit(0)) if rollup else F.count("*")


def _rows_where(rollup: bool, condition: Column) -> Column:
    if rollup:
        return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0))
    return F.count_if(condition)


def _avg_rating(rollup: bool) -> Column:
    rating = F.col("rating")
    if rollup:
        return F.sum(rating * F.col("n")) / F.sum(F.when(rating.isNotNull(), F.col("n")))
    return F.avg(rating)


def _round(column: Column) -> Column:
    return F.round(column, 2)


def _share(part: Column, whole: Column) -> Column:
    """Percentage with one decimal."""
    return F.round(F.lit(100.0).cast("double") * part / whole, 1)


def _positive(rollup: bool) -> Column:
    return _rows_where(rollup, to_int("rating") >= SATISFIED_FROM)


# --- review reports ---


def reviews_by_source(reviews: DataFrame, rollup: bool = False) -> DataFrame:
    reviews = _rated(reviews)
    return (
        reviews.groupBy("source", "data_source")
        .agg(
            _rows(rollup).alias("total_reviews"),
            _round(_avg_rating(rollup)).alias("avg_rating"),
            _positive(rollup).alias("positive_reviews"),
        )
        .orderBy(F.desc("total_reviews"), "source", "data_source")
    )


def reviews_daily(reviews: DataFrame, rollup: bool = False) -> DataFrame:
    reviews = _rated(reviews)
    return (
        reviews.groupBy(_day(rollup).alias("date"), "data_source")
        .agg(
            _rows(rollup).alias("daily_reviews"),
            _round(_avg_rating(rollup)).alias("daily_avg_rating"),
        )
        .orderBy(F.desc("date"), "data_source")
    )


def satisfaction(reviews: DataFrame, rollup: bool = False) -> DataFrame:
    """Satisfaction levels with their share of all reviews.

    There are three levels, so all counts fit one global aggregate.  A rating that cannot be
    read is neither satisfied nor neutral and counts as unsatisfied.
    """
    reviews = _rated(reviews)
    counts = reviews.agg(
        _positive(rollup).alias("high"),
        _rows_where(rollup, to_int("rating") == NEUTRAL).alias("mid"),
        _rows(rollup).alias("total"),
    )
    levels = counts.select(
        "total",
        F.stack(
            F.lit(3),
            F.lit("Satisfied"),
            F.col("high"),
            F.lit("Neutral"),
            F.col("mid"),
            F.lit("Unsatisfied"),
            F.col("total") - F.col("high") - F.col("mid"),
        ).alias("satisfaction_level", "count"),
    )
    return (
        levels.where(F.col("count") > 0)
        .select(
            "satisfaction_level",
            "count",
            _share(F.col("count"), F.col("total")).alias("percentage"),
        )
        .orderBy(F.desc("count"), "satisfaction_level")
    )


def compare_sources(reviews: DataFrame, rollup: bool = False) -> DataFrame:
    """Existing against scraped; times are ISO text, whose order is the time order."""
    reviews = _rated(reviews)
    first, last = (
        ("first_at", "last_at") if rollup else ("timestamp", "timestamp")
    )
    return reviews.groupBy("data_source").agg(
        _rows(rollup).alias("total_reviews"),
        _round(_avg_rating(rollup)).alias("avg_rating"),
        F.min(first).alias("earliest_review"),
        F.max(last).alias("latest_review"),
    )


def source_performance(reviews: DataFrame, rollup: bool = False) -> DataFrame:
    reviews = _rated(reviews)
    return (
        reviews.groupBy("source")
        .agg(
            _rows(rollup).alias("total_reviews"),
            _round(_avg_rating(rollup)).alias("avg_rating"),
            _share(_positive(rollup), _rows(rollup)).alias("satisfaction_rate"),
            F.countDistinct("category").alias("categories_count"),
        )
        .orderBy(F.desc("satisfaction_rate"), F.desc("total_reviews"), "source")
    )


def avg_rating_by_category(reviews: DataFrame, rollup: bool = False) -> DataFrame:
    reviews = _rated(reviews)
    return (
        reviews.groupBy("category")
        .agg(_avg_rating(rollup).alias("avg_rating"))
        .orderBy("category")
    )


def metric_summary(reviews: DataFrame, images: DataFrame, rollup: bool = False) -> DataFrame:
    """Four headline metrics as (metric, value) text rows: one scan per table.

    With ``rollup`` the reviews are a rollup and ``images`` are :func:`image_categories`.
    """
    reviews = _rated(reviews)
    review_row = reviews.agg(
        _rows(rollup).cast("string").alias("total_reviews"),
        _round(_avg_rating(rollup)).cast("string").alias("avg_rating"),
        F.countDistinct("source").cast("string").alias("unique_sources"),
    )
    total = F.coalesce(F.sum("image_count"), F.lit(0)) if rollup else F.count("*")
    image_row = images.agg(total.cast("string").alias("total_images"))

    def as_rows(row: DataFrame) -> DataFrame:
        # Explicit stack: an unpivot would drop a metric that is NULL on empty input.
        cells = [part for name in row.columns for part in (F.lit(name), F.col(name))]
        return row.select(F.stack(F.lit(len(row.columns)), *cells).alias("metric", "value"))

    return as_rows(review_row).unionByName(as_rows(image_row))


def review_kpis(reviews: DataFrame) -> DataFrame:
    """Rows, mean rating and distinct sources of any review layout (1 without a source)."""
    source = source_column(reviews)
    sources = F.countDistinct(source) if source else F.lit(1).cast("bigint")
    return reviews.agg(
        F.count("*").alias("total_reviews"),
        F.avg(rating_column(reviews)).alias("avg_rating"),
        sources.alias("sources"),
    )


def rating_histogram(reviews: DataFrame) -> DataFrame:
    """Reviews per rating, ascending; unreadable ratings are left out."""
    return (
        reviews.select(rating_column(reviews).alias("rating"))
        .where("rating IS NOT NULL")
        .groupBy("rating")
        .agg(F.count("*").alias("n"))
        .orderBy("rating")
    )


def top_products(reviews: DataFrame, product: str = "ProductId", limit: int = 5) -> DataFrame:
    return top_keys(reviews, product, limit)


# --- image reports ---


def image_categories(images: DataFrame) -> DataFrame:
    return (
        images.groupBy("category", "data_source")
        .agg(
            F.count("*").alias("image_count"),
            _round(F.avg(to_double("size_kb"))).alias("avg_size_kb"),
        )
        .orderBy(F.desc("image_count"), "category", "data_source")
    )


def image_category_counts(images: DataFrame) -> DataFrame:
    return (
        images.where("category IS NOT NULL")
        .groupBy("category")
        .agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), "category")
    )


def avg_size_by_source(images: DataFrame) -> DataFrame:
    return (
        images.groupBy("source")
        .agg(F.avg(to_double("size_kb")).alias("avg_size_kb"))
        .orderBy("source")
    )


def count_by(df: DataFrame, key: str) -> DataFrame:
    """Rows per key."""
    return df.groupBy(key).agg(F.count("*").alias("n")).orderBy(key)
