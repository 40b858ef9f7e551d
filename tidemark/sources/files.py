"""Landed datasets: CSV and Parquet scans, zones, inventory, previews and fallbacks."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidemark import schemas
from tidemark.sources import versions

# Where each dataset is landed, below the lake root.
ZONES = {
    ("text", "existing"): "data/text/existing",
    ("text", "scraped"): "data/text/scraped",
    ("images", "existing"): "data/images/existing",
    ("images", "scraped"): "data/images/scraped",
    ("streaming", "news"): "data/streaming/news",
    ("processed", "news"): "data/test/news_preprocessed",
    ("processed", "queue"): "data/test/api_queue",
    ("processed", "rollup"): "data/analytics/review_rollup",
    ("processed", "images"): "data/analytics/image_categories",
    ("streaming", "unreadable"): "data/streaming/unreadable",
    ("streaming", "statistics"): "data/streaming/statistics",
    ("live", "totals"): "data/live/totals",
    ("live", "buckets"): "data/live/buckets",
    ("results", "ia"): "data/ia_results",
    ("results", "failed"): "data/ia_failed",
    ("results", "summary"): "data/analytics_summary",
}


# A line break inside a CSV field is written as this mark and a letter, so that
# files can be split at line breaks.
MARK = "\x1b"
BREAKS = {"\n": "n", "\r": "r"}


def _string_columns(schema: StructType) -> list[str]:
    return [field.name for field in schema.fields if field.dataType == StringType()]


def with_marked_breaks(df: DataFrame) -> DataFrame:
    """Text columns on one line each."""

    def marked(name: str) -> Column:
        text = F.replace(F.col(name), F.lit(MARK), F.lit(f"{MARK}e"))
        for char, letter in BREAKS.items():
            text = F.replace(text, F.lit(char), F.lit(MARK + letter))
        return F.when(F.col(name).rlike(f"[{MARK}\n\r]"), text).otherwise(F.col(name))

    return df.withColumns({name: marked(name) for name in _string_columns(df.schema)})


def with_line_breaks(df: DataFrame) -> DataFrame:
    """Undo :func:`with_marked_breaks`; text without the mark is passed on as it is."""

    def plain(name: str) -> Column:
        text = F.col(name)
        for char, letter in BREAKS.items():
            text = F.replace(text, F.lit(MARK + letter), F.lit(char))
        text = F.replace(text, F.lit(f"{MARK}e"), F.lit(MARK))
        return F.when(F.col(name).contains(MARK), text).otherwise(F.col(name))

    return df.withColumns({name: plain(name) for name in _string_columns(df.schema)})


def zone_path(root: str, kind: str, origin: str) -> str:
    return f"{root.rstrip('/')}/{ZONES[kind, origin]}"


# --- scans ---


def read_csv(
    spark: SparkSession, path: str | list[str], schema: StructType, mode: str = "PERMISSIVE"
) -> DataFrame:
    """Headered CSV with a fixed schema; quotes are escaped by doubling them.

    ``enforceSchema`` is off, so a file whose header does not fit fails instead of being
    mapped by position.  ``DROPMALFORMED`` leaves out blank and short rows.  Line breaks that
    :func:`write_csv` has marked are put back.  Of a zone with versions the newest is read.
    """
    path = versions.folders(spark, path) if isinstance(path, str) else path
    rows = (
        spark.read.schema(schema)
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("enforceSchema", False)
        .option("mode", mode)
        .csv(path)
    )
    return with_line_breaks(rows)


def read_complete_rows(
    spark: SparkSession, path: str | list[str], schema: StructType
) -> DataFrame:
    """CSV rows with at least the header's fields; surplus fields are cut off.

    Blank and short rows are left out.  A malformed row is either short or long, which the
    commas outside its quotes tell.
    """
    marked = StructType([*schema.fields, StructField(schemas.CORRUPT, StringType())])
    rows = (
        spark.read.schema(marked)
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("columnNameOfCorruptRecord", schemas.CORRUPT)
        # Rows are measured against the whole schema, whatever columns a query reads.
        .option("columnPruning", False)
        .csv(path)
    )
    raw = F.col(schemas.CORRUPT)
    commas = F.length(F.regexp_replace(raw, '"[^"]*"|[^,"]', ""))
    long_enough = raw.isNull() | (commas >= len(schema.fields) - 1)
    # Spark refuses to read the corrupt column alone, as a count would, so look at one more.
    readable = F.length(F.coalesce(schema.names[0], F.lit(""))) >= 0
    return rows.where(long_enough & readable).drop(schemas.CORRUPT)


def read_reviews(spark: SparkSession, root: str, origin: str = "existing") -> DataFrame:
    schema = schemas.REVIEWS_EXISTING if origin == "existing" else schemas.REVIEWS_SCRAPED
    return read_csv(spark, zone_path(root, "text", origin), schema)


def read_images(spark: SparkSession, root: str, origin: str = "existing") -> DataFrame:
    schema = schemas.IMAGES_EXISTING if origin == "existing" else schemas.IMAGES_SCRAPED
    return read_csv(spark, zone_path(root, "images", origin), schema)


def load_existing_data(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """Existing reviews and images, also registered as views."""
    reviews, images = read_reviews(spark, root), read_images(spark, root)
    reviews.createOrReplaceTempView("existing_reviews")
    images.createOrReplaceTempView("existing_images")
    return reviews, images


def load_scraped_data(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """Scraped reviews and images, also registered as views."""
    reviews = read_reviews(spark, root, "scraped")
    images = read_images(spark, root, "scraped")
    reviews.createOrReplaceTempView("scraped_reviews")
    images.createOrReplaceTempView("scraped_images")
    return reviews, images


def read_parquet(
    spark: SparkSession, path: str, schema: StructType | None = None
) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


# --- previews and fallbacks ---


def preview_reviews(spark: SparkSession, path: str, rows: int = 99) -> DataFrame:
    """First complete rows of a product review file, as a dashboard shows them."""
    return read_complete_rows(spark, path, schemas.PRODUCT_REVIEWS).limit(rows)


def preview_images(spark: SparkSession, path: str, rows: int = 49) -> DataFrame:
    """First complete rows of an image listing."""
    return read_complete_rows(spark, path, schemas.IMAGE_LISTING).limit(rows)


def sample_texts(reviews: DataFrame, rows: int = 3) -> DataFrame:
    """The text of the first reviews by id, numeric ids in numeric order."""
    order = [F.col("review_id").try_cast("bigint").asc_nulls_last(), F.col("review_id")]
    return reviews.select("review_id", "review_text").orderBy(*order).limit(rows)


def read_or_else(
    primary: Callable[[], DataFrame], fallback: Callable[[], DataFrame]
) -> DataFrame:
    """``primary()``, or ``fallback()`` when its path is missing or it has no row.

    The column ``origin`` says which: stand-in rows never pass for real ones.
    """
    try:
        frame = primary()
        if not frame.isEmpty():
            return frame.withColumn("origin", F.lit("primary"))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
    return fallback().withColumn("origin", F.lit("fallback"))


def first_sample(
    candidates: Sequence[DataFrame], default: str, size: int = 100
) -> DataFrame:
    """One row: the first text of the first candidate that has one, cut to ``size``.

    Every candidate is a frame with ``review_id`` and ``review_text``; earlier ones win.
    """
    spark = candidates[0].sparkSession
    tagged = [
        sample_texts(frame, 1).select(F.lit(rank).alias("rank"), "review_text")
        for rank, frame in enumerate(candidates)
    ]
    tagged.append(
        spark.range(1).select(
            F.lit(len(candidates)).alias("rank"), F.lit(default).alias("review_text")
        )
    )
    best = reduce(DataFrame.unionByName, tagged).orderBy("rank").limit(1)
    return best.select(F.substring("review_text", 1, size).alias("sample"))


# --- folders ---


def list_files(spark: SparkSession, path: str | list[str], pattern: str = "*") -> DataFrame:
    """Path and size of every file below a folder; no file is opened."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .load(path)
        .select("path", "length")
    )


def inventory(spark: SparkSession, root: str) -> DataFrame:
    """Files and bytes of each text and image zone."""
    zones = [key for key in ZONES if key[0] in ("text", "images")]
    parts = [
        list_files(spark, zone_path(root, *zone)).select(
            F.lit(zone[0]).alias("kind"), F.lit(zone[1]).alias("origin"), "length"
        )
        for zone in zones
    ]
    return (
        reduce(DataFrame.unionByName, parts)
        .groupBy("kind", "origin")
        .agg(F.count("*").alias("files"), F.sum("length").alias("bytes"))
        .orderBy("kind", "origin")
    )


def line_count(spark: SparkSession, path: str) -> DataFrame:
    """Number of text lines of a dataset, headers included."""
    return spark.read.text(path).agg(F.count("*").alias("lines"))


# --- sinks ---


def land(df: DataFrame, root: str, kind: str, origin: str) -> str:
    """Replace a CSV zone with ``df`` and return its path.

    The zone is a plain folder, as other programs read it; while it is replaced it must not be
    read.  :func:`land_version` has no such moment.
    """
    path = zone_path(root, kind, origin)
    write_csv(df, path, header=True)
    return path


# Spaces at the ends of a field are part of it.
CSV_OPTIONS = {
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def write_csv(df: DataFrame, path: str, header: bool = False) -> None:
    """One line per row: line breaks inside a field are marked."""
    writer = with_marked_breaks(df).write.mode("overwrite")
    writer.options(header=header, **CSV_OPTIONS).csv(path)


def land_version(df: DataFrame, root: str, kind: str, origin: str) -> int:
    """Replace a CSV zone in one step and return the version.

    Readers that began before go on with the old rows; :func:`read_csv` finds the newest.
    """
    options = {"header": "true", **CSV_OPTIONS}
    path = zone_path(root, kind, origin)
    return versions.replace(with_marked_breaks(df), path, form="csv", options=options)


def write_parquet(
    df: DataFrame, path: str, mode: str = "overwrite", by: Sequence[str] = ()
) -> None:
    """Write Parquet, partitioned ``by`` columns if any, so that readers skip what they can."""
    writer = df.write.mode(mode)
    (writer.partitionBy(*by) if by else writer).parquet(path)
