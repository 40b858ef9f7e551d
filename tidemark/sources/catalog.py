"""Catalog tables over the landed zones."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.schemas import IA_RESULTS
from tidemark.sources import versions
from tidemark.sources.files import with_line_breaks, zone_path

DATABASE = "analytics"

# Declared types of the two external CSV tables.
REVIEWS_DDL = (
    "review_id STRING, review_text STRING, rating INT, timestamp STRING, source STRING, "
    "product_category STRING"
)
IMAGES_DDL = (
    "image_id STRING, filename STRING, category STRING, timestamp STRING, source STRING, "
    "size_kb INT, width INT, height INT, format STRING"
)


def create_tables(spark: SparkSession, root: str, database: str = DATABASE) -> None:
    """(Re)create the database with ``reviews``, ``images`` and ``ia_results``.

    All three have a location of their own, so dropping them leaves the files alone.  Zones with
    versions are shown as of now: call it again after a commit.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for table, ddl, kind in (
        ("reviews", REVIEWS_DDL, "text"),
        ("images", IMAGES_DDL, "images"),
    ):
        spark.sql(f"DROP TABLE IF EXISTS {database}.{table}")
        spark.sql(
            f"CREATE TABLE {database}.{table} ({ddl}) USING csv "
            "OPTIONS (header 'true', quote '\"', escape '\"') "
            f"LOCATION '{versions.folders(spark, zone_path(root, kind, 'existing'))[0]}'"
        )
    results = zone_path(root, "results", "ia")
    known = spark.catalog.tableExists(f"{database}.ia_results")
    if known:
        kind = spark.catalog.getTable(f"{database}.ia_results").tableType
        spark.sql(f"DROP {'VIEW' if kind == 'VIEW' else 'TABLE'} {database}.ia_results")
    if versions.version(spark, results) is not None:
        runs = " UNION ALL ".join(
            f"SELECT * FROM parquet.`{folder}`" for folder in versions.folders(spark, results)
        )
        spark.sql(f"CREATE VIEW {database}.ia_results AS {runs}")
        return
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in IA_RESULTS)
    spark.sql(
        f"CREATE TABLE {database}.ia_results ({columns}) USING parquet "
        f"LOCATION '{results}'"
    )


def save_bucketed(df: DataFrame, table: str, path: str, key: str, buckets: int) -> None:
    """Replace a Parquet table laid out in buckets of ``key``.

    The queue and its results, bucketed alike, join and aggregate by id without a shuffle.
    """
    (
        df.write.mode("overwrite")
        .format("parquet")
        .bucketBy(buckets, key)
        .sortBy(key)
        .option("path", path)
        .saveAsTable(table)
    )


def read_table(spark: SparkSession, table: str) -> DataFrame:
    """A catalog table over a CSV zone, with the line breaks of its texts put back."""
    return with_line_breaks(spark.table(table))


def show_tables(spark: SparkSession, database: str = DATABASE) -> DataFrame:
    return spark.sql(f"SHOW TABLES IN {database}")


def describe(spark: SparkSession, table: str, extended: bool = False) -> DataFrame:
    return spark.sql(f"DESCRIBE {'EXTENDED ' if extended else ''}{table}")


def compute_statistics(spark: SparkSession, table: str) -> DataFrame:
    """Refresh row count and size for the planner and return the table's description."""
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS")
    return describe(spark, table, extended=True)


def show_extended(spark: SparkSession, database: str, pattern: str) -> DataFrame:
    return spark.sql(f"SHOW TABLE EXTENDED IN {database} LIKE '{pattern}'")
