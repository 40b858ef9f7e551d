"""Shared pieces of the operators: written intermediate tables and word rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.session import run_folder

# White space that ends a word or is stripped from a line.
SPACE = "\x20\x09\x0a\x0b\x0c\x0d"
WORD = "[^\\x20\\x09-\\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def saved(frame: DataFrame, name: str) -> DataFrame:
    """``frame`` written once to the shared folder and read back.

    It cuts the lineage: a lost executor costs no more than the tasks that read the table.
    """
    spark = frame.sparkSession
    path = run_folder(spark, name)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def text_of(column: str = "text") -> Column:
    """The text, empty where it is NULL."""
    return F.coalesce(F.col(column), F.lit(""))


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def once(frame: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column that later expressions and filters read without computing it again."""
    return frame.withColumn(name, F.explode(F.array(value)))
