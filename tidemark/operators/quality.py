"""Checks on landed data.  Each returns rows, so a job can store or act on them."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.sources import versions
from tidemark.sources.files import list_files
from tidemark.sources.session import run_folder


class Rule(NamedTuple):
    """A check of single rows: rows for which ``holds`` is not true break it."""

    name: str
    holds: Column


BROKEN = "broken_rules"


def marked(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """``df`` with the names of the rules that a row breaks, in their order."""
    names = [F.when(F.coalesce(r.holds, F.lit(False)), None).otherwise(F.lit(r.name)) for r in rules]
    return df.withColumn(BROKEN, F.array_compact(F.array(*names)))


def _counts(rules: list[Rule]) -> list[Column]:
    broken = [F.count_if(F.array_contains(BROKEN, r.name)).alias(r.name) for r in rules]
    return [F.count(F.lit(1)).alias("rows"), *broken]


def quarantine(df: DataFrame, rules: list[Rule], good: str, bad: str) -> dict[str, int]:
    """Write rows that keep all rules to ``good`` and the others, with their marks, to ``bad``.

    All rules are one pass over ``df``: the marked rows are written once, into a folder for each
    outcome, and the same write counts all rows and those that break each rule. Both tables change
    in whole steps (:mod:`tidemark.sources.versions`). Returns the counts, ``rows`` for all.
    """
    names = [rule.name for rule in rules]
    if len(set(names)) < len(names) or "rows" in names:
        raise ValueError("rules need names of their own, other than 'rows'")
    spark = df.sparkSession
    seen = Observation()
    split = marked(df, rules).observe(seen, *_counts(rules))
    folder = run_folder(spark, "judged")
    split.withColumn("is_bad", F.size(BROKEN) > 0).write.partitionBy("is_bad").parquet(folder)
    judged = spark.read.schema(f"{_ddl(split)}, is_bad boolean").parquet(folder)
    versions.replace(judged.where("NOT is_bad").drop("is_bad", BROKEN), good)
    versions.replace(judged.where("is_bad").drop("is_bad"), bad)
    return dict(seen.get)


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)


def rule_counts(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """(rule, broken): how many rows break each rule, from one aggregate."""
    counts = marked(df, rules).agg(*_counts(rules))
    pairs = [F.struct(F.lit(r.name).alias("rule"), F.col(r.name).alias("broken")) for r in rules]
    return counts.select(F.inline(F.array(*pairs)))


def missing_columns(df: DataFrame, expected: list[str]) -> list[str]:
    """Expected columns the dataset does not have."""
    return [name for name in expected if name not in df.columns]


def header_has(spark: SparkSession, path: str, column: str) -> bool:
    """A CSV dataset's header names the column."""
    return column in spark.read.option("header", True).csv(path).columns


def files_of_type(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    """One row: the number of matching files and whether there is any."""
    return list_files(spark, path, pattern).agg(
        F.count("*").alias("files"), (F.count("*") > 0).alias("present")
    )


def write_and_verify(df: DataFrame, path: str) -> tuple[int, int]:
    """Overwrite ``path`` with ``df``; (rows written, rows read back).

    The written rows are counted by the write itself, so the plan runs once.
    """
    written = Observation()
    df.observe(written, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(path)
    return written.get["rows"], df.sparkSession.read.parquet(path).count()


def gate_counts(df: DataFrame, passes: Column | str) -> DataFrame:
    """One row: how many rows pass a gate and how many do not."""
    flag = F.col(passes) if isinstance(passes, str) else passes
    kept = F.count_if(flag)
    return df.agg(kept.alias("kept"), (F.count("*") - kept).alias("dropped"))
