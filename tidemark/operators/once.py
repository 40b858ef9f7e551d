"""Costly columns, computed once per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_once(df: DataFrame, name: str, column: Column) -> DataFrame:
    """Add a costly column (a parse, a chain of regexes) that later filters do not repeat.

    A filter on a projected column is pushed below the projection and computes the column
    again, for every row and every use.  A generated column is out of its reach: the filter
    stays above the generator and reads the finished value.
    """
    return df.select("*", F.explode(F.array(column)).alias(name))
