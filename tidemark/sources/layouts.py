"""Adapters from each known file layout to the canonical one; missing columns are NULL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import schemas


def canonical(df: DataFrame, names: list[str], renames: dict[str, Column]) -> DataFrame:
    """``names`` in order: renamed, taken as they are, or typed NULLs."""

    def pick(name: str) -> Column:
        if name in renames:
            return renames[name].cast("string").alias(name)
        if name in df.columns:
            return F.col(name).cast("string").alias(name)
        return F.lit(None).cast("string").alias(name)

    return df.select(*[pick(name) for name in names])


def reviews_layout(df: DataFrame) -> DataFrame:
    """Any known review layout as the six canonical columns."""
    renames = {}
    if "Score" in df.columns:
        renames = {
            "review_id": F.col("Id"),
            "review_text": F.col("Text"),
            "rating": F.col("Score"),
        }
    return canonical(df, schemas.REVIEWS_EXISTING.names, renames)


def images_layout(df: DataFrame) -> DataFrame:
    """Any known image layout as the six canonical columns."""
    names = [name for name in schemas.ALL_IMAGES.names if name != "data_source"]
    return canonical(df, names, {})
