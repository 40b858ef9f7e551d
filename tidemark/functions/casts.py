"""Lenient conversions: what cannot be read becomes NULL, never an error."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Naive ISO-8601 date or date-time, up to microseconds.
ISO_NAIVE = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?)?$"


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def to_double(value: Column | str) -> Column:
    return _column(value).try_cast("double")


def to_int(value: Column | str) -> Column:
    """Integer part: ``4.7`` reads as 4, junk as NULL."""
    return to_double(value).try_cast("int")


def parse_iso(value: Column | str) -> Column:
    """Naive ISO text as a zone-free timestamp; a ``Z`` is ignored, offsets are not read."""
    text = F.replace(_column(value), F.lit("Z"), F.lit(""))
    return F.when(text.rlike(ISO_NAIVE), text.try_cast("timestamp_ntz"))


def iso_text(value: Column | str) -> Column:
    """Timestamp as ISO text with microseconds."""
    return F.date_format(_column(value), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def rating_column(df: DataFrame) -> Column:
    """Numeric rating of a review layout: ``Score``, else ``rating``, else 0."""
    for name in ("Score", "rating"):
        if name in df.columns:
            return to_double(name)
    return F.lit(0.0)


def source_column(df: DataFrame) -> str | None:
    """First column whose name mentions a source."""
    return next((name for name in df.columns if "source" in name.lower()), None)


def present_columns(df: DataFrame, wanted: list[str]) -> list[str]:
    """The wanted columns that exist, or every column when none does."""
    return [name for name in wanted if name in df.columns] or df.columns
