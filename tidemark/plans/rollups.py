"""The review rollup kept up to date: only months with changed reviews are computed again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.plans import reports
from tidemark.sources import versions


def _month(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def changed_months(reviews: DataFrame) -> list[str | None]:
    """The months of new, late or removed reviews, None for times that cannot be read.

    There is one value for each month, however many reviews changed.
    """
    months = reviews.select(_month(reports.review_day()).alias("month")).distinct()
    return sorted((row["month"] for row in months.collect()), key=lambda m: (m is None, m or ""))


def of_months(reviews: DataFrame, months: list[str | None]) -> DataFrame:
    """The reviews of these months."""
    known = [month for month in months if month is not None]
    wanted = F.coalesce(_month(reports.review_day()).isin(known), F.lit(False))
    if None in months:
        wanted = wanted | reports.review_day().isNull()
    return reviews.where(wanted)


def refresh(reviews: DataFrame, path: str, months: list[str | None] | None = None) -> DataFrame:
    """Bring the rollup below ``path`` up to date with ``reviews`` and return it.

    ``months`` are those with changes; without them, and the first time, all are computed. Every
    month is a part of its own (parts by day would be thousands of tiny files): the new parts take
    the places of the old ones in one commit, the files of other months stay as they are, and a
    month that has lost all its reviews goes.
    """
    spark = reviews.sparkSession
    at = versions.version(spark, path)
    if months is None or at is None:
        rollup, parts = reports.review_rollup(reviews), list(at.runs) if at else []
    else:
        rollup = reports.review_rollup(of_months(reviews, months))
        parts = ["none" if month is None else month for month in months]
    versions.replace_parts(rollup, path, _month(F.col("date")), parts)
    return versions.read(spark, path)
