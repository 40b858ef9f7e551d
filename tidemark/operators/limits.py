"""First and latest rows, overall and per source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Entries kept of each feed per cycle.
FEED_CAPS = {
    "hackernews": 15,
    "reddit_technology": 12,
    "bbc_technology": 10,
    "techcrunch": 8,
}
OTHER_FEEDS_CAP = 5


# Parts that a source is ranked in before it is ranked as a whole.
SALTS = 64


def feed_cap(source: str = "source") -> Column:
    """Entries kept of one fetched feed.

    An entry's position within its own payload is known, so keeping the first ones is a
    filter; no ranking is needed.
    """
    return _cap(source, FEED_CAPS, OTHER_FEEDS_CAP)


def _cap(source: str, caps: dict[str, int], default: int) -> Column:
    cap = F.lit(default)
    for name, size in caps.items():
        cap = F.when(F.col(source) == name, size).otherwise(cap)
    return cap


def _ranked_below(df: DataFrame, keys: list, order: list[str], bound: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") <= bound)


def first_per_source(
    items: DataFrame,
    position: str | list[str],
    caps: dict[str, int],
    default: int,
    source: str = "source",
) -> DataFrame:
    """The first rows of every source by ``position``; ``default`` caps unlisted sources.

    Rows are ranked within salted parts of each source first, and what is left of the parts is
    ranked per source, so a source that holds most rows is spread over many tasks whatever the
    caps and settings are.  The largest cap bounds both rankings, the others are checked last.
    """
    order = [position] if isinstance(position, str) else position
    largest = max([default, *caps.values()])
    salt = F.pmod(F.xxhash64(*order), F.lit(SALTS))
    items = _ranked_below(items, [source, salt], order, largest).drop("_rank")
    ranked = _ranked_below(items, [source], order, largest)
    if any(cap != largest for cap in [default, *caps.values()]):
        ranked = ranked.where(F.col("_rank") <= _cap(source, caps, default))
    return ranked.drop("_rank")


def newest_per_key(rows: DataFrame, key: str, order: list[Column], limit: int) -> DataFrame:
    """The first ``limit`` rows of every key in ``order``, ranked in salted parts of a key first."""
    salt = F.pmod(F.xxhash64(*rows.columns), F.lit(SALTS))
    rows = _ranked_below(rows, [key, salt], order, limit).drop("_rank")
    return _ranked_below(rows, [key], order, limit).drop("_rank")


def latest(df: DataFrame, when: Column | str, limit: int, *ties: str) -> DataFrame:
    """The newest ``limit`` rows, newest first."""
    moment = F.col(when) if isinstance(when, str) else when
    return df.orderBy(moment.desc_nulls_last(), *ties).limit(limit)


def top_keys(df: DataFrame, key: str, limit: int = 5) -> DataFrame:
    """The most frequent keys with their counts; ties go to the smaller key."""
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), key)
        .limit(limit)
    )
