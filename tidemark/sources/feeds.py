"""Landed feed payloads as item rows.

A payload is one fetched document: a feed as XML text (RSS, RDF or Atom, told apart by the root
element) or a listing as JSON text, in the column ``payload``, next to the name of its ``source``.
Any table with the two columns can be decoded; :func:`read_payloads` makes one from a folder of
files.  Decoding adds ``feed`` and ``problem``; every payload has items, or a problem, or is a
well-formed feed without items.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators.once import with_once
from tidemark.schemas import CORRUPT


def read_payloads(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """One row per file below ``path``; the parent folder names the source.

    A file is one value, so this is for feeds, which fit a task.
    """
    files = spark.read.text(
        path, wholetext=True, recursiveFileLookup=True, pathGlobFilter=pattern
    )
    return files.select(
        F.element_at(F.split("_metadata.file_path", "/"), -2).alias("source"),
        F.col("value").alias("payload"),
    )


# The name of the root element, after declarations, comments and a document type.
ROOT = r"(?s)\A\x{FEFF}?(?:\s|<\?.*?\?>|<!--.*?-->|<!DOCTYPE[^>\[]*(?:\[.*?\])?\s*>)*+<([^\s/>]+)"
DIALECTS = {"rss": "rss", "feed": "atom", "rdf:RDF": "rdf"}


def _schema_text(schema) -> str:
    """The schema as a DDL type, with names that hold a colon in quotes."""
    return re.sub(r"([\w-]+:[\w-]+)(?=:)", r"`\1`", schema.simpleString())


def decode_rss(payloads: DataFrame) -> DataFrame:
    """Payloads with the decoded feed in ``feed``, its ``dialect``, and what is wrong in ``problem``.

    A dialect is known by the root element: ``rss``, ``feed`` (Atom) or ``rdf:RDF``.  A payload
    that is missing, is no well-formed XML or has another root is a problem: bad XML is its own
    text, the others have a short reason.
    """
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    decoded = with_once(payloads, "feed", F.from_xml("payload", _schema_text(schemas.FEED), options))
    root = F.regexp_extract("payload", ROOT, 1)
    known = F.create_map(*[F.lit(x) for pair in DIALECTS.items() for x in pair])
    decoded = decoded.withColumn("dialect", F.try_element_at(known, root))
    problem = (
        F.when(F.trim(F.coalesce("payload", F.lit(""))) == "", "no payload")
        .when(F.col(f"feed.{CORRUPT}").isNotNull(), F.col(f"feed.{CORRUPT}"))
        .when(F.col("dialect").isNull(), F.concat(F.lit("no feed: "), root))
        .when(F.col("feed").isNull(), "not read")
        .when((F.col("dialect") == "rss") & F.col("feed.channel").isNull(), "no channel")
    )
    return decoded.withColumn("problem", problem)


def decode_listing(payloads: DataFrame) -> DataFrame:
    """Payloads with the decoded listing in ``feed`` and what is wrong in ``problem``.

    Bad JSON is its own text; a payload that is missing or has no list of posts, such as an error
    message, has a short reason.
    """
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    decoded = with_once(payloads, "feed", F.from_json("payload", schemas.LISTING, options))
    problem = (
        F.when(F.trim(F.coalesce("payload", F.lit(""))) == "", "no payload")
        .when(F.col(f"feed.{CORRUPT}").isNotNull(), F.col(f"feed.{CORRUPT}"))
        .when(F.col("feed.data.children").isNull(), "no listing")
    )
    return decoded.withColumn("problem", problem)


def corrupt_payloads(decoded: DataFrame) -> DataFrame:
    """The payloads that could not be decoded: a failing source does not stop the others."""
    return decoded.where(F.col("problem").isNotNull()).drop("feed")


def _keep(payloads: DataFrame) -> list[Column]:
    return [F.col(name) for name in payloads.columns if name not in ("payload", "feed", "problem")]


def rss_items(payloads: DataFrame) -> DataFrame:
    """One row per feed item, with its position in the feed."""
    return feed_items(decode_rss(payloads))


def _item(title, link, description, content, tags, published) -> Column:
    names = ("title", "link", "description", "content", "tags", "published")
    values = (title, link, description, content, tags, published)
    return F.struct(*[v.alias(n) for n, v in zip(names, values, strict=True)])


def _rss_item(item: Column) -> Column:
    return _item(
        item["title"],
        item["link"],
        F.coalesce(item["description"], item["summary"]),
        item["content:encoded"],
        item["category"],
        item["pubDate"],
    )


def _rdf_item(item: Column) -> Column:
    return _item(
        item["title"],
        item["link"],
        F.coalesce(item["description"], item["summary"]),
        item["content:encoded"],
        F.coalesce(item["dc:subject"], item["category"]),
        F.coalesce(item["dc:date"], item["pubDate"]),
    )


def _atom_item(entry: Column) -> Column:
    """The page of an entry is its first link that is an alternate, or else its first link."""
    links = F.coalesce(entry["link"], F.array().cast(schemas.ATOM_ENTRY["link"].dataType))
    pages = F.filter(links, lambda x: F.coalesce(x["_rel"], F.lit("alternate")) == "alternate")
    link = F.coalesce(F.get(pages, F.lit(0))["_href"], F.get(links, F.lit(0))["_href"], entry["id"])
    return _item(
        entry["title"],
        link,
        entry["summary"],
        entry["content"],
        F.transform(entry["category"], lambda c: c["_term"]),
        F.coalesce(entry["published"], entry["updated"]),
    )


def feed_items(decoded: DataFrame) -> DataFrame:
    """The items of decoded feeds of any dialect, as the same columns."""
    kept = _keep(decoded)
    dialect = F.col("dialect")
    listed = (
        F.when(dialect == "rss", F.transform("feed.channel.item", _rss_item))
        .when(dialect == "rdf", F.transform("feed.item", _rdf_item))
        .when(dialect == "atom", F.transform("feed.entry", _atom_item))
    )
    read = decoded.where(F.col("problem").isNull())
    items = read.select(*kept, F.posexplode(listed).alias("position", "item"))
    return items.select(*kept, "position", "item.*")


def listing_posts(payloads: DataFrame) -> DataFrame:
    """One row per post of a listing, with its position."""
    return post_rows(decode_listing(payloads))


def post_rows(decoded: DataFrame) -> DataFrame:
    """The posts of decoded listings."""
    kept = _keep(decoded)
    posts = decoded.where(F.col("problem").isNull()).select(*kept, F.posexplode("feed.data.children").alias("position", "child"))
    return posts.select(*kept, "position", "child.data.*")
