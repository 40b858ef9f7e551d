"""The given tables in the shapes the operators expect.  Every adapter maps whole tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

from tidemark.sources.topics import IMAGES_TOPIC, TEXT_TOPIC, encode

# Collection time given to rows of tables without one.
SEEN_AT = "2025-06-22T20:00:00.000000"
# Moment that "now" stands for: just after the last event.
AS_OF = "2024-01-31T00:00:00"
SPLIT_DATE = "1999-01-01"

TABLES = [
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
    "documents",
    "embeddings",
    "pages",
    "benchmark",
    "labels",
    "conversations",
]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def as_of() -> Column:
    return F.lit(AS_OF).cast(TimestampNTZType())


def _iso_seconds(column: str) -> Column:
    return F.date_format(column, "yyyy-MM-dd'T'HH:mm:ss")


# --- reviews and images ---


def _reviews(orders: DataFrame) -> DataFrame:
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    price = F.col("o_totalprice")
    return orders.select(
        F.col("o_orderkey").cast("string").alias("review_id"),
        F.concat(
            # A quote, a comma and a line break, as in real reviews.
            F.lit('He said "'), priority, F.lit('",\norder '), F.col("o_orderkey").cast("string")
        ).alias("review_text"),
        # Fractions and junk are part of what the reports must cope with.
        F.when(priority == "4-NOT SPECIFIED", "4.5")
        .when((priority == "2-HIGH") & (status == "P"), "n/a")
        .otherwise(F.substring(priority, 1, 1))
        .alias("rating"),
        _iso_seconds("o_orderdate").alias("timestamp"),
        F.when(status == "F", "amazon")
        .when(status == "O", "ebay")
        .otherwise("shopify")
        .alias("source"),
        F.when(price >= 375000, "home")
        .when(price >= 250000, "electronics")
        .when(price >= 125000, "books")
        .alias("product_category"),
    )


def review_sets(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """(existing, scraped) reviews: the orders before and from a date on."""
    orders = table(spark, folder, "orders")
    split = F.lit(SPLIT_DATE).cast(TimestampNTZType())
    scraped = _reviews(orders.where(F.col("o_orderdate") >= split)).withColumns(
        {
            "scraped_from": F.concat("source", F.lit(".example.com")),
            "source": F.lit("web_scraping"),
        }
    )
    return _reviews(orders.where(F.col("o_orderdate") < split)), scraped


def product_reviews(spark: SparkSession, folder: str) -> DataFrame:
    """Line items as product reviews; returned ones have no readable score."""
    score = F.col("l_linenumber").cast("string")
    return table(spark, folder, "lineitem").select(
        F.concat_ws("_", F.col("l_orderkey"), F.col("l_linenumber")).alias("Id"),
        F.col("l_partkey").cast("string").alias("ProductId"),
        F.when(F.col("l_returnflag") == "R", "n/a").otherwise(score).alias("Score"),
        F.col("l_returnflag").alias("Summary"),
        F.col("l_linestatus").alias("Text"),
    )


def _images(part: DataFrame) -> DataFrame:
    return part.select(
        F.col("p_partkey").cast("string").alias("image_id"),
        F.concat(F.replace("p_name", F.lit(" "), F.lit("_")), F.lit(".jpg")).alias("filename"),
        F.lower("p_type").alias("category"),
        F.lit(SEEN_AT).alias("timestamp"),
        F.col("p_brand").alias("source"),
        F.col("p_size").cast("string").alias("size_kb"),
    )


def image_sets(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """(existing, scraped) images: the small and the large parts."""
    part = table(spark, folder, "part")
    return _images(part.where("p_size <= 38")), _images(part.where("p_size > 38"))


# --- texts ---


def as_news(documents: DataFrame) -> DataFrame:
    """Documents as news whose titles hold URLs at both ends."""
    return documents.select(
        F.col("doc_id").cast("string").alias("id"),
        F.concat(
            F.lit("https://news.example.com/"),
            F.col("doc_id"),
            F.lit(" "),
            F.col("text"),
            F.lit(" www.example.org/"),
            F.col("source"),
        ).alias("title"),
        F.lit(SEEN_AT).alias("timestamp"),
        "source",
    )


def news(spark: SparkSession, folder: str) -> DataFrame:
    return as_news(table(spark, folder, "documents"))


def turn_id() -> Column:
    return F.concat_ws("_", "conv_id", "turn")


def batch_items(spark: SparkSession, folder: str) -> DataFrame:
    """Conversation turns as batch items; system turns have a type nobody handles."""
    return table(spark, folder, "conversations").select(
        turn_id().alias("id"),
        F.when(F.col("role") == "system", "other").otherwise("text").alias("type"),
        F.col("text").alias("content"),
    )


def _first_line(column: str) -> Column:
    return F.split_part(F.col(column), F.lit("\n"), F.lit(1))


def feed_items(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as feed items: the first line is the title."""
    return table(spark, folder, "documents").select(
        "source",
        F.col("doc_id").alias("position"),
        _first_line("text").alias("title"),
        F.concat(F.lit("https://www.example.com/"), "doc_id").alias("link"),
        F.col("text").alias("description"),
        F.col("text").alias("content"),
        F.array("lang", "source", F.lit("news"), F.lit("fourth")).alias("tags"),
        F.when(F.col("lang") != "es", F.lit("Sun, 22 Jun 2025")).alias("published"),
    )


def page_items(spark: SparkSession, folder: str) -> DataFrame:
    """Web pages as items of aggregated feeds: the markup is the description."""
    return table(spark, folder, "pages").select(
        F.col("url").alias("feed_url"),
        F.concat("url", F.lit("#"), "page_id").alias("link"),
        F.regexp_extract("html", "<title>(.*?)</title>", 1).alias("title"),
        F.col("html").alias("description"),
        F.lit(None).cast("string").alias("published"),
    )


def posts(spark: SparkSession, folder: str) -> DataFrame:
    """Conversation turns as listing posts: users write bodies, system posts are empty."""
    role = F.col("role")
    return table(spark, folder, "conversations").select(
        turn_id().alias("id"),
        F.when(role == "system", "").otherwise(_first_line("text")).alias("title"),
        F.when(role == "user", F.col("text")).otherwise("").alias("selftext"),
        F.concat(F.lit("/r/technology/"), "conv_id").alias("permalink"),
        F.when(role == "user", F.col("turn").cast("int")).alias("ups"),
        F.length("text").alias("num_comments"),
        F.lit(None).cast("string").alias("url"),
        F.lit(None).cast("string").alias("thumbnail"),
        F.col("role").alias("author"),
    )


def image_posts(spark: SparkSession, folder: str) -> DataFrame:
    """Parts as posts with links of several kinds, not all of them images."""
    kind = F.col("p_type")
    suffix = (
        F.when(kind == "ECONOMY", ".jpg")
        .when(kind == "LARGE", ".jpeg")
        .when(kind == "MEDIUM", ".png")
        .when(kind == "PROMO", ".gif")
        .when(kind == "SMALL", ".jpg?width=640")
        .otherwise(".JPG")
    )
    return table(spark, folder, "part").select(
        F.col("p_partkey").cast("string").alias("id"),
        F.concat("p_name", F.lit(" Machine near a CITY car, "), "p_brand").alias("title"),
        F.concat(F.lit("https://i.example.com/"), "p_partkey", suffix).alias("url"),
        F.when(kind == "LARGE", "self")
        .when(kind != "PROMO", F.concat(F.lit("https://t.example.com/"), "p_partkey"))
        .alias("thumbnail"),
        F.col("p_size").alias("ups"),
        F.when(F.col("p_size") > 10, F.col("p_size")).alias("num_comments"),
        F.when(kind != "MEDIUM", F.lower("p_brand")).alias("author"),
        F.col("p_brand").alias("subreddit"),
    )


FEED_NAMES = {"src0": "hackernews", "src1": "bbc_technology", "src2": "techcrunch"}


def escaped_xml(column: Column) -> Column:
    for char, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        column = F.replace(column, F.lit(char), F.lit(name))
    return column


def _concat(*parts: str | Column) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def feed_payloads(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as feeds with an item per line: by turns RSS, RDF and Atom.

    Of ten one is cut off, one is missing, and one is a web page.
    """
    number, lang = F.col("doc_id").cast("string"), F.col("lang")

    def items(build) -> Column:
        return F.array_join(F.transform(F.split("body", "\n"), build), "")

    def title(i: Column) -> Column:
        return _concat("Entry ", (i + 1).cast("string"))

    def page(i: Column) -> Column:
        return _concat("https://example.com/", number, "/", (i + 1).cast("string"))

    rss = items(
        lambda line, i: _concat(
            *("<item><title>", title(i), "</title><link>", page(i), "</link><category>", lang),
            *("</category><category>news</category><description>", line, "</description>"),
            *("<content:encoded>", line, "</content:encoded><pubDate>day ", number, "</pubDate></item>"),
        )
    )
    rdf = items(
        lambda line, i: _concat(
            *('<item rdf:about="', page(i), '"><title>', title(i), "</title><link>", page(i)),
            *("</link><dc:subject>", lang, "</dc:subject><dc:subject>news</dc:subject><description>"),
            *(line, "</description><content:encoded>", line, "</content:encoded><dc:date>day "),
            *(number, "</dc:date></item>"),
        )
    )
    atom = items(
        lambda line, i: _concat(
            *("<entry><id>urn:", number, '</id><title type="text">', title(i), "</title>"),
            *('<link rel="enclosure" href="https://example.com/file"/><link href="', page(i)),
            *('"/><category term="', lang, '"/><category term="news"/><summary>', line),
            *('</summary><content type="html">', line, "</content><updated>day ", number),
            "</updated></entry>",
        )
    )
    atom_head = '<feed xmlns="http://www.w3.org/2005/Atom"><link rel="self" href="https://example.com"/>'
    rdf_head = '<rdf:RDF xmlns:rdf="http://www.w3.org/1999/02/22-rdf-syntax-ns#"><channel rdf:about="x"/>'
    kind, tenth = F.col("doc_id") % 3, F.col("doc_id") % 10
    payload = (
        F.when(tenth == 0, "<rss><channel><item>cut")
        .when(tenth == 3, F.lit(None).cast("string"))
        .when(tenth == 6, "<!DOCTYPE html><html><body>moved</body></html>")
        .when(kind == 0, _concat("<rss><channel>", rss, "</channel></rss>"))
        .when(kind == 1, _concat("<?xml version='1.0'?><!-- a feed -->\n", rdf_head, rdf, "</rdf:RDF>"))
        .otherwise(_concat(atom_head, atom, "</feed>"))
    )
    source = F.col("source")
    for name, feed in FEED_NAMES.items():
        source = F.when(F.col("source") == name, feed).otherwise(source)
    documents = table(spark, folder, "documents")
    documents = documents.withColumn("body", escaped_xml(F.coalesce("text", F.lit(""))))
    return documents.select(
        source.alias("source"),
        _concat("https://", F.col("source"), ".example.com/feed").alias("feed_url"),
        payload.alias("payload"),
    )


def listing_payloads(spark: SparkSession, folder: str) -> DataFrame:
    """Conversation turns as listings of one post: of texts, of a board, and without a source.

    Of ten conversations one has no payloads, and one has error messages in their place.
    """
    conv = F.col("conv_id")
    kind, tenth = conv % 4, conv % 10
    link = _concat("https://i.example.com/", turn_id(), ".jpg")
    post = F.struct(
        turn_id().alias("id"),
        F.col("role").alias("title"),
        F.col("text").alias("selftext"),
        F.when(kind != 0, link).alias("url"),
        F.col("turn").cast("int").alias("ups"),
    )
    children = F.array(F.struct(post.alias("data"))).alias("children")
    listing = F.to_json(F.struct(F.struct(children).alias("data")))
    return table(spark, folder, "conversations").select(
        F.when(kind == 0, "reddit_technology")
        .when(kind == 1, "board")
        .when(kind == 3, "")
        .alias("source"),
        F.when(tenth == 8, '{"error": 429}').when(tenth != 7, listing).alias("payload"),
    )


# --- events ---


def as_messages(events: DataFrame) -> DataFrame:
    """Events as messages of both topics: views are images, the rest are articles."""
    kind = F.col("event_type")
    k = F.get_json_object("props", "$.k").cast("int")
    return events.select(
        F.when(kind == "view", IMAGES_TOPIC).otherwise(TEXT_TOPIC).alias("topic"),
        F.concat(F.lit("ev_"), F.col("event_id").cast("string")).alias("id"),
        F.concat(kind, F.lit(" by user é"), F.col("user_id").cast("string")).alias("title"),
        F.when(kind != "signup", kind).alias("source"),
        F.when(k >= 75, "science")
        .when(k >= 50, "business")
        .when(k >= 20, "technology")
        .alias("category"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("scraped_at"),
        F.when(kind != "error", k).alias("word_count"),
    )


def event_messages(spark: SparkSession, folder: str) -> DataFrame:
    return as_messages(table(spark, folder, "events"))


def topic_records(spark: SparkSession, folder: str) -> DataFrame:
    """The messages as topic records: key and JSON value."""
    return encode(event_messages(spark, folder), F.col("topic"), F.lit(AS_OF))


def damaged_records(spark: SparkSession, folder: str) -> DataFrame:
    """The records, with the values of the source ``error`` made unreadable."""
    records = topic_records(spark, folder)
    is_bad = F.col("value").contains('"source":"error"')
    broken = F.when(is_bad, F.concat(F.lit("{"), "value")).otherwise(F.col("value"))
    return records.withColumn("value", broken)


# --- scoring ---


def score_requests(spark: SparkSession, folder: str) -> DataFrame:
    """Conversation turns as scorer input."""
    return table(spark, folder, "conversations").select(
        turn_id().alias("id"),
        F.lit("text").alias("data_type"),
        F.col("text").alias("content"),
        F.lit("sentiment").alias("task"),
    )


def stored_results(spark: SparkSession, folder: str) -> DataFrame:
    """Results for the assistant turns, each scored twice."""
    turns = table(spark, folder, "conversations").where("role = 'assistant'")
    size = F.length("text").cast("double")
    return turns.select(
        turn_id().alias("original_id"),
        F.lit("sentiment").alias("analysis_type"),
        F.explode(
            F.array(
                F.struct(
                    F.lit("early").alias("result"),
                    (size + 1).alias("confidence"),
                    F.lit("2025-06-22T20:00:00").alias("processed_at"),
                ),
                F.struct(
                    F.lit("late").alias("result"),
                    size.alias("confidence"),
                    F.lit("2025-06-23T20:00:00").alias("processed_at"),
                ),
            )
        ).alias("r"),
    ).select("original_id", "analysis_type", "r.*")
