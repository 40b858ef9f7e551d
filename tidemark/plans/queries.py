"""Every operator as a query on the given tables: name -> function of (session, folder)."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import casts, categories, html, text
from tidemark.operators import articles, limits, preprocess, quality, scoring, unify
from tidemark.operators.once import with_once
from tidemark.plans import jobs, live, reports, rollups, tables
from tidemark.sources import catalog, changes, feeds, files, topics, versions
from tidemark.sources.session import run_folder
from tidemark.streaming import pipelines, silence

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    """Register a query under its function name."""
    QUERIES[build.__name__] = build
    return build


def _seen():
    return F.lit(tables.SEEN_AT)


def _all_reviews(spark, folder):
    return unify.all_reviews(*tables.review_sets(spark, folder))


def _all_images(spark, folder):
    return unify.all_images(*tables.image_sets(spark, folder))


# --- unified views and reports ---


@query
def unified_reviews(spark, folder):
    return _all_reviews(spark, folder)


@query
def unified_images(spark, folder):
    return _all_images(spark, folder)


@query
def reviews_by_source(spark, folder):
    return reports.reviews_by_source(_all_reviews(spark, folder))


@query
def incremental_reports(spark, folder):
    """The report by source from a rollup that a few late reviews have changed.

    The rollup is made without every 97th review; then the months of those are computed
    again.
    """
    run = run_folder(spark, "rollup")
    reviews = _all_reviews(spark, folder)
    late = F.col("review_id").cast("long") % 97 == 0
    rollups.refresh(reviews.where(~late), run)
    rollup = rollups.refresh(reviews, run, rollups.changed_months(reviews.where(late)))
    return reports.reviews_by_source(rollup, rollup=True)


@query
def reviews_daily(spark, folder):
    daily = reports.reviews_daily(_all_reviews(spark, folder))
    return daily.withColumn("date", F.col("date").cast("string"))


@query
def satisfaction(spark, folder):
    return reports.satisfaction(_all_reviews(spark, folder))


@query
def image_categories(spark, folder):
    return reports.image_categories(_all_images(spark, folder))


@query
def compare_sources(spark, folder):
    return reports.compare_sources(_all_reviews(spark, folder))


@query
def source_performance(spark, folder):
    return reports.source_performance(_all_reviews(spark, folder))


@query
def metric_summary(spark, folder):
    return reports.metric_summary(_all_reviews(spark, folder), _all_images(spark, folder))


@query
def review_kpis(spark, folder):
    return reports.review_kpis(_all_reviews(spark, folder))


@query
def product_review_kpis(spark, folder):
    return reports.review_kpis(tables.product_reviews(spark, folder))


@query
def rating_histogram(spark, folder):
    return reports.rating_histogram(tables.product_reviews(spark, folder))


@query
def rating_coerce(spark, folder):
    reviews = tables.product_reviews(spark, folder)
    return reviews.select("Id", casts.rating_column(reviews).alias("rating"))


@query
def adaptive_columns(spark, folder):
    reviews = tables.product_reviews(spark, folder)
    wanted = casts.present_columns(reviews, ["Id", "Score", "Summary", "Text"])
    return reviews.select(*wanted)


@query
def product_reviews_unified(spark, folder):
    return unify.review_rows(tables.product_reviews(spark, folder), "existing")


@query
def image_category_counts(spark, folder):
    return reports.image_category_counts(_all_images(spark, folder))


@query
def avg_rating_by_category(spark, folder):
    return reports.avg_rating_by_category(_all_reviews(spark, folder))


@query
def avg_size_by_source(spark, folder):
    return reports.avg_size_by_source(_all_images(spark, folder))


@query
def top_products(spark, folder):
    return reports.top_products(tables.product_reviews(spark, folder))


@query
def table_counts(spark, folder):
    counts = [
        tables.table(spark, folder, name)
        .agg(F.count("*").alias("n"))
        .select(F.lit(name).alias("table_name"), "n")
        for name in tables.TABLES
    ]
    return reduce(DataFrame.unionByName, counts)


@query
def review_rollup(spark, folder):
    rollup = reports.review_rollup(_all_reviews(spark, folder))
    return rollup.withColumn("date", F.col("date").cast("string"))


@query
def rollup_reports(spark, folder):
    """The review reports, all from one written rollup."""
    path = run_folder(spark, "rollup")
    files.write_parquet(reports.review_rollup(_all_reviews(spark, folder)), path)
    rollup = files.read_parquet(spark, path)

    def rows(name, report, key, n, part=None, value=None, share=None):
        def measure(column, kind):
            return F.lit(None).cast(kind) if column is None else F.col(column).cast(kind)

        return report.select(
            F.lit(name).alias("report"),
            F.concat_ws("/", *key).alias("key"),
            F.col(n).alias("n"),
            measure(part, "long").alias("part"),
            measure(value, "double").alias("value"),
            measure(share, "double").alias("share"),
        )

    parts = [
        rows(
            "by_source",
            reports.reviews_by_source(rollup, rollup=True),
            ["source", "data_source"],
            "total_reviews",
            part="positive_reviews",
            value="avg_rating",
        ),
        rows(
            "daily",
            reports.reviews_daily(rollup, rollup=True),
            ["date", "data_source"],
            "daily_reviews",
            value="daily_avg_rating",
        ),
        rows(
            "satisfaction",
            reports.satisfaction(rollup, rollup=True),
            ["satisfaction_level"],
            "count",
            share="percentage",
        ),
        rows(
            "compare",
            reports.compare_sources(rollup, rollup=True),
            ["data_source", "earliest_review", "latest_review"],
            "total_reviews",
            value="avg_rating",
        ),
        rows(
            "performance",
            reports.source_performance(rollup, rollup=True),
            ["source"],
            "total_reviews",
            part="categories_count",
            value="avg_rating",
            share="satisfaction_rate",
        ),
    ]
    return reduce(DataFrame.unionByName, parts)


@query
def landed_csv_reviews(spark, folder):
    """Both review sets written as CSV zones, read back and unified."""
    root = run_folder(spark, "zones")
    existing, scraped = tables.review_sets(spark, folder)
    files.land(existing, root, "text", "existing")
    files.land(scraped, root, "text", "scraped")
    return unify.all_reviews(
        files.read_reviews(spark, root), files.read_reviews(spark, root, "scraped")
    )


def _landable(spark, folder):
    """All reviews in the layout of the existing ones."""
    existing, scraped = tables.review_sets(spark, folder)
    return existing.unionByName(scraped.select(*existing.columns))


@query
def catalog_review_counts(spark, folder):
    """Reviews and their characters per source, from a catalog table over a landed zone."""
    root = run_folder(spark, "tables")
    files.land(_landable(spark, folder), root, "text", "existing")
    spark.sql("DROP TABLE IF EXISTS landed_reviews")
    spark.sql(
        f"CREATE TABLE landed_reviews ({catalog.REVIEWS_DDL}) USING csv "
        "OPTIONS (header 'true', quote '\"', escape '\"') "
        f"LOCATION '{files.zone_path(root, 'text', 'existing')}'"
    )
    landed = catalog.read_table(spark, "landed_reviews")
    return landed.groupBy("source").agg(
        F.count("*").alias("n"), F.sum(F.length("review_text")).alias("characters")
    )


@query
def landed_line_count(spark, folder):
    """Text lines of a dataset landed as one line per review, without headers."""
    path = run_folder(spark, "lines")
    files.write_csv(_landable(spark, folder), path)
    return files.line_count(spark, path)


@query
def verified_write(spark, folder):
    """Rows written and rows found when reading back."""
    counts = quality.write_and_verify(_all_reviews(spark, folder), run_folder(spark, "verify"))
    return spark.createDataFrame([counts], "written long, found long")


@query
def sample_texts(spark, folder):
    return files.sample_texts(_landable(spark, folder))


@query
def first_sample(spark, folder):
    return files.first_sample(list(tables.review_sets(spark, folder)), "no data")


@query
def first_product_reviews(spark, folder):
    reviews = tables.product_reviews(spark, folder)
    return reviews.select("Id", "Score").orderBy("Id").limit(10)


# --- text functions ---


@query
def clean_ascii(spark, folder):
    return tables.news(spark, folder).select("id", text.clean_ascii("title").alias("cleaned"))


@query
def clean_words(spark, folder):
    return tables.news(spark, folder).select("id", text.clean_words("title").alias("cleaned"))


@query
def clean_keep_dots(spark, folder):
    return tables.news(spark, folder).select(
        "id", text.clean_keep_dots("title").alias("cleaned")
    )


@query
def clean_plain(spark, folder):
    return tables.news(spark, folder).select("id", text.clean_plain("title").alias("cleaned"))


@query
def clean_html(spark, folder):
    pages = tables.table(spark, folder, "pages")
    return pages.select("page_id", html.clean_html("html").alias("cleaned"))


@query
def tokenize(spark, folder):
    turns = tables.table(spark, folder, "conversations")
    return turns.select(
        tables.turn_id().alias("id"),
        text.word_count("text").alias("token_count"),
        F.array_join(text.tokenize("text"), "|").alias("tokens"),
    )


@query
def text_shape(spark, folder):
    turns = tables.table(spark, folder, "conversations")
    quoted = F.concat(F.lit('""'), "text", F.lit('"'))
    return turns.select(
        tables.turn_id().alias("id"),
        F.length("text").alias("size"),
        text.truncate("text", 100).alias("cut"),
        text.preview("text", 60, "Untitled").alias("preview"),
        text.strip_quotes(quoted).alias("unquoted"),
    )


@query
def stable_ids(spark, folder):
    pages = tables.table(spark, folder, "pages")
    return pages.select("page_id", text.stable_id("hn_", "url").alias("id"))


@query
def url_hosts(spark, folder):
    return tables.table(spark, folder, "pages").select("page_id", text.host("url").alias("host"))


@query
def image_link_filter(spark, folder):
    posts = tables.image_posts(spark, folder)
    return posts.where(text.is_image_link("url")).select("id", "url")


@query
def categorize_content(spark, folder):
    documents = tables.table(spark, folder, "documents")
    return documents.select("doc_id", categories.categorize_content("text").alias("category"))


@query
def categorize_many(spark, folder):
    """The categories of documents from a list of a thousand more words, made by rule."""
    letters = "abcdefghij"
    rare = [a + b + c + "q" for a in letters for b in letters for c in letters]
    keywords = categories.ARTICLE_KEYWORDS | {"rare": rare}
    documents = tables.table(spark, folder, "documents")
    return documents.select("doc_id", categories.first_of_many("text", keywords).alias("category"))


@query
def categorize_image(spark, folder):
    turns = tables.table(spark, folder, "conversations")
    return turns.select(
        tables.turn_id().alias("id"), categories.categorize_image("text").alias("category")
    )


@query
def base64_text(spark, folder):
    turns = tables.table(spark, folder, "conversations")
    return turns.select(
        tables.turn_id().alias("id"),
        text.base64_line(F.encode("text", "UTF-8")).alias("content"),
    )


# --- preprocessing ---


def _news(spark, folder):
    moment = F.lit(tables.SEEN_AT).cast("timestamp")
    return preprocess.preprocess_news(tables.news(spark, folder), moment)


@query
def preprocess_news(spark, folder):
    return _news(spark, folder).drop("title", "processed_time")


@query
def preprocess_stats(spark, folder):
    return preprocess.preprocess_stats(_news(spark, folder))


@query
def cleaning_stats(spark, folder):
    cleaned = preprocess.with_clean_sentences(tables.news(spark, folder), "title")
    return preprocess.cleaning_stats(cleaned)


@query
def gate_counts(spark, folder):
    titles = preprocess.with_clean_titles(tables.news(spark, folder))
    return quality.gate_counts(titles, "ready_for_ia")


@query
def api_queue(spark, folder):
    queue = preprocess.api_queue(_news(spark, folder))
    moment = F.date_format("metadata.processed_time", "yyyy-MM-dd'T'HH:mm:ss")
    return queue.select(
        "id",
        "data_type",
        "content",
        F.col("metadata.source").alias("source"),
        F.col("metadata.title_original").alias("title_original"),
        F.col("metadata.word_count").alias("word_count"),
        moment.alias("processed_time"),
    )


@query
def preprocess_batch_text(spark, folder):
    ready = preprocess.preprocess_texts(tables.batch_items(spark, folder))
    return ready.withColumn("tokens", F.array_join("tokens", "|"))


@query
def preprocess_batch(spark, folder):
    """Turns as texts and pages as images, in one batch."""
    texts = tables.batch_items(spark, folder).withColumn("path", F.lit(None).cast("string"))
    pages = tables.table(spark, folder, "pages")
    pictures = pages.select(
        F.concat(F.lit("page_"), "page_id").alias("id"),
        F.lit("image").alias("type"),
        F.lit(None).cast("string").alias("content"),
        F.concat("url", F.lit("#"), "page_id").alias("path"),
    )
    stored = pages.select(
        F.concat("url", F.lit("#"), "page_id").alias("path"),
        F.encode("html", "UTF-8").alias("content"),
    )
    ready = preprocess.preprocess_batch(texts.unionByName(pictures), stored, resize=False)
    return ready.withColumn("tokens", F.array_join("tokens", "|"))


# --- ingest ---


@query
def articles_title_wc(spark, folder):
    return articles.short_title_articles(tables.feed_items(spark, folder), seen_at=_seen())


@query
def articles_news(spark, folder):
    return articles.news_articles(tables.feed_items(spark, folder), seen_at=_seen())


@query
def articles_truncated(spark, folder):
    items = tables.feed_items(spark, folder)
    events = articles.long_content_articles(items, seen_at=_seen())
    return events.withColumn("tags", F.array_join("tags", "|"))


@query
def articles_fallback(spark, folder):
    return articles.listing_articles(tables.posts(spark, folder), seen_at=_seen())


@query
def articles_host(spark, folder):
    return articles.aggregated_articles(tables.page_items(spark, folder), seen_at=_seen())


@query
def image_events(spark, folder):
    return articles.image_events(tables.image_posts(spark, folder), seen_at=_seen())


@query
def articles_by_source(spark, folder):
    """Articles of a whole cycle and their words, per source."""
    items = tables.feed_items(spark, folder)
    cycle = articles.collect_cycle(
        articles.short_title_articles(items),
        articles.listing_articles(tables.posts(spark, folder)),
        articles.news_articles(items),
        articles.long_content_articles(items),
        articles.aggregated_articles(tables.page_items(spark, folder)),
    )
    return cycle.groupBy("source").agg(
        F.count("*").alias("n"), F.sum("word_count").alias("words")
    )


@query
def ingest_all_entries(spark, folder):
    """Every entry of every readable feed and listing, by source; no id is missing."""
    cycle = _cycle(spark, folder)
    kept = ["source", "data_type", "id"]
    entries = cycle.articles.select(kept).unionByName(cycle.images.select(kept))
    return entries.groupBy("source", "data_type").agg(
        F.count("*").alias("n"), F.countDistinct("id").alias("ids")
    )


@query
def corrupt_feeds(spark, folder):
    """Payloads that could not be read, by source and reason."""
    reason = F.when(F.col("reason").startswith("<"), "not XML").otherwise(F.col("reason"))
    failures = _cycle(spark, folder).failures.withColumn("reason", reason)
    return failures.groupBy("source", "kind", "reason").agg(F.count("*").alias("n"))


@query
def feed_dialects(spark, folder):
    """Lines of documents written as items of RSS, RDF and Atom feeds and read back."""
    items = feeds.rss_items(tables.feed_payloads(spark, folder))
    return items.select(
        "source",
        "dialect",
        "link",
        "title",
        text.collapse_spaces("description").alias("description"),
        text.collapse_spaces("content").alias("content"),
        F.array_join("tags", "|").alias("tags"),
        "published",
    )


def _cycle(spark, folder):
    payloads = tables.feed_payloads(spark, folder), tables.listing_payloads(spark, folder)
    return jobs.ingest(*payloads, seen_at=_seen())


@query
def first_n_per_source(spark, folder):
    # The caps of limits.FEED_CAPS, given to sources of the table.
    caps = {"src0": 15, "src1": 12, "src2": 10, "src3": 8}
    items = tables.feed_items(spark, folder).select("source", "position")
    return limits.first_per_source(items, "position", caps, limits.OTHER_FEEDS_CAP)


@query
def first_n_large_cap(spark, folder):
    """Caps beyond a thousand rows; one source holds half of them all."""
    items = tables.table(spark, folder, "lineitem").select(
        F.col("l_returnflag").alias("source"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("position"),
    )
    return limits.first_per_source(items, "position", {"N": 5000}, 2000)


@query
def rss_items(spark, folder):
    """Documents written as one-item feeds and read back."""

    documents = tables.table(spark, folder, "documents")
    payloads = documents.select(
        "source",
        F.concat(
            F.lit("<rss><channel><title>feed</title><item><title>"),
            tables.escaped_xml(F.col("text")),
            F.lit("</title><link>https://example.com/"),
            F.col("doc_id").cast("string"),
            F.lit("</link><content:encoded>"),
            tables.escaped_xml(F.col("text")),
            F.lit("</content:encoded><category>"),
            F.col("lang"),
            F.lit("</category><category>news</category></item></channel></rss>"),
        ).alias("payload"),
    )
    items = feeds.rss_items(payloads)
    return items.select(
        "source",
        "link",
        text.collapse_spaces("title").alias("title"),
        text.collapse_spaces("content").alias("content"),
        F.array_join("tags", "|").alias("tags"),
    )


@query
def listing_posts(spark, folder):
    """Conversation turns written as one-post listings and read back."""
    post = F.struct(
        tables.turn_id().alias("id"),
        F.col("text").alias("title"),
        F.col("role").alias("author"),
        F.col("turn").alias("ups"),
    )
    child = F.struct(post.alias("data"))
    listing = F.struct(F.struct(F.array(child).alias("children")).alias("data"))
    payloads = tables.table(spark, folder, "conversations").select(
        F.lit("tech").alias("source"), F.to_json(listing).alias("payload")
    )
    return feeds.listing_posts(payloads).select("source", "id", "title", "author", "ups")


@query
def json_roundtrip(spark, folder):
    decoded, _ = topics.split_corrupt(topics.decode(tables.topic_records(spark, folder)))
    return decoded.select(
        "topic",
        "key",
        "title",
        "source",
        "category",
        "scraped_at",
        "word_count",
        "kafka_topic",
        "sent_to_kafka_at",
    )


@query
def corrupt_messages(spark, folder):
    """Values cut off on the way, told apart from the readable ones."""
    _, bad = topics.split_corrupt(topics.decode(tables.damaged_records(spark, folder)))
    return bad.select("topic", "key", F.substring(topics.CORRUPT, 1, 2).alias("start"))


@query
def newest_messages(spark, folder):
    """The last fifty records of the topics."""
    records = tables.table(spark, folder, "events").select(
        F.lit(topics.TEXT_TOPIC).alias("topic"),
        F.lit(0).alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").alias("timestamp"),
    )
    return topics.newest_messages(records).select("offset")


# --- live figures ---


@query
def topic_stats(spark, folder):
    records = tables.topic_records(spark, folder)
    decoded = topics.decode(records, fields=["source", "category", "scraped_at"])
    messages, _ = topics.split_corrupt(decoded)
    return live.topic_stats(messages, tables.as_of())


@query
def ingest_counters(spark, folder):
    decoded = topics.decode(tables.damaged_records(spark, folder), fields=["id"])
    return live.ingest_counters(decoded, F.col(topics.CORRUPT).isNotNull())


@query
def last_hour_count(spark, folder):
    return live.last_hour_count(tables.table(spark, folder, "events"), "ts", tables.as_of())


@query
def feed_freshness(spark, folder):
    events = tables.table(spark, folder, "events")
    fresh = live.feed_freshness(events, F.col("ts"), tables.as_of())
    return fresh.withColumn("last_update", casts.iso_text("last_update"))


@query
def hourly_counts(spark, folder):
    hours = live.hourly_counts(tables.table(spark, folder, "events"), "ts")
    return hours.withColumn("hour", F.date_format("hour", "yyyy-MM-dd HH:mm"))


@query
def hourly_counts_of_day(spark, folder):
    events = tables.table(spark, folder, "events")
    hours = live.hourly_counts(events, "ts", F.lit("2024-01-15"))
    return hours.withColumn("hour", F.date_format("hour", "yyyy-MM-dd HH:mm"))


@query
def articles_per_day_for_source(spark, folder):
    daily = live.articles_per_day(tables.event_messages(spark, folder), "purchase")
    return daily.withColumn("date", F.col("date").cast("string"))


@query
def article_cards(spark, folder):
    return live.article_cards(
        tables.event_messages(spark, folder).where(F.col("topic") == topics.TEXT_TOPIC)
    )


@query
def image_cards(spark, folder):
    events = articles.image_events(tables.image_posts(spark, folder), seen_at=_seen())
    return live.image_cards(events)


@query
def latest_articles(spark, folder):
    messages = tables.event_messages(spark, folder)
    return live.latest_articles(messages.where(F.col("topic") == topics.TEXT_TOPIC))


@query
def latest_images(spark, folder):
    """The newest are taken before their titles are cleaned."""
    posts = tables.image_posts(spark, folder).where(text.is_image_link("url"))
    day = F.lpad((F.col("id").cast("long") % 28 + 1).cast("string"), 2, "0")
    seen = F.concat(F.lit("2025-06-"), day, F.lit("T20:00:00.000000"))
    # Spark moves a projection below a limit; it does not move one below a generator.
    newest = with_once(limits.latest(posts, seen, 8, "id"), "newest", F.lit(True))
    return live.image_cards(articles.image_events(newest, seen_at=seen))


# --- scoring ---


def length_scorer(requests: list[dict]) -> list[dict]:
    """Stand-in model: long texts are positive; every fifth turn of a conversation fails."""
    replies = []
    for request in requests:
        content = request["content"]
        if int(request["id"].rpartition("_")[2]) % 5 == 4:
            replies.append({"status": "error", "error": "no answer for the fifth turn"})
            continue
        if request["task"] == "topic":
            category = "long" if len(content) >= 200 else "short"
            result = {"classification": {"category": category}}
            replies.append({"status": "success", "result": result})
            continue
        label, confidence = ("POSITIVE", 0.9) if len(content) >= 200 else ("NEGATIVE", 0.6)
        sentiment = {"label": label, "confidence": confidence}
        replies.append({"status": "success", "result": {"sentiment": sentiment}})
    return replies


def paragraph_detector(content: bytes) -> list[dict]:
    """Stand-in detector: every paragraph tag is an object at its byte offset.

    Images whose size is a multiple of seven are unreadable.
    """
    if len(content) % 7 == 0:
        raise ValueError("unreadable image")
    found, start = [], content.find(b"<p>")
    while start >= 0:
        box = [[float(start), 0.0, float(start + 3), 1.0]]
        found.append({"class": 1, "confidence": 0.5, "bbox": box})
        start = content.find(b"<p>", start + 3)
    return found


def _scored(spark, folder):
    return scoring.score(
        tables.score_requests(spark, folder), length_scorer, now="2025-06-22T20:00:00"
    )


@query
def ai_requests(spark, folder):
    requests = scoring.single_requests(tables.news(spark, folder))
    return requests.select(
        "id",
        "type",
        "analysis_type",
        "content",
        F.col("metadata.source").alias("source"),
        F.col("metadata.timestamp").alias("timestamp"),
    )


@query
def batch_requests(spark, folder):
    requests = scoring.batch_requests(_all_reviews(spark, folder), "orders")
    return requests.select(
        "data_type",
        "content",
        "task",
        F.col("metadata.id").alias("id"),
        F.col("metadata.source").alias("source"),
    )


@query
def score_results(spark, folder):
    scored = _scored(spark, folder)
    return scoring.with_analysis(scored).select(
        "original_id",
        "analysis_type",
        "confidence",
        "processed_at",
        "status",
        "sentiment",
        "sentiment_confidence",
        "topic",
        "error",
    )


@query
def failed_requests(spark, folder):
    return scoring.failures(_scored(spark, folder)).select("original_id", "error")


@query
def scored_tasks(spark, folder):
    """A queue scored for sentiment, then for topics; each row shows the results of both."""
    queue = tables.score_requests(spark, folder)
    path = run_folder(spark, "results")
    for task in ("sentiment", "topic"):
        scoring.score_pending(queue.withColumn("task", F.lit(task)), length_scorer, path)
    stored = scoring.with_analysis(scoring.read_results(spark, path))
    joined = scoring.queue_with_results(queue.select("id"), stored)
    return joined.select("id", "analysis_type", "sentiment", "topic")


def uneven_scorer(requests: list[dict]) -> list[dict]:
    """Stand-in model that needs no id and fails on some lengths."""
    good = {"status": "success", "result": {"sentiment": {"label": "POSITIVE", "confidence": 0.9}}}
    bad = {"status": "error", "error": "no answer"}
    return [bad if len(request["content"]) % 5 == 4 else good for request in requests]


@query
def rescored_once(spark, folder):
    """A run repeated after it died between its two writes, with requests that have no id.

    The first call stands for the run that died: it stores results and no failures.
    """
    first = F.col("id").endswith("_0") & (F.split_part("id", F.lit("_"), F.lit(1)).cast("long") % 7 == 0)
    queue = tables.score_requests(spark, folder)
    queue = queue.withColumn("id", F.when(~first, F.col("id")))
    stored, failed = run_folder(spark, "results"), run_folder(spark, "failed")
    scoring.score_pending(queue, uneven_scorer, stored, run="first")
    for run in ("first", "first"):
        scoring.score_pending(queue, uneven_scorer, stored, failed_path=failed, run=run)
    parts = [
        versions.read(spark, path).select(F.lit(kind).alias("kind"), F.col("original_id").alias("id"))
        for kind, path in (("result", stored), ("failure", failed))
    ]
    return parts[0].unionByName(parts[1]).groupBy("kind", "id").agg(F.count("*").alias("n"))


@query
def pending_topics(spark, folder):
    """No request for a second task is done by the results of the first."""
    queue = tables.score_requests(spark, folder).withColumn("task", F.lit("topic"))
    return scoring.pending(queue, tables.stored_results(spark, folder)).select("id", "task")


@query
def batch_success(spark, folder):
    return scoring.batch_success(_scored(spark, folder))


@query
def scored_successes(spark, folder):
    return scoring.successes(_scored(spark, folder)).select("original_id", "confidence")


@query
def queue_with_results(spark, folder):
    queue = tables.score_requests(spark, folder).select("id", "content")
    joined = scoring.queue_with_results(queue, tables.stored_results(spark, folder))
    return joined.select("id", F.length("content").alias("size"), "result", "confidence")


@query
def pending_requests(spark, folder):
    queue = tables.score_requests(spark, folder)
    return scoring.pending(queue, tables.stored_results(spark, folder)).select("id", "task")


@query
def detections(spark, folder):
    pages = tables.table(spark, folder, "pages").select(
        F.col("page_id").cast("string").alias("path"),
        F.encode("html", "UTF-8").alias("content"),
    )
    return scoring.object_counts(scoring.detect(pages, paragraph_detector))


# --- streams, drained once ---


def _order_rules():
    """Ten checks of orders, most of which some orders break."""
    price, order = F.col("o_totalprice"), F.col("o_orderkey")
    return [
        quality.Rule("has_key", order.isNotNull()),
        quality.Rule("has_customer", F.col("o_custkey") > 0),
        quality.Rule("price_positive", price > 0),
        quality.Rule("price_plausible", price < 400_000),
        quality.Rule("status_known", F.col("o_orderstatus").isin("F", "O", "P")),
        quality.Rule("status_final", F.col("o_orderstatus") != "P"),
        quality.Rule("priority_given", F.col("o_orderpriority") != "4-NOT SPECIFIED"),
        quality.Rule("dated", F.col("o_orderdate").isNotNull()),
        quality.Rule("not_old", F.year("o_orderdate") >= 1993),
        quality.Rule("key_not_round", order % 100 != 0),
    ]


@query
def rule_counts(spark, folder):
    """How many orders break each of ten rules."""
    return quality.rule_counts(tables.table(spark, folder, "orders"), _order_rules())


@query
def quarantined_orders(spark, folder):
    """Orders that break a rule, with the rules, as the quarantine has them."""
    run = run_folder(spark, "quarantine")
    orders = tables.table(spark, folder, "orders")
    quality.quarantine(orders, _order_rules(), f"{run}/good", f"{run}/bad")
    bad = versions.read(spark, f"{run}/bad")
    return bad.select("o_orderkey", F.array_join(quality.BROKEN, ",").alias("broken"))


@query
def stream_landed_news(spark, folder):
    """Documents as a stream: cleaned, gated, landed as Parquet and read back."""
    run = run_folder(spark, "landing")
    documents = pipelines.stream_parquet(
        spark, f"{folder}/documents*.parquet", tables.table(spark, folder, "documents").schema
    )
    moment = F.lit(tables.SEEN_AT).cast("timestamp")
    pipelines.start_landing(
        tables.as_news(documents), f"{run}/news", f"{run}/checkpoint", once=True, now=moment
    ).awaitTermination()
    landed = files.read_parquet(spark, f"{run}/news")
    return landed.select("id", "title_cleaned", "word_count", "title_length")


def _event_stream(spark, folder):
    schema = tables.table(spark, folder, "events").schema
    return pipelines.stream_parquet(spark, f"{folder}/events*.parquet", schema)


@query
def stream_running_totals(spark, folder):
    """Running totals per source and category, kept by a stream."""
    run = run_folder(spark, "totals")
    totals = pipelines.running_totals(tables.as_messages(_event_stream(spark, folder)))
    keys = ["topic", "source", "category"]
    pipelines.start_updates(
        totals, f"{run}/totals", f"{run}/checkpoint", keys, once=True
    ).awaitTermination()
    return pipelines.current_values(spark, f"{run}/totals", keys)


@query
def live_totals_under_update(spark, folder):
    """Totals read before and after a second batch; the first reader runs during and after it."""
    run = run_folder(spark, "updated")
    keys = ["topic", "source", "category"]
    messages = tables.event_messages(spark, folder).select("topic", "id", "source", "category")
    half = F.substring("id", 4, 20).cast("long") % 2
    pinned = []
    for part in (0, 1):
        messages.where(half == part).write.parquet(f"{run}/topic/part={part}")
        stream = pipelines.stream_parquet(spark, f"{run}/topic/part=*", messages.schema)
        totals = pipelines.running_totals(stream)
        pipelines.start_updates(
            totals, f"{run}/totals", f"{run}/checkpoint", keys, once=True
        ).awaitTermination()
        pinned.append(pipelines.current_values(spark, f"{run}/totals", keys))
    before, after = pinned
    return before.withColumn("seen", F.lit("before")).unionByName(
        after.withColumn("seen", F.lit("after"))
    )


@query
def changed_files(spark, folder):
    """Lines of a folder of files taken in two runs; the second reads the new and changed files only.

    Between the runs one file is replaced, one is new, and the others stay.
    """
    run = run_folder(spark, "files")
    turns = tables.table(spark, folder, "conversations").withColumn("part", F.col("conv_id") % 5)
    line = F.concat(tables.turn_id(), F.lit(" "), F.col("role"))
    taken = []

    def write(part, rows):
        rows.select(line).coalesce(1).write.mode("overwrite").text(f"{run}/in/part-{part}")

    def take(number):
        found = changes.ChangeSet(spark, f"{run}/in", f"{run}/known", "*.txt")
        kept = f"{run}/taken-{number}"
        spark.read.text(found.paths()).write.parquet(kept)
        found.done()
        taken.append(spark.read.parquet(kept).withColumn("run", F.lit(number)))

    for part in range(4):
        write(part, turns.where(F.col("part") == part))
    take(1)
    write(3, turns.where("part = 3 AND turn > 0"))
    write(4, turns.where("part = 4"))
    take(2)
    return taken[0].unionByName(taken[1])


@query
def silent_sources(spark, folder):
    """When sources of the events fell silent and came back, told by a stream in four batches."""
    run = run_folder(spark, "silence")
    events = tables.table(spark, folder, "events")
    moment = F.col("ts").cast("timestamp")
    first, last = events.agg(F.min(F.unix_micros(moment)), F.max(F.unix_micros(moment))).first()
    part = ((F.unix_micros(moment) - first) * 4 / (last - first + 1)).cast("int")
    timed = events.select(F.col("event_type").alias("source"), moment.alias("event_time"))
    for number in range(4):
        timed.where(part == number).coalesce(1).write.parquet(f"{run}/events/part={number}")
    stream = pipelines.stream_parquet(spark, f"{run}/events/part=*", timed.schema, 1)
    found = silence.transitions(stream)
    with silence.rocks_state(spark):
        query = pipelines.start_parquet(found, f"{run}/found", f"{run}/checkpoint", once=True)
    query.awaitTermination()
    told = files.read_parquet(spark, f"{run}/found")
    return told.select("source", "state", F.date_format("at", "yyyy-MM-dd HH:mm:ss").alias("at"))


@query
def replaced_zone(spark, folder):
    """A zone of reviews replaced while a reader holds it: old rows for it, new ones for the next."""
    root = run_folder(spark, "zone")
    existing, _ = tables.review_sets(spark, folder)
    files.land_version(existing.where("CAST(review_id AS BIGINT) % 2 = 0"), root, "text", "existing")
    before = files.read_reviews(spark, root)
    files.land_version(existing, root, "text", "existing")
    after = files.read_reviews(spark, root)
    both = before.withColumn("seen", F.lit("before")).unionByName(
        after.withColumn("seen", F.lit("after"))
    )
    return both.groupBy("seen", "source").agg(
        F.count("*").alias("n"), F.sum(F.length("review_text")).alias("chars")
    )


@query
def stream_hourly_counts(spark, folder):
    """Count of every hour, the open ones included, kept by a stream."""
    run = run_folder(spark, "hours")
    timed = pipelines.with_event_time(tables.as_messages(_event_stream(spark, folder)))
    pipelines.start_updates(
        pipelines.hourly_windows(timed), f"{run}/hours", f"{run}/checkpoint", ["hour"], once=True
    ).awaitTermination()
    hours = pipelines.current_values(spark, f"{run}/hours", ["hour"])
    return hours.select(F.date_format("hour", "yyyy-MM-dd HH:mm").alias("hour"), "n")


@query
def stream_last_hour(spark, folder):
    """Count of the last hour at every five minutes, from bucket counts kept by a stream."""
    run = run_folder(spark, "sliding")
    timed = pipelines.with_event_time(tables.as_messages(_event_stream(spark, folder)))
    pipelines.start_updates(
        pipelines.bucket_counts(timed),
        f"{run}/buckets",
        f"{run}/checkpoint",
        ["bucket"],
        once=True,
    ).awaitTermination()
    buckets = pipelines.current_values(spark, f"{run}/buckets", ["bucket"])
    counts = pipelines.last_hour_counts(buckets)
    return counts.select(F.date_format("as_of", "yyyy-MM-dd HH:mm").alias("as_of"), "n")


@query
def stream_split(spark, folder):
    """Readable and unreadable messages of a topic, landed side by side."""
    run = run_folder(spark, "split")
    records = tables.damaged_records(spark, folder).select("topic", "value")
    files.write_parquet(records, f"{run}/topic")
    stream = pipelines.stream_parquet(spark, f"{run}/topic", records.schema)
    pipelines.start_split(
        topics.decode(stream),
        topics.CORRUPT,
        f"{run}/good",
        f"{run}/unreadable",
        f"{run}/checkpoint",
        once=True,
    ).awaitTermination()
    parts = [
        files.read_parquet(spark, f"{run}/{kind}").select(F.lit(kind).alias("kind"), "topic")
        for kind in ("good", "unreadable")
    ]
    return parts[0].unionByName(parts[1]).groupBy("kind", "topic").agg(F.count("*").alias("n"))


@query
def cycle_statistics(spark, folder):
    """Counts of every cycle of a topic that is landed in three runs, from what the job keeps."""
    run = run_folder(spark, "cycles")
    records = tables.damaged_records(spark, folder).select("topic", "value")
    part = F.pmod(F.get_json_object("value", "$.word_count").cast("int"), F.lit(3))
    part = F.coalesce(part, F.lit(0))
    root = f"{run}/lake"
    for number in range(3):
        records.where(part == number).write.parquet(f"{run}/topic/part={number}")
        stream = pipelines.stream_parquet(spark, f"{run}/topic/part=*", records.schema)
        jobs.land_topic(stream, root, f"{run}/checkpoint", once=True).awaitTermination()
    kept = pipelines.current_values(spark, files.zone_path(root, "streaming", "statistics"))
    return kept.agg(
        F.count("batch").alias("cycles"),
        F.countDistinct("batch").alias("batches"),
        *[F.sum(n).alias(n) for n in ("total_scraped", "text_articles", "image_metadata", "errors")],
    )


@query
def stream_newest_messages(spark, folder):
    """The last 50 messages of every topic, kept by a stream; every batch has old and new ones."""
    run = run_folder(spark, "newest")
    messages = tables.event_messages(spark, folder).select("topic", "id", "scraped_at")
    order = [F.col("scraped_at").desc(), F.col("id")]
    part = F.substring("id", 4, 20).cast("long") % 3
    for number in range(3):
        messages.where(part == number).write.parquet(f"{run}/topic/part={number}")
        stream = pipelines.stream_parquet(spark, f"{run}/topic/part=*", messages.schema)
        pipelines.start_newest(
            stream, f"{run}/newest", f"{run}/checkpoint", "topic", order, 50, once=True
        ).awaitTermination()
    return pipelines.current_values(spark, f"{run}/newest")


@query
def stream_deduplicated(spark, folder):
    """Messages landed once: sent twice, late and fresh in one batch, and without an id.

    After the first batch the watermark is an hour before the last event. The second holds, for
    every tenth message, a late copy of a new id and two fresh ones, and two copies without id.
    """
    run = run_folder(spark, "unique")
    messages = tables.event_messages(spark, folder)
    twice = messages.select("*", F.explode(F.array(F.lit(1), F.lit(2))).alias("send"))
    tenth = messages.where(F.col("id").endswith("0"))
    fresh = F.lit("2024-02-01T00:00:00.000000")
    again = tenth.withColumn("id", F.concat(F.lit("again_"), "id"))
    nameless = tenth.withColumns({"id": F.lit(None).cast("string"), "scraped_at": fresh})
    late = again.withColumn("scraped_at", F.lit("2023-01-01T00:00:00.000000"))
    fresh_rows = again.withColumn("scraped_at", fresh)
    second = reduce(
        DataFrame.unionByName, [late, fresh_rows, fresh_rows, nameless, nameless]
    )
    for batch in (twice.drop("send"), second):
        files.write_parquet(batch, f"{run}/sent", mode="append")
        stream = pipelines.stream_parquet(spark, f"{run}/sent", messages.schema)
        unique = pipelines.deduplicated(pipelines.with_event_time(stream))
        pipelines.start_parquet(
            unique.select("id", "source"), f"{run}/unique", f"{run}/checkpoint", once=True
        ).awaitTermination()
    return files.read_parquet(spark, f"{run}/unique")
