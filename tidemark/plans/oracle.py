"""ANSI SQL twins of the queries, over the same tables, for checking results."""

from __future__ import annotations

from tidemark.functions.categories import ARTICLE_KEYWORDS, IMAGE_KEYWORDS
from tidemark.plans.tables import AS_OF, SEEN_AT, SPLIT_DATE, TABLES

# RE2 spelling of the Unicode whitespace and word classes.
_SPACE = r"\s\x0b\x1c-\x1f\x{85}\p{Z}"
_WORD = r"\p{L}\p{N}_"


# --- expressions ---


def _sub(text: str, pattern: str, by: str) -> str:
    return f"regexp_replace({text}, '{pattern}', '{by}', 'g')"


def _collapse(text: str) -> str:
    return f"trim({_sub(text, f'[{_SPACE}]+', ' ')})"


def _no_urls(text: str, www: bool = True) -> str:
    head = r"(http|www\.)" if www else "http"
    return _sub(text, f"{head}[^{_SPACE}]+", "")


def _clean_ascii(text: str) -> str:
    kept = _sub(_no_urls(text, www=False), f"[^a-zA-Z0-9{_SPACE}]", "")
    return f"lower({_collapse(kept)})"


def _clean_words(text: str, also: str = "") -> str:
    spaced = _sub(_no_urls(text), f"[^{_WORD}{also}{_SPACE}]", " ")
    return f"lower({_collapse(spaced)})"


def _clean_plain(text: str) -> str:
    return f"trim({_no_urls(_sub(text, f'[{_SPACE}]+', ' '))})"


def _words(text: str) -> str:
    return f"CAST(len(regexp_extract_all({text}, '[^{_SPACE}]+')) AS INTEGER)"


def _tokens(text: str, separator: str) -> str:
    return f"array_to_string(regexp_extract_all({text}, '[^{_SPACE}]+'), '{separator}')"


def _host(url: str) -> str:
    return f"replace(split_part(split_part({url}, '//', 2), '/', 1), 'www.', '')"


def _category(text: str, keywords: dict[str, list[str]]) -> str:
    branches = " ".join(
        "WHEN "
        + " OR ".join(f"contains(lower({text}), '{word}')" for word in words)
        + f" THEN '{name}'"
        for name, words in keywords.items()
    )
    return f"CASE {branches} ELSE 'general' END"


def _strip_tags(markup: str) -> str:
    """Readable text, for the entities that occur; a reference may lack its semicolon."""
    for name, char in (("copy", "©"), ("middot", "·"), ("quot", '"'), ("amp", "&")):
        markup = _sub(markup, rf"&{name}(?:;|([^a-zA-Z0-9;.-]))", rf"{char}\1")
    shown = _sub(markup, r"(?is)<script.*?</script>|<style.*?</style>|<!--.*?-->", "")
    return _sub(shown, r"<[^>]*>", "")


def _clean_html(markup: str) -> str:
    return _clean_plain(_strip_tags(markup))


_RATING = "TRY_CAST(rating AS DOUBLE)"
_RATING_INT = f"CAST(trunc({_RATING}) AS INTEGER)"
_POSITIVE = f"count(*) FILTER (WHERE {_RATING_INT} >= 4)"


# --- shared relations ---

_REVIEW_COLUMNS = """
    CAST(o_orderkey AS VARCHAR) AS review_id,
    'He said "' || o_orderpriority || '",' || chr(10) || 'order '
        || CAST(o_orderkey AS VARCHAR) AS review_text,
    CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN '4.5'
         WHEN o_orderpriority = '2-HIGH' AND o_orderstatus = 'P' THEN 'n/a'
         ELSE substring(o_orderpriority, 1, 1) END AS rating,
    strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS "timestamp",
    CASE WHEN o_orderdate >= TIMESTAMP '{split}' THEN 'web_scraping'
         WHEN o_orderstatus = 'F' THEN 'amazon'
         WHEN o_orderstatus = 'O' THEN 'ebay' ELSE 'shopify' END AS source,
    CASE WHEN o_totalprice >= 375000 THEN 'home'
         WHEN o_totalprice >= 250000 THEN 'electronics'
         WHEN o_totalprice >= 125000 THEN 'books' ELSE 'unknown' END AS category,
    CASE WHEN o_orderdate >= TIMESTAMP '{split}' THEN 'scraped' ELSE 'existing' END
        AS data_source
""".format(split=SPLIT_DATE)

_REVIEWS = f"reviews AS (SELECT {_REVIEW_COLUMNS} FROM orders)"

_IMAGES = f"""images AS (
    SELECT CAST(p_partkey AS VARCHAR) AS image_id,
           replace(p_name, ' ', '_') || '.jpg' AS filename,
           lower(p_type) AS category,
           '{SEEN_AT}' AS "timestamp",
           p_brand AS source,
           CAST(p_size AS VARCHAR) AS size_kb,
           CASE WHEN p_size <= 38 THEN 'existing' ELSE 'scraped' END AS data_source
    FROM part)"""

_PRODUCTS = """products AS (
    SELECT CAST(l_orderkey AS VARCHAR) || '_' || CAST(l_linenumber AS VARCHAR) AS "Id",
           CAST(l_partkey AS VARCHAR) AS "ProductId",
           CASE WHEN l_returnflag = 'R' THEN 'n/a' ELSE CAST(l_linenumber AS VARCHAR) END
               AS "Score",
           l_returnflag AS "Summary",
           l_linestatus AS "Text"
    FROM lineitem)"""

_NEWS = f"""news AS (
    SELECT CAST(doc_id AS VARCHAR) AS id,
           'https://news.example.com/' || doc_id || ' ' || text || ' www.example.org/' || source
               AS title,
           '{SEEN_AT}' AS "timestamp",
           source
    FROM documents)"""

_PREPROCESSED = f"""{_NEWS}, cleaned AS (
    SELECT *, {_clean_words('title')} AS title_cleaned FROM news), counted AS (
    SELECT *, {_words('title_cleaned')} AS word_count,
           CAST(length(title) AS INTEGER) AS title_length
    FROM cleaned), processed AS (
    SELECT * FROM counted WHERE word_count >= 3)"""

_TURN = "CAST(conv_id AS VARCHAR) || '_' || CAST(turn AS VARCHAR)"

_ITEMS = r"""items AS (
    SELECT source, doc_id AS position, split_part(text, E'\n', 1) AS title,
           'https://www.example.com/' || doc_id AS link, text AS description, lang
    FROM documents)"""

_POSTS = rf"""posts AS (
    SELECT {_TURN} AS id,
           CASE WHEN role = 'system' THEN '' ELSE split_part(text, E'\n', 1) END AS title,
           CASE WHEN role = 'user' THEN text ELSE '' END AS selftext,
           '/r/technology/' || conv_id AS permalink,
           CASE WHEN role = 'user' THEN CAST(turn AS INTEGER) ELSE 0 END AS ups,
           CAST(length(text) AS INTEGER) AS num_comments
    FROM conversations)"""

_IMAGE_POSTS = """posts AS (
    SELECT CAST(p_partkey AS VARCHAR) AS id,
           p_name || ' Machine near a CITY car, ' || p_brand AS title,
           'https://i.example.com/' || p_partkey || CASE p_type
               WHEN 'ECONOMY' THEN '.jpg' WHEN 'LARGE' THEN '.jpeg' WHEN 'MEDIUM' THEN '.png'
               WHEN 'PROMO' THEN '.gif' WHEN 'SMALL' THEN '.jpg?width=640' ELSE '.JPG' END AS url,
           CASE WHEN p_type = 'LARGE' THEN 'self' WHEN p_type = 'PROMO' THEN ''
                ELSE 'https://t.example.com/' || p_partkey END AS thumbnail,
           p_size AS ups,
           CASE WHEN p_size > 10 THEN p_size ELSE 0 END AS num_comments,
           CASE WHEN p_type = 'MEDIUM' THEN 'unknown' ELSE lower(p_brand) END AS author,
           p_brand AS subreddit
    FROM part)"""

_IMAGE_LINK = "regexp_matches(url, '\\.(jpg|jpeg|png|gif)$')"

_MESSAGES = """messages AS (
    SELECT CASE WHEN event_type = 'view' THEN 'images-topic' ELSE 'text-topic' END AS topic,
           'ev_' || event_id AS id,
           event_type || ' by user é' || user_id AS title,
           CASE WHEN event_type <> 'signup' THEN event_type END AS source,
           CASE WHEN k >= 75 THEN 'science' WHEN k >= 50 THEN 'business'
                WHEN k >= 20 THEN 'technology' END AS category,
           strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS scraped_at,
           CASE WHEN event_type <> 'error' THEN k END AS word_count,
           ts
    FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events))"""

_BROKEN = """checks AS (
    SELECT o_orderkey, rule, place, NOT coalesce(holds, false) AS breaks
    FROM orders, LATERAL (VALUES
        ('has_key', 0, o_orderkey IS NOT NULL), ('has_customer', 1, o_custkey > 0),
        ('price_positive', 2, o_totalprice > 0), ('price_plausible', 3, o_totalprice < 400000),
        ('status_known', 4, o_orderstatus IN ('F', 'O', 'P')),
        ('status_final', 5, o_orderstatus <> 'P'),
        ('priority_given', 6, o_orderpriority <> '4-NOT SPECIFIED'),
        ('dated', 7, o_orderdate IS NOT NULL), ('not_old', 8, year(o_orderdate) >= 1993),
        ('key_not_round', 9, o_orderkey % 100 <> 0)) AS r(rule, place, holds))"""

_EVENT_FIELDS = f"""'{SEEN_AT}' AS "timestamp", '{SEEN_AT}' AS scraped_at"""

_IMAGE_EVENTS = f"""{_IMAGE_POSTS}, image_events AS (
    SELECT 'reddit_img_' || id AS id, {_clean_plain('title')} AS title, url AS image_url,
           thumbnail AS thumbnail_url, 'reddit_' || subreddit AS source,
           {_category('title', IMAGE_KEYWORDS)} AS category, ups AS upvotes,
           num_comments AS comments, subreddit, author, {_EVENT_FIELDS},
           'image_metadata' AS data_type
    FROM posts WHERE {_IMAGE_LINK})"""

_SCORED = f"""scored AS (
    SELECT {_TURN} AS original_id, 'sentiment' AS analysis_type,
           CASE WHEN turn % 5 = 4 THEN NULL
                WHEN length(text) >= 200 THEN CAST(0.9 AS DOUBLE)
                ELSE CAST(0.6 AS DOUBLE) END AS confidence,
           '2025-06-22T20:00:00' AS processed_at,
           CASE WHEN turn % 5 = 4 THEN 'error' ELSE 'success' END AS status,
           CASE WHEN turn % 5 = 4 THEN NULL
                WHEN length(text) >= 200 THEN 'POSITIVE' ELSE 'NEGATIVE' END AS sentiment
    FROM conversations)"""


def _articles(source: str, prefix: str, body: str, columns: str) -> str:
    """An article query over the document items; ``body`` is the cleaned content's name."""
    return f"""WITH {_ITEMS}, cleaned AS (
        SELECT *, {_clean_plain('title')} AS clean_title,
               {_clean_plain('description')} AS body FROM items)
    SELECT '{prefix}' || sha256(link) AS id, clean_title AS title, {body} AS content,
           link AS url, '{source}' AS source, 'technology' AS category, {_EVENT_FIELDS},
           'text' AS data_type, {columns}
    FROM cleaned"""


_BOTH_WORDS = _words("clean_title || ' ' || body")
_PUBLISHED = "CASE WHEN lang <> 'es' THEN 'Sun, 22 Jun 2025' ELSE '' END AS published"

ORACLE: dict[str, str] = {
    # --- unified views and reports ---
    "unified_reviews": f"WITH {_REVIEWS} SELECT * FROM reviews",
    "landed_csv_reviews": f"WITH {_REVIEWS} SELECT * FROM reviews",
    "unified_images": f"WITH {_IMAGES} SELECT * FROM images",
    "reviews_by_source": f"""WITH {_REVIEWS}
        SELECT source, data_source, count(*) AS total_reviews,
               round(avg({_RATING}), 2) AS avg_rating, {_POSITIVE} AS positive_reviews
        FROM reviews GROUP BY source, data_source""",
    "reviews_daily": f"""WITH {_REVIEWS}
        SELECT CAST(CAST(CAST("timestamp" AS TIMESTAMP) AS DATE) AS VARCHAR) AS date,
               data_source, count(*) AS daily_reviews,
               round(avg({_RATING}), 2) AS daily_avg_rating
        FROM reviews GROUP BY 1, 2""",
    "satisfaction": f"""WITH {_REVIEWS}, levels AS (
            SELECT CASE WHEN {_RATING_INT} >= 4 THEN 'Satisfied'
                        WHEN {_RATING_INT} = 3 THEN 'Neutral' ELSE 'Unsatisfied' END
                       AS satisfaction_level
            FROM reviews)
        SELECT satisfaction_level, count(*) AS "count",
               round(CAST(100.0 AS DOUBLE) * count(*) / (SELECT count(*) FROM reviews), 1)
                   AS percentage
        FROM levels GROUP BY satisfaction_level""",
    "image_categories": f"""WITH {_IMAGES}
        SELECT category, data_source, count(*) AS image_count,
               round(avg(TRY_CAST(size_kb AS DOUBLE)), 2) AS avg_size_kb
        FROM images GROUP BY category, data_source""",
    "compare_sources": f"""WITH {_REVIEWS}
        SELECT data_source, count(*) AS total_reviews, round(avg({_RATING}), 2) AS avg_rating,
               min("timestamp") AS earliest_review, max("timestamp") AS latest_review
        FROM reviews GROUP BY data_source""",
    "source_performance": f"""WITH {_REVIEWS}
        SELECT source, count(*) AS total_reviews, round(avg({_RATING}), 2) AS avg_rating,
               round(CAST(100.0 AS DOUBLE) * {_POSITIVE} / count(*), 1) AS satisfaction_rate,
               count(DISTINCT category) AS categories_count
        FROM reviews GROUP BY source""",
    "metric_summary": f"""WITH {_REVIEWS}, {_IMAGES}
        SELECT 'total_reviews' AS metric, CAST(count(*) AS VARCHAR) AS value FROM reviews
        UNION ALL
        SELECT 'avg_rating', CAST(round(avg({_RATING}), 2) AS VARCHAR) FROM reviews
        UNION ALL
        SELECT 'unique_sources', CAST(count(DISTINCT source) AS VARCHAR) FROM reviews
        UNION ALL
        SELECT 'total_images', CAST(count(*) AS VARCHAR) FROM images""",
    "review_rollup": f"""WITH {_REVIEWS}
        SELECT source, data_source, category,
               CAST(CAST(CAST("timestamp" AS TIMESTAMP) AS DATE) AS VARCHAR) AS date,
               {_RATING} AS rating, count(*) AS n, min("timestamp") AS first_at,
               max("timestamp") AS last_at
        FROM reviews GROUP BY 1, 2, 3, 4, 5""",
    "rollup_reports": f"""WITH {_REVIEWS}, days AS (
            SELECT *, CAST(CAST(CAST("timestamp" AS TIMESTAMP) AS DATE) AS VARCHAR) AS date,
                   CASE WHEN {_RATING_INT} >= 4 THEN 'Satisfied'
                        WHEN {_RATING_INT} = 3 THEN 'Neutral' ELSE 'Unsatisfied' END AS level
            FROM reviews)
        SELECT 'by_source' AS report, source || '/' || data_source AS key, count(*) AS n,
               {_POSITIVE} AS part, round(avg({_RATING}), 2) AS value,
               CAST(NULL AS DOUBLE) AS share FROM days GROUP BY source, data_source
        UNION ALL
        SELECT 'daily', date || '/' || data_source, count(*), NULL, round(avg({_RATING}), 2), NULL
        FROM days GROUP BY date, data_source
        UNION ALL
        SELECT 'satisfaction', level, count(*), NULL, NULL,
               round(CAST(100.0 AS DOUBLE) * count(*) / (SELECT count(*) FROM days), 1)
        FROM days GROUP BY level
        UNION ALL
        SELECT 'compare',
               data_source || '/' || min("timestamp") || '/' || max("timestamp"), count(*),
               NULL, round(avg({_RATING}), 2), NULL FROM days GROUP BY data_source
        UNION ALL
        SELECT 'performance', source, count(*), count(DISTINCT category),
               round(avg({_RATING}), 2),
               round(CAST(100.0 AS DOUBLE) * {_POSITIVE} / count(*), 1)
        FROM days GROUP BY source""",
    "review_kpis": f"""WITH {_REVIEWS}
        SELECT count(*) AS total_reviews, avg({_RATING}) AS avg_rating,
               count(DISTINCT source) AS sources FROM reviews""",
    "product_review_kpis": f"""WITH {_PRODUCTS}
        SELECT count(*) AS total_reviews, avg(TRY_CAST("Score" AS DOUBLE)) AS avg_rating,
               CAST(1 AS BIGINT) AS sources FROM products""",
    "rating_histogram": f"""WITH {_PRODUCTS}
        SELECT TRY_CAST("Score" AS DOUBLE) AS rating, count(*) AS n FROM products
        WHERE TRY_CAST("Score" AS DOUBLE) IS NOT NULL GROUP BY 1""",
    "rating_coerce": f"""WITH {_PRODUCTS}
        SELECT "Id", TRY_CAST("Score" AS DOUBLE) AS rating FROM products""",
    "adaptive_columns": f"""WITH {_PRODUCTS}
        SELECT "Id", "Score", "Summary", "Text" FROM products""",
    "product_reviews_unified": f"""WITH {_PRODUCTS}
        SELECT "Id" AS review_id, "Text" AS review_text, "Score" AS rating,
               CAST(NULL AS VARCHAR) AS "timestamp", CAST(NULL AS VARCHAR) AS source,
               'unknown' AS category, 'existing' AS data_source FROM products""",
    "image_category_counts": f"""WITH {_IMAGES}
        SELECT category, count(*) AS n FROM images GROUP BY category""",
    "avg_rating_by_category": f"""WITH {_REVIEWS}
        SELECT category, avg({_RATING}) AS avg_rating FROM reviews GROUP BY category""",
    "avg_size_by_source": f"""WITH {_IMAGES}
        SELECT source, avg(TRY_CAST(size_kb AS DOUBLE)) AS avg_size_kb
        FROM images GROUP BY source""",
    "top_products": f"""WITH {_PRODUCTS}
        SELECT "ProductId", count(*) AS n FROM products
        GROUP BY "ProductId" ORDER BY n DESC, "ProductId" LIMIT 5""",
    "table_counts": " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS n FROM {name}" for name in TABLES
    ),
    "catalog_review_counts": f"""WITH {_REVIEWS}
        SELECT source, count(*) AS n, CAST(sum(length(review_text)) AS BIGINT) AS characters
        FROM reviews GROUP BY source""",
    "landed_line_count": "SELECT count(*) AS lines FROM orders",
    "sample_texts": f"""WITH {_REVIEWS}
        SELECT review_id, review_text FROM reviews ORDER BY CAST(review_id AS BIGINT) LIMIT 3""",
    "first_sample": f"""WITH {_REVIEWS}
        SELECT substring(review_text, 1, 100) AS sample FROM reviews
        ORDER BY data_source, CAST(review_id AS BIGINT) LIMIT 1""",
    "first_product_reviews": f"""WITH {_PRODUCTS}
        SELECT "Id", "Score" FROM products ORDER BY "Id" LIMIT 10""",
    # --- text functions ---
    "clean_ascii": f"WITH {_NEWS} SELECT id, {_clean_ascii('title')} AS cleaned FROM news",
    "clean_words": f"WITH {_NEWS} SELECT id, {_clean_words('title')} AS cleaned FROM news",
    "clean_keep_dots": f"""WITH {_NEWS}
        SELECT id, {_clean_words('title', also='.')} AS cleaned FROM news""",
    "clean_plain": f"WITH {_NEWS} SELECT id, {_clean_plain('title')} AS cleaned FROM news",
    "clean_html": f"SELECT page_id, {_clean_html('html')} AS cleaned FROM pages",
    "tokenize": f"""SELECT {_TURN} AS id, {_words('text')} AS token_count,
               {_tokens('text', '|')} AS tokens FROM conversations""",
    "text_shape": f"""SELECT {_TURN} AS id, CAST(length(text) AS INTEGER) AS size,
               CASE WHEN length(text) > 100 THEN substring(text, 1, 100) || '...' ELSE text END
                   AS cut,
               substring(text, 1, 60) || '...' AS preview,
               trim('""' || text || '"', '"') AS unquoted
        FROM conversations""",
    "stable_ids": "SELECT page_id, 'hn_' || sha256(url) AS id FROM pages",
    "url_hosts": f"SELECT page_id, {_host('url')} AS host FROM pages",
    "image_link_filter": f"WITH {_IMAGE_POSTS} SELECT id, url FROM posts WHERE {_IMAGE_LINK}",
    "categorize_content": f"""SELECT doc_id, {_category('text', ARTICLE_KEYWORDS)} AS category
        FROM documents""",
    "categorize_many": f"""SELECT doc_id,
               CASE WHEN {_category('text', ARTICLE_KEYWORDS)} <> 'general'
                    THEN {_category('text', ARTICLE_KEYWORDS)}
                    WHEN regexp_matches(lower(text), '[a-j]{{3}}q') THEN 'rare'
                    ELSE 'general' END AS category
        FROM documents""",
    "categorize_image": f"""SELECT {_TURN} AS id, {_category('text', IMAGE_KEYWORDS)} AS category
        FROM conversations""",
    "base64_text": f"SELECT {_TURN} AS id, base64(encode(text)) AS content FROM conversations",
    # --- preprocessing ---
    "preprocess_news": f"""WITH {_PREPROCESSED}
        SELECT id, "timestamp", source, title AS title_original, title_cleaned, word_count,
               title_length, 'text' AS data_type, true AS ready_for_ia FROM processed""",
    "preprocess_stats": f"""WITH {_PREPROCESSED}
        SELECT count(*) AS total, avg(word_count) AS avg_words, max(word_count) AS max_words,
               count(DISTINCT source) AS sources FROM processed""",
    "cleaning_stats": f"""WITH {_NEWS}, counted AS (
            SELECT {_words(_clean_words('title', also='.'))} AS word_count FROM news)
        SELECT count(*) AS total, count(*) FILTER (WHERE word_count >= 3) AS ready,
               avg(word_count) AS avg_words FROM counted""",
    "gate_counts": f"""WITH {_PREPROCESSED}
        SELECT count(*) FILTER (WHERE word_count >= 3) AS kept,
               count(*) FILTER (WHERE word_count < 3) AS dropped FROM counted""",
    "api_queue": f"""WITH {_PREPROCESSED}
        SELECT id, 'text' AS data_type, title_cleaned AS content, source,
               title AS title_original, word_count, '{SEEN_AT[:19]}' AS processed_time
        FROM processed""",
    "preprocess_batch_text": f"""WITH cleaned AS (
            SELECT {_TURN} AS id, {_clean_ascii('text')} AS content FROM conversations
            WHERE role <> 'system')
        SELECT id, 'text' AS type, content, replace(content, ' ', '|') AS tokens,
               {_words('content')} AS token_count FROM cleaned""",
    "preprocess_batch": f"""WITH cleaned AS (
            SELECT {_TURN} AS id, {_clean_ascii('text')} AS content FROM conversations
            WHERE role <> 'system')
        SELECT id, 'text' AS type, content, replace(content, ' ', '|') AS tokens,
               {_words('content')} AS token_count, CAST(NULL AS VARCHAR) AS format
        FROM cleaned
        UNION ALL
        SELECT 'page_' || page_id, 'image', base64(encode(html)), NULL, NULL, 'base64'
        FROM pages""",
    # --- ingest ---
    "articles_title_wc": _articles(
        "hackernews", "hn_", "body", f"{_words('clean_title')} AS word_count"
    ),
    "articles_news": _articles(
        "bbc_technology", "bbc_", "body", f"{_PUBLISHED}, {_BOTH_WORDS} AS word_count"
    ),
    "articles_truncated": _articles(
        "techcrunch",
        "tc_",
        "CASE WHEN length(body) > 500 THEN substring(body, 1, 500) || '...' ELSE body END",
        "lang || '|' || cleaned.source || '|news' AS tags, "
        f"{_PUBLISHED}, {_BOTH_WORDS} AS word_count",
    ),
    "articles_fallback": f"""WITH {_POSTS}, cleaned AS (
            SELECT *, {_clean_plain('title')} AS clean_title,
                   {_clean_plain('selftext')} AS body
            FROM posts WHERE title <> '' OR selftext <> '')
        SELECT 'reddit_' || id AS id, clean_title AS title,
               CASE WHEN body = '' THEN clean_title ELSE body END AS content,
               'https://reddit.com' || permalink AS url, 'reddit_technology' AS source,
               'technology' AS category, {_EVENT_FIELDS}, 'text' AS data_type,
               ups AS upvotes, num_comments AS comments, {_BOTH_WORDS} AS word_count
        FROM cleaned""",
    "articles_host": f"""WITH cleaned AS (
            SELECT {_host('url')} AS host, url || '#' || page_id AS link,
                   {_clean_html("regexp_extract(html, '<title>(.*?)</title>', 1)")}
                       AS clean_title,
                   {_clean_html('html')} AS body
            FROM pages)
        SELECT host || '_' || sha256(link) AS id, clean_title AS title, body AS content,
               link AS url, host AS source,
               {_category("clean_title || ' ' || body", ARTICLE_KEYWORDS)} AS category,
               {_EVENT_FIELDS}, 'text' AS data_type, '' AS published,
               {_BOTH_WORDS} AS word_count
        FROM cleaned""",
    "image_events": f"WITH {_IMAGE_EVENTS} SELECT * FROM image_events",
    "first_n_per_source": """WITH ranked AS (
            SELECT source, doc_id AS position,
                   row_number() OVER (PARTITION BY source ORDER BY doc_id) AS r
            FROM documents)
        SELECT source, position FROM ranked
        WHERE r <= CASE source WHEN 'src0' THEN 15 WHEN 'src1' THEN 12
                               WHEN 'src2' THEN 10 WHEN 'src3' THEN 8 ELSE 5 END""",
    "rss_items": f"""SELECT source, 'https://example.com/' || doc_id AS link,
               {_collapse('text')} AS title, {_collapse('text')} AS content,
               lang || '|news' AS tags FROM documents""",
    "listing_posts": f"""SELECT 'tech' AS source, {_TURN} AS id, text AS title,
               role AS author, CAST(turn AS INTEGER) AS ups FROM conversations""",
    "json_roundtrip": f"""WITH {_MESSAGES}
        SELECT topic, id AS key, title, source, category, scraped_at, word_count,
               topic AS kafka_topic, '{AS_OF}' AS sent_to_kafka_at FROM messages""",
    "corrupt_messages": f"""WITH {_MESSAGES}
        SELECT topic, id AS key, '{{{{' AS start FROM messages WHERE source = 'error'""",
    "newest_messages": """SELECT event_id AS "offset" FROM events
        ORDER BY ts DESC, event_id DESC LIMIT 50""",
    # --- live figures ---
    "topic_stats": f"""WITH {_MESSAGES}, articles AS (
            SELECT coalesce(source, 'unknown') AS source,
                   coalesce(category, 'general') AS category, ts
            FROM messages WHERE topic = 'text-topic')
        SELECT 'total' AS dimension, 'articles' AS key, count(*) AS n FROM articles
        UNION ALL
        SELECT 'total', 'images', count(*) FROM messages WHERE topic = 'images-topic'
        UNION ALL
        SELECT 'total', 'last_hour', count(*) FROM articles
        WHERE ts >= TIMESTAMP '{AS_OF}' - INTERVAL 1 HOUR
        UNION ALL
        SELECT 'source', source, count(*) FROM articles GROUP BY source
        UNION ALL
        SELECT 'category', category, count(*) FROM articles GROUP BY category""",
    "ingest_counters": f"""WITH {_MESSAGES}, judged AS (
            SELECT topic, coalesce(source = 'error', false) AS bad FROM messages)
        SELECT count(*) FILTER (WHERE NOT bad) AS total_scraped,
               count(*) FILTER (WHERE NOT bad AND topic = 'text-topic') AS text_articles,
               count(*) FILTER (WHERE NOT bad AND topic = 'images-topic') AS image_metadata,
               count(*) FILTER (WHERE bad) AS errors FROM judged""",
    "stream_split": f"""WITH {_MESSAGES}, judged AS (
            SELECT topic, coalesce(source = 'error', false) AS bad FROM messages)
        SELECT CASE WHEN bad THEN 'unreadable' ELSE 'good' END AS kind, topic, count(*) AS n
        FROM judged GROUP BY 1, 2""",
    "cycle_statistics": f"""WITH {_MESSAGES}, judged AS (
            SELECT topic, coalesce(source = 'error', false) AS bad FROM messages)
        SELECT CAST(3 AS BIGINT) AS cycles, CAST(3 AS BIGINT) AS batches,
               count(*) FILTER (WHERE NOT bad) AS total_scraped,
               count(*) FILTER (WHERE NOT bad AND topic = 'text-topic') AS text_articles,
               count(*) FILTER (WHERE NOT bad AND topic = 'images-topic') AS image_metadata,
               count(*) FILTER (WHERE bad) AS errors
        FROM judged""",
    "stream_newest_messages": f"""WITH {_MESSAGES}
        SELECT topic, id, scraped_at FROM messages
        QUALIFY row_number() OVER (PARTITION BY topic ORDER BY scraped_at DESC, id) <= 50""",
    "last_hour_count": f"""SELECT count(*) AS n FROM events
        WHERE ts >= TIMESTAMP '{AS_OF}' - INTERVAL 1 HOUR""",
    "feed_freshness": f"""WITH newest AS (
            SELECT max(ts) AS last,
                   CAST(floor(epoch(TIMESTAMP '{AS_OF}' - max(ts))) AS BIGINT) AS age_seconds
            FROM events)
        SELECT strftime(last, '%Y-%m-%dT%H:%M:%S.%f') AS last_update, age_seconds,
               CASE WHEN age_seconds < 600 THEN 'active' ELSE 'slowed' END AS status,
               CASE WHEN age_seconds < 600 THEN age_seconds || 's'
                    ELSE CAST(floor(age_seconds / 60) AS BIGINT) || 'min' END AS age
        FROM newest""",
    "hourly_counts": """SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M') AS hour,
               count(*) AS n FROM events GROUP BY 1""",
    "hourly_counts_of_day": """SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M')
               AS hour, count(*) AS n FROM events
        WHERE CAST(ts AS DATE) = DATE '2024-01-15' GROUP BY 1""",
    "articles_per_day_for_source": """SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS date,
               count(*) AS n FROM events WHERE event_type = 'purchase' GROUP BY 1""",
    "article_cards": f"""WITH {_MESSAGES}
        SELECT id, substring(title, 1, 60) || '...' AS title,
               coalesce(source, 'Unknown') AS source, coalesce(category, 'general') AS category,
               'No content...' AS content, CAST(NULL AS VARCHAR) AS url,
               substring(scraped_at, 1, 19) AS scraped_at,
               coalesce(word_count, 0) AS word_count, CAST(NULL AS INTEGER) AS upvotes
        FROM messages WHERE topic = 'text-topic'""",
    "latest_articles": f"""WITH {_MESSAGES}
        SELECT id, substring(title, 1, 60) || '...' AS title,
               coalesce(source, 'Unknown') AS source, coalesce(category, 'general') AS category,
               'No content...' AS content, CAST(NULL AS VARCHAR) AS url,
               substring(scraped_at, 1, 19) AS scraped_at,
               coalesce(word_count, 0) AS word_count, CAST(NULL AS INTEGER) AS upvotes
        FROM messages WHERE topic = 'text-topic' ORDER BY ts DESC, id LIMIT 10""",
    "image_cards": f"""WITH {_IMAGE_EVENTS}
        SELECT id, substring(title, 1, 40) AS title, source, category,
               CASE WHEN thumbnail_url NOT IN ('', 'self') THEN thumbnail_url END
                   AS thumbnail_url,
               upvotes, comments, '{SEEN_AT[:19]}' AS scraped_at FROM image_events""",
    "latest_images": f"""WITH {_IMAGE_EVENTS}, timed AS (
            SELECT *, '2025-06-' || lpad(CAST(CAST(regexp_extract(id, '[0-9]+$') AS BIGINT) % 28 + 1
                   AS VARCHAR), 2, '0') || 'T20:00:00' AS seen FROM image_events)
        SELECT id, substring(title, 1, 40) AS title, source, category,
               CASE WHEN thumbnail_url NOT IN ('', 'self') THEN thumbnail_url END
                   AS thumbnail_url,
               upvotes, comments, seen AS scraped_at FROM timed
        ORDER BY seen DESC, id LIMIT 8""",
    # --- scoring ---
    "ai_requests": f"""WITH {_NEWS}
        SELECT id, 'text' AS type, 'text' AS analysis_type, title AS content, source,
               "timestamp" FROM news""",
    "batch_requests": f"""WITH {_REVIEWS}
        SELECT 'text' AS data_type, review_text AS content, 'sentiment' AS task,
               'review_' || review_id AS id, 'orders' AS source FROM reviews""",
    "score_results": f"""WITH {_SCORED}
        SELECT *, confidence AS sentiment_confidence, CAST(NULL AS VARCHAR) AS topic,
               CASE WHEN status = 'error' THEN 'no answer for the fifth turn' END AS error
        FROM scored""",
    "failed_requests": f"""WITH {_SCORED}
        SELECT original_id, 'no answer for the fifth turn' AS error FROM scored
        WHERE status = 'error'""",
    "scored_tasks": f"""WITH {_SCORED}, both_tasks AS (
            SELECT original_id AS id, 'sentiment' AS analysis_type, sentiment,
                   CAST(NULL AS VARCHAR) AS topic FROM scored WHERE status = 'success'
            UNION ALL
            SELECT original_id, 'topic', NULL,
                   CASE WHEN sentiment = 'POSITIVE' THEN 'long' ELSE 'short' END
            FROM scored WHERE status = 'success'
            UNION ALL
            SELECT original_id, NULL, NULL, NULL FROM scored WHERE status = 'error')
        SELECT * FROM both_tasks""",
    "pending_topics": f"SELECT {_TURN} AS id, 'topic' AS task FROM conversations",
    "batch_success": f"""WITH {_SCORED}
        SELECT count(*) AS total_processed,
               count(*) FILTER (WHERE status = 'success') AS successful FROM scored""",
    "scored_successes": f"""WITH {_SCORED}
        SELECT original_id, confidence FROM scored WHERE status = 'success'""",
    "queue_with_results": f"""SELECT {_TURN} AS id, CAST(length(text) AS INTEGER) AS size,
               CASE WHEN role = 'assistant' THEN 'late' END AS result,
               CASE WHEN role = 'assistant' THEN CAST(length(text) AS DOUBLE) END AS confidence
        FROM conversations""",
    "pending_requests": f"""SELECT {_TURN} AS id, 'sentiment' AS task FROM conversations
        WHERE role <> 'assistant'""",
    "detections": """SELECT CAST(page_id AS VARCHAR) AS path,
               CASE WHEN strlen(html) % 7 <> 0 THEN
                   CAST((length(html) - length(replace(html, '<p>', ''))) / 3 AS INTEGER) END
                   AS objects_count,
               CASE WHEN strlen(html) % 7 = 0 THEN 'error' ELSE 'success' END AS status
        FROM pages""",
    # --- streams ---
    "stream_landed_news": f"""WITH {_PREPROCESSED}
        SELECT id, title_cleaned, word_count, title_length FROM processed""",
    "stream_running_totals": f"""WITH {_MESSAGES}
        SELECT topic, coalesce(source, 'unknown') AS source,
               coalesce(category, 'general') AS category, count(*) AS n
        FROM messages GROUP BY 1, 2, 3""",
    "live_totals_under_update": f"""WITH {_MESSAGES}
        SELECT topic, coalesce(source, 'unknown') AS source,
               coalesce(category, 'general') AS category, count(*) AS n, 'after' AS seen
        FROM messages GROUP BY ALL
        UNION ALL
        SELECT topic, coalesce(source, 'unknown'), coalesce(category, 'general'), count(*), 'before'
        FROM messages WHERE CAST(substr(id, 4) AS BIGINT) % 2 = 0 GROUP BY ALL""",
    "changed_files": f"""SELECT {_TURN} || ' ' || role AS value, 1 AS run
        FROM conversations WHERE conv_id % 5 < 4
        UNION ALL
        SELECT {_TURN} || ' ' || role, 2 FROM conversations
        WHERE conv_id % 5 = 4 OR (conv_id % 5 = 3 AND turn > 0)""",
    "silent_sources": """WITH gaps AS (
            SELECT event_type AS source, ts,
                   lag(ts) OVER (PARTITION BY event_type ORDER BY ts) AS before,
                   lead(ts) OVER (PARTITION BY event_type ORDER BY ts) AS after,
                   max(ts) OVER () - INTERVAL 1 HOUR AS told
            FROM events),
        moments AS (
            SELECT source, 'active' AS state, ts AS moment, told FROM gaps
            WHERE before IS NULL OR ts > before + INTERVAL 600 SECOND
            UNION ALL
            SELECT source, 'slowed', ts + INTERVAL 600 SECOND, told FROM gaps
            WHERE after IS NULL OR after > ts + INTERVAL 600 SECOND)
        SELECT source, state, strftime(moment, '%Y-%m-%d %H:%M:%S') AS "at"
        FROM moments WHERE moment <= told""",
    "replaced_zone": f"""WITH {_REVIEWS}
        SELECT seen, source, count(*) AS n, CAST(sum(length(review_text)) AS BIGINT) AS chars
        FROM reviews, (VALUES ('before'), ('after')) AS s(seen)
        WHERE data_source = 'existing' AND (seen = 'after' OR CAST(review_id AS BIGINT) % 2 = 0)
        GROUP BY seen, source""",
    "rescored_once": f"""SELECT
               CASE WHEN length(text) % 5 = 4 THEN 'failure' ELSE 'result' END AS kind,
               CASE WHEN turn <> 0 OR conv_id % 7 <> 0 THEN {_TURN} END AS id, count(*) AS n
        FROM conversations GROUP BY ALL""",
    "rule_counts": f"""WITH {_BROKEN}
        SELECT rule, count(*) FILTER (WHERE breaks) AS broken FROM checks GROUP BY rule""",
    "quarantined_orders": f"""WITH {_BROKEN}
        SELECT o_orderkey, string_agg(rule, ',' ORDER BY place) FILTER (WHERE breaks) AS broken
        FROM checks GROUP BY o_orderkey HAVING bool_or(breaks)""",
    "stream_hourly_counts": """SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M')
               AS hour, count(*) AS n FROM events GROUP BY 1""",
    "stream_last_hour": """WITH slots AS (
            SELECT time_bucket(INTERVAL 5 MINUTE, ts) + k * INTERVAL 5 MINUTE AS as_of
            FROM events, (SELECT unnest(range(1, 13)) AS k))
        SELECT strftime(as_of, '%Y-%m-%d %H:%M') AS as_of, count(*) AS n
        FROM slots GROUP BY 1""",
    "stream_deduplicated": f"""WITH {_MESSAGES}, again AS (
            SELECT * FROM messages WHERE id LIKE '%0'),
        nameless AS (SELECT DISTINCT topic, title, source, category, word_count FROM again)
        SELECT id, source FROM messages
        UNION ALL SELECT 'again_' || id, source FROM again
        UNION ALL SELECT NULL, source FROM nameless""",
    "verified_write": f"""WITH {_REVIEWS}
        SELECT count(*) AS written, count(*) AS found FROM reviews""",
    "first_n_large_cap": """WITH ranked AS (
            SELECT l_returnflag AS source, l_orderkey * 10 + l_linenumber AS position,
                   row_number() OVER (PARTITION BY l_returnflag
                                      ORDER BY l_orderkey * 10 + l_linenumber) AS r
            FROM lineitem)
        SELECT source, position FROM ranked
        WHERE r <= CASE source WHEN 'N' THEN 5000 ELSE 2000 END""",
    "ingest_all_entries": """WITH feeds AS (
            SELECT CASE source WHEN 'src0' THEN 'hackernews' WHEN 'src1' THEN 'bbc_technology'
                               WHEN 'src2' THEN 'techcrunch' ELSE source || '.example.com' END
                       AS source,
                   len(string_split(coalesce(text, ''), chr(10))) AS n
            FROM documents WHERE doc_id % 10 NOT IN (0, 3, 6)),
        posts AS (
            SELECT CASE conv_id % 4 WHEN 0 THEN 'reddit_technology' WHEN 1 THEN 'reddit_board'
                                    WHEN 3 THEN 'reddit_' END AS source,
                   CASE conv_id % 4 WHEN 0 THEN 'text' ELSE 'image_metadata' END AS data_type
            FROM conversations WHERE conv_id % 10 NOT IN (7, 8))
        SELECT source, 'text' AS data_type, CAST(sum(n) AS BIGINT) AS n,
               CAST(sum(n) AS BIGINT) AS ids FROM feeds GROUP BY source
        UNION ALL
        SELECT source, data_type, count(*), count(*) FROM posts GROUP BY ALL""",
    "corrupt_feeds": """SELECT CASE source WHEN 'src0' THEN 'hackernews'
                   WHEN 'src1' THEN 'bbc_technology' WHEN 'src2' THEN 'techcrunch'
                   ELSE source END AS source, 'rss' AS kind,
               CASE doc_id % 10 WHEN 0 THEN 'not XML' WHEN 3 THEN 'no payload'
                                ELSE 'no feed: html' END AS reason, count(*) AS n
        FROM documents WHERE doc_id % 10 IN (0, 3, 6) GROUP BY ALL
        UNION ALL
        SELECT CASE conv_id % 4 WHEN 0 THEN 'reddit_technology' WHEN 1 THEN 'board'
                                WHEN 3 THEN '' END, 'listing',
               CASE conv_id % 10 WHEN 7 THEN 'no payload' ELSE 'no listing' END, count(*)
        FROM conversations WHERE conv_id % 10 IN (7, 8) GROUP BY ALL""",
    "feed_dialects": f"""WITH lines AS (
            SELECT *, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                   generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i
            FROM documents WHERE doc_id % 10 NOT IN (0, 3, 6))
        SELECT CASE source WHEN 'src0' THEN 'hackernews' WHEN 'src1' THEN 'bbc_technology'
                           WHEN 'src2' THEN 'techcrunch' ELSE source END AS source,
               CASE doc_id % 3 WHEN 0 THEN 'rss' WHEN 1 THEN 'rdf' ELSE 'atom' END AS dialect,
               'https://example.com/' || doc_id || '/' || i AS link, 'Entry ' || i AS title,
               coalesce({_collapse('line')}, '') AS description,
               coalesce({_collapse('line')}, '') AS content,
               lang || '|news' AS tags, 'day ' || doc_id AS published FROM lines""",
}

ORACLE["incremental_reports"] = ORACLE["reviews_by_source"]

# Articles and words of a whole cycle, from the twins of its branches.
ORACLE["articles_by_source"] = (
    "SELECT source, count(*) AS n, CAST(sum(word_count) AS BIGINT) AS words FROM ("
    + " UNION ALL ".join(
        f"SELECT source, word_count FROM ({ORACLE[name]})"
        for name in (
            "articles_title_wc",
            "articles_news",
            "articles_truncated",
            "articles_fallback",
            "articles_host",
        )
    )
    + ") GROUP BY source"
)
