"""Explicit schemas of every dataset.  No reader in the package infers a schema."""

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# Column PERMISSIVE readers put an undecodable record into.
CORRUPT = "_corrupt_record"


def _strings(*names: str) -> StructType:
    return StructType([StructField(name, StringType()) for name in names])


# --- landed CSV layouts (every column is read as text, reports cast leniently) ---

REVIEWS_EXISTING = _strings(
    "review_id", "review_text", "rating", "timestamp", "source", "product_category"
)
REVIEWS_SCRAPED = _strings(*REVIEWS_EXISTING.names, "scraped_from")
PRODUCT_REVIEWS = _strings("Id", "ProductId", "Score", "Summary", "Text")
IMAGES_EXISTING = _strings(
    "image_id",
    "filename",
    "category",
    "timestamp",
    "source",
    "size_kb",
    "width",
    "height",
    "format",
)
IMAGES_SCRAPED = _strings(
    "image_id",
    "filename",
    "category",
    "timestamp",
    "source",
    "size_kb",
    "scraped_from",
    "url",
)
IMAGE_LISTING = _strings("image_id", "filename", "category", "path", "size_kb")

# --- unified views ---

ALL_REVIEWS = _strings(
    "review_id", "review_text", "rating", "timestamp", "source", "category", "data_source"
)
ALL_IMAGES = _strings(
    "image_id", "filename", "category", "timestamp", "source", "size_kb", "data_source"
)

# --- topic messages ---

ARTICLE = StructType(
    [
        StructField("id", StringType()),
        StructField("title", StringType()),
        StructField("content", StringType()),
        StructField("url", StringType()),
        StructField("source", StringType()),
        StructField("category", StringType()),
        StructField("timestamp", StringType()),
        StructField("scraped_at", StringType()),
        StructField("word_count", IntegerType()),
        StructField("data_type", StringType()),
        StructField("upvotes", IntegerType()),
        StructField("comments", IntegerType()),
        StructField("tags", ArrayType(StringType())),
        StructField("published", StringType()),
        StructField("kafka_topic", StringType()),
        StructField("sent_to_kafka_at", StringType()),
    ]
)
IMAGE_EVENT = StructType(
    [
        StructField("id", StringType()),
        StructField("title", StringType()),
        StructField("image_url", StringType()),
        StructField("thumbnail_url", StringType()),
        StructField("source", StringType()),
        StructField("category", StringType()),
        StructField("upvotes", IntegerType()),
        StructField("comments", IntegerType()),
        StructField("timestamp", StringType()),
        StructField("scraped_at", StringType()),
        StructField("subreddit", StringType()),
        StructField("author", StringType()),
        StructField("data_type", StringType()),
        StructField("kafka_topic", StringType()),
        StructField("sent_to_kafka_at", StringType()),
    ]
)

# One schema wide enough for both topics, so that a mixed topic is decoded in one pass.
MESSAGE = StructType(
    ARTICLE.fields + [f for f in IMAGE_EVENT.fields if f.name not in ARTICLE.names]
)

# --- landed feed payloads ---

RSS_ITEM = StructType(
    [
        StructField("title", StringType()),
        StructField("link", StringType()),
        StructField("description", StringType()),
        StructField("summary", StringType()),
        StructField("content:encoded", StringType()),
        StructField("category", ArrayType(StringType())),
        StructField("pubDate", StringType()),
    ]
)
# An item of an RDF feed has Dublin Core fields in place of some of RSS.
RDF_ITEM = StructType(
    RSS_ITEM.fields
    + [
        StructField("dc:subject", ArrayType(StringType())),
        StructField("dc:date", StringType()),
    ]
)
ATOM_ENTRY = StructType(
    [
        StructField("id", StringType()),
        StructField("title", StringType()),
        StructField(
            "link",
            ArrayType(
                StructType([StructField("_href", StringType()), StructField("_rel", StringType())])
            ),
        ),
        StructField("summary", StringType()),
        StructField("content", StringType()),
        StructField("category", ArrayType(StructType([StructField("_term", StringType())]))),
        StructField("published", StringType()),
        StructField("updated", StringType()),
    ]
)
# What the three dialects have below their root elements.
FEED = StructType(
    [
        StructField("channel", StructType([StructField("item", ArrayType(RSS_ITEM))])),
        StructField("item", ArrayType(RDF_ITEM)),
        StructField("entry", ArrayType(ATOM_ENTRY)),
        StructField(CORRUPT, StringType()),
    ]
)
LISTING_POST = StructType(
    [
        StructField("id", StringType()),
        StructField("title", StringType()),
        StructField("selftext", StringType()),
        StructField("permalink", StringType()),
        StructField("ups", IntegerType()),
        StructField("num_comments", IntegerType()),
        StructField("url", StringType()),
        StructField("thumbnail", StringType()),
        StructField("author", StringType()),
    ]
)
LISTING = StructType(
    [
        StructField(
            "data",
            StructType(
                [
                    StructField(
                        "children",
                        ArrayType(StructType([StructField("data", LISTING_POST)])),
                    )
                ]
            ),
        ),
        StructField(CORRUPT, StringType()),
    ]
)

# --- pipeline tables ---

NEWS = _strings("id", "title", "timestamp", "source")
NEWS_PREPROCESSED = StructType(
    NEWS.fields
    + [
        StructField("title_original", StringType()),
        StructField("title_cleaned", StringType()),
        StructField("word_count", IntegerType()),
        StructField("title_length", IntegerType()),
        StructField("processed_time", TimestampType()),
        StructField("data_type", StringType()),
        StructField("ready_for_ia", BooleanType()),
    ]
)
API_QUEUE = StructType(
    [
        StructField("id", StringType()),
        StructField("data_type", StringType()),
        StructField("content", StringType()),
        StructField(
            "metadata",
            StructType(
                [
                    StructField("source", StringType()),
                    StructField("title_original", StringType()),
                    StructField("word_count", IntegerType()),
                    StructField("processed_time", TimestampType()),
                ]
            ),
        ),
    ]
)
IA_RESULTS = StructType(
    [
        StructField("original_id", StringType()),
        StructField("analysis_type", StringType()),
        StructField("result", StringType()),
        StructField("confidence", DoubleType()),
        StructField("processed_at", StringType()),
    ]
)
SCORED = StructType(
    IA_RESULTS.fields
    + [StructField("status", StringType()), StructField("error", StringType())]
)

# Shape of the JSON kept in ``ia_results.result``.
ANALYSIS = StructType(
    [
        StructField(
            "sentiment",
            StructType(
                [StructField("label", StringType()), StructField("confidence", DoubleType())]
            ),
        ),
        StructField("classification", StructType([StructField("category", StringType())])),
        StructField(
            "object_detection", StructType([StructField("objects_count", IntegerType())])
        ),
    ]
)
DETECTIONS = ArrayType(
    StructType(
        [
            StructField("class", IntegerType()),
            StructField("confidence", DoubleType()),
            StructField("bbox", ArrayType(ArrayType(DoubleType()))),
        ]
    )
)
METRIC_SUMMARY = _strings("metric", "value")
