"""Feeds, listings, topics and the article events made from them."""

import json

import pytest
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators import articles, limits
from tidemark.plans import jobs, live
from tidemark.sources import feeds, topics


def seen():
    return F.lit("2025-06-24T12:00:00")


RSS = """<?xml version="1.0"?>
<rss version="2.0" xmlns:content="http://purl.org/rss/1.0/modules/content/"><channel>
<title>Feed</title>
<item><title>Big &amp;amp; bold title</title><link>https://e.org/1</link>
  <description><![CDATA[<p>Said <b>so</b> at https://e.org/x now</p>]]></description>
  <category>a</category><category>b</category><category>c</category><category>d</category>
  <pubDate>Mon, 23 Jun 2025</pubDate></item>
<item><title>Second</title><link>https://e.org/2</link><description>short</description>
  <content:encoded><![CDATA[<p>%s</p>]]></content:encoded></item>
</channel></rss>""" % ("word " * 150)


@pytest.fixture(scope="module")
def items(spark):
    payloads = spark.createDataFrame(
        [("hackernews", RSS), ("broken", "<rss><channel><item>")], "source string, payload string"
    )
    return feeds.rss_items(payloads).orderBy("position").cache()


def test_rss_items(items):
    first, second = items.collect()
    assert (first.source, first.position, first.link) == ("hackernews", 0, "https://e.org/1")
    assert first.title == "Big &amp; bold title"
    assert first.tags == ["a", "b", "c", "d"]
    assert (second.description, second.tags, second.published) == ("short", None, None)


def test_broken_feed_is_kept_apart(spark):
    payloads = spark.createDataFrame(
        [("good", RSS), ("bad", "<rss><channel><item>")], "source string, payload string"
    )
    bad = feeds.corrupt_payloads(feeds.decode_rss(payloads)).collect()
    assert [r.source for r in bad] == ["bad"]
    listings = spark.createDataFrame(
        [("good", '{"data": {"children": []}}'), ("bad", "{oops")],
        "source string, payload string",
    )
    bad = feeds.corrupt_payloads(feeds.decode_listing(listings)).collect()
    assert [r.source for r in bad] == ["bad"]


def test_payload_files(spark, tmp_path):
    (tmp_path / "hackernews").mkdir()
    (tmp_path / "hackernews" / "1.xml").write_text(RSS)
    payloads = feeds.read_payloads(spark, str(tmp_path), "*.xml")
    assert [tuple(r) for r in payloads.collect()] == [("hackernews", RSS)]
    assert feeds.rss_items(payloads).count() == 2


def test_short_title_articles(items):
    first = articles.short_title_articles(items, seen_at=seen()).first()
    assert (first.title, first.content) == ("Big & bold title", "Said so at  now")
    assert (first.word_count, first.source, first.category) == (4, "hackernews", "technology")
    assert first.id.startswith("hn_")
    assert first.timestamp == first.scraped_at == "2025-06-24T12:00:00"


def test_news_articles(items):
    first, second = articles.news_articles(items, seen_at=seen()).collect()
    assert (first.word_count, first.published) == (8, "Mon, 23 Jun 2025")
    assert (second.word_count, second.published) == (2, "")


def test_long_content_articles(items):
    first, second = articles.long_content_articles(items, seen_at=seen()).collect()
    assert first.tags == ["a", "b", "c"] and second.tags == []
    assert first.content == "Said so at  now"
    assert len(second.content) == 503 and second.content.endswith("...")
    assert second.word_count == 151


def test_aggregated_articles(items):
    tagged = items.withColumn("feed_url", F.lit("https://www.rss.site.org/feed"))
    first, second = articles.aggregated_articles(tagged, seen_at=seen()).collect()
    assert (first.source, first.category) == ("rss.site.org", "technology")
    assert second.category == "general"
    assert first.id.startswith("rss.site.org_")


def test_listing(spark):
    def post(**fields):
        return {"data": fields}

    payload = json.dumps(
        {
            "data": {
                "children": [
                    post(id="1", title="Only title", selftext="", permalink="/r/1", ups=3),
                    post(id="2", title="T", selftext="a body", num_comments=2),
                    post(id="3", title="", selftext=""),
                    post(id="4", title="My Mountain car", url="https://i.e.org/p.png", ups=9),
                    post(id="5", title="x", url="https://i.e.org/p.png?s=1"),
                ]
            }
        }
    )
    payloads = spark.createDataFrame([("tech", payload)], "subreddit string, payload string")
    posts = feeds.listing_posts(payloads)
    made = {r.id: r for r in articles.listing_articles(posts, seen_at=seen()).collect()}
    assert set(made) == {"reddit_1", "reddit_2", "reddit_4", "reddit_5"}
    first, second = made["reddit_1"], made["reddit_2"]
    assert (first.content, first.word_count, first.upvotes) == ("Only title", 2, 3)
    assert (first.comments, first.url) == (0, "https://reddit.com/r/1")
    assert (second.content, second.word_count, second.comments) == ("a body", 3, 2)
    assert second.url == "https://reddit.com"

    (image,) = articles.image_events(posts, seen_at=seen()).collect()
    assert (image.id, image.source, image.category) == (
        "reddit_img_4",
        "reddit_tech",
        "nature",
    )
    assert (image.thumbnail_url, image.author, image.upvotes) == ("", "unknown", 9)
    assert set(image.asDict()) < set(schemas.IMAGE_EVENT.names)


def test_cycle(spark, items):
    cycle = articles.collect_cycle(
        articles.short_title_articles(items), articles.long_content_articles(items)
    )
    assert {r.source: r.n for r in live.articles_by_source(cycle).collect()} == {
        "hackernews": 2,
        "techcrunch": 2,
    }
    assert set(cycle.columns) < set(schemas.ARTICLE.names)


def test_first_per_source(spark):
    frame = spark.range(0, 3000, numPartitions=6).selectExpr(
        "id", "CASE WHEN id < 2000 THEN 'hot' WHEN id < 2990 THEN 'warm' ELSE 'cold' END source"
    )
    caps = {"hot": 15, "warm": 8}
    kept = limits.first_per_source(frame, "id", caps, 5)
    assert {r.source: (r.n, r.last) for r in kept.groupBy("source").agg(
        F.count("*").alias("n"), F.max("id").alias("last")).collect()} == {
        "hot": (15, 14),
        "warm": (8, 2007),
        "cold": (5, 2994),
    }
    assert limits.first_per_source(frame, "id", {}, 2).count() == 6
    # Beyond Spark's own bound the salted ranking gives the same rows.
    large = limits.first_per_source(frame, "id", {"warm": 3}, 1500)
    assert {r.source: (r.n, r.last) for r in large.groupBy("source").agg(
        F.count("*").alias("n"), F.max("id").alias("last")).collect()} == {
        "hot": (1500, 1499),
        "warm": (3, 2002),
        "cold": (10, 2999),
    }


def test_latest_and_top(spark):
    frame = spark.createDataFrame(
        [("a", "2"), ("b", "3"), ("c", None), ("d", "3")], "id string, at string"
    )
    assert [r.id for r in limits.latest(frame, "at", 3, "id").collect()] == ["b", "d", "a"]
    top = limits.top_keys(frame, "at", 2).collect()
    assert [tuple(r) for r in top] == [("3", 2), ("2", 1)]


def test_topic_encoding(spark):
    article = spark.createDataFrame(
        [("1", "Émile", ["x"], None)],
        "id string, title string, tags array<string>, upvotes int",
    )
    record = topics.encode(article, topics.TEXT_TOPIC, seen()).first()
    assert (record.topic, record.key) == ("text-topic", "1")
    assert json.loads(record.value) == {
        "id": "1",
        "title": "Émile",
        "tags": ["x"],
        "kafka_topic": "text-topic",
        "sent_to_kafka_at": "2025-06-24T12:00:00",
    }
    assert "É" in record.value


def test_topic_decoding(spark):
    records = spark.createDataFrame(
        [
            ("text-topic", b"1", b'{"id": "1", "word_count": 3, "extra": true}', 0, 5),
            ("images-topic", b"2", b'{"id": "2", "author": "me"}', 0, 6),
            ("text-topic", None, b"not json", 0, 7),
        ],
        "topic string, key binary, value binary, partition int, offset bigint",
    )
    good, bad = topics.split_corrupt(topics.decode(records))
    rows = good.orderBy("offset").collect()
    assert [(r.key, r.word_count, r.author) for r in rows] == [("1", 3, None), ("2", None, "me")]
    assert [(r.topic, r[schemas.CORRUPT]) for r in bad.collect()] == [("text-topic", "not json")]


def test_newest_messages(spark):
    records = spark.range(200).selectExpr(
        "'t' topic", "0 partition", "id offset", "timestamp_seconds(id) timestamp"
    )
    newest = topics.newest_messages(records).collect()
    assert [r.offset for r in newest] == list(range(199, 149, -1))


@pytest.mark.parametrize(
    "connect",
    [
        lambda spark: topics.read_topics(spark, "localhost:9"),
        lambda spark: topics.stream_topics(spark, "localhost:9", per_trigger=50),
        lambda spark: topics.send(spark.range(1), "localhost:9", topics.TEXT_TOPIC),
    ],
)
def test_kafka_needs_its_connector(spark, connect):
    with pytest.raises(Exception, match="kafka"):
        connect(spark)


def test_cycle_of_all_feeds(spark):
    from tidemark.plans import jobs

    many = "".join(
        f"<item><title>Title {i}</title><link>https://e.org/{i}</link>"
        f"<description>About software {i}</description></item>"
        for i in range(40)
    )
    feed = f"<rss><channel>{many}</channel></rss>"
    rss = spark.createDataFrame(
        [
            ("hackernews", "https://n.org/rss", feed),
            ("bbc_technology", "https://b.org/rss", feed),
            ("techcrunch", "https://t.org/rss", feed),
            ("rss.c.org", "https://www.rss.c.org/x.rss", feed),
            ("hackernews", "https://n.org/rss", "<broken"),
        ],
        "source string, feed_url string, payload string",
    )
    children = [
        {"data": {"id": str(i), "title": f"Forest {i}", "url": f"https://i.org/{i}.jpg"}}
        for i in range(30)
    ]
    listing = json.dumps({"data": {"children": children}})
    listings = spark.createDataFrame(
        [("reddit_technology", listing), ("EarthPorn", listing)],
        "source string, payload string",
    )
    whole = jobs.ingest(rss, listings, seen())
    assert {r.source: r.n for r in live.articles_by_source(whole.articles).collect()} == {
        "hackernews": 40,
        "reddit_technology": 30,
        "bbc_technology": 40,
        "techcrunch": 40,
        "rss.c.org": 40,
    }
    texts, images, failures = jobs.ingest(rss, listings, seen(), cap=limits.feed_cap())
    assert [(r.source, r.kind) for r in failures.collect()] == [("hackernews", "rss")]
    assert {r.source: r.n for r in live.articles_by_source(texts).collect()} == {
        "hackernews": 15,
        "reddit_technology": 12,
        "bbc_technology": 10,
        "techcrunch": 8,
        "rss.c.org": 5,
    }
    assert texts.where("source = 'rss.c.org'").first().category == "technology"
    assert {(r.source, r.category) for r in images.collect()} == {("reddit_EarthPorn", "nature")}
    assert images.count() == 30
    records = topics.encode(texts, topics.TEXT_TOPIC, seen())
    decoded, bad = topics.split_corrupt(topics.decode(records))
    assert (decoded.count(), bad.count()) == (50, 0)


ATOM = """<?xml version="1.0" encoding="utf-8"?>
<!-- made by hand <rss> -->
<feed xmlns="http://www.w3.org/2005/Atom">
  <title>own title</title><link href="https://a.example/" rel="self"/>
  <entry><title type="html">First &lt;b&gt;one</title><id>urn:1</id>
    <link href="https://a.example/f.mp3" rel="enclosure"/><link href="https://a.example/1"/>
    <category term="x"/><category term="y"/><summary>short</summary>
    <content type="text">long</content><updated>2024-01-02</updated></entry>
  <entry><title>Second</title><id>urn:2</id><published>2024-01-01</published>
    <updated>2024-01-03</updated></entry>
</feed>"""
RDF = """<rdf:RDF xmlns:rdf="http://www.w3.org/1999/02/22-rdf-syntax-ns#"
  xmlns="http://purl.org/rss/1.0/" xmlns:dc="http://purl.org/dc/elements/1.1/">
  <channel rdf:about="https://r.example/"><title>own title</title></channel>
  <item rdf:about="https://r.example/1"><title>Only</title><link>https://r.example/1</link>
    <description>text</description><dc:subject>x</dc:subject><dc:date>2024-02-03</dc:date></item>
</rdf:RDF>"""


def test_atom_and_rdf_feeds(spark):
    payloads = spark.createDataFrame([("a", ATOM), ("r", RDF)], "source string, payload string")
    items = feeds.rss_items(payloads).orderBy("source", "position").collect()
    fields = ("title", "link", "description", "content", "tags", "published", "dialect")
    assert [tuple(r[f] for f in fields) for r in items] == [
        ("First <b>one", "https://a.example/1", "short", "long", ["x", "y"], "2024-01-02", "atom"),
        ("Second", "urn:2", None, None, None, "2024-01-01", "atom"),
        ("Only", "https://r.example/1", "text", None, ["x"], "2024-02-03", "rdf"),
    ]


@pytest.mark.parametrize(
    ("payload", "problem"),
    [
        (None, "no payload"),
        ("", "no payload"),
        ("<html><body>moved</body></html>", "no feed: html"),
        ("<atom:feed><atom:entry/></atom:feed>", "no feed: atom:feed"),
        ("<rss></rss>", "no channel"),
        ("<rss><channel><item>", "<rss><channel><item>"),
        ("<rss><channel></channel></rss>", None),
        ("<!DOCTYPE rss [<!ENTITY a 'b'>]><rss><channel><title>t</title></channel></rss>", None),
        ("<feed xmlns='http://www.w3.org/2005/Atom'><title>t</title></feed>", None),
        ("<rdf:RDF><channel><title>t</title></channel></rdf:RDF>", None),
    ],
)
def test_what_is_no_feed_is_a_problem(spark, payload, problem):
    frame = spark.createDataFrame([("s", payload)], "source string, payload string")
    assert feeds.decode_rss(frame).first().problem == problem
    assert feeds.rss_items(frame).count() == 0


def test_every_payload_is_read_or_a_failure(spark):
    post = '{"data": {"children": [{"data": {"id": "%s", "title": "t", "url": "https://i/x.jpg"}}]}}'
    names = ["reddit_technology", "board", "", None]
    listings = [(name, post % i) for i, name in enumerate(names)]
    listings += [("board", None), ("board", '{"error": 404}'), (None, "{oops")]
    rss = [(name, f"https://{name}.example/f", text) for name in ("", None, "techcrunch") for text in (RSS, ATOM, RDF)]
    rss += [("x", "https://x.example/f", None), (None, None, "<html/>")]
    cycle = jobs.ingest(
        spark.createDataFrame(rss, "source string, feed_url string, payload string"),
        spark.createDataFrame(listings, "source string, payload string"),
    )
    assert cycle.articles.count() == 3 * (2 + 2 + 1) + 1
    assert sorted((r.id, r.subreddit) for r in cycle.images.collect()) == [
        ("reddit_img_1", "board"),
        ("reddit_img_2", ""),
        ("reddit_img_3", None),
    ]
    reasons = sorted(r.reason for r in cycle.failures.collect())
    assert reasons == ["no feed: html", "no listing", "no payload", "no payload", "{oops"]
