"""Text functions against Python's own rules."""

import random
import re

import pytest
from pyspark.sql import functions as F

from tidemark.functions import casts, categories, text

# Letters, digits, marks, URLs and every kind of whitespace, joined at random.
PIECES = [
    *["a", "B", "7", "_", "-", ".", "...", "!", "'", '"', "&", "<b>", " ", "  ", "\t", "\n"],
    *["é", "Ü", "ß", "İ", "Σ", "é", "日本", "Ⅷ"],
    *["½", "²", "٣", "\U0001f600", "​", "﻿", "᠎"],
    *["http", "http://x.y/z?q=1", "https://é.org/a", "HTTP://Q"],
    *["www.", "www.site.org", "WWW.SITE.ORG", "wwwx"],
    *["\r\n", "\x0b", "\x0c", "\x1c", "\x1d", "\x1e", "\x1f", "\x85", "\xa0"],
    *[" ", " ", " ", " ", " ", " ", "　"],
]


@pytest.fixture(scope="module")
def samples():
    pick = random.Random(7)
    made = ["".join(pick.choices(PIECES, k=pick.randint(1, 14))) for _ in range(1500)]
    return ["", " ", *PIECES, *made]


def drop(pattern, value):
    return re.compile(pattern).sub("", value)


def py_ascii(value):
    kept = drop(r"[^a-zA-Z0-9\s]", drop(r"http\S+", value))
    return " ".join(kept.split()).lower()


def py_words(value):
    return " ".join(re.findall(r"\w+", drop(r"http\S+|www\.\S+", value))).lower()


def py_dots(value):
    return " ".join(re.findall(r"[\w.]+", drop(r"http\S+|www\.\S+", value))).lower()


def py_plain(value):
    return drop(r"http\S+|www\.\S+", re.compile(r"\s+").sub(" ", value)).strip()


@pytest.mark.parametrize(
    "ours, theirs",
    [
        (text.clean_ascii, py_ascii),
        (text.clean_words, py_words),
        (text.clean_keep_dots, py_dots),
        (text.clean_plain, py_plain),
        (text.word_count, lambda value: len(value.split())),
        (text.tokenize, str.split),
        (text.collapse_spaces, lambda value: " ".join(value.split())),
    ],
    ids=["ascii", "words", "dots", "plain", "word_count", "tokenize", "collapse"],
)
def test_same_as_python(column, samples, ours, theirs):
    found = column(ours("t"), samples)
    wrong = [(s, a, theirs(s)) for s, a in zip(samples, found) if a != theirs(s)]
    assert wrong == []


def test_null_text_is_empty(column):
    for cleaner in (text.clean_ascii, text.clean_words, text.clean_keep_dots, text.clean_plain):
        assert column(cleaner("t"), [None]) == [""]
    assert column(text.tokenize("t"), [None]) == [[]]
    assert column(text.word_count("t"), [None]) == [0]


def test_ascii_cleaning_merges_words(column):
    assert column(text.clean_ascii("t"), ["it's a well-known www.x.org"]) == [
        "its a wellknown wwwxorg"
    ]


def test_spaced_word_count_matches_tokens(column, samples):
    cleaned = text.clean_words("t")
    assert column(text.spaced_word_count(cleaned), samples) == [
        len(py_words(value).split()) for value in samples
    ]


def test_cuts(column):
    assert column(text.truncate("t", 3), ["abc", "abcd", None]) == ["abc", "abc...", None]
    assert column(text.preview("t", 3, "Untitled"), ["ab", "abcd", None]) == [
        "ab...",
        "abc...",
        "Unt...",
    ]
    assert column(text.strip_quotes("t"), ['"a"b"', "c"]) == ['a"b', "c"]


def test_hosts_and_ids(column):
    urls = ["https://www.a.org/x", "http://b.www.c:80", "//d", "nothing", None]
    assert column(text.host("t"), urls) == ["a.org", "b.c:80", "d", None, None]
    first, again, other = column(text.stable_id("hn_", "t"), ["u", "u", "v"])
    assert first == again != other
    assert re.fullmatch("hn_[0-9a-f]{64}", first)


def test_image_links(column):
    links = ["a.jpg", "a.jpeg", "a.png", "a.gif", "a.JPG", "a.jpg?x=1", "a.bmp", "", None]
    assert column(text.is_image_link("t"), links) == [True] * 4 + [False] * 5


def test_base64_is_one_line(column):
    import base64

    values = [bytes(range(200)), b"", b"x"]
    assert column(text.base64_line("t"), values, "binary") == [
        base64.b64encode(value).decode() for value in values
    ]


def test_categories(column):
    contents = [
        "He SAID so",
        "the market for movies",
        "a Study of games",
        "music and football",
        "basketball",
        "new treatment",
        "nothing here",
        "",
    ]
    assert column(categories.categorize_content("t"), contents) == [
        "technology",
        "business",
        "science",
        "entertainment",
        "sports",
        "health",
        "general",
        "general",
    ]
    titles = ["Mountain city", "Robot car", "Urban transport", "Scary", "dog"]
    assert column(categories.categorize_image("t"), titles) == [
        "nature",
        "technology",
        "urban",
        "vehicles",
        "general",
    ]


def test_every_keyword_is_found(column):
    for rules, categorize in (
        (categories.ARTICLE_KEYWORDS, categories.categorize_content),
        (categories.IMAGE_KEYWORDS, categories.categorize_image),
    ):
        words = [word for group in rules.values() for word in group]

        def expected(word):
            return next(name for name, group in rules.items() if any(w in word for w in group))

        assert column(categorize("t"), words) == [expected(word) for word in words]


def test_lenient_numbers(column):
    values = ["5", "4.7", " 3 ", "x", "", None, "1e1", "NaN"]
    assert column(casts.to_int("t"), values) == [5, 4, 3, None, None, None, 10, None]
    assert column(casts.to_double("t"), values[:6]) == [5.0, 4.7, 3.0, None, None, None]


def test_iso_times(column):
    values = [
        "2025-01-15T10:00:00Z",
        "2025-01-15 10:00:00.123456",
        "2025-01-15",
        "2025-01-15T10:00:00+02:00",
        "2025",
        "2025-13-01",
        "Unknown",
        "",
        None,
    ]
    found = column(casts.parse_iso("t").cast("string"), values)
    assert found == [
        "2025-01-15 10:00:00",
        "2025-01-15 10:00:00.123456",
        "2025-01-15 00:00:00",
    ] + [None] * 6


def test_adaptive_columns(spark):
    scored = spark.createDataFrame([("5", "1")], "Score string, rating string")
    rated = spark.createDataFrame([("x", "a")], "rating string, DataSource string")
    bare = spark.createDataFrame([("x",)], "other string")
    rows = [f.select(casts.rating_column(f)).first()[0] for f in (scored, rated, bare)]
    assert rows == [5.0, None, 0.0]
    assert [casts.source_column(f) for f in (scored, rated)] == [None, "DataSource"]
    assert casts.present_columns(scored, ["Id", "Score"]) == ["Score"]
    assert casts.present_columns(bare, ["Id", "Score"]) == ["other"]


def test_long_text_is_processed_whole(column):
    long = "word " * 50_000 + "end http://u.v/w"
    assert column(F.length(text.clean_words("t")), [long]) == [5 * 50_000 + 3]
