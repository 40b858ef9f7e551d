"""Text cleaning, counting and shaping, as native column expressions.

Whitespace and word characters follow the Unicode rules of Python's ``re``.  Java's ``\\s``
and ``\\w`` are ASCII-only, so the classes are spelled out.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Character-class bodies (to be put between brackets).
SPACE = r"\s\x1c-\x1f\x85\p{Z}"
WORD = r"\p{L}\p{N}_"

URL_HTTP = rf"http[^{SPACE}]+"
URL_ANY = rf"(?:http|www\.)[^{SPACE}]+"


def _text(value: Column | str) -> Column:
    column = F.col(value) if isinstance(value, str) else value
    return F.coalesce(column, F.lit(""))


def _drop_urls(text: Column, pattern: str, seen: Column | None = None) -> Column:
    """Remove URLs.  A plain substring search on ``seen`` spares URL-free text the regex."""
    seen = text if seen is None else seen
    candidate = seen.contains("http")
    if pattern == URL_ANY:
        candidate = candidate | seen.contains("www.")
    return F.when(candidate, F.regexp_replace(text, pattern, "")).otherwise(text)


def collapse_spaces(value: Column | str) -> Column:
    """Whitespace runs become one space, both ends are stripped."""
    return F.trim(F.regexp_replace(_text(value), f"[{SPACE}]+", " "))


def clean_ascii(value: Column | str) -> Column:
    """Drop URLs, delete everything but ASCII letters, digits and spaces, lower-case.

    Deleted characters leave no gap, so ``it's`` becomes ``its``.
    """
    no_urls = _drop_urls(_text(value), URL_HTTP)
    kept = F.regexp_replace(no_urls, f"[^a-zA-Z0-9{SPACE}]+", "")
    return F.lower(collapse_spaces(kept))


def clean_words(value: Column | str) -> Column:
    """Drop URLs, keep words only, one space apart, lower-case.

    Punctuation turns into a space and space runs collapse; both are one pass here, since
    everything that is not a word character ends up as a single space.
    """
    no_urls = _drop_urls(_text(value), URL_ANY)
    return F.lower(F.trim(F.regexp_replace(no_urls, f"[^{WORD}]+", " ")))


def clean_keep_dots(value: Column | str) -> Column:
    """As :func:`clean_words`, but dots survive."""
    no_urls = _drop_urls(_text(value), URL_ANY)
    return F.lower(F.trim(F.regexp_replace(no_urls, rf"[^{WORD}.]+", " ")))


def clean_plain(value: Column | str) -> Column:
    """Whitespace to single spaces, then drop URLs (their gaps stay), strip the ends.

    The step after tag removal in :func:`tidemark.functions.html.clean_html`.
    """
    text = _text(value)
    spaced = F.regexp_replace(text, f"[{SPACE}]+", " ")
    return F.trim(_drop_urls(spaced, URL_ANY, seen=text))


def tokenize(value: Column | str) -> Column:
    """Whitespace tokens; blank text has none."""
    plain = F.regexp_replace(_text(value), f"[{SPACE}&&[^ ]]", " ")
    return F.array_remove(F.split(plain, " "), "")


def word_count(value: Column | str) -> Column:
    """Number of whitespace tokens."""
    return F.size(tokenize(value))


def plain_word_count(value: Column | str) -> Column:
    """Number of tokens of text whose only whitespace is the space."""
    return F.regexp_count(_text(value), F.lit("[^ ]+"))


def spaced_word_count(value: Column | str) -> Column:
    """Number of tokens of text whose words are exactly one space apart."""
    text = _text(value)
    spaces = F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))
    return F.when(text == "", F.lit(0)).otherwise(spaces + 1)


def truncate(value: Column | str, size: int) -> Column:
    """Cut to ``size`` characters and mark the cut with ``...``; shorter text is untouched."""
    text = F.col(value) if isinstance(value, str) else value
    return F.when(
        F.length(text) > size, F.concat(F.substring(text, 1, size), F.lit("..."))
    ).otherwise(text)


def preview(value: Column | str, size: int, default: str) -> Column:
    """First ``size`` characters, always followed by ``...``."""
    text = F.col(value) if isinstance(value, str) else value
    return F.concat(F.substring(F.coalesce(text, F.lit(default)), 1, size), F.lit("..."))


def strip_quotes(value: Column | str) -> Column:
    """Remove double quotes around a value."""
    return F.btrim(F.col(value) if isinstance(value, str) else value, F.lit('"'))


def stable_id(prefix: Column | str, link: Column | str, *others: str) -> Column:
    """``prefix`` + SHA-256 of the link: the same entry has the same id in every run.

    An entry without a link is named by ``others`` instead, so that no id is NULL.
    """
    head = F.lit(prefix) if isinstance(prefix, str) else prefix
    target = F.col(link) if isinstance(link, str) else link
    if others:
        target = F.coalesce(target, F.concat_ws("\x1f", *others))
    return F.concat(head, F.sha2(target, 256))


def host(url: Column | str) -> Column:
    """Network location of a URL without any ``www.``; NULL when there is no ``//``."""
    target = F.col(url) if isinstance(url, str) else url
    location = F.split_part(F.split_part(target, F.lit("//"), F.lit(2)), F.lit("/"), F.lit(1))
    return F.nullif(F.replace(location, F.lit("www."), F.lit("")), F.lit(""))


def is_image_link(url: Column | str) -> Column:
    """The link ends in one of four image suffixes (case-sensitive, no query string)."""
    target = F.col(url) if isinstance(url, str) else url
    # Accepted suffixes.
    suffixes = (".jpg", ".jpeg", ".png", ".gif")
    found = F.lit(False)
    for suffix in suffixes:
        found = found | target.endswith(suffix)
    return F.coalesce(found, F.lit(False))


def base64_line(content: Column | str) -> Column:
    """Base64 as one line; Spark breaks lines after 76 characters."""
    data = F.col(content) if isinstance(content, str) else content
    return F.replace(F.base64(data), F.lit("\r\n"), F.lit(""))
