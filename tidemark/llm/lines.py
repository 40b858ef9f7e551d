"""Removal of lines that many documents repeat."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import SPACE, once, saved, text_of

MIN_CHARS = 40
MIN_DOCUMENTS = 5
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(SPACE)), UPPER, UPPER.lower())


def text_key(text: Column) -> list[Column]:
    """128 bits of hash, which tell the texts of one doc_id apart."""
    return [F.xxhash64(text).alias("t1"), F.xxhash64(F.lit("second"), text).alias("t2")]


def occurrences(documents: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """One row per text and long line: 128 bits of hash of both and the line's position."""
    texts = documents.select("doc_id", *text_key(text_of()), text_of().alias("text"))
    split = F.posexplode(F.split("text", "\n")).alias("at", "line")
    lines = texts.select("doc_id", "t1", "t2", split)
    # An upper bound on the key's length, cheap to test before the key is made.
    lines = lines.where(F.char_length("line") >= min_chars)
    lines = lines.withColumn("key", F.explode(F.array(line_key(F.col("line")))))
    return lines.where(F.char_length("key") >= min_chars).select(
        F.xxhash64("key").alias("h1"),
        F.xxhash64(F.lit("second"), "key").alias("h2"),
        "doc_id",
        "t1",
        "t2",
        "at",
    )


def placed_lines(documents: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """Occurrences ranged and sorted by hash, document and position, as a written table.

    The rows of a frequent line spread over as many partitions as they need, since documents are
    part of the range. ``is_first`` marks the first occurrence in a document.
    """
    runs = Window.partitionBy("h1", "h2", "doc_id").orderBy("at")
    placed = occurrences(documents, min_chars).repartitionByRange("h1", "h2", "doc_id")
    placed = placed.withColumn("is_first", F.row_number().over(runs) == 1)
    return saved(placed, "lines")


def keep_bitmaps(
    documents: DataFrame, min_chars: int = MIN_CHARS, min_documents: int = MIN_DOCUMENTS
) -> DataFrame:
    """The lines to drop, as one compressed bitmap per text of a document that loses any.

    Every partition of the sorted lines reduces its runs to a document count and a largest
    document before the next shuffle, so a frequent line is a few rows there. Lines that reach
    ``min_documents`` join back to their occurrences; Spark splits a skewed key in that join.

    A bitmap is a sorted list of (word, bits): bit ``i`` of word ``w`` is set when line
    ``64 * w + i`` goes. Words without a set bit are left out, and so are documents that keep
    every line.
    """
    placed = placed_lines(documents, min_chars)
    repeated = (
        placed.groupBy("h1", "h2")
        .agg(F.count_if("is_first").alias("n"), F.max("doc_id").alias("keeper"))
        .where(F.col("n") >= min_documents)
    )
    # Written, so that both sides of the join are plain shuffles, whose skew Spark can split.
    dropped = placed.join(saved(repeated, "repeated"), ["h1", "h2"]).where(
        F.col("doc_id").isNull() | (F.col("doc_id") < F.col("keeper"))
    )
    words = dropped.groupBy("doc_id", "t1", "t2", F.expr("CAST(at DIV 64 AS INT)").alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, CAST(at % 64 AS INT))")).alias("bits")
    )
    return words.groupBy("doc_id", "t1", "t2").agg(
        F.array_sort(F.collect_list(F.struct("word", "bits"))).alias("bitmap")
    )


def _positions(bitmap: Column) -> Column:
    """The line numbers whose bits are set."""

    def of_word(word: Column) -> Column:
        set_bits = F.filter(F.sequence(F.lit(0), F.lit(63)), lambda i: F.getbit(word["bits"], i) == 1)
        return F.transform(set_bits, lambda i: word["word"] * 64 + i)

    return F.flatten(F.transform(bitmap, of_word))


def drop_lines(
    documents: DataFrame, min_chars: int = MIN_CHARS, min_documents: int = MIN_DOCUMENTS
) -> DataFrame:
    """``documents`` with repeated lines taken out, plus n_lines and n_dropped.

    A line goes if its key has ``min_chars`` code points or more and ``min_documents`` documents
    hold it, except in the largest doc_id that does.

    A NULL or empty text is one empty line. Lines with a shorter key always stay. Rows that share
    a doc_id count as one document, and rows without one count together as one below all others;
    each row loses the lines that go from its own text. A text that loses nothing is passed on as
    it is. All columns stay; an input column called n_lines or n_dropped is replaced.
    An empty table gives no rows.
    """
    bitmaps = keep_bitmaps(documents, min_chars, min_documents)
    rows = documents.select(F.struct("*").alias("row"))
    rows = rows.withColumns({"doc_id": F.col("row.doc_id"), "lines": F.split(text_of("row.text"), "\n")})
    rows = rows.select("*", *text_key(text_of("row.text")))
    bitmaps = bitmaps.select(
        F.col("doc_id").alias("of"), F.col("t1").alias("of1"), F.col("t2").alias("of2"), "bitmap"
    )
    same = F.col("doc_id").eqNullSafe(F.col("of"))
    same &= (F.col("t1") == F.col("of1")) & (F.col("t2") == F.col("of2"))
    joined = rows.join(bitmaps, same, "left")
    changed = F.col("bitmap").isNotNull()
    last = F.size("lines") - 1
    stay = F.array_except(F.sequence(F.lit(0), last), _positions(F.col("bitmap")))
    joined = once(joined, "stay", F.when(changed, stay))
    kept = F.array_join(F.transform("stay", lambda i: F.get("lines", i)), "\n")
    cleaned = F.struct(
        F.when(changed, kept).otherwise(F.col("row.text")).alias("text"),
        F.size("lines").cast("long").alias("n_lines"),
        F.when(changed, F.size("lines") - F.size("stay"))
        .otherwise(0)
        .cast("long")
        .alias("n_dropped"),
    )
    joined = joined.select("row", cleaned.alias("cleaned"))
    own = {"text", "n_lines", "n_dropped"}
    return joined.select(
        *[F.col("row").getField(c).alias(c) for c in documents.columns if c not in own],
        "cleaned.*",
    )
