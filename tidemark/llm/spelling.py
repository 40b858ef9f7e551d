"""Spelling variants: words one edit apart, found by two pivotal bigrams of each word."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import once, saved, text_of

MIN_LENGTH, MIN_COUNT = 5, 3
RARER = 2
SLIP = 97
# A maximal run of at least MIN_LENGTH letters; shorter ones give no word.
RUN = "[A-Za-zÀ-ÿ]{%d,}" % MIN_LENGTH
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# Words from this length on also meet by their halves; longer ones have no pivots.
LONG = 64


def spelled(documents: DataFrame) -> DataFrame:
    """One row per long run of letters: ``word``, with one code point left out of every 97th."""
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    runs = documents.select(
        F.concat(key, F.lit(":")).alias("key"),
        F.explode(F.regexp_extract_all(text_of(), F.lit(RUN), F.lit(0))).alias("run"),
    )
    ascii_only = F.octet_length("run") == F.char_length("run")
    lowered = F.when(ascii_only, F.lower("run")).otherwise(
        F.translate(F.col("run"), UPPER, UPPER.lower())
    )
    runs = once(runs.select("key", lowered.alias("low")), "run", F.col("low"))
    runs = once(runs, "crc", F.crc32(F.concat("key", "run").cast("binary")))
    at = (F.col("crc") % F.char_length("run")).cast("int")
    left_out = F.concat(
        F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.char_length("run"))
    )
    return runs.select(F.when(F.col("crc") % SLIP == 0, left_out).otherwise(F.col("run")).alias("word"))


def vocabulary(documents: DataFrame) -> DataFrame:
    """(word, n) of the words that are long and frequent enough, as a written table."""
    words = spelled(documents).where(F.char_length("word") >= MIN_LENGTH)
    counted = words.groupBy("word").agg(F.count("*").alias("n"))
    return saved(counted.where(F.col("n") >= MIN_COUNT), "vocabulary")


def gram_order(words: DataFrame) -> dict[str, int]:
    """Bigrams, rarest first. Words have 90 letters at most, so there are at most 8,100."""
    places = F.sequence(F.lit(1), F.char_length("word") - 1)
    grams = words.select(F.explode(F.transform(places, lambda i: F.substring("word", i, F.lit(2)))))
    rows = grams.groupBy("col").agg(F.count("*").alias("n")).orderBy("n", "col").collect()
    return {row["col"]: rank for rank, row in enumerate(rows)}


def signature(word: str, order: dict[str, int]) -> tuple[int, list[int], list[int]]:
    """(last, pivots, prefix): the rank that ends the prefix, and places of bigrams.

    The prefix holds the three rarest bigrams and all others as rare as the third. The pivots are
    the two bigrams of the prefix that share no letter and are rarest together.
    """
    ranks = [order[word[i : i + 2]] for i in range(len(word) - 1)]
    last = sorted(ranks)[2]
    prefix = [i for i, rank in enumerate(ranks) if rank <= last]
    # By place: the rarest bigram that ends before place i, and the best pair so far.
    single: tuple[int, int] | None = None
    pair: tuple[int, int, int] | None = None
    waiting: list[int] = []
    for i in prefix:
        while waiting and waiting[0] <= i - 2:
            j = waiting.pop(0)
            single = min(single or (ranks[j], j), (ranks[j], j))
        if single is not None:
            pair = min(pair or (single[0] + ranks[i], single[1], i), (single[0] + ranks[i], single[1], i))
        waiting.append(i)
    return last, [pair[1], pair[2]], prefix


def _signatures(order: dict[str, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = batch.column("word").to_pylist()
            rows = [(0, [], []) if len(w) > LONG else signature(w, order) for w in words]
            last, pivots, prefix = zip(*rows, strict=True) if rows else ((), (), ())
            places = pa.list_(pa.int32())
            arrays = [pa.array(last, pa.int32()), pa.array(pivots, places), pa.array(prefix, places)]
            names = [*batch.schema.names, "last", "pivots", "prefix"]
            yield pa.RecordBatch.from_arrays([*batch.columns, *arrays], names)

    return run


def _entry(side: str, part: Column, length: Column) -> Column:
    """What two words meet by: an equal beginning or end, and the length of the index's word."""
    return F.xxhash64(F.lit(side), part, length)


def _sides(place: Column, lengths: list[Column]) -> Column:
    """Entries of the bigram at ``place``: the word up to its end, and the word from its start on.

    A bigram that outlives the edit has it wholly on its left or on its right, so the other side
    is the same in both words; this fixes its position in the other word for every length.
    """
    head = F.substring("word", F.lit(1), place + 2)
    tail = F.substring("word", place + 1, F.char_length("word"))
    return F.array(*[_entry(s, part, n) for n in lengths for s, part in (("<", head), (">", tail))])


def near_pairs(words: DataFrame) -> DataFrame:
    """(a, a_n, b, b_n): every pair of words one edit apart, once, a before b.

    Of two such words take the one whose prefix ends with the rarer bigram. The edit leaves one of
    its pivots whole, since they share no letter, and this bigram is in the other word's prefix,
    at most one place off. So pivots are joined with prefixes, and what meets is verified.
    """
    order = gram_order(words.where(F.char_length("word") <= LONG))
    signed = saved(
        words.mapInArrow(
            _signatures(order),
            "word string, n long, last int, pivots array<int>, prefix array<int>",
        ),
        "signatures",
    )
    length = F.char_length("word")
    lengths = [length - 1, length, length + 1]
    pivots = F.flatten(F.transform("pivots", lambda p: _sides(p, lengths)))
    prefix = F.flatten(F.transform("prefix", lambda p: _sides(p, [length])))
    # Halves: one of them outlives the edit. The index has those of all words it may meet.
    half = F.floor(length / 2).cast("int")
    probes, index = [], []
    for n in lengths:
        probes += [
            _entry("[", F.substring("word", F.lit(1), half), n),
            _entry("]", F.substring("word", half + 1, length), n),
        ]
        other = F.floor(n / 2).cast("int")
        rest = n - other
        index += [
            _entry("[", F.substring("word", F.lit(1), other), length),
            _entry("]", F.substring("word", length - rest + 1, rest), length),
        ]
    is_long = length >= LONG
    probe = F.concat(pivots, F.when(is_long, F.array(*probes)).otherwise(F.array()))
    entry = F.concat(prefix, F.when(is_long, F.array(*index)).otherwise(F.array()))
    asking = signed.select(
        F.explode(F.array_distinct(probe)).alias("key"),
        F.col("word").alias("a"),
        F.col("n").alias("a_n"),
        F.col("last").alias("a_last"),
    )
    held = signed.select(
        F.explode(F.array_distinct(entry)).alias("key"),
        F.col("word").alias("b"),
        F.col("n").alias("b_n"),
        F.col("last").alias("b_last"),
    )
    met = asking.join(held, "key").where("a_last <= b_last AND a <> b")
    met = met.where(F.levenshtein("a", "b", 1) == 1)
    first = F.struct(F.col("a").alias("word"), F.col("a_n").alias("n"))
    second = F.struct(F.col("b").alias("word"), F.col("b_n").alias("n"))
    pairs = met.select(F.least(first, second).alias("x"), F.greatest(first, second).alias("y"))
    pairs = pairs.select(
        F.col("x.word").alias("a"),
        F.col("x.n").alias("a_n"),
        F.col("y.word").alias("b"),
        F.col("y.n").alias("b_n"),
    )
    return saved(pairs.distinct(), "near-pairs")


def last_forms(forms: DataFrame) -> DataFrame:
    """(word, root): where the chain of ``form`` ends, for each word that has one.

    Every form is twice as frequent, so a chain has at most 63 steps; each round halves them.
    """
    links = saved(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        further = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        joined = links.join(further, "root", "left")
        if joined.where("next IS NOT NULL").isEmpty():
            return links
        links = saved(joined.select("word", F.coalesce("next", "root").alias("root")), "roots")


def variants(documents: DataFrame) -> DataFrame:
    """word, form, root, n, n_near and form_n of every word of the corpus.

    A word is a run of letters, A-Z lower-cased, with slips: where the crc32 of ``doc_id:run`` is
    divisible by 97, the code point at that crc modulo the length is left out. Words of at least 5
    code points that occur at least 3 times count. Words one inserted, deleted or replaced code
    point apart are near. The most frequent near word (of equals the smallest) is a word's form if
    it is at least twice as frequent; the root is where the chain of forms ends.

    NULL and empty texts have no words; a NULL doc_id reads as ``null``. Repeated rows count as
    often as they are listed. Texts of any length are split whole, and runs of any length are
    words. Other columns are not read. An empty table gives no rows.
    """
    words = vocabulary(documents)
    pairs = near_pairs(words)
    back = pairs.select(
        F.col("b").alias("a"), F.col("b_n").alias("a_n"), F.col("a").alias("b"), F.col("a_n").alias("b_n")
    )
    best = F.min(F.struct((-F.col("b_n")).alias("minus"), "b")).alias("best")
    near = pairs.unionByName(back).groupBy("a", "a_n").agg(F.count("*").alias("n_near"), best)
    frequent = -F.col("best.minus") >= RARER * F.col("a_n")
    near = saved(
        near.select(
            F.col("a").alias("word"),
            "n_near",
            F.when(frequent, F.col("best.b")).alias("form"),
            F.when(frequent, -F.col("best.minus")).alias("form_n"),
        ),
        "near",
    )
    roots = last_forms(near.where("form IS NOT NULL"))
    result = words.join(near, "word", "left").join(roots, "word", "left")
    return result.select(
        "word",
        "form",
        F.coalesce("root", "word").alias("root"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        "form_n",
    )
