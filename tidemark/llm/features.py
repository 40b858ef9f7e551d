"""Dense features of texts, and the bounded samples that models are fitted on."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import words
from tidemark.llm.common import saved

# Second-person words, folded.
SECOND_PERSON = (
    "you your yours yourself youre u ur "
    "du dich dir dein deine ihr euch euer "
    "tu te toi ton ta vous votre vos "
    "tú ti usted ustedes vosotros"
).split()
NEAR = 5
# Salts of the kinds of lexicon entries: whole words, and their first 4 and 5 bytes.
PREFIXES = (0, 4, 5)

SHAPE = [
    "log_words",
    "word_bytes",
    "capitals",
    "punctuation",
    "exclamation",
    "pipes",
    "symbols",
    "digits",
    "newlines",
    "other_bytes",
    "repeated_words",
    "distinct_words",
    "odd_words",
    "second_person",
    "masked_letters",
]
LEXICAL = ["hits", "weighted_hits", "heaviest_hit", "prefix_hits", "near_second_person", "log_hits"]


def _flags(characters: str) -> np.ndarray:
    table = np.zeros(256, dtype=np.uint8)
    table[[ord(c) for c in characters]] = 1
    return table


_CLASSES = {
    "capitals": _flags("ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    "punctuation": _flags(".,;:!?'\"()-"),
    "exclamation": _flags("!?"),
    "pipes": _flags("|"),
    "symbols": _flags("#*$%&<>=@^~_+{}[]\\/"),
    "digits": _flags("0123456789"),
    "newlines": _flags("\n"),
    "other_bytes": np.repeat(np.array([0, 1], dtype=np.uint8), 128),
}
_LETTERS = _flags("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")


def term_hashes(
    folded: np.ndarray, starts: np.ndarray, ends: np.ndarray
) -> dict[int, np.ndarray]:
    """Hashes of every word and of its first bytes, told apart by kind."""
    sums = words.prefix_hashes(folded)
    out = {}
    for kind in PREFIXES:
        stops = ends if not kind else np.minimum(ends, starts + kind)
        hashed = words.span_hashes(sums, starts, stops)
        out[kind] = words.mixed(hashed + np.uint64(kind))
    return out


def _second_person() -> np.ndarray:
    texts = pa.array(SECOND_PERSON)
    _, _, data, offsets = next(words.chunks(texts))
    folded, starts, ends, _ = words.words(data, offsets, words.TERMS)
    return np.sort(term_hashes(folded, starts, ends)[0])


def _found(values: np.ndarray, ordered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each value is in ``ordered``, and where."""
    if not len(ordered):
        return np.zeros(len(values), bool), np.zeros(len(values), np.int64)
    at = np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)
    return ordered[at] == values, at


def text_features(
    data: np.ndarray, offsets: np.ndarray, lexicon: tuple[np.ndarray, np.ndarray] | None = None
) -> np.ndarray:
    """One row of SHAPE (and LEXICAL) figures per text. An empty text gives a row of zeros.

    ``lexicon`` holds sorted term hashes and their weights.
    """
    size = len(offsets) - 1
    folded, starts, ends, owner = words.words(data, offsets, words.TERMS)
    n_words = np.bincount(owner, minlength=size).astype(float)
    n_bytes = np.diff(offsets).astype(float)
    per_byte, per_word = np.maximum(n_bytes, 1), np.maximum(n_words, 1)
    terms = term_hashes(folded, starts, ends)
    word = terms[0]
    same_text = np.zeros(len(word), bool)
    same_text[1:] = owner[1:] == owner[:-1]
    repeated = np.zeros(len(word), bool)
    repeated[1:] = (word[1:] == word[:-1]) & same_text[1:]
    order = np.lexsort((word, owner))
    first = np.ones(len(word), bool)
    first[1:] = (word[order][1:] != word[order][:-1]) | (owner[order][1:] != owner[order][:-1])
    digit = words.sums_by_text(_CLASSES["digits"][data], np.append(starts, len(data)))
    letters = ends - starts - digit[: len(starts)] if len(starts) else np.empty(0)
    odd = (digit > 0) & (letters > 0) if len(starts) else np.empty(0, bool)
    person, _ = _found(word, _SECOND_PERSON)
    columns = [np.log1p(n_words), words.counts(ends - starts, owner, size) / per_word]
    columns += [words.sums_by_text(table[data], offsets) / per_byte for table in _CLASSES.values()]
    columns += [
        words.counts(repeated, owner, size) / per_word,
        np.bincount(owner[order][first], minlength=size) / per_word,
        words.counts(odd, owner, size) / per_word,
        words.counts(person, owner, size) / per_word,
        words.sums_by_text(_masked(data), offsets) / per_byte,
    ]
    if lexicon is not None:
        columns += _lexical(terms, owner, person, per_word, size, lexicon)
    return np.column_stack(columns)


def _masked(data: np.ndarray) -> np.ndarray:
    """Bytes that are symbols between two letters, as in a word spelled around a filter."""
    letter = _LETTERS[data]
    masked = np.zeros(len(data), np.uint8)
    if len(data) > 2:
        masked[1:-1] = letter[:-2] & letter[2:] & _CLASSES["symbols"][data[1:-1]]
    return masked


def _lexical(terms, owner, person, per_word, size, lexicon):
    keys, weights = lexicon
    hit, at = _found(terms[0], keys)
    weight = np.where(hit, weights[at] if len(weights) else 0.0, 0.0)
    prefix = np.zeros(len(owner), bool)
    best = weight.copy()
    for kind in PREFIXES[1:]:
        found, place = _found(terms[kind], keys)
        prefix |= found
        best = np.maximum(best, np.where(found, weights[place] if len(weights) else 0.0, 0.0))
    any_hit = hit | prefix
    # Hits with a second-person word of the same text within NEAR words.
    people = np.flatnonzero(person)
    near = np.zeros(len(owner), bool)
    if len(people):
        index = np.arange(len(owner))
        right = np.searchsorted(people, index)
        for side in (np.minimum(right, len(people) - 1), np.maximum(right - 1, 0)):
            other = people[side]
            near |= (np.abs(other - index) <= NEAR) & (owner[other] == owner)
    heaviest = np.zeros(size)
    np.maximum.at(heaviest, owner[any_hit], best[any_hit])
    return [
        words.counts(hit, owner, size) / per_word,
        words.counts(best, owner, size) / per_word,
        heaviest,
        words.counts(prefix, owner, size) / per_word,
        words.counts(any_hit & near, owner, size) / per_word,
        np.log1p(words.counts(any_hit, owner, size)),
    ]


_SECOND_PERSON = _second_person()


def by_text(
    frame: DataFrame, keep: list[str], compute: Callable[[np.ndarray, np.ndarray], np.ndarray]
) -> DataFrame:
    """Columns ``keep`` and ``features`` (array of double) of every row's ``text``."""
    schema = frame.select(*keep, F.lit(None).cast("array<double>").alias("features")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = [n for n in batch.schema.names if n != "text"]
            for first, last, data, offsets in words.chunks(batch.column("text")):
                matrix = compute(data, offsets)
                flat = pa.array(matrix.ravel())
                ends = np.arange(len(matrix) + 1, dtype=np.int32) * matrix.shape[1]
                lists = pa.ListArray.from_arrays(pa.array(ends), flat)
                part = batch.slice(first, last - first)
                yield pa.RecordBatch.from_arrays(
                    [part.column(n) for n in names] + [lists], [*names, "features"]
                )

    return frame.select(*keep, "text").mapInArrow(run, schema)


def crc_part(modulus: int) -> Column:
    """crc32 of the doc_id as text, modulo; NULL ids count as the text 'null'."""
    as_text = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    return (F.crc32(as_text.cast("binary")) % modulus).cast("int")


def bounded_sample(rows: DataFrame, most: int) -> DataFrame:
    """At most ``most`` rows, by the smallest hash of doc_id; the same rows on every run."""
    return rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)


def with_texts(sample: DataFrame, documents: DataFrame, name: str) -> DataFrame:
    """The sampled rows with their texts, written once.

    The sample's size is bounded by its parameter, so it is broadcast and no text is shuffled.
    """
    texts = documents.select("doc_id", "text")
    return saved(texts.join(F.broadcast(sample), "doc_id"), name)
