"""Search for benchmark items in documents under edit distance."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import walks, words
from tidemark.llm.common import saved

SIMILARITY = 0.8
# Chance to find a copy with all allowed edits where they hurt most; 1 asks for the exact search.
RECALL = 0.9999
# Bits of a bitmap of hashes: 2 MB each, however large the benchmark is.
BITS = 1 << 24
BUCKET = 1 << 15
LONG_ITEM = 10
GRAM = 3
# Cells of the tables of distances that are filled together.
CELLS = 1 << 20
# Starts of possible matches that leave the scan as one window, in units of the longest match.
WINDOW = 2


def allowed(length: int, similarity: float = SIMILARITY) -> int:
    """Most word edits that leave an item of ``length`` words as similar as asked."""
    return int((1 - similarity) * length + 1e-9)


def gram_rule(length: int, similarity: float) -> tuple[int, int]:
    """(gram length, grams shared): what any match of an item of this length must have.

    An edit touches at most q of the grams of q words, so a long item keeps at least
    m - q + 1 - q * d of them. A short one cut into d + 1 pieces keeps a whole piece.
    """
    edits = allowed(length, similarity)
    shared = length - GRAM + 1 - GRAM * edits
    if length >= LONG_ITEM and shared >= 1:
        return GRAM, shared
    return min(length // (edits + 1), GRAM + 1), 1


def seed_rule(length: int, similarity: float) -> tuple[int, int]:
    """(grams, step): of an item's grams at every ``step`` words, so many cannot all be edited.

    ``d`` edits touch at most ``q * d`` overlapping grams, or ``d`` of the pieces of a short item.
    """
    edits = allowed(length, similarity)
    q, shared = gram_rule(length, similarity)
    if length >= LONG_ITEM and length - GRAM + 1 - GRAM * edits >= 1:
        return q * edits + 1, 1
    return edits + 1, length // (edits + 1)


def grams(hashes: np.ndarray, owner: np.ndarray, size: int) -> np.ndarray:
    """Hashes of runs of ``size`` words; 0 where a run would leave its text."""
    out = np.zeros(len(hashes), np.uint64)
    n = len(hashes) - size + 1
    if n <= 0:
        return out
    total = np.zeros(n, np.uint64)
    for i in range(size):
        total = words.mixed(total ^ hashes[i : i + n]) + np.uint64(i + 1)
    out[:n] = np.where(owner[:n] == owner[size - 1 :], total | np.uint64(1), np.uint64(0))
    return out


def _text_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    folded, starts, ends, owner = words.words(data, offsets, words.TERMS)
    return words.span_hashes(words.prefix_hashes(folded), starts, ends), owner


def _item_rows(similarity: float):
    """One row per item: its words, gram and seed rules, and gram hashes by position."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, offsets in words.chunks(batch.column("text")):
                hashes, owner = _text_words(data, offsets)
                bounds = np.searchsorted(owner, np.arange(last - first + 1))
                rows = []
                for i in range(last - first):
                    own = hashes[bounds[i] : bounds[i + 1]]
                    if not len(own):
                        continue
                    q, shared = gram_rule(len(own), similarity)
                    n_seeds, step = seed_rule(len(own), similarity)
                    item_grams = grams(own, np.zeros(len(own)), q)[: len(own) - q + 1]
                    rows.append(
                        (
                            batch.column("item_id")[first + i].as_py(),
                            len(own) + allowed(len(own), similarity), q, shared, n_seeds, step,
                            own.view(np.int64), item_grams.view(np.int64),
                        )
                    )
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _ITEM_TYPES, strict=True)],
                        _ITEM_NAMES,
                    )

    return run


_LIST = pa.list_(pa.int64())
_ITEM_NAMES = ["item_id", "reach", "q", "shared", "n_seeds", "step", "words", "grams"]
_ITEM_TYPES = [pa.int64(), *[pa.int32()] * 5, _LIST, _LIST]
_ITEM_SCHEMA = (
    "item_id long, reach int, q int, shared int, n_seeds int, step int, "
    "words array<long>, grams array<long>"
)


def seeds(items: DataFrame) -> DataFrame:
    """(item, q, gram): of every item, the grams of which any match has one as it is.

    An item has its grams that the fewest items hold, so that a phrase of many items leads to none.
    """
    placed = items.select("item", "q", "n_seeds", "step", F.posexplode("grams").alias("at", "gram"))
    held = placed.groupBy("gram").agg(F.count_distinct("item").alias("held"))
    rarest = Window.partitionBy("item").orderBy("held", "gram", "at")
    placed = placed.where("at % step = 0").join(held, "gram")
    placed = placed.withColumn("rank", F.row_number().over(rarest))
    return placed.where("rank <= n_seeds").select("item", "q", "gram").distinct()


def bitmap(rows: DataFrame, column: str) -> np.ndarray:
    """A bitmap of the hashes in ``column``: 2 MB through the driver, however many rows."""
    # Spark numbers the bits of a bitmap from 1.
    slot = F.pmod(F.col(column), F.lit(BITS)) + 1
    found = (
        rows.select(slot.alias("slot"))
        .groupBy(F.bitmap_bucket_number("slot").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits"))
    )
    out = np.zeros(BITS // 8, np.uint8)
    for row in found.collect():
        at = (row["bucket"] - 1) * (BUCKET // 8)
        out[at : at + BUCKET // 8] = np.frombuffer(row["bits"], np.uint8)
    return out


def marked(values: np.ndarray, bits: np.ndarray) -> np.ndarray:
    slot = values & np.uint64(BITS - 1)
    return (bits[(slot >> np.uint64(3)).astype(np.int64)] >> (slot & np.uint64(7))) & 1 > 0


@dataclass(frozen=True)
class Search:
    """What a scan of documents needs of the benchmark; its size is fixed by BITS."""

    gram_bits: dict[int, np.ndarray]
    gram_needs: dict[int, int]
    seed_bits: dict[int, np.ndarray]
    reach: int


def prepared(items: DataFrame, seeded: DataFrame) -> Search | None:
    """The bitmaps and lengths of written item rows; None for an empty benchmark."""
    rules = items.groupBy("q").agg(F.min("shared").alias("shared")).collect()
    if not rules:
        return None
    needs = {row["q"]: row["shared"] for row in rules}
    # Words of the longest match: every allowed edit may add one.
    reach = items.agg(F.max("reach")).first()[0]
    exploded = items.select("q", F.explode("grams").alias("gram"))
    return Search(
        {q: bitmap(exploded.where(F.col("q") == q), "gram") for q in needs},
        needs,
        {q: bitmap(seeded.where(F.col("q") == q), "gram") for q in needs},
        reach,
    )


def _candidates(
    hashes: np.ndarray, owner: np.ndarray, heads: np.ndarray, search: Search
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs (first, last) of places where a match may begin, with enough of the benchmark's grams
    behind them; and the seeds (place, gram) among the words."""
    change = np.zeros(len(hashes) + 1, np.int64)
    at, seed = [], []
    for q, bits in search.gram_bits.items():
        gram = grams(hashes, owner, q)
        hits = np.flatnonzero((gram != 0) & marked(gram, bits))
        need = search.gram_needs[q]
        if len(hits) < need:
            continue
        sown = hits[marked(gram[hits], search.seed_bits[q])]
        at.append(sown)
        seed.append(gram[sown])
        lead, last = hits[: len(hits) - need + 1], hits[need - 1 :]
        close = (last - lead < search.reach) & (owner[lead] == owner[last])
        lead, last = lead[close], last[close]
        np.add.at(change, np.maximum(last + 1 - search.reach, heads[owner[lead]]), 1)
        np.add.at(change, lead + 1, -1)
    begins = (np.cumsum(change[:-1]) > 0).astype(np.int8)
    # A run ends with its text.
    inner = heads[1:-1]
    edges = np.diff(np.r_[0, begins, 0])
    both = inner[(inner > 0) & (inner < len(begins))]
    both = both[(begins[both] == 1) & (begins[both - 1] == 1)]
    first = np.sort(np.r_[np.flatnonzero(edges == 1), both])
    last = np.sort(np.r_[np.flatnonzero(edges == -1), both]) - 1
    if not at:
        return first, last, np.empty(0, np.int64), np.empty(0, np.uint64)
    at, seed = np.concatenate(at), np.concatenate(seed)
    order = np.argsort(at, kind="stable")
    return first, last, at[order], seed[order]


def _scan(search: Search):
    """Windows in which a match may lie: the seeds there, and the words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = WINDOW * search.reach
        for batch in batches:
            for first, last, data, offsets in words.chunks(batch.column("text")):
                hashes, owner = _text_words(data, offsets)
                if not len(hashes):
                    continue
                heads = np.searchsorted(owner, np.arange(last - first + 1))
                begins, ends, at, seed = _candidates(hashes, owner, heads, search)
                rows = []
                for begin, end in zip(begins.tolist(), ends.tolist(), strict=True):
                    text = owner[begin]
                    for low in range(begin, end + 1, size):
                        high = min(low + size - 1, end) + search.reach
                        high = min(high, heads[text + 1])
                        inside = slice(*np.searchsorted(at, [low, high]))
                        own = np.unique(seed[inside])
                        if len(own):
                            rows.append((first + int(text), low - heads[text], own, hashes[low:high]))
                if not rows:
                    continue
                ids = batch.column("doc_id").take(pa.array([r[0] for r in rows]))
                yield pa.RecordBatch.from_arrays(
                    [
                        ids,
                        pa.array([r[1] for r in rows], pa.int64()),
                        pa.array([r[2].view(np.int64) for r in rows], _LIST),
                        pa.array([r[3].view(np.int64) for r in rows], _LIST),
                    ],
                    ["doc_id", "start", "seeds", "span"],
                )

    return run


def _narrowed(item: np.ndarray, span: np.ndarray, similarity: float) -> np.ndarray | None:
    """The words of the span that a match of the item can cover; None if it cannot match."""
    q, shared = gram_rule(len(item), similarity)
    own = grams(item.view(np.uint64), np.zeros(len(item)), q)[: len(item) - q + 1]
    hits = np.flatnonzero(np.isin(grams(span.view(np.uint64), np.zeros(len(span)), q), own))
    reach = len(item) + allowed(len(item), similarity)
    if len(hits) < shared:
        return None
    lead, last = hits[: len(hits) - shared + 1], hits[shared - 1 :]
    close = last - lead < reach
    if not close.any():
        return None
    return span[max(0, last[close][0] + 1 - reach) : lead[close][-1] + reach]


def distances(items: list[np.ndarray], spans: list[np.ndarray]) -> np.ndarray:
    """Least word edits that turn each item into some run of words of its span."""
    height, width = max(map(len, items)), max(map(len, spans))
    if len(items) > 1 and len(items) * (height + width) > CELLS:
        half = len(items) // 2
        return np.r_[distances(items[:half], spans[:half]), distances(items[half:], spans[half:])]
    item, span = np.zeros((len(items), height), np.int64), np.zeros((len(spans), width), np.int64)
    item_words = np.zeros((len(items), height), bool)
    span_words = np.zeros((len(spans), width), bool)
    for i, (a, b) in enumerate(zip(items, spans, strict=True)):
        item[i, : len(a)], item_words[i, : len(a)] = a, True
        span[i, : len(b)], span_words[i, : len(b)] = b, True
    lengths = item_words.sum(axis=1)
    across = np.arange(width + 1)
    row = np.zeros((len(items), width + 1), np.int64)
    best = np.where(lengths == 0, 0, height)
    for k in range(height):
        differs = ~((span == item[:, k : k + 1]) & span_words & item_words[:, k : k + 1])
        following = np.empty_like(row)
        following[:, 0] = k + 1
        following[:, 1:] = np.minimum(row[:, 1:] + 1, row[:, :-1] + differs)
        row = np.minimum.accumulate(following - across, axis=1) + across
        ends = lengths == k + 1
        best[ends] = row[ends].min(axis=1)
    return best


def _verify(similarity: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 512):
                part = batch.slice(first, 512)
                items = part.column("words").to_numpy(zero_copy_only=False)
                spans = part.column("span").to_numpy(zero_copy_only=False)
                spans = [_narrowed(i, s, similarity) for i, s in zip(items, spans, strict=True)]
                may = np.array([s is not None for s in spans])
                if not may.any():
                    continue
                part = part.filter(pa.array(may))
                items, spans = items[may], [s for s in spans if s is not None]
                edits = distances(list(items), list(spans))
                near = [e <= allowed(len(i), similarity) for e, i in zip(edits, items, strict=True)]
                if not any(near):
                    continue
                share = 1 - edits / np.array([len(i) for i in items])
                kept = pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        part.column("item_id"),
                        pa.array(edits),
                        pa.array(share),
                    ],
                    ["doc_id", "item_id", "distance", "similarity"],
                )
                yield kept.filter(pa.array(near))

    return run


def _item_keys(repeats: int):
    """One row per item and key of its walks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            own = batch.column("words").to_numpy(zero_copy_only=False)
            number, key = walks.item_keys([w.view(np.uint64) for w in own], repeats)
            yield pa.RecordBatch.from_arrays(
                [batch.column("item").take(pa.array(number)), pa.array(key.view(np.int64))],
                ["item", "key"],
            )

    return run


def _window_keys(repeats: int, kinds: list[int], bits: np.ndarray):
    """One row per window and key of a walk from any of its words, if an item may have the key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            spans = batch.column("span").to_numpy(zero_copy_only=False)
            names = batch.column("window").to_numpy()
            ends = np.cumsum([len(s) + 1 for s in spans])
            # Windows are walked together up to CHUNK places, a longer one by itself.
            parts = np.split(np.arange(len(spans)), np.flatnonzero(np.diff(ends // walks.CHUNK)) + 1)
            for part in parts:
                line, heads = walks.laid_out([spans[i] for i in part])
                places = np.flatnonzero(line != walks.END)
                for first in range(0, len(places), walks.CHUNK):
                    starts = places[first : first + walks.CHUNK]
                    owner = part[np.searchsorted(heads, starts, "right") - 1]
                    hits = []
                    for repeat in range(repeats):
                        for backward in (False, True):
                            for _, _, key in walks.keys(line, starts, repeat, kinds, backward):
                                hit = np.flatnonzero((key != walks.END) & marked(key, bits))
                                hits.append((owner[hit], key[hit]))
                    met = pa.RecordBatch.from_arrays(
                        [
                            pa.array(names[np.concatenate([o for o, _ in hits])]),
                            pa.array(np.concatenate([k for _, k in hits]).view(np.int64)),
                        ],
                        ["window", "key"],
                    )
                    if met.num_rows:
                        yield met

    return run


def _by_walks(
    windows: DataFrame, items: DataFrame, similarity: float, recall: float
) -> DataFrame:
    """window and item that have a key of their walks in common."""
    sizes = items.select(F.least(F.size("words"), F.lit(2 * walks.PIECE)).alias("n")).distinct()
    lengths = {row["n"] for row in sizes.collect()}
    if 2 * walks.PIECE in lengths:
        # Longer items have parts of half a piece to a piece.
        lengths |= set(range(walks.PIECE // 2, walks.PIECE + 1))
    kinds = walks.kinds_of(sorted(lengths))
    repeats = max(walks.repeats_for(recall, similarity, kind) for kind in kinds)
    texts = items.select("item", "words").dropDuplicates(["item"])
    own = saved(texts.mapInArrow(_item_keys(repeats), "item long, key long").distinct(), "keys")
    walk = _window_keys(repeats, kinds, bitmap(own, "key"))
    met = windows.select("window", "span").mapInArrow(walk, "window long, key long")
    return met.distinct().join(own, "key").select("window", "item").distinct()


def _by_seeds(windows: DataFrame, seeded: DataFrame) -> DataFrame:
    """window and item where the window holds a seed of the item: all that can match."""
    hits = windows.select("window", F.explode("seeds").alias("gram"))
    return hits.join(seeded.drop("q"), "gram").select("window", "item").distinct()


def contaminated(
    documents: DataFrame,
    benchmark: DataFrame,
    similarity: float = SIMILARITY,
    recall: float = RECALL,
) -> DataFrame:
    """doc_id, item_id, distance and similarity of every item found in a document.

    A document holds an item if some run of its words is within ``(1 - similarity)`` times the
    item's length of word edits of it. Words are compared without case (A-Z) and ASCII
    punctuation. Each whole text is scanned for places that enough of the benchmark's word grams
    follow (a condition that any match meets); only the windows there leave the scan. Walks of the
    CGK embedding start at every word of a window, forward and backward, and at both ends of every
    item, over its whole length; items and windows meet by sampled steps, with as many repeats as
    ``recall`` needs for the worst placement of edits. Each pair that shares enough grams of the
    item is verified by exact edit distance over the words. The distance is the least of all
    matches of a window. With a ``recall`` of 1 windows meet items by seeds instead (grams of
    which any match has one unedited), and nothing is missed.

    NULL and empty texts hold nothing; items without a word are ignored. Rows that share a doc_id
    (or have none) give one row per item with the best match, and so do repeated items. Other
    columns are not read. Empty tables give no rows.
    """
    items = benchmark.select(F.col("item_id").cast("long"), "text").mapInArrow(
        _item_rows(similarity), _ITEM_SCHEMA
    )
    item = F.xxhash64("item_id", "words").alias("item")
    items = saved(items.select("*", item), "items")
    seeded = saved(seeds(items), "seeds")
    search = prepared(items, seeded)
    schema = documents.select("doc_id").schema.add("item_id", "long").add("distance", "long")
    schema = schema.add("similarity", "double")
    if search is None:
        return documents.sparkSession.createDataFrame([], schema)
    found = documents.select("doc_id", "text").mapInArrow(
        _scan(search), f"doc_id {documents.schema['doc_id'].dataType.simpleString()}, "
        "start long, seeds array<long>, span array<long>"
    )
    name = F.xxhash64("doc_id", "start", "span").alias("window")
    windows = saved(found.select(name, "doc_id", "seeds", "span"), "windows")
    if recall < 1:
        pairs = _by_walks(windows, items, similarity, recall)
    else:
        pairs = _by_seeds(windows, seeded)
    texts = items.select("item", "item_id", "words").dropDuplicates(["item"])
    pairs = pairs.join(windows.drop("seeds"), "window").join(texts, "item")
    verified = pairs.select("doc_id", "item_id", "words", "span").mapInArrow(
        _verify(similarity), schema
    )
    return verified.groupBy("doc_id", "item_id").agg(
        F.min("distance").alias("distance"), F.max("similarity").alias("similarity")
    )
