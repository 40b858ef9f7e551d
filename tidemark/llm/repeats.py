"""Removal of byte strings that occur twice or more anywhere in the documents."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import bwt, words
from tidemark.llm.common import saved, text_of

LENGTH = 200
NO_ID = -(1 << 63)
# Bytes scanned at once; longer texts are scanned in pieces that overlap by a string.
PIECE = 1 << 23
# Bytes of context that one task transforms.
BLOCK_BYTES = 1 << 20
# Anchors, and their contexts, with more rows than MIN_HOT are dealt out: the largest MAX_HOT.
MIN_HOT = 10_000
MAX_HOT = 100_000
# Different contexts of an anchor that are transformed together.
MAX_CONTEXTS = 4096
SPAN, CONTEXT, WINDOWS = 0, 1, 2
# Rules of rows besides these kinds: all rows of the anchor are in one part; a copy, whatever else
# is in the part.
ALL_AT_ONCE, COPIED = 3, 8
# Parts that a frequent context is dealt out to.
SPREAD = 256

# A text is named by its doc_id and 128 bits of hash.
_KEY = "doc long, twin long, other long"


def anchor_length(length: int) -> int:
    return max(1, length * 8 // 25)


def _least_codes(codes: np.ndarray, width: int) -> np.ndarray:
    """The least code of every run of ``width``."""
    n = len(codes)
    if n < width:
        return np.empty(0, np.uint64)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = codes
    blocks = padded.reshape(-1, width)
    forward = np.minimum.accumulate(blocks, axis=1).ravel()
    backward = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(backward[: n - width + 1], forward[width - 1 : n])


def domains(
    data: np.ndarray, offsets: np.ndarray, length: int
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(anchor, context hash, text index, start, count) of all strings of ``length`` bytes.

    The anchor of a string is the hash of its least substring (of ``anchor_length`` bytes, by
    hash order, the first of equal ones). Equal strings have equal anchors at equal places, so
    all occurrences of a string meet under its anchor. Strings with the same anchor occurrence
    begin at neighbouring positions and make one row; the context hash covers all their bytes and
    where the anchor stands in them.
    """
    size = anchor_length(length)
    for base in range(0, max(len(data), 1), PIECE):
        part = data[base : base + PIECE + length - 1]
        if len(part) < length:
            return
        heads = np.clip(offsets - base, 0, len(part))
        sums = words.prefix_hashes(part)
        at = np.arange(len(part) - size + 1)
        hashes = words.span_hashes(sums, at, at + size)
        low = np.uint64((1 << 24) - 1)
        codes = (hashes & ~low) | at.astype(np.uint64)
        anchors = (_least_codes(codes, length - size + 1) & low).astype(np.int64)
        room = np.diff(heads) - length + 1
        inside = np.zeros(len(anchors) + 1, np.int32)
        fits = room > 0
        np.add.at(inside, heads[:-1][fits], 1)
        np.add.at(inside, heads[:-1][fits] + room[fits], -1)
        starts = np.flatnonzero(np.cumsum(inside[:-1]) > 0)
        if not len(starts):
            continue
        own = anchors[starts]
        text = np.searchsorted(heads, starts, "right") - 1
        new = np.r_[
            True,
            (own[1:] != own[:-1]) | (starts[1:] != starts[:-1] + 1) | (text[1:] != text[:-1]),
        ]
        rows = np.flatnonzero(new)
        first, count = starts[rows], np.diff(np.r_[rows, len(starts)])
        anchor = own[rows]
        content = words.span_hashes(sums, first, first + count + length - 1)
        context = words.mixed(content ^ words.mixed((anchor - first).astype(np.uint64)))
        begin = first + base - offsets[text[rows]]
        yield hashes[anchor], context, text[rows], begin, count


def _place(values: np.ndarray, ordered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each value is in ``ordered``, and where."""
    if not len(ordered):
        return np.zeros(len(values), bool), np.zeros(len(values), np.int64)
    at = np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)
    return ordered[at] == values, at


@dataclass(frozen=True)
class Frequent:
    """Anchors of very many rows and, of those, contexts of very many rows; sorted.

    ``kinds`` says how the contexts of each anchor are compared: SPAN for one context (there is
    nothing to compare), else CONTEXT or WINDOWS.
    """

    anchors: np.ndarray
    kinds: np.ndarray
    contexts: np.ndarray


def _scan(length: int, frequent: Frequent, only_frequent: bool = False):
    """Rows of ``domains``, with the part of the anchor and the rule they go under.

    The rows of most anchors are one part.  A frequent anchor is dealt out by context, and a
    frequent context by text besides.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, twin, other = (batch.column(n).to_numpy() for n in ("doc", "twin", "other"))
            for first, _, data, offsets in words.chunks(batch.column("text")):
                for anchor, context, text, start, count in domains(data, offsets, length):
                    hot, at = _place(anchor, frequent.anchors)
                    if only_frequent:
                        anchor, context, text, start, count, at = (
                            c[hot] for c in (anchor, context, text, start, count, at)
                        )
                        hot = hot[hot]
                    rule = np.full(len(anchor), ALL_AT_ONCE, np.int32)
                    part = np.zeros(len(anchor), np.uint64)
                    owner = text + first
                    if hot.any():
                        rule[hot] = frequent.kinds[at[hot]]
                        part[hot] = context[hot]
                        known, _ = _place(context, frequent.contexts)
                        known &= hot
                        rule[known] += COPIED
                        spread = doc[owner[known]].view(np.uint64) % np.uint64(SPREAD)
                        part[known] = words.mixed(part[known] + spread)
                    columns = [anchor.view(np.int64), part.view(np.int64), context.view(np.int64)]
                    columns += [doc[owner], twin[owner], other[owner], start.astype(np.int64)]
                    columns += [count.astype(np.int32), rule]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], _DOMAIN_NAMES)

    return run


_DOMAIN_NAMES = ["anchor", "part", "context", "doc", "twin", "other", "start", "count", "rule"]
_DOMAIN = f"anchor long, part long, context long, {_KEY}, start long, count int, rule int"
_FOUND_NAMES = ["kind", "anchor", "doc", "twin", "other", "start", "count"]
_FOUND = f"kind int, anchor long, {_KEY}, start long, count int"


def _decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over rows sorted by anchor, part and context: what is repeated, what must be compared.

    A context that occurs twice is repeated as a whole.  One row of every context of an anchor with
    several goes on to be compared byte by byte.
    """
    rest = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        rest = table if rest is None else pa.concat_tables([rest, table])
        anchor, part = (rest.column(n).to_numpy() for n in ("anchor", "part"))
        cuts = np.flatnonzero((anchor[1:] != anchor[:-1]) | (part[1:] != part[:-1])) + 1
        if len(cuts):
            yield from _decided(rest.slice(0, int(cuts[-1])))
            rest = rest.slice(int(cuts[-1]))
    if rest is not None and rest.num_rows:
        yield from _decided(rest)


def _decided(rows: pa.Table) -> Iterator[pa.RecordBatch]:
    anchor, part, context, rule = (
        rows.column(n).to_numpy() for n in ("anchor", "part", "context", "rule")
    )
    n = len(anchor)
    new_part = np.r_[True, (anchor[1:] != anchor[:-1]) | (part[1:] != part[:-1])]
    new_context = new_part | np.r_[True, context[1:] != context[:-1]]
    heads = np.flatnonzero(new_context)
    size = np.diff(np.r_[heads, n])
    copied = np.repeat(size > 1, size) | (rule >= COPIED)
    of = np.cumsum(new_part)[heads] - 1
    contexts = np.bincount(of)[of]
    own = rule[heads] % COPIED
    whole = own == ALL_AT_ONCE
    kind = np.where(whole, np.where(contexts > MAX_CONTEXTS, WINDOWS, CONTEXT), own)
    asked = np.where(whole, contexts > 1, own != SPAN)
    index = np.r_[np.flatnonzero(copied), heads[asked]]
    if not len(index):
        return
    kinds = np.r_[np.full(int(copied.sum()), SPAN), kind[asked]].astype(np.int32)
    columns = [rows.column(name).to_numpy()[index] for name in _FOUND_NAMES[1:]]
    yield pa.RecordBatch.from_arrays([pa.array(c) for c in [kinds, *columns]], _FOUND_NAMES)


def _counted_frequent(texts: DataFrame, length: int) -> Frequent:
    """The anchors with over MIN_HOT rows, and their contexts with as many: MAX_HOT at most.

    Rows are added up in their tasks before they are shuffled.
    """
    none = np.empty(0, np.uint64)
    nothing = Frequent(none, np.empty(0, np.int32), none)
    rows = texts.mapInArrow(_scan(length, nothing), _DOMAIN).select("anchor")
    many = rows.groupBy("anchor").agg(F.count("*").alias("n")).where(F.col("n") > MIN_HOT)
    listed = many.orderBy(F.desc("n"), "anchor").limit(MAX_HOT).collect()
    if not listed:
        return nothing
    anchors = np.sort(np.array([row["anchor"] for row in listed], np.int64).view(np.uint64))
    first = Frequent(anchors, np.zeros(len(anchors), np.int32), none)
    rows = texts.mapInArrow(_scan(length, first, only_frequent=True), _DOMAIN)
    contexts = rows.groupBy("anchor", "context").agg(F.count("*").alias("n"))
    contexts = saved(contexts, "frequent")
    kinds = np.zeros(len(anchors), np.int32)
    for row in contexts.groupBy("anchor").agg(F.count("*").alias("n")).collect():
        at = np.searchsorted(anchors, np.int64(row["anchor"]).view(np.uint64))
        kinds[at] = SPAN if row["n"] == 1 else CONTEXT if row["n"] <= MAX_CONTEXTS else WINDOWS
    often = contexts.where(F.col("n") > MIN_HOT).orderBy(F.desc("n"), "context").limit(MAX_HOT)
    copied = np.array([row["context"] for row in often.collect()], np.int64).view(np.uint64)
    return Frequent(anchors, kinds, np.sort(copied))


def _contexts(length: int):
    """The bytes of the asked contexts, and hashes of the strings of the asked windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            asked = batch.column("asked").to_pylist()
            doc, twin, other = (batch.column(n).to_pylist() for n in ("doc", "twin", "other"))
            for first, last, data, offsets in words.chunks(batch.column("text")):
                rows = []
                for i in range(first, last):
                    text = data[offsets[i - first] : offsets[i - first + 1]]
                    for one in asked[i]:
                        low, high = one["start"], one["start"] + one["count"] + length - 1
                        rows.append((one["kind"], one["anchor"], doc[i], twin[i], other[i], low,
                                     one["count"], text[low:high].tobytes()))
                if rows:
                    yield from _split(rows, length)

    return run


def _split(rows: list[tuple], length: int) -> Iterator[pa.RecordBatch]:
    whole = [(*row[1:], None, None) for row in rows if row[0] == CONTEXT]
    for row in rows:
        if row[0] != WINDOWS:
            continue
        _, anchor, doc, twin, other, low, count, content = row
        sums = words.prefix_hashes(np.frombuffer(content, np.uint8))
        at = np.arange(count)
        w1 = words.span_hashes(sums, at, at + length)
        salted = words.prefix_hashes(np.frombuffer(content, np.uint8) ^ np.uint8(0x5A))
        w2 = words.span_hashes(salted, at, at + length)
        for i, a, b in zip(at.tolist(), w1.view(np.int64).tolist(), w2.view(np.int64).tolist(), strict=True):
            whole.append((anchor, doc, twin, other, low + i, 1, None, a, b))
    if whole:
        columns = zip(*whole, strict=True)
        arrays = [pa.array(c, t) for c, t in zip(columns, _CONTEXT_TYPES, strict=True)]
        yield pa.RecordBatch.from_arrays(arrays, _CONTEXT_NAMES)


_CONTEXT_NAMES = ["anchor", "doc", "twin", "other", "start", "count", "content", "w1", "w2"]
_CONTEXT_TYPES = [*[pa.int64()] * 5, pa.int32(), pa.binary(), pa.int64(), pa.int64()]
_CONTEXT = f"anchor long, {_KEY}, start long, count int, content binary, w1 long, w2 long"
_SPAN = f"{_KEY}, low long, high long"


def _transform(length: int):
    """One block per partition: the runs of its strings that occur twice in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [b for b in batches if b.num_rows]
        if not parts:
            return
        rows = pa.Table.from_batches(parts).combine_chunks()
        text = np.frombuffer(b"".join(rows.column("content").to_pylist()), np.uint8)
        doc, twin, other, start, count = (
            rows.column(n).to_numpy() for n in ("doc", "twin", "other", "start", "count")
        )
        count = count.astype(np.int64)
        sizes = count + length - 1
        base = np.cumsum(sizes) - sizes
        owner = np.repeat(np.arange(len(count)), count)
        place = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
        hit = np.flatnonzero(bwt.repeated(text, base[owner] + place, length))
        if not len(hit):
            return
        new = np.r_[True, (hit[1:] != hit[:-1] + 1) | (owner[hit[1:]] != owner[hit[:-1]])]
        heads = np.flatnonzero(new)
        tails = np.r_[heads[1:] - 1, len(hit) - 1]
        of = owner[hit[heads]]
        low = start[of] + place[hit[heads]]
        high = start[of] + place[hit[tails]] + length
        yield pa.RecordBatch.from_arrays(
            [pa.array(c) for c in (doc[of], twin[of], other[of], low, high)],
            ["doc", "twin", "other", "low", "high"],
        )

    return run


def repeated_spans(texts: DataFrame, length: int = LENGTH) -> DataFrame:
    """(doc, twin, other, low, high): byte spans that cover every repeated string; they may overlap."""
    frequent = _counted_frequent(texts, length)
    rows = texts.mapInArrow(_scan(length, frequent), _DOMAIN)
    rows = rows.repartition("anchor", "part").sortWithinPartitions("anchor", "part", "context")
    found = saved(rows.mapInArrow(_decide, _FOUND), "found")
    asked = (
        found.where(F.col("kind") != SPAN)
        .groupBy("doc", "twin", "other")
        # A set: rows that agree in id and text ask for the same places, and each is given them once.
        .agg(F.collect_set(F.struct("kind", "anchor", "start", "count")).alias("asked"))
    )
    contexts = texts.join(asked, ["doc", "twin", "other"]).mapInArrow(_contexts(length), _CONTEXT)
    contexts = saved(contexts, "contexts")
    size = contexts.agg(F.sum(F.octet_length("content"))).first()[0] or 0
    blocks = contexts.where("content IS NOT NULL").drop("w1", "w2")
    blocks = blocks.repartition(max(1, size // BLOCK_BYTES), "anchor")
    compared = blocks.mapInArrow(_transform(length), _SPAN)
    windows = contexts.where("content IS NULL").drop("anchor", "count", "content")
    twice = windows.groupBy("w1", "w2").agg(F.count("*").alias("n")).where("n > 1")
    single = windows.join(saved(twice, "twice"), ["w1", "w2"]).select(
        "doc",
        "twin",
        "other",
        F.col("start").alias("low"),
        (F.col("start") + length).alias("high"),
    )
    whole = found.where(F.col("kind") == SPAN).select(
        "doc",
        "twin",
        "other",
        F.col("start").alias("low"),
        (F.col("start") + F.col("count") + (length - 1)).alias("high"),
    )
    return whole.unionByName(saved(compared, "compared")).unionByName(single)


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        doc = batch.column("doc_id")
        spans = batch.column("spans")
        for first, last, data, offsets in words.chunks(batch.column("text")):
            rows = []
            for i in range(last - first):
                text = data[offsets[i] : offsets[i + 1]]
                own = spans[first + i].values
                if own is None or not len(own):
                    rows.append((text.tobytes(), len(text), 0, 0))
                    continue
                low, high = (own.field(n).to_numpy() for n in (0, 1))
                depth = np.zeros(len(text) + 1, np.int32)
                np.add.at(depth, low, 1)
                np.add.at(depth, high, -1)
                gone = np.cumsum(depth[:-1]) > 0
                runs = int(gone[0]) + int(np.count_nonzero(gone[1:] & ~gone[:-1]))
                rows.append((text[~gone].tobytes(), len(text), int(gone.sum()), runs))
            kept, *numbers = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays(
                [doc.slice(first, last - first), pa.array(kept, pa.binary())]
                + [pa.array(c, pa.int64()) for c in numbers],
                ["doc_id", "kept", "n_bytes", "n_removed", "n_spans"],
            )


def drop_repeats(documents: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, kept (bytes), n_bytes, n_removed and n_spans of every document.

    Every byte that a string of ``length`` bytes covers is removed if that string also starts
    anywhere else, in the same text or another; strings are judged on the input.

    Strings meet under an anchor that they share (see ``domains``). Under an anchor, contexts that
    occur twice are repeated as a whole; the others are joined to blocks, and a Burrows-Wheeler
    transform of each block finds the strings in it that have a common prefix of ``length`` with
    another. Anchors of very many rows are counted first and dealt out by context, contexts of very
    many rows by text as well; where an anchor has more than MAX_CONTEXTS different contexts, its
    strings are counted singly by 128 bits of hash. So no task gets an unbounded group.

    A NULL text is empty; texts shorter than ``length`` lose nothing. Rows that share a doc_id are
    separate texts, and a repeated row repeats all its strings. ``length`` must be 8 or more.
    Other columns are not read. An empty table gives no rows.
    """
    if length < bwt.FIRST:
        raise ValueError(f"strings of fewer than {bwt.FIRST} bytes are not supported")
    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc")
    twin, other = F.xxhash64("text").alias("twin"), F.xxhash64(F.lit("other"), "text").alias("other")
    texts = documents.select(doc, twin, other, text_of().alias("text"))
    spans = repeated_spans(texts, length)
    spans = spans.groupBy("doc", "twin", "other")
    # A set: each of many equal rows has found the same spans.
    spans = spans.agg(F.collect_set(F.struct("low", "high")).alias("spans"))
    joined = texts.join(spans, ["doc", "twin", "other"], "left")
    doc_id = F.when(F.col("doc") != NO_ID, F.col("doc")).alias("doc_id")
    return joined.select(doc_id, "text", "spans").mapInArrow(
        _apply, "doc_id long, kept binary, n_bytes long, n_removed long, n_spans long"
    )
