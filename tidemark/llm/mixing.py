"""Mixing sources to target weights by pivotal rounding."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import saved, text_of, word_count

MAX_COPIES = 3
# Documents that one task rounds together.
BLOCK = 4096
WEIGHTS = (1, 2, 3)


def document_size() -> Column:
    """Words of the text; 0 for a NULL one."""
    return word_count(text_of())


def ranked_sources(sizes: DataFrame) -> DataFrame:
    """Sources with their size, count and rank by code point, NULL last.

    The rank is a position within a sorted range plus the sizes of the ranges before it: one
    number per range passes through the driver, however many sources there are.
    """
    sources = sizes.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count("*").alias("n_documents")
    )
    order = [F.col("source").isNull(), F.col("source")]
    placed = sources.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = saved(placed.withColumn("place", F.monotonically_increasing_id()), "sources")
    placed = placed.withColumns(
        {"range": F.shiftrightunsigned("place", 33), "at": F.expr("place & 8589934591")}
    )
    counts = placed.groupBy("range").count().orderBy("range").collect()
    before, offsets = 0, []
    for row in counts:
        offsets.append((row["range"], before))
        before += row["count"]
    if not offsets:
        return placed.select("source", "source_size", "n_documents", F.lit(0).alias("rank"))
    shift = F.create_map(*[F.lit(value).cast("long") for pair in offsets for value in pair])
    rank = F.col("at") + F.element_at(shift, F.col("range"))
    return placed.select("source", "source_size", "n_documents", rank.alias("rank"))


def source_targets(
    sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_copies: int = MAX_COPIES
) -> DataFrame:
    """Adds ``target``, each source's share of all words in proportion to its weight.

    A target stops at ``max_copies`` times its source's size, and what that leaves goes to the
    others by weight. The words per weight only rise from round to round, so a capped source stays
    capped; each round is one aggregate that returns two numbers.
    """
    listed = F.array(*[F.lit(float(w)) for w in weights])
    weight = F.get(listed, (F.col("rank") % len(weights)).cast("int"))
    sources = sources.withColumns(
        {"weight": weight, "most": (F.col("source_size") * max_copies).cast("double")}
    )
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    per_weight, capped = 0.0, -1
    while True:
        over = F.col("most") <= per_weight * F.col("weight")
        row = sources.agg(
            F.count_if(over).alias("capped"),
            F.coalesce(F.sum(F.when(over, F.col("most"))), F.lit(0.0)).alias("words"),
            F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0.0)).alias("weight"),
        ).first()
        if row["capped"] == capped or not row["weight"]:
            break
        capped = row["capped"]
        per_weight = (total - row["words"]) / row["weight"]
    target = F.least("most", F.lit(float(per_weight)) * F.col("weight"))
    return sources.withColumn("target", target)


def _uniform(*parts: np.ndarray | int) -> np.ndarray:
    """Reproducible numbers in [0, 1) from integer keys."""
    mixed = np.uint64(0x9E3779B97F4A7C15)
    with np.errstate(over="ignore"):
        for part in parts:
            mixed = (mixed ^ np.asarray(part).astype(np.int64).view(np.uint64)) * np.uint64(
                0xBF58476D1CE4E5B9
            )
            mixed = mixed ^ (mixed >> np.uint64(29))
    return (mixed >> np.uint64(11)).astype(np.float64) / float(1 << 53)


def pivot(shares: np.ndarray, sizes: np.ndarray, draws: np.ndarray) -> int | None:
    """Rounds ``shares`` in place to 0 or 1, but for one that may stay fractional; its index.

    Two unsettled documents at a time move words between each other until one of them is settled.
    The direction is drawn so that every share keeps its expectation, and the words the two take
    together do not change.
    """
    open_at = None
    for i in range(len(shares)):
        if not 0.0 < shares[i] < 1.0:
            continue
        if open_at is None:
            open_at = i
            continue
        j = open_at
        up = min((1.0 - shares[i]) * sizes[i], shares[j] * sizes[j])
        down = min(shares[i] * sizes[i], (1.0 - shares[j]) * sizes[j])
        moved = up if draws[i] * (up + down) < down else -down
        left, right = shares[i] + moved / sizes[i], shares[j] - moved / sizes[j]
        shares[i] = _settled(left)
        shares[j] = _settled(right)
        if 0.0 < shares[i] < 1.0:
            open_at = i
        elif not 0.0 < shares[j] < 1.0:
            open_at = None
    return open_at


def _settled(share: float) -> float:
    if share < 1e-9:
        return 0.0
    return 1.0 if share > 1.0 - 1e-9 else share


def _round_groups(level: int, seed: int):
    """Rounds runs of equal (group, block) in a sorted partition, one run in memory at a time."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest: pd.DataFrame | None = None
        for batch in batches:
            frame = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            key = frame["rank"].to_numpy() * (1 << 31) + frame["block"].to_numpy()
            cuts = np.flatnonzero(key[1:] != key[:-1]) + 1
            starts = [0, *cuts.tolist(), len(frame)]
            for start, end in zip(starts[:-2], starts[1:-1], strict=True):
                yield rounded(frame.iloc[start:end])
            rest = frame.iloc[starts[-2] :] if len(frame) else None
        if rest is not None and len(rest):
            yield rounded(rest)

    def rounded(group: pd.DataFrame) -> pd.DataFrame:
        shares = group["share"].to_numpy(dtype=float).copy()
        sizes = group["size"].to_numpy()
        draws = _uniform(seed, level, group["key"].to_numpy(), sizes, np.arange(len(group)))
        open_at = pivot(shares, sizes.astype(float), draws)
        settled = np.ones(len(group), dtype=bool)
        if open_at is not None:
            settled[open_at] = False
        return group.assign(share=shares, settled=settled)

    return run


def mix(
    documents: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    max_copies: int = MAX_COPIES,
    block: int = BLOCK,
    seed: int = 7,
) -> DataFrame:
    """doc_id, size, source_size, target, copies and taken (size times copies) per document.

    Every document starts with the fractional copies target / source_size. Whole copies are kept;
    the fractions are rounded by pairs inside blocks of about ``block`` documents of a source, the
    one left over in each block goes to the next level, and so on until a source has one, which
    is drawn. Rounding moves words, not counts, so a source's words differ from its target by less
    than the last document. A source may hold any part of the rows, as its blocks are separate
    keys.

    The draws are hashes of the document's id and size and of the seed, so reruns agree. A NULL or
    blank text has size 0 and takes nothing. A NULL source is a source of its own, ranked last.
    Rows with equal or NULL doc_id are separate documents. Other columns are not read. An empty
    table gives no rows.
    """
    sizes = saved(
        documents.select("doc_id", "source", document_size().alias("size")), "sizes"
    )
    sources = saved(source_targets(ranked_sources(sizes), weights, max_copies), "targets")
    largest = sources.agg(F.max("n_documents")).first()[0] or 0
    copies = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    named = sources.select(
        F.col("source").alias("of"), "source_size", "target", "rank", "n_documents"
    )
    rows = sizes.join(named, F.col("source").eqNullSafe(F.col("of"))).withColumn("copies", copies)
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(-1).cast("long"))
    n_blocks = F.greatest(F.ceil(F.col("n_documents") / block), F.lit(1))
    rows = rows.select(
        F.col("doc_id").isNotNull().alias("named"),
        "size",
        "source_size",
        "target",
        "rank",
        F.floor("copies").cast("int").alias("whole"),
        (F.col("copies") - F.floor("copies")).alias("share"),
        key.alias("key"),
        F.pmod(F.xxhash64(key, "size"), n_blocks).cast("int").alias("block"),
        F.lit(False).alias("settled"),
    )
    empty = rows.where(F.col("size") == 0).withColumn("share", F.lit(0.0))
    level, waiting, done = 0, rows.where(F.col("size") > 0), [empty]
    while True:
        placed = waiting.repartition("rank", "block").sortWithinPartitions(
            "rank", "block", "size", "key"
        )
        result = saved(placed.mapInPandas(_round_groups(level, seed), rows.schema), "rounded")
        done.append(result.where("settled"))
        waiting = result.where("NOT settled")
        if largest <= block:
            break
        largest, level = math.ceil(largest / block), level + 1
        waiting = waiting.withColumn("block", F.expr(f"CAST(block DIV {block} AS INT)"))
    draw = F.pmod(F.xxhash64("key", "size", F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)
    done.append(waiting.withColumn("share", F.when(draw < F.col("share"), 1.0).otherwise(0.0)))
    mixed = done[0]
    for part in done[1:]:
        mixed = mixed.unionByName(part)
    total = (F.col("whole") + F.col("share").cast("int")).alias("copies")
    return mixed.select(
        F.when(F.col("named"), F.col("key")).alias("doc_id"),
        "size",
        "source_size",
        "target",
        total,
        (F.col("size") * (F.col("whole") + F.col("share").cast("int"))).alias("taken"),
    )
