"""Similar texts by word shingles: a MinHash forest, then exact Jaccard similarity."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import words
from tidemark.llm.common import saved
from tidemark.llm.components import components
from tidemark.llm.decontam import bitmap, marked

SHINGLE = 5
NO_ID = -(1 << 63)
# Side of the rows of a block that meets itself; two blocks have sides 0 and 1.
WITHIN = 2


@dataclass(frozen=True)
class Settings:
    """``trees`` tries over ``depth`` values each; ``block`` texts meet in one task."""

    similarity: float = 0.8
    recall: float = 0.99999
    trees: int = 24
    depth: int = 5
    block: int = 1024

    @property
    def prefix(self) -> int:
        """Values that must agree in a trie: shortened from the full depth until, for two texts
        as similar as asked, the chance to meet in some trie reaches the target recall."""
        for length in range(self.depth, 1, -1):
            if 1 - (1 - self.similarity**length) ** self.trees >= self.recall:
                return length
        return 1

    @property
    def agreeing(self) -> int:
        """Least number of agreeing values for a pair to be verified: over four deviations
        below the mean of a pair that is as similar as asked."""
        n = self.trees * self.depth
        spread = (n * self.similarity * (1 - self.similarity)) ** 0.5
        return int(n * self.similarity - 4.2 * spread)


def shingles(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, owner, digests) of all runs of SHINGLE words; digests are of the word sequences.

    A text with fewer words, but not none, has one shingle of all of them.
    """
    size = len(offsets) - 1
    folded, starts, ends, owner = words.words(data, offsets, words.PLAIN)
    hashes = words.span_hashes(words.prefix_hashes(folded), starts, ends)
    n_words = np.bincount(owner, minlength=size)
    heads = np.cumsum(n_words) - n_words
    place = np.arange(len(hashes), dtype=np.uint64) - heads[owner].astype(np.uint64)
    digests = np.zeros((size, 2), np.uint64)
    some = n_words > 0
    if len(hashes):
        for i in range(2):
            spread = words.mixed(hashes + words.mixed(place * np.uint64(2) + np.uint64(i + 1)))
            digests[some, i] = np.add.reduceat(spread, heads[some])
    n = len(hashes) - SHINGLE + 1
    total = np.zeros(max(n, 0), np.uint64)
    for i in range(SHINGLE if n > 0 else 0):
        total = words.mixed(total ^ hashes[i : i + n]) + np.uint64(i + 1)
    whole = owner[:n] == owner[SHINGLE - 1 :] if n > 0 else np.empty(0, bool)
    short = np.flatnonzero(some & (n_words < SHINGLE))
    found = np.concatenate([total[whole], words.mixed(digests[short, 0])])
    owners = np.concatenate([owner[:n][whole] if n > 0 else np.empty(0, np.int64), short])
    order = np.argsort(owners, kind="stable")
    return found[order], owners[order], digests


def signatures(hashes: np.ndarray, owner: np.ndarray, size: int, values: int) -> np.ndarray:
    """MinHash values of 16 bits, one row per text; a row of zeros for a text without words."""
    out = np.zeros((size, values), np.uint16)
    if not len(hashes):
        return out
    heads = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
    odd = words.mixed(np.arange(1, values + 1, dtype=np.uint64)) | np.uint64(1)
    for i in range(values):
        least = np.minimum.reduceat(hashes * odd[i], heads)
        out[owner[heads], i] = words.mixed(least) >> np.uint64(48)
    return out


def _sign(values: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("node")
            for first, last, data, offsets in words.chunks(batch.column("text")):
                hashes, owner, digests = shingles(data, offsets)
                signed = signatures(hashes, owner, last - first, values)
                has_words = np.isin(np.arange(last - first), owner)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(first, last - first),
                        pa.array(digests[:, 0].view(np.int64)),
                        pa.array(np.ascontiguousarray(digests[:, 1]).view(np.int64)),
                        pa.array([row.tobytes() for row in signed], pa.binary()),
                        pa.array(has_words),
                    ],
                    ["node", "d1", "d2", "signature", "has_words"],
                )

    return run


def _prefixes(settings: Settings):
    """One row per text and trie: the hash of its matched prefix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            nodes = np.repeat(batch.column("node").to_numpy(), settings.trees)
            matrix = _matrix(batch.column("signature"), settings)
            parts = matrix.reshape(len(matrix), settings.trees, settings.depth)
            key = np.tile(np.arange(settings.trees, dtype=np.uint64), (len(matrix), 1))
            for i in range(settings.prefix):
                key = words.mixed(words.mixed(key) ^ parts[:, :, i].astype(np.uint64))
            tree = np.tile(np.arange(settings.trees, dtype=np.int32), len(matrix))
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes), pa.array(tree), pa.array(key.ravel().view(np.int64))],
                ["node", "tree", "key"],
            )

    return run


def _matrix(column: pa.Array, settings: Settings) -> np.ndarray:
    rows = b"".join(column.to_pylist())
    return np.frombuffer(rows, np.uint16).reshape(-1, settings.trees * settings.depth)


def _candidates(a: np.ndarray, b: np.ndarray, tree: int, settings: Settings) -> np.ndarray:
    """Pairs whose signatures agree enough and that no earlier trie brings together."""
    out = np.zeros((len(a), len(b)), bool)
    step = max(1, (1 << 22) // max(1, len(b) * a.shape[1]))
    for first in range(0, len(a), step):
        same = a[first : first + step, None, :] == b[None]
        enough = np.count_nonzero(same, axis=2) >= settings.agreeing
        parts = same.reshape(*same.shape[:2], settings.trees, settings.depth)
        met = parts[:, :, :tree, : settings.prefix].all(axis=3).any(axis=2)
        out[first : first + step] = enough & ~met
    return out


def common(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of sorted sets, all of ``a`` with all of ``b``."""
    values = np.concatenate([*a, *b])
    shared, inverse, n = np.unique(values, return_inverse=True, return_counts=True)
    column = np.cumsum(n > 1) - 1
    useful = (n > 1)[inverse]
    row = np.repeat(np.arange(len(a) + len(b)), [len(s) for s in [*a, *b]])
    row, column = row[useful], column[inverse][useful]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    total = np.zeros((len(a), len(b)), np.float32)
    width = 4096
    for first in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        lo, hi = np.searchsorted(column, [first, first + width])
        dense = np.zeros((len(a) + len(b), width), np.float32)
        dense[row[lo:hi], column[lo:hi] - first] = 1
        total += dense[: len(a)] @ dense[len(a) :].T
    return total.astype(np.int64)


def _roots(links: np.ndarray, nodes: np.ndarray) -> np.ndarray:
    """The smallest node that each node reaches over ``links`` (a symmetric matrix)."""
    label = nodes.copy()
    top = np.iinfo(np.int64).max
    while True:
        least = np.minimum(label, np.where(links, label[None, :], top).min(axis=1))
        if (least == label).all():
            return label
        label = least


def _group_links(settings: Settings, exact: bool):
    """Runs over rows sorted by group: the two sides of a block pair, or one block with itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            frame = pa.Table.from_batches([batch])
            rest = frame if rest is None else pa.concat_tables([rest, frame])
            group = rest.column("group").to_numpy()
            cuts = np.flatnonzero(group[1:] != group[:-1]) + 1
            if not len(cuts):
                continue
            yield from results(rest.slice(0, int(cuts[-1])), cuts[:-1])
            rest = rest.slice(int(cuts[-1]))
        if rest is not None and rest.num_rows:
            yield from results(rest, np.empty(0, np.int64))

    def results(rows: pa.Table, cuts: np.ndarray) -> Iterator[pa.RecordBatch]:
        rows = rows.combine_chunks()
        bounds = [0, *cuts.tolist(), rows.num_rows]
        for first, last in zip(bounds[:-1], bounds[1:], strict=True):
            if last - first > 1:
                found = linked(rows.slice(first, last - first))
                if found is not None:
                    yield found

    def linked(rows: pa.Table) -> pa.RecordBatch | None:
        node = rows.column("node").to_numpy()
        side = rows.column("side").to_numpy()
        tree = rows.column("tree")[0].as_py()
        signed = _matrix(rows.column("signature"), settings)
        within = side[0] == WITHIN
        left = np.flatnonzero(side != 1)
        right = left if within else np.flatnonzero(side == 1)
        if not len(left) or not len(right):
            return None
        near = _candidates(signed[left], signed[right], tree, settings)
        near &= node[left][:, None] != node[right][None]
        if not near.any():
            return None
        if exact:
            sets = rows.column("shingles").to_pylist()
            sets = [np.asarray(s, np.int64) for s in sets]
            shared = common([sets[i] for i in left], [sets[i] for i in right])
            sizes = np.array([len(s) for s in sets])
            union = sizes[left][:, None] + sizes[right][None] - shared
            near &= shared >= settings.similarity * union - 1e-9
        links = np.zeros(len(node), np.int64)
        np.add.at(links, left, near.sum(axis=1))
        if not within:
            np.add.at(links, right, near.sum(axis=0))
        square = np.zeros((len(node), len(node)), bool)
        square[np.ix_(left, right)] = near
        square |= square.T
        keep = links > 0
        if not keep.any():
            return None
        roots = _roots(square, node)
        columns = [rows.column("group").to_numpy()[keep], node[keep], links[keep], roots[keep]]
        return pa.RecordBatch.from_arrays(
            [pa.array(c) for c in columns], ["group", "node", "links", "root"]
        )

    return run


def _sets(bits: np.ndarray):
    """Sorted distinct shingle hashes of the texts whose node is marked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("hash").to_numpy().view(np.uint64)
            wanted = batch.filter(pa.array(marked(ids, bits)))
            for first, last, data, offsets in words.chunks(wanted.column("text")):
                hashes, owner, digests = shingles(data, offsets)
                bounds = np.searchsorted(owner, np.arange(last - first + 1))
                sets = [
                    np.unique(hashes[a:b]).view(np.int64)
                    for a, b in zip(bounds[:-1], bounds[1:], strict=True)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        wanted.column("node").slice(first, last - first),
                        pa.array(digests[:, 0].view(np.int64)),
                        pa.array(sets, pa.list_(pa.int64())),
                    ],
                    ["node", "d1", "shingles"],
                )

    return run


def _grouped(prefixes: DataFrame, settings: Settings) -> DataFrame:
    """group, tree, side and node of the texts that share a prefix with another.

    A prefix that more than ``block`` texts share is cut into blocks by a hash of the text, and
    each pair of blocks is a group of its own, so no task meets more than two blocks at once.
    """
    shared = prefixes.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    shared = saved(shared, "shared")
    n_blocks = F.ceil(F.col("n") / settings.block).cast("int")
    rows = prefixes.join(shared, "key").withColumn("n_blocks", n_blocks)
    rows = rows.withColumn("own", F.pmod(F.xxhash64("node", "key"), "n_blocks").cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)))
    low, high = F.least("own", "other"), F.greatest("own", "other")
    return rows.select(
        F.xxhash64("key", low, high).alias("group"),
        "tree",
        F.when(F.col("own") == F.col("other"), WITHIN)
        .otherwise((F.col("own") > F.col("other")).cast("int"))
        .alias("side"),
        "node",
    )


def similar(documents: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """doc_id, class_id and n_links of every document.

    Two different texts are linked if the Jaccard similarity of their sets of SHINGLE-word shingles
    is ``similarity`` or more; n_links counts the different texts that a document's text is linked
    to. class_id is the smallest doc_id that links and copies lead to. Words are runs without
    ASCII white space; texts with the same words are copies, which share one search.

    Signatures are searched by trie prefixes, the matched prefix being as long as the target recall
    allows. Within a group, pairs are compared by signature, and a pair is counted in the first
    trie that holds it; only texts that have such a partner are read again, as sets of shingles, and
    verified exactly in the same groups. A group returns one row per text, never its pairs.

    A NULL text is empty; texts without words are copies of each other without links. A text of
    fewer than SHINGLE words has one shingle. Rows that share a doc_id are one document with several
    texts, those without one are one document with a NULL id. Other columns are not read. An
    empty table gives no rows.
    """
    values = settings.trees * settings.depth
    node = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("node")
    texts = documents.select(node, "text")
    signed = saved(
        texts.mapInArrow(
            _sign(values), "node long, d1 long, d2 long, signature binary, has_words boolean"
        ),
        "signatures",
    )
    # Written, so that Spark can split the rows of a text that many documents copy; so is the
    # list of shared prefixes.
    first = saved(signed.groupBy("d1", "d2").agg(F.min("node").alias("first")), "first")
    members = saved(
        signed.select("node", "d1", "d2", "has_words").join(first, ["d1", "d2"]), "members"
    )
    kept = members.where("node = first AND has_words").select("node", "d1", "d2").distinct()
    unique = saved(
        signed.join(kept, ["node", "d1", "d2"])
        .groupBy("node", "d1")
        .agg(F.min("signature").alias("signature")),
        "unique",
    )
    prefixes = unique.select("node", "signature").mapInArrow(
        _prefixes(settings), "node long, tree int, key long"
    )
    grouped = _grouped(saved(prefixes, "prefixes"), settings)
    rows = grouped.join(unique, "node")
    kind = "group long, node long, links long, root long"
    ordered = rows.select("group", "tree", "side", "node", "signature").repartition("group")
    ordered = ordered.sortWithinPartitions("group", "side", "node")
    near = ordered.mapInArrow(_group_links(settings, exact=False), kind)
    near = saved(near.select("group", "node").distinct(), "near")

    hashed = F.xxhash64("node").alias("hash")
    bits = bitmap(near.select(hashed), "hash")
    sets = texts.select("node", "text", hashed).mapInArrow(
        _sets(bits), "node long, d1 long, shingles array<long>"
    )
    sets = saved(sets.join(unique, ["node", "d1"]).dropDuplicates(["node", "d1"]), "sets")
    verified = grouped.join(near, ["group", "node"]).join(sets, "node")
    verified = verified.select("group", "tree", "side", "node", "signature", "shingles")
    verified = verified.repartition("group").sortWithinPartitions("group", "side", "node")
    links = saved(verified.mapInArrow(_group_links(settings, exact=True), kind), "verified")

    counts = links.groupBy("node").agg(F.sum("links").alias("n_links"))
    # Texts that one doc_id holds belong together; all other copies stay out of the search.
    least = members.groupBy("node").agg(F.min("first").alias("a"), F.max("first").alias("most"))
    several = least.where("a <> most").select("node", "a")
    held = members.join(several, "node").select("a", F.col("first").alias("b"))
    found = links.select(F.col("node").alias("a"), F.col("root").alias("b"))
    classes = components(found.unionByName(held))
    classes = classes.join(counts, "node", "left").withColumnRenamed("node", "first")
    result = members.select("node", "first").join(classes, "first", "left")
    result = result.groupBy("node").agg(
        F.sum("n_links").alias("n_links"),
        F.min(F.coalesce("component", "first")).alias("component"),
    )
    class_id = F.col("component")
    return result.select(
        F.when(F.col("node") != NO_ID, F.col("node")).alias("doc_id"),
        F.when(class_id != NO_ID, class_id).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
    )


