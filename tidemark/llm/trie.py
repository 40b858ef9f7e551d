"""A prefix trie over conversations: shards of sorted paths, joined by the skeleton of their bounds.

A path is a string of bytes, 25 for each turn. Conversations are ranged by it into shards. A trie
node whose members all lie in one shard is finished there, over sorted rows. Only a prefix of a
splitter path can have members in several shards; these nodes are the skeleton, a small trie that
every task gets. Shards give partial figures for them, which are added up.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import saved

GROUP = 5
MOST_SHARED = 9
# Bytes of a turn in a path, and of the end of a path: no id or an id, then the id.
TURN, END = 25, 10
# Bounds of the sample that splitters are chosen from: rows, and bytes of each path.
MAX_SAMPLE, MAX_SPLITTER = 20_000, 64 * TURN + END
# Characters of ids that a shard gives at once for a node of the skeleton.
CHUNK = 1 << 16
NO_ID = 1 << 63
EMPTY_SHA = hashlib.sha256(b"").hexdigest()
ROOT = 0


def _hex(value: Column) -> Column:
    return F.lpad(F.hex(value), 16, "0")


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """(conv, pos, element): every turn's place and its 25 bytes, as hex digits.

    A turn stands for its role and text by 128 bits of hash, followed by the text's length.
    """
    role, text = (F.coalesce(F.col(name).cast("string"), F.lit("")) for name in ("role", "text"))
    element = F.concat(
        F.lit("01"),
        _hex(F.xxhash64(role, text)),
        _hex(F.xxhash64(F.lit("second"), role, text)),
        _hex(F.octet_length(text).cast("long")),
    )
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv"),
        F.col("turn").cast("long").alias("turn"),
        element.alias("element"),
    )
    order = Window.partitionBy("conv").orderBy(F.col("turn").asc_nulls_first(), "element")
    rows = rows.withColumn("pos", F.row_number().over(order) - 1)
    return saved(rows.select("conv", "pos", "element"), "numbered-turns")


def shared_turns(conv: Column) -> Column:
    """How many turns a conversation takes from the first of its group; 0 without an id."""
    crc = F.crc32(conv.cast("string").cast("binary"))
    return F.coalesce(crc % MOST_SHARED, F.lit(0))


def rebuilt_keys(conversations: DataFrame) -> DataFrame:
    """``key`` of every rebuilt conversation: its path and its id, in the order of the trie."""
    turns = numbered_turns(conversations)
    convs = turns.select("conv").distinct()
    place = F.struct(F.lit(1).alias("part"), "pos", "element").alias("place")
    own = turns.where(F.col("pos") >= shared_turns(F.col("conv"))).select("conv", place)
    first = turns.select(F.col("conv").alias("first"), "pos", "element")
    wanted = convs.withColumn("first", F.col("conv") - F.col("conv") % GROUP)
    place = F.struct(F.lit(0).alias("part"), "pos", "element").alias("place")
    taken = wanted.join(first.where(F.col("pos") < MOST_SHARED), "first")
    taken = taken.where(F.col("pos") < shared_turns(F.col("conv"))).select("conv", place)
    turnless = convs.withColumn("place", F.lit(None).cast(own.schema["place"].dataType))
    lists = own.unionByName(taken).unionByName(turnless).groupBy("conv")
    lists = lists.agg(F.array_sort(F.collect_list("place")).alias("places"))
    path = F.array_join(F.transform("places", lambda p: p["element"]), "")
    ordered = _hex(F.col("conv").bitwiseXOR(F.lit(-(1 << 63))))
    end = F.when(F.col("conv").isNull(), F.lit("0001" + "0" * 16)).otherwise(
        F.concat(F.lit("0000"), ordered)
    )
    return saved(lists.select(F.unhex(F.concat(path, end)).alias("key")), "paths")


def choose_splitters(sample: list[bytes], shards: int) -> list[bytes]:
    """At most ``shards`` - 1 bounds, each the shortest prefix that parts two sampled paths."""
    sample = sorted(sample)
    found = []
    for i in range(1, shards):
        at = i * len(sample) // shards
        if not at or sample[at] == sample[at - 1]:
            continue
        low, high = sample[at - 1], sample[at]
        same = next((k for k, (a, b) in enumerate(zip(low, high, strict=False)) if a != b), len(low))
        found.append(high[: same + 1])
    return sorted(set(found))


class Skeleton:
    """The trie of splitter paths. Node 0 is the root."""

    def __init__(self, splitters: list[bytes]):
        self.splitters = splitters
        self.children: dict[tuple[int, bytes], int] = {}
        self.parent, self.depth = [-1], [0]
        for splitter in splitters:
            node, at = ROOT, 0
            while len(splitter) >= at + TURN and splitter[at] == 1:
                step = (node, splitter[at : at + TURN])
                if step not in self.children:
                    self.children[step] = len(self.parent)
                    self.parent.append(node)
                    self.depth.append(self.depth[node] + 1)
                node, at = self.children[step], at + TURN


def sampled_skeleton(keys: DataFrame, shards: int) -> Skeleton:
    size = min(max(20 * shards, 1000), MAX_SAMPLE)
    sample = keys.select(F.substring("key", 1, MAX_SPLITTER).alias("key"), F.xxhash64("key").alias("h"))
    rows = sample.orderBy("h", "key").limit(size).collect()
    return Skeleton(choose_splitters([bytes(r["key"]) for r in rows], shards))


NODE, PARTIAL, ENDS = 0, 1, 2
_COLUMNS = {
    "kind": pa.int32(),
    "shard": pa.int32(),
    "node": pa.int64(),
    "in_skeleton": pa.bool_(),
    "parent": pa.int64(),
    "depth": pa.int64(),
    "least": pa.int64(),
    "n_convs": pa.int64(),
    "n_children": pa.int64(),
    "n_leaves": pa.int64(),
    "saved_tokens": pa.int64(),
    "size": pa.int64(),
    "ends": pa.string(),
}
_KINDS = {pa.int32(): "int", pa.int64(): "long", pa.bool_(): "boolean", pa.string(): "string"}
_SCHEMA = ", ".join(f"{name} {_KINDS[kind]}" for name, kind in _COLUMNS.items())


def id_text(conv: int) -> str:
    return "null" if conv == NO_ID else str(conv)


class _Open:
    """A node on the path at hand, with the figures gathered below it so far."""

    __slots__ = ("number", "skeleton", "size", "n", "least", "children", "leaves", "saved", "ends", "sha")

    def __init__(self, number: int, skeleton: int, size: int):
        self.number, self.skeleton, self.size = number, skeleton, size
        self.n = self.children = self.leaves = self.saved = 0
        self.least, self.ends, self.sha = NO_ID, [], None


class ShardTrie:
    """Figures of the nodes of one shard, fed with its keys in order.

    It holds the nodes of one path. Rows are listed in ``out`` as soon as they are complete.
    """

    def __init__(self, shard: int, skeleton: Skeleton):
        self.shard, self.skeleton = shard, skeleton
        self.path, self.next = b"", 1
        self.stack = [_Open(ROOT, ROOT, 0)]
        self.out: list[tuple] = []

    def add(self, key: bytes) -> None:
        path = key[:-END]
        if path != self.path:
            same, most = 0, min(len(path), len(self.path))
            while same < most and path[same : same + TURN] == self.path[same : same + TURN]:
                same += TURN
            self._close(same // TURN + 1)
            for at in range(same, len(path), TURN):
                self._open(path[at : at + TURN])
            self.path = path
        no_id = key[-9] == 1
        self._end(NO_ID if no_id else int.from_bytes(key[-8:], "big") - (1 << 63))

    def finish(self) -> None:
        self._close(0)

    def _open(self, element: bytes) -> None:
        above = self.stack[-1].skeleton
        known = self.skeleton.children.get((above, element), -1) if above >= 0 else -1
        self.stack.append(_Open(self.next, known, int.from_bytes(element[-8:], "big")))
        self.next += 1

    def _end(self, conv: int) -> None:
        top = self.stack[-1]
        top.n += 1
        top.least = min(top.least, conv)
        if top.skeleton >= 0:
            top.ends.append(id_text(conv))
            if len(top.ends) * 20 >= CHUNK:
                self._flush(top)
        elif top.sha is None:
            top.sha = hashlib.sha256(id_text(conv).encode())
        else:
            top.sha.update(f",{id_text(conv)}".encode())

    def _flush(self, node: _Open) -> None:
        if node.ends:
            row = self._row(ENDS, node.skeleton, True, None, None, node, ",".join(node.ends))
            self.out.append(row)
            node.ends = []

    def _row(self, kind, number, in_skeleton, parent, depth, node, ends) -> tuple:
        least = None if node.least == NO_ID else node.least
        figures = (least, node.n, node.children, node.leaves, node.saved, node.size)
        return (kind, self.shard, number, in_skeleton, parent, depth, *figures, ends)

    def _close(self, depth: int) -> None:
        while len(self.stack) > depth:
            node = self.stack.pop()
            if node.skeleton >= 0:
                self._flush(node)
                self.out.append(self._row(PARTIAL, node.skeleton, True, None, None, node, None))
                continue
            above = self.stack[-1]
            node.leaves = node.leaves or 1
            node.saved += (node.n - 1) * node.size
            in_skeleton = above.skeleton >= 0
            parent = above.skeleton if in_skeleton else above.number
            ends = node.sha.hexdigest() if node.sha else None
            self.out.append(
                self._row(NODE, node.number, in_skeleton, parent, len(self.stack), node, ends)
            )
            above.n += node.n
            above.least = min(above.least, node.least)
            above.children += 1
            above.leaves += node.leaves
            above.saved += node.saved


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    arrays = [pa.array(c, k) for c, k in zip(columns, _COLUMNS.values(), strict=True)]
    return pa.RecordBatch.from_arrays(arrays, list(_COLUMNS))


def _shard_tries(skeleton: Skeleton):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = None
        for batch in batches:
            shards, keys = batch.column("shard").to_pylist(), batch.column("key").to_pylist()
            for shard, key in zip(shards, keys, strict=True):
                if trie is None or trie.shard != shard:
                    if trie is not None:
                        trie.finish()
                        yield _batch(trie.out)
                    trie = ShardTrie(shard, skeleton)
                trie.add(key)
                if len(trie.out) >= 4096:
                    yield _batch(trie.out)
                    trie.out = []
        if trie is not None:
            trie.finish()
            yield _batch(trie.out)

    return run


def _placed(splitters: list[bytes]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("key")
            shards = [bisect_right(splitters, key) for key in keys.to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(shards, pa.int32()), keys], ["shard", "key"])

    return run


def _joined_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest per node, over its chunks in order."""
    node, sha, done = None, None, []
    for batch in batches:
        rows = zip(batch.column("node").to_pylist(), batch.column("ends").to_pylist(), strict=True)
        for number, ends in rows:
            if number != node:
                if sha is not None:
                    done.append((node, sha.hexdigest()))
                node, sha = number, hashlib.sha256(ends.encode())
            else:
                sha.update(f",{ends}".encode())
    if sha is not None:
        done.append((node, sha.hexdigest()))
    if done:
        numbers, digests = zip(*done, strict=True)
        arrays = [pa.array(numbers, pa.int64()), pa.array(digests)]
        yield pa.RecordBatch.from_arrays(arrays, ["node", "digest"])


def _skeleton_rows(skeleton: Skeleton, figures: DataFrame) -> list[tuple]:
    """The finished nodes of the skeleton, from the sums of their partial figures.

    There are at most 64 nodes for each splitter, whatever the size of the input.
    """
    partial = figures.where(F.col("kind") == PARTIAL).groupBy("node").agg(
        F.sum("n_convs"),
        F.min("least"),
        F.sum("n_children"),
        F.sum("n_leaves"),
        F.sum("saved_tokens"),
        F.max("size"),
    )
    chunks = figures.where(F.col("kind") == ENDS).select("node", "shard", "least", "ends")
    chunks = chunks.withColumn("first", F.expr("try_cast(split(ends, ',', 2)[0] AS long)"))
    chunks = chunks.repartition("node").sortWithinPartitions(
        "node", "shard", F.col("first").asc_nulls_last()
    )
    digests = dict(tuple(r) for r in chunks.mapInArrow(_joined_ends, "node long, digest string").collect())
    sums = {r[0]: list(r)[1:] for r in partial.collect()}
    least_of = lambda a, b: b if a is None else a if b is None else min(a, b)
    for node in range(len(skeleton.parent) - 1, -1, -1):
        if node not in sums:
            continue
        n, least, _, leaves, gained, size = sums[node]
        if not leaves:
            sums[node][3] = leaves = 1
        if node != ROOT:
            sums[node][4] = gained = gained + (n - 1) * size
            above = sums[skeleton.parent[node]]
            above[0] += n
            above[1] = least_of(above[1], least)
            above[2] += 1
            above[3] += leaves
            above[4] += gained
    rows = []
    for node, (n, least, children, leaves, gained, _) in sums.items():
        parent = sums[skeleton.parent[node]][1] if node != ROOT else None
        digest = digests.get(node, EMPTY_SHA)
        rows.append((node, least, skeleton.depth[node], parent, n, children, leaves, gained, digest))
    return rows


def prefix_trie(conversations: DataFrame, shards: int | None = None) -> DataFrame:
    """One row per distinct sequence of first turns of the rebuilt conversations.

    conv_id is its smallest member, parent_conv_id that of the sequence without the last turn;
    further depth, n_convs, n_children, n_leaves, saved_tokens (bytes of text that are written
    once instead of once a member) and ends_sha256 over the members that end there.

    Turns are ordered by ``turn``, NULL first, and then by a hash of role and text; a repeated row
    is a turn of its own. NULL role or text is empty. Rows without a conv_id are one conversation,
    which shares nothing, comes after all others, and is written ``null`` in ends_sha256; a node
    that only it reaches has a NULL conv_id. Texts of any length count by hash and length. Other
    columns are not read. An empty table gives no rows.

    Two turns are the same if 128 bits of hash over role and text, and the text's length, are. A
    path is held by one task at 25 bytes a turn. Copies of a conversation, however many, lie side
    by side and are dealt over shards by their ids; only lists of their ids meet in one task, as a
    stream. Conversations that share over 64 first turns are not parted from each other.
    """
    spark = conversations.sparkSession
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = rebuilt_keys(conversations)
    skeleton = sampled_skeleton(keys, shards)
    placed = keys.mapInArrow(_placed(skeleton.splitters), "shard int, key binary")
    placed = placed.repartitionById(shards, "shard").sortWithinPartitions("key")
    figures = saved(placed.mapInArrow(_shard_tries(skeleton), _SCHEMA), "trie")
    kind = (
        "node long, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
        "n_leaves long, saved_tokens long, ends_sha256 string"
    )
    rows = _skeleton_rows(skeleton, figures)
    trunk = spark.createDataFrame(rows, kind)
    columns = [c for c in trunk.columns if c != "node"]
    nodes = figures.where(F.col("kind") == NODE)
    local = nodes.where("NOT in_skeleton").drop("kind", "in_skeleton")
    parents = nodes.where("n_children > 0").select(
        "shard", F.col("node").alias("parent"), F.col("least").alias("parent_conv_id")
    )
    # At most 64 rows for each splitter.
    tops = F.broadcast(
        trunk.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    )
    hung = nodes.where("in_skeleton").drop("kind", "in_skeleton").join(tops, "parent")
    finished = local.join(parents, ["shard", "parent"]).unionByName(hung)
    digest = F.coalesce("ends", F.lit(EMPTY_SHA)).alias("ends_sha256")
    finished = finished.withColumn("conv_id", F.col("least")).select(*columns[:-1], digest)
    return finished.unionByName(trunk.select(columns))
