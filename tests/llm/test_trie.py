"""The prefix trie against a plain one."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tidemark.llm import trie

CHATS = "conv_id long, turn long, role string, text string"
COLUMNS = [
    "conv_id",
    "depth",
    "parent_conv_id",
    "n_convs",
    "n_children",
    "n_leaves",
    "saved_tokens",
    "ends_sha256",
]


def plain_trie(rows):
    """Rows of the trie from dictionaries of whole prefixes; ``None`` ids come last."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(turns)] for c, turns in own.items()}
    members = defaultdict(list)
    ends = defaultdict(list)
    order = lambda c: (c is None, c or 0)
    for conv in sorted(own, key=order):
        path = own[conv]
        if conv is not None:
            h = zlib.crc32(str(conv).encode()) % 9
            first = conv - (abs(conv) % 5) * (1 if conv >= 0 else -1)
            path = own.get(first, [])[:h] + path[h:]
        path = tuple(path)
        ends[path].append(conv)
        for depth in range(len(path) + 1):
            members[path[:depth]].append(conv)
    leaves, saved, children = defaultdict(int), defaultdict(int), defaultdict(int)
    for path in members:
        if path:
            children[path[:-1]] += 1
    for path, of in members.items():
        gain = (len(of) - 1) * len(path[-1][1].encode()) if path else 0
        for depth in range(len(path) + 1):
            leaves[path[:depth]] += path not in children
            saved[path[:depth]] += gain
    out = []
    for path, of in members.items():
        ids = ",".join("null" if c is None else str(c) for c in ends[path])
        above = members[path[:-1]][0] if path else None
        digest = hashlib.sha256(ids.encode()).hexdigest()
        figures = (len(of), children[path], leaves[path], saved[path], digest)
        out.append((of[0], len(path), above, *figures))
    return sorted(out, key=repr)


def rows_of(frame):
    return sorted((tuple(r) for r in frame.select(COLUMNS).collect()), key=repr)


def chats(spark, rows):
    return spark.createDataFrame(rows, CHATS).repartition(4)


def mixed_rows():
    random.seed(5)
    rows = []
    for conv in [*range(-12, 60), 1 << 40, (1 << 40) + 3]:
        if conv == 25:
            continue  # the first of its group is missing
        for turn in range(random.randrange(1, 12)):
            text = random.choice(["", "a", "é", "x" * 3000, None, "b\nc", f"own {conv % 3}"])
            rows.append((conv, turn, random.choice(["user", "assistant", None]), text))
    rows += [(70, None, "system", "first"), (70, 0, "user", "second")]
    rows += [(None, 1, "user", "no id"), (None, 0, "user", "a")]
    rows += [(80, 0, "user", "twice"), (80, 0, "user", "twice")]
    return rows


@pytest.mark.parametrize("shards", [1, 3, 16])
def test_trie_equals_plain_one(spark, shards):
    rows = mixed_rows()
    frame = chats(spark, rows).withColumn("key", F.lit("x")).withColumn("shard", F.lit(9))
    assert rows_of(trie.prefix_trie(frame, shards)) == plain_trie(rows)


def test_many_copies_of_a_conversation_are_dealt_over_shards(spark):
    rows = [(conv * 5, turn, "user", f"t{turn}") for conv in range(400) for turn in range(4)]
    rows += [(conv * 5, turn, "user", f"c{conv} {turn}") for conv in range(400, 420) for turn in range(3)]
    frame = chats(spark, rows)
    keys = trie.rebuilt_keys(frame)
    splitters = trie.sampled_skeleton(keys, 8).splitters
    whole = 4 * trie.TURN
    assert sum(len(s) > whole for s in splitters) >= 3  # bounds among the ids of the copies
    assert rows_of(trie.prefix_trie(frame, 8)) == plain_trie(rows)


def test_one_very_long_conversation(spark):
    rows = [(7, turn, "user", f"t{turn % 3}") for turn in range(200)]
    rows += [(8, turn, "user", "x" * 100_000) for turn in range(2)]
    assert rows_of(trie.prefix_trie(chats(spark, rows), 4)) == plain_trie(rows)


def test_empty_table_and_no_turns_left(spark):
    assert rows_of(trie.prefix_trie(chats(spark, []), 4)) == []
    # Short conversations of which nothing is left, since the first of the group is missing.
    rows = [(conv, 0, "user", "x") for conv in range(100, 180) if conv % 5]
    got = rows_of(trie.prefix_trie(chats(spark, rows), 4))
    assert got == plain_trie(rows)
    assert sum(r[1] == 0 for r in got) == 1


def test_splitters_are_shortest_bounds():
    keys = [bytes([1]) * 30, bytes([1]) * 30 + b"\2", b"\3" + bytes(60), b"\3" + bytes(61)]
    found = trie.choose_splitters(keys, 4)
    assert found == [keys[1], b"\3", keys[3]]
    assert trie.choose_splitters([], 4) == []
