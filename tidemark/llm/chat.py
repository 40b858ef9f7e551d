"""Chat formatting as a prefix tree: turns that conversations share are written once."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import words
from tidemark.llm.common import saved

# The control strings of the template.
OPEN, CLOSE, SLASH, END = "[INST", "]", "[/INST", "</s>"
LEARNED_ROLE = "assistant"
NO_ID = -(1 << 63)
NO_TURN = -(1 << 63)
_TURN = re.compile(r"\[INST ((?:[^\\\]]|\\.)*)\](.*)</s>", re.DOTALL)
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)


def escaped(text: Column) -> Column:
    """A backslash before every backslash and control string."""
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for control in (OPEN, SLASH, END):
        text = F.replace(text, F.lit(control), F.lit("\\" + control))
    return text


def unescaped(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def _opening(role: Column) -> Column:
    role = F.replace(escaped(role), F.lit(CLOSE), F.lit("\\" + CLOSE))
    return F.concat(F.lit(OPEN + " "), role, F.lit(CLOSE))


def formatted_turn(role: Column, text: Column) -> Column:
    return F.concat(_opening(role), escaped(text), F.lit(END))


def read_turn(formatted: str) -> tuple[str, str]:
    """Role and text of one formatted turn."""
    match = _TURN.fullmatch(formatted)
    if match is None:
        raise ValueError("not a formatted turn")
    return unescaped(match[1]), unescaped(match[2])


def turns(conversations: DataFrame) -> DataFrame:
    """Rows without NULLs, with 128 bits of hash over role and text."""
    role = F.coalesce(F.col("role"), F.lit(""))
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = conversations.select(
        F.coalesce(F.col("conv_id").cast("long"), F.lit(NO_ID)).alias("conv"),
        F.coalesce(F.col("turn").cast("long"), F.lit(NO_TURN)).alias("turn"),
        role.alias("role"),
        text.alias("text"),
    )
    return rows.withColumns(
        {
            "h1": F.xxhash64("role", "text"),
            "h2": F.xxhash64(F.lit("second"), "role", "text"),
        }
    )


def _path_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Depth, node and first position of every turn, over rows sorted by conversation.

    A node stands for a whole prefix. Its hash is a running sum over (depth, turn), so rows
    stream through and a conversation of any length needs no more memory than a batch.
    """
    last, depth0, start0 = None, 0, 0
    sums0 = (np.uint64(0), np.uint64(0))
    for batch in batches:
        if not batch.num_rows:
            continue
        conv = batch.column("conv").to_numpy()
        size = batch.column("n_tokens").to_numpy()
        index = np.arange(len(conv))
        heads = np.r_[True, conv[1:] != conv[:-1]]
        first = np.maximum.accumulate(np.where(heads, index, 0))
        goes_on = (first == 0) & (last is not None and bool(conv[0] == last))
        depth = index - first + np.where(goes_on, depth0, 0)
        before = np.cumsum(size) - size
        start = before - before[first] + np.where(goes_on, start0, 0)
        nodes = []
        with np.errstate(over="ignore"):
            for i, name in enumerate(("h1", "h2")):
                own = batch.column(name).to_numpy().view(np.uint64)
                own = words.mixed(own + words.mixed(depth.astype(np.uint64) + np.uint64(i + 1)))
                total = np.cumsum(own)
                carried = np.where(goes_on, sums0[i], np.uint64(0))
                nodes.append(total - (total[first] - own[first]) + carried)
        last, depth0 = conv[-1], int(depth[-1]) + 1
        start0 = int(start[-1] + size[-1])
        sums0 = (nodes[0][-1], nodes[1][-1])
        names = ["conv", "turn", "h1", "h2", "n_tokens"]
        columns = [batch.column(n) for n in names]
        columns += [pa.array(depth), pa.array(start)]
        columns += [pa.array(node.view(np.int64)) for node in nodes]
        yield pa.RecordBatch.from_arrays(columns, [*names, "depth", "start", "n1", "n2"])


def paths(rows: DataFrame) -> DataFrame:
    """Every turn with its depth, position and segment, as a written table.

    A segment is named by the smallest conversation that holds a prefix; it owns one run of turns
    from the point where it leaves the conversations before it. Hashes only are shuffled here.
    """
    sizes = rows.withColumn("n_tokens", F.char_length(formatted_turn(F.col("role"), F.col("text"))))
    sizes = sizes.select("conv", "turn", "h1", "h2", F.col("n_tokens").cast("long"))
    placed = sizes.repartition("conv").sortWithinPartitions("conv", "turn", "h1", "h2")
    kind = "conv long, turn long, h1 long, h2 long, n_tokens long, depth long, start long"
    placed = saved(placed.mapInArrow(_path_hashes, f"{kind}, n1 long, n2 long"), "turns")
    # Written, so that Spark can split the rows of a prefix that many conversations share.
    owners = saved(placed.groupBy("n1", "n2").agg(F.min("conv").alias("segment")), "owners")
    return saved(placed.join(owners, ["n1", "n2"]), "paths")


def segments(placed: DataFrame) -> DataFrame:
    """For each segment its place in depth-first order and the intervals it attends to.

    Intervals are runs of token positions inside the segments it hangs from, root first, then its
    own. The order key lists, from the root, how far down each segment branches off (deepest
    first) and its name: sorted by it, a segment follows its parent and its subtree is one run.
    """
    runs = placed.groupBy("conv", "segment").agg(
        F.min("start").alias("from"),
        F.max(F.col("start") + F.col("n_tokens")).alias("to"),
        F.min("depth").alias("branch"),
    )
    lists = runs.groupBy("conv").agg(
        F.array_sort(F.collect_list(F.struct("from", "to", "branch", "segment"))).alias("runs"),
        F.max(F.col("segment") == F.col("conv")).alias("owns"),
    )
    return lists.where("owns").select(
        "conv",
        F.transform(
            "runs", lambda r: F.struct((-r["branch"]).alias("branch"), r["segment"].alias("segment"))
        ).alias("order"),
        F.transform(
            "runs", lambda r: F.struct(r["segment"].alias("segment"), r["from"], r["to"])
        ).alias("attention"),
    )


def tree(rows: DataFrame, placed: DataFrame) -> DataFrame:
    """The formatted output: each shared turn once, in depth-first order, as a written table.

    Tokens are the code points of ``formatted``. ``position`` is the position id of its first one
    along the conversation, ``attention`` what its segment may attend to, and ``loss_from`` and
    ``loss_length`` give the tokens to learn from. Texts are shuffled once to meet their nodes and
    once into order.
    """
    own = placed.where("conv = segment").join(segments(placed), "conv")
    keys = ["conv", "turn", "h1", "h2"]
    texts = rows.groupBy(*keys).agg(F.first("role").alias("role"), F.first("text").alias("text"))
    nodes = own.join(texts, keys)
    learned = F.col("role") == LEARNED_ROLE
    nodes = nodes.select(
        F.col("conv").alias("segment"),
        "depth",
        "order",
        F.col("start").alias("position"),
        "n_tokens",
        "attention",
        F.when(learned, F.char_length(_opening(F.col("role")))).alias("loss_from"),
        F.when(learned, F.char_length(escaped(F.col("text")))).alias("loss_length"),
        formatted_turn(F.col("role"), F.col("text")).alias("formatted"),
    )
    placed_in_order = nodes.repartitionByRange("order", "depth").sortWithinPartitions(
        "order", "depth"
    )
    return saved(placed_in_order, "tree")


def format_chats(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(tree, paths): the formatted turns, and for every conversation the turns it consists of.

    Turns are ordered by ``turn``; rows with equal or NULL turns follow a hash of their role and
    text, NULL first. NULL role or text is empty. Rows with a NULL conv_id are one conversation. A
    repeated row is a turn of its own. Other columns are not read. An empty table gives two empty
    tables. One conversation is read by one task, as a stream of batches.
    """
    rows = turns(conversations)
    placed = paths(rows)
    return tree(rows, placed), placed


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Figures of each conversation from its formatted turns, over sorted rows."""
    state = None
    done: list[tuple] = []

    def closed(s) -> tuple:
        conv, n, whole, loss_chars, loss, chars = s
        return conv, n, whole.hexdigest(), loss_chars, loss.hexdigest(), chars

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(column) for column in zip(*rows, strict=True)], list(_DIGEST_COLUMNS)
        )

    for batch in batches:
        columns = [batch.column(n).to_pylist() for n in ("conv", "formatted", "loss_from", "loss_length")]
        for conv, formatted, loss_from, loss_length in zip(*columns, strict=True):
            if state is None or state[0] != conv:
                if state is not None:
                    done.append(closed(state))
                state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            role, text = read_turn(formatted)
            state[1] += 1
            state[2].update(f"{role}\n{text}\n".encode())
            state[5] += len(formatted)
            if loss_from is not None:
                learned = unescaped(formatted[loss_from : loss_from + loss_length])
                state[3] += len(learned)
                state[4].update(learned.encode())
        if len(done) >= 4096:
            yield batch_of(done)
            done = []
    if state is not None:
        done.append(closed(state))
    if done:
        yield batch_of(done)


_DIGEST_COLUMNS = {
    "conv": "long",
    "n_turns": "long",
    "turns_sha256": "string",
    "loss_chars": "long",
    "loss_sha256": "string",
    "formatted_chars": "long",
}


def read_back(formatted: DataFrame, placed: DataFrame) -> DataFrame:
    """Digests of every conversation, from the written tree and the paths through it."""
    nodes = formatted.select("segment", "depth", "formatted", "loss_from", "loss_length")
    rows = placed.select("conv", "segment", "depth").join(nodes, ["segment", "depth"])
    rows = rows.repartition("conv").sortWithinPartitions("conv", "depth")
    kind = ", ".join(f"{name} {kind}" for name, kind in _DIGEST_COLUMNS.items())
    digests = rows.mapInArrow(_digests, kind)
    conv_id = F.when(F.col("conv") != NO_ID, F.col("conv")).alias("conv_id")
    return digests.select(conv_id, *[n for n in _DIGEST_COLUMNS if n != "conv"])
