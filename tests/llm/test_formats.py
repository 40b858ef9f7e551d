"""Chat trees and WARC archives: exact round trips."""

import base64
import gzip
import hashlib
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidemark.llm import chat, warc
from tidemark.sources.session import run_folder

CHATS = "conv_id long, turn long, role string, text string"
PAGES = "page_id long, url string, html string"
HARD = ["</s>[INST] ok [/INST]", "\\</s>", "\\", "[INST user]x</s>", "a\\\\[INST", "é\n]</s", ""]


def chats(spark, rows):
    return spark.createDataFrame(rows, CHATS).repartition(3)


def digests_of(rows):
    by_conv = {}
    for conv, turn, role, text in rows:
        by_conv.setdefault(conv, []).append((turn, role or "", text or ""))
    out = {}
    for conv, turns in by_conv.items():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0))
        whole = "".join(f"{r}\n{t}\n" for _, r, t in turns)
        learned = "".join(t for _, r, t in turns if r == "assistant")
        sha = [hashlib.sha256(x.encode()).hexdigest() for x in (whole, learned)]
        out[conv] = (len(turns), sha[0], len(learned), sha[1])
    return out


def chat_rows():
    rows = []
    for conv in range(30):
        for turn in range(2 + conv % 4):
            role = ("system", "user", "assistant")[turn % 3]
            text = HARD[(conv // 6 * (turn > 1) + turn) % len(HARD)]
            rows.append((conv, turn, role, text if turn < 3 else f"{text}{conv % 2}"))
    rows += [(40, 0, "assistant", None), (41, None, None, None), (41, 0, "a]b\\", "x")]
    rows += [(None, 0, "user", "no id"), (42, 0, "user", "y" * 5000)]
    rows += [(50, i, "assistant", str(i)) for i in range(300)]
    return rows


def test_chats_round_trip(spark):
    rows = chat_rows()
    frame = chats(spark, rows).withColumn("h1", F.lit(1)).withColumn("depth", F.lit("x"))
    tree, paths = chat.format_chats(frame)
    got = {
        r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256)
        for r in chat.read_back(tree, paths).collect()
    }
    assert got == digests_of(rows)


def test_tree_is_shared_and_depth_first(spark):
    rows = chat_rows()
    tree, paths = chat.format_chats(chats(spark, rows))
    nodes = tree.collect()
    prefixes = set()
    by_conv = {}
    for conv, _turn, role, text in sorted(rows, key=lambda r: (r[0] or -1, r[1] or -1)):
        by_conv.setdefault(conv, []).append((role or "", text or ""))
    for turns in by_conv.values():
        prefixes |= {tuple(turns[: i + 1]) for i in range(len(turns))}
    assert len(nodes) == len(prefixes)
    ordered = sorted(nodes, key=lambda n: ([(o.branch, o.segment) for o in n.order], n.depth))
    seen = {}
    for node in ordered:
        assert len(node.formatted) == node.n_tokens
        # A parent is emitted before its children, and ids go on where the parent ends.
        spans = [(a.segment, a["from"], a.to) for a in node.attention]
        assert spans[0][1] == 0 and all(x[2] == y[1] for x, y in zip(spans, spans[1:], strict=False))
        assert spans[-1][0] == node.segment
        assert all(s in seen for s, _, _ in spans[:-1])
        seen.setdefault(node.segment, node.position)
        if node.depth:
            assert node.position > 0
        if node.loss_from is not None:
            part = node.formatted[node.loss_from : node.loss_from + node.loss_length]
            assert chat.read_turn(node.formatted)[1] == chat.unescaped(part)


def test_equal_turns_and_empty_chats(spark):
    rows = [(1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "user", "a")]
    result = chat.read_back(*chat.format_chats(chats(spark, rows))).collect()
    assert [(r.conv_id, r.n_turns) for r in result] == [(1, 3)]
    assert chat.read_back(*chat.format_chats(chats(spark, []))).collect() == []


def page_rows():
    rows = [(i, f"http://h/{i}", f"<p>{i}</p>" * (i * 3 + 1)) for i in range(120)]
    rows += [(200 + i, None, "x" * 1000) for i in range(5)] + [(300, "u", "é" * 500)]
    rows += [(301, "u\r\nEvil: 1", "é" * 500), (302, "u", "y" * 999), (303, "u", "y" * 999)]
    rows += [(400, "u", None), (401, "u", ""), (None, "u", "x" * 1000), (None, "u", None)]
    return [*rows, (500, "u", "z" * 3_000_000), (202, None, "x" * 1000)]


def expected_pages(rows):
    newest = {}
    for page, _, html in rows:
        payload = (html or "").encode()
        if page is not None and len(payload) >= 1000:
            newest[payload] = max(newest.get(payload, page), page)
    out = []
    for page, _, html in rows:
        payload = (html or "").encode()
        last = newest.get(payload)
        refers = last if page is not None and last is not None and page < last else None
        kind = "response" if refers is None else "revisit"
        out.append((page, len(payload), hashlib.sha1(payload).hexdigest(), kind, refers))
    return sorted(out, key=str)


SMALL = warc.Limits(shard_bytes=20_000, roll_bytes=4000)


def test_archives_round_trip(spark):
    rows = page_rows()
    frame = spark.createDataFrame(rows, PAGES).repartition(3).withColumn("sha1", F.lit(1))
    result = warc.archive_and_read(frame.withColumn("shard", F.lit("x")), SMALL).collect()
    assert sorted((tuple(r) for r in result), key=str) == expected_pages(rows)


def test_archives_are_deterministic(spark):
    frame = spark.createDataFrame(page_rows(), PAGES)
    files = []
    for parts in (1, 5):
        folder = run_folder(spark, "warc")
        manifest = warc.write_archives(frame.repartition(parts), folder, SMALL).collect()
        assert len({m.shard for m in manifest}) > 1 and any(m.part > 0 for m in manifest)
        for line in manifest:
            data = Path(line.file).read_bytes()
            assert len(data) == line.bytes and hashlib.sha256(data).hexdigest() == line.sha256
            assert line.bytes <= SMALL.roll_bytes or line.records == 1
            assert gzip.decompress(data).startswith(b"WARC/1.1\r\n")
        names = {Path(p).name for p in map(str, Path(folder.removeprefix("file:")).iterdir())}
        assert names == {Path(line.file).name for line in manifest}
        files.append(sorted((Path(m.file).name, m.sha256) for m in manifest))
    assert files[0] == files[1]


def test_damage_is_noticed():
    good = warc.record(1, "u", b"payload", hashlib.sha1(b"payload").hexdigest(), None)
    plain = gzip.decompress(good)
    assert warc.parsed(plain)[:2] == (1, 7)
    with pytest.raises(ValueError, match="damaged"):
        warc.parsed(plain.replace(b"payload\r\n\r\n", b"pAyload\r\n\r\n"))
    digest = base64.b32encode(hashlib.sha1(b"payload").digest())
    assert b"WARC-Payload-Digest: sha1:" + digest in plain


def test_no_pages(spark):
    assert warc.archive_and_read(spark.createDataFrame([], PAGES)).collect() == []
