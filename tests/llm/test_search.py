"""Repeated strings, similar texts and benchmark search against brute force."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import bwt, components, decontam, forest, repeats, walks

KIND = "doc_id long, text string"


def frame_of(spark, rows, kind=KIND, parts=3):
    return spark.createDataFrame(rows, kind).repartition(parts)


def words_of(rng, n, size=400):
    return [f"w{rng.randrange(size)}" for _ in range(n)]


@pytest.mark.parametrize("letters", [1, 2, 4, 30])
def test_repeated_strings_of_a_block(letters):
    rng = np.random.default_rng(letters)
    for length in (8, 9, 16, 20, 37):
        text = rng.integers(0, letters, int(rng.integers(length + 1, 300))).astype(np.uint8)
        text[len(text) // 2 :][: len(text) // 4] = text[: len(text) // 4]
        starts = np.flatnonzero(rng.random(len(text) - length + 1) < 0.7)
        seen = Counter(text[s : s + length].tobytes() for s in starts)
        expected = [seen[text[s : s + length].tobytes()] > 1 for s in starts]
        assert bwt.repeated(text, starts, length).tolist() == expected


def brute_repeats(rows, length):
    texts = [(t or "").encode() for _, t in rows]
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for (doc, _), text in zip(rows, texts, strict=True):
        gone = np.zeros(len(text) + 1, bool)
        for i in range(len(text) - length + 1):
            if seen[text[i : i + length]] > 1:
                gone[i : i + length] = True
        kept = bytes(b for b, g in zip(text, gone, strict=False) if not g)
        runs = sum(1 for i in range(len(text)) if gone[i] and (i == 0 or not gone[i - 1]))
        out.append((doc, kept, len(text), int(gone.sum()), runs))
    return sorted(out, key=str)


def repeat_rows():
    rng = random.Random(3)
    passage = " ".join(words_of(rng, 25))
    rows = [(i, " ".join(words_of(rng, 40))) for i in range(20)]
    for i in range(20, 50):
        own = words_of(rng, 30)
        at = rng.randrange(30)
        rows.append((i, " ".join([*own[:at], passage, *own[at:]])))
    rows += [(50, rows[3][1]), (51, rows[3][1]), (52, "ab" * 80), (53, "Of " * 40), (54, None)]
    rows += [(55, ""), (56, "x" * 39), (57, "x" * 39), (58, "é" * 60), (59, "\x00" * 90)]
    rows += [(60, rows[5][1][:70]), (61, passage + passage), (None, passage), (None, "lone")]
    rows += [(62, "twin text one " * 9), (62, "another text " * 9), (63, "same"), (63, "same")]
    return rows


@pytest.mark.parametrize("hot", [False, True])
def test_repeats_match_brute_force(spark, monkeypatch, hot):
    if hot:
        monkeypatch.setattr(repeats, "MIN_HOT", 4)
        monkeypatch.setattr(repeats, "MAX_CONTEXTS", 12)
    rows = repeat_rows()
    frame = frame_of(spark, rows).withColumn("doc", F.lit(1)).withColumn("twin", F.lit("x"))
    result = repeats.drop_repeats(frame, length=40).collect()
    got = [(r.doc_id, bytes(r.kept), r.n_bytes, r.n_removed, r.n_spans) for r in result]
    assert sorted(got, key=str) == brute_repeats(rows, 40)


def test_texts_whose_short_hashes_agree_are_told_apart(spark):
    numbers = spark.range(400_000).select(
        F.concat(F.lit("own start "), F.repeat(F.col("id").cast("string"), 12)).alias("text")
    )
    short = numbers.groupBy(F.hash("text")).agg(F.collect_list("text").alias("t")).where("size(t) > 1")
    one, two = sorted(short.first().t)[:2]
    rows = [(None, one), (None, two), (1, one + " end"), (2, "x" * 30)]
    rows += [(5, two), (5, one), (6, one[:60])]
    result = repeats.drop_repeats(frame_of(spark, rows), length=40).collect()
    got = [(r.doc_id, bytes(r.kept), r.n_bytes, r.n_removed, r.n_spans) for r in result]
    assert sorted(got, key=str) == brute_repeats(rows, 40)
    lone = [(None, one), (None, two), (1, one[20:])]
    result = repeats.drop_repeats(frame_of(spark, lone), length=40).collect()
    got = [(r.doc_id, bytes(r.kept), r.n_bytes, r.n_removed, r.n_spans) for r in result]
    assert sorted(got, key=str) == brute_repeats(lone, 40)


@pytest.mark.parametrize("hot", [False, True])
def test_many_equal_rows_are_given_their_spans_once(spark, monkeypatch, hot):
    if hot:
        monkeypatch.setattr(repeats, "MIN_HOT", 4)
        monkeypatch.setattr(repeats, "MAX_CONTEXTS", 12)
    rng = random.Random(6)
    copied = " ".join("".join(rng.choices("abcdef", k=6)) for _ in range(120))
    own = "".join(rng.choices("xyz", k=300))
    rows = [(None, copied)] * 60 + [(5, copied)] * 60 + [(6, own), (None, own[:100] + copied[:90])]
    result = repeats.drop_repeats(frame_of(spark, rows), length=40).collect()
    got = [(r.doc_id, bytes(r.kept), r.n_bytes, r.n_removed, r.n_spans) for r in result]
    assert sorted(got, key=str) == brute_repeats(rows, 40)


def test_long_texts_are_scanned_in_pieces(spark, monkeypatch):
    rng = random.Random(5)
    rows = [(i, " ".join(words_of(rng, 300, 60))) for i in range(4)]
    rows.append((4, rows[0][1][100:900] + rows[1][1][50:700]))
    whole = {tuple(r) for r in repeats.drop_repeats(frame_of(spark, rows, parts=1), 40).collect()}
    data = np.frombuffer("".join(t for _, t in rows).encode(), np.uint8)
    offsets = np.cumsum([0] + [len(t) for _, t in rows])
    monkeypatch.setattr(repeats, "PIECE", 256)
    pieces = list(repeats.domains(data, offsets, 40))
    covered = sorted(
        (int(t), int(s) + k)
        for _, _, text, start, count in pieces
        for t, s, c in zip(text, start, count, strict=True)
        for k in range(int(c))
    )
    expected = [(i, s) for i, (_, t) in enumerate(rows) for s in range(len(t) - 39)]
    assert covered == expected
    assert {(r[0], bytes(r[1])) for r in whole} == {r[:2] for r in brute_repeats(rows, 40)}


def test_repeats_of_an_empty_table(spark):
    assert repeats.drop_repeats(frame_of(spark, []), 40).collect() == []
    with pytest.raises(ValueError):
        repeats.drop_repeats(frame_of(spark, []), 7)


def brute_similar(rows, similarity=0.8):
    """doc_id to (class, links), where a text is its sequence of words."""
    texts = defaultdict(set)
    for doc, text in rows:
        texts[tuple((text or "").split())].add(doc)
    sets = {
        t: {t[i : i + 5] for i in range(len(t) - 4)} if len(t) > 4 else {t} if t else set()
        for t in texts
    }
    links, parent = defaultdict(set), {d: d for d, _ in rows}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    def join(docs):
        roots = sorted({root(d) for d in docs})
        for other in roots[1:]:
            parent[other] = roots[0]

    for docs in texts.values():
        join(docs)
    for a in texts:
        for b in texts:
            if a < b and sets[a] and sets[b]:
                shared = len(sets[a] & sets[b])
                if shared >= similarity * (len(sets[a]) + len(sets[b]) - shared) - 1e-9:
                    links[a].add(b)
                    links[b].add(a)
                    join(texts[a] | texts[b])
    return {d: (root(d), len(links[t])) for t, docs in texts.items() for d in docs}


def similar_rows():
    rng = random.Random(11)
    rows, doc = [], 0
    for _ in range(12):
        base = words_of(rng, rng.randrange(30, 120))
        for _ in range(rng.randrange(1, 9)):
            text = list(base)
            for _ in range(rng.randrange(0, 4)):
                text[rng.randrange(len(text))] = f"new{rng.random()}"
            rows.append((doc, " ".join(text)))
            doc += 1
    base = words_of(rng, 100)
    for _ in range(40):
        text = list(base)
        text[rng.randrange(100)] = f"odd{rng.random()}"
        rows.append((doc, " ".join(text)))
        doc += 1
    rows += [(doc, rows[0][1]), (doc + 1, "  " + rows[0][1].replace(" ", "\n")), (doc + 2, "a b c")]
    rows += [(doc + 3, "a b c"), (doc + 4, "a b d"), (doc + 5, ""), (doc + 6, None), (doc + 7, " \t")]
    return rows


@pytest.mark.parametrize("block", [1024, 8])
def test_similar_texts_match_brute_force(spark, block):
    rows = similar_rows()
    frame = frame_of(spark, rows).withColumn("group", F.lit(1)).withColumn("node", F.lit("x"))
    result = forest.similar(frame, forest.Settings(block=block)).collect()
    assert {r.doc_id: (r.class_id, r.n_links) for r in result} == brute_similar(rows)
    assert len(result) == len(rows)


def test_similar_takes_repeated_and_null_ids(spark):
    text, other = " ".join(map(str, range(30))), " ".join(map(str, range(100, 130)))
    rows = [(1, text), (1, other), (2, other), (3, text), (None, text), (None, None), (4, "z")]
    result = {r.doc_id: r.class_id for r in forest.similar(frame_of(spark, rows)).collect()}
    assert result == {1: None, 2: None, 3: None, None: None, 4: 4}
    assert forest.similar(frame_of(spark, [])).collect() == []


def test_prefix_shortens_to_the_target_recall():
    assert forest.Settings(recall=0.5).prefix > forest.Settings().prefix
    settings = forest.Settings()
    assert 1 - (1 - 0.8**settings.prefix) ** settings.trees >= settings.recall


def test_components_of_paths_and_stars(spark):
    chain = [(i, i + 1) for i in range(60)] + [(100 + i, 100) for i in range(1, 40)] + [(7, 7)]
    result = components.components(spark.createDataFrame(chain, "a long, b long"))
    found = {r.node: r.component for r in result.collect()}
    assert found == {**{i: 0 for i in range(61)}, **{100 + i: 100 for i in range(40)}}
    assert components.components(spark.createDataFrame([], "a long, b long")).collect() == []


def least_edits(item, text):
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (a != b)))
        row = new
    return min(row)


def edited(rng, item, edits):
    item = list(item)
    for _ in range(edits):
        at, kind = rng.randrange(len(item)), rng.randrange(3)
        if kind == 0:
            item[at] = f"typo{rng.random()}"
        elif kind == 1:
            del item[at]
        else:
            item.insert(at, f"more{rng.random()}")
    return item


def benchmark_rows():
    rng = random.Random(17)
    items = [words_of(rng, n, 300) for n in (1, 2, 4, 6, 9, 12, 15, 20, 30, 45, 59, 80)]
    docs = []
    for number in range(160):
        text = words_of(rng, rng.randrange(20, 200), 300)
        if number % 4 < 3:
            item = items[number % len(items)]
            edits = (0, decontam.allowed(len(item)) // 2, decontam.allowed(len(item)) + 3)
            copy = edited(rng, item, edits[number % 4]) if len(item) > 2 else list(item)
            at = rng.randrange(len(text))
            text = [*text[:at], *[w.upper() + "," for w in copy], *text[at:]]
        docs.append((number, " ".join(text)))
    return docs, [(i, " ".join(item)) for i, item in enumerate(items)]


def test_search_finds_what_brute_force_finds(spark):
    docs, items = benchmark_rows()
    expected = {}
    for doc, text in docs:
        own = [w.lower().strip(",") for part in text.split() for w in part.replace(".", " ").split()]
        for item_id, item in items:
            item = [p for w in item.split() for p in w.replace(".", " ").split()]
            edits = least_edits(item, own)
            if edits <= decontam.allowed(len(item)):
                expected[doc, item_id] = edits
    docs += [(900, None), (901, ""), (902, "...")]
    items += [(50, None), (51, ""), (52, "?!")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    frame = frame_of(spark, docs).withColumn("key", F.lit(1)).withColumn("span", F.lit("x"))
    result = decontam.contaminated(frame, benchmark.withColumn("words", F.lit(1))).collect()
    found = {(r.doc_id, r.item_id): r.distance for r in result}
    assert len(found) == len(result)
    assert set(found) <= set(expected)
    assert all(found[k] >= expected[k] for k in found)
    assert len(found) >= 0.97 * len(expected)
    exact = {k for k, edits in expected.items() if edits == 0}
    assert exact <= set(found)


def test_search_takes_repeats_and_empty_tables(spark):
    item = " ".join(f"q{i}" for i in range(20))
    benchmark = spark.createDataFrame([(1, item), (1, item), (2, item)], "item_id long, text string")
    docs = frame_of(spark, [(5, item), (5, f"x {item}"), (None, item), (6, "q1 q2")])
    result = decontam.contaminated(docs, benchmark).collect()
    assert sorted((r.doc_id or 0, r.item_id, r.similarity) for r in result) == [
        (0, 1, 1.0), (0, 2, 1.0), (5, 1, 1.0), (5, 2, 1.0),
    ]
    assert decontam.contaminated(docs, benchmark.limit(0)).collect() == []
    assert decontam.contaminated(frame_of(spark, []), benchmark).collect() == []


def edited_between(rng, item, edits, low, high):
    """``item`` with its words of a range replaced, cut and added to, ``edits`` in all."""
    places = sorted(rng.sample(range(low, high), min(edits, high - low)), reverse=True)
    out = list(item)
    for at in places:
        kind = rng.randrange(3)
        out[at : at + 1] = [[f"typo{rng.getrandbits(40)}"], [], [out[at], f"more{rng.getrandbits(40)}"]][kind]
    return out


def test_search_finds_edits_at_the_limit_wherever_they_lie(spark):
    rng = random.Random(23)
    items = [words_of(rng, n, 5000) for n in (5, 9, 10, 16, 31, 59, 100, 127, 250)]
    docs, expected = [], {}
    for number, item in enumerate(items):
        n, edits = len(item), decontam.allowed(len(item))
        copies = [item[edits:], item[:-edits], item[: n // 2] + item[n // 2 + edits :]]
        copies += [[f"new{i}" for i in range(edits)] + item[edits:]]
        copies += [item[:-edits] + [f"new{i}" for i in range(edits)]]
        part = max(edits, n * 9 // 20)
        for low in (0, (n - part) // 2, n - part):
            copies += [edited_between(rng, item, edits, low, low + part) for _ in range(6)]
        copies += [edited_between(rng, item, edits, 0, n) for _ in range(6)]
        for copy in copies:
            around = [words_of(rng, rng.randrange(40), 5000) for _ in range(2)]
            text = [*around[0], *copy, *around[1]]
            own = [p for w in text for p in w.replace(".", " ").split()]
            least = least_edits(item, own)
            if least <= edits:
                expected[len(docs), number] = least
            docs.append((len(docs), " ".join(text)))
    assert len(expected) > 0.8 * len(docs)
    benchmark = [(i, " ".join(item)) for i, item in enumerate(items)]
    benchmark = spark.createDataFrame(benchmark, "item_id long, text string")
    result = decontam.contaminated(frame_of(spark, docs), benchmark).collect()
    found = {(r.doc_id, r.item_id): r.distance for r in result}
    assert found == expected


def test_search_equals_brute_force_on_phrases_that_items_share(spark):
    rng = random.Random(29)
    heading = words_of(rng, 8, 40)
    items = [heading + words_of(rng, rng.randrange(1, 40), 40) for _ in range(25)]
    items += [words_of(rng, n, 40) for n in (1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11)]
    docs = []
    for _ in range(60):
        item = rng.choice(items)
        copy = edited(rng, item, decontam.allowed(len(item)) + rng.randrange(2))
        copy = [w.replace(".", "") for w in copy]
        docs.append([*words_of(rng, 60, 40), *heading, *copy, *words_of(rng, 200, 40)])
    expected = {}
    for doc, text in enumerate(docs):
        for number, item in enumerate(items):
            least = least_edits(item, text)
            if least <= decontam.allowed(len(item)):
                expected[doc, number] = least
    benchmark = [(i, " ".join(item)) for i, item in enumerate(items)]
    benchmark = spark.createDataFrame(benchmark, "item_id long, text string")
    frame = frame_of(spark, [(i, " ".join(text)) for i, text in enumerate(docs)])
    result = decontam.contaminated(frame, benchmark).collect()
    assert {(r.doc_id, r.item_id): r.distance for r in result} == expected


@pytest.mark.parametrize("length", [7, 16, 37, 59])
def test_walks_reach_the_target_recall_at_every_placement(length):
    kind = walks.length_class(length)
    few, many = (walks.repeats_for(r, decontam.SIMILARITY, kind) for r in (0.9, decontam.RECALL))
    assert few < many
    for trial in walks.trials(kind, decontam.allowed, copies=30, repeats=many):
        assert trial.hits.any(axis=1).all(), trial.placement


def test_walks_that_differ_by_little_write_the_same_words():
    rng = np.random.default_rng(2)
    item = rng.integers(1, 1 << 62, 60, dtype=np.uint64)
    other = rng.integers(1, 1 << 62, 60, dtype=np.uint64)
    near = np.delete(item, 30)
    line, heads = walks.laid_out([item, near, other])
    agree = [walks.walked(line, r, 80, heads) for r in range(40)]
    same = np.mean([(s[:, 0] == s[:, 1]).mean() for s in agree])
    assert same > 0.7
    assert max((s[:, 0] == s[:, 2]).max() for s in agree) == 0


def test_pieces_cover_an_item_of_any_length():
    for length in (*range(1, 200), 1000, 50_000):
        parts = walks.pieces(length)
        assert [a for a, _ in parts] == [0, *[b for _, b in parts[:-1]]] and parts[-1][1] == length
        assert max(b - a for a, b in parts) <= walks.PIECE


def test_walks_find_what_the_exact_search_finds(spark):
    docs, items = benchmark_rows()
    rng = random.Random(31)
    items.append((99, " ".join(words_of(rng, 2500, 900))))
    long_item = items[-1][1].split()
    docs.append((500, " ".join(edited(rng, long_item, decontam.allowed(len(long_item)) // 3))))
    docs.append((501, " ".join([*words_of(rng, 3000, 900), *long_item[400:], "end"])))
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    both = [
        {tuple(r) for r in decontam.contaminated(frame_of(spark, docs), benchmark, recall=r).collect()}
        for r in (decontam.RECALL, 1)
    ]
    assert both[0] == both[1] and {(500, 99), (501, 99)} <= {r[:2] for r in both[0]}
