"""Line dedup, quality rules and mixing against plain Python."""

import hashlib
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tidemark.llm import lines, mixing, rules

SPACE = "\x20\x09\x0a\x0b\x0c\x0d"
LONG = "A line that is long enough to be a key of forty"
KIND = "doc_id long, text string, source string"


def documents(spark, rows):
    return spark.createDataFrame([(d, t, s) for d, t, s in rows], KIND)


def key_of(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(SPACE))


def plain_lines(rows):
    holders = defaultdict(set)
    for doc, text, _ in rows:
        for line in (text or "").split("\n"):
            holders[key_of(line)].add(doc)
    out = []
    for doc, text, _ in rows:
        all_lines = (text or "").split("\n")

        def gone(line, doc=doc):
            key = key_of(line)
            known = [d for d in holders[key] if d is not None]
            return len(key) >= 40 and len(holders[key]) >= 5 and (doc is None or doc < max(known))

        kept = [line for line in all_lines if not gone(line)]
        out.append((doc, len(all_lines), len(all_lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


LINE_ROWS = [
    (1, f"{LONG}\nown one\n\t{LONG.upper()} ", "a"),
    (2, f"{LONG.lower()}\n\n{LONG}", "a"),
    (3, f"x\n{LONG}\x0b", "b"),
    (4, LONG, "b"),
    (5, f"{LONG}\nlast\n{LONG}", None),
    (6, "", "a"),
    (7, None, "a"),
    (8, "short\n" * 200 + "É" * 39, "c"),
    (9, "É" * 40, "c"),
    (10, "é" * 40, "c"),
    (11, "\n".join(["É" * 40] * 130), "c"),
    (12, "É" * 40 + "\r", "c"),
    (13, "É" * 40, "c"),
    (14, " " + "É" * 40, "c"),
]


def test_lines_match_plain_python(spark):
    result = lines.drop_lines(documents(spark, LINE_ROWS)).collect()
    got = [(r.doc_id, r.n_lines, r.n_dropped, r.text or "") for r in result]
    assert sorted(got, key=str) == plain_lines(LINE_ROWS)


def test_null_and_repeated_ids_count_as_one_document(spark):
    rows = [(None, LONG, "a"), (None, f"{LONG}\nrest", "a"), (1, LONG, "a"), (1, LONG, "a")]
    rows += [(2, LONG, "a"), (3, LONG, "a")]
    result = lines.drop_lines(documents(spark, rows)).orderBy("doc_id").collect()
    # Five documents: none, 1, 2 and 3 make four, so nothing goes.
    assert {r.n_dropped for r in result} == {0}
    result = lines.drop_lines(documents(spark, [*rows, (4, LONG, "a")])).collect()
    assert sorted((r.doc_id or 0, r.n_dropped) for r in result) == [
        (0, 1), (0, 1), (1, 1), (1, 1), (2, 1), (3, 1), (4, 0),
    ]


def test_rows_of_one_id_lose_only_their_own_lines(spark):
    rows = [(None, f"{LONG}\nown", "a"), (None, f"own\nx\n{LONG}", "a"), (None, "own\nx", "a")]
    rows += [(1, f"{LONG}\nfirst", "a"), (1, f"second\nthird\n{LONG}", "a"), (1, "fourth", "a")]
    rows += [(i, LONG, "a") for i in range(2, 6)]
    result = lines.drop_lines(documents(spark, rows)).collect()
    got = [(r.doc_id, r.n_lines, r.n_dropped, r.text or "") for r in result]
    assert sorted(got, key=str) == plain_lines(rows)


def test_line_columns_may_clash(spark):
    frame = documents(spark, LINE_ROWS)
    for name in ("bitmap", "stay", "lines", "row", "n_lines", "h1", "of"):
        frame = frame.withColumn(name, F.lit("kept"))
    result = lines.drop_lines(frame)
    assert result.columns.count("n_lines") == 1
    assert {r.bitmap for r in result.collect()} == {"kept"}
    got = [(r.doc_id, r.n_lines, r.n_dropped, r.text or "") for r in result.collect()]
    assert sorted(got, key=str) == plain_lines(LINE_ROWS)


def test_bitmaps_are_sparse(spark):
    bitmaps = {r.doc_id: r.bitmap for r in lines.keep_bitmaps(documents(spark, LINE_ROWS)).collect()}
    assert 5 not in bitmaps and 8 not in bitmaps
    assert [(w["word"], w["bits"]) for w in bitmaps[1]] == [(0, 0b101)]
    assert sum(bin(w["bits"] & (2**64 - 1)).count("1") for w in bitmaps[11]) == 130


def plain_measures(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    starts = defaultdict(list)
    for i in range(len(words) - 7):
        starts[tuple(words[i : i + 8])].append(i)
    covered = {i + k for at in starts.values() if len(at) > 1 for i in at for k in range(8)}
    full = [line for line in text.split("\n") if line.strip(SPACE)]
    symbols = sum(c in "#*$%&|<>" for c in text)
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    return (
        len(words), sum(map(len, words)), symbols, len(full) - len(set(full)), len(covered), failed,
    )


RULE_TEXTS = [
    None, "", " \n\t", "word", "a b c d e f g h " * 5, "é ü " * 30,
    " ".join(f"w{i}" for i in range(25)) + "\nsame #line|\nsame #line|\n same #line|",
    " ".join(f"w{i % 9}" for i in range(60)), "x" * 5000 + " " + " ".join(map(str, range(3000))),
    "a b " * 25, " ".join(f"v{i}" for i in range(19)), " ".join(f"v{i}" for i in range(20)),
]


def test_measures_match_plain_python(spark):
    rows = [(i, t, "s") for i, t in enumerate(RULE_TEXTS)]
    result = rules.measures(documents(spark, rows)).drop("source").orderBy("doc_id").collect()
    assert [tuple(r)[1:] for r in result] == [plain_measures(t) for t in RULE_TEXTS]


def test_hosts_reject_their_documents(spark):
    good = " ".join(f"w{i}" for i in range(30))
    rows = [(i, "bad", "junk") for i in range(400)] + [(1000, good, "junk")]
    rows += [(2000 + i, good, f"host{i % 7}") for i in range(140)] + [(3000, good, None)]
    rows += [(4000 + i, "bad", f"host{i % 7}") for i in range(14)] + [(5000, "bad", "once")]
    judged = {r.doc_id: r for r in rules.quality_rules(documents(spark, rows)).collect()}
    assert not judged[1000].base_failed and not judged[1000].kept
    assert judged[3000].kept and all(judged[2000 + i].kept for i in range(140))
    assert not any(judged[i].kept for i in range(400))
    assert len(judged) == len(rows)


def plain_rejected(hosts):
    """Names of bad hosts from {name: (documents, failed)}."""
    rates = {h: x / n for h, (n, x) in hosts.items()}
    mean = sum(rates.values()) / len(rates)
    noise = sum(1 / n for n, _ in hosts.values()) / len(hosts)
    variance = sum((r - mean) ** 2 for r in rates.values()) / max(len(rates) - 1, 1)
    if noise >= 1 or variance - mean * (1 - mean) * noise <= 1e-12 * (1 - noise):
        return set()
    strength = max(mean * (1 - mean) * (1 - noise) / (variance - mean * (1 - mean) * noise) - 1, 0)
    out = set()
    for host, (n, x) in hosts.items():
        a, b = x + mean * strength, n - x + (1 - mean) * strength
        deviation = (a * b / ((a + b) ** 2 * (a + b + 1))) ** 0.5
        if a / (a + b) - 3 * deviation > max(0.5, mean):
            out.add(host)
    return out


HOSTS = [
    {**{f"clean{i}": (20, i % 2) for i in range(50)}, "junk": (100, 80)},
    {**{f"clean{i}": (20, 1) for i in range(30)}, "half": (100, 55), "few": (2, 2), "one": (1, 1)},
    {f"h{i}": (1, i % 2) for i in range(40)},
    {"alone": (60, 45)},
    {f"same{i}": (40, 30) for i in range(9)},
]


@pytest.mark.parametrize("hosts", HOSTS)
def test_a_bad_host_loses_its_good_documents_and_others_stay_whole(spark, hosts):
    good = " ".join(f"w{i}" for i in range(30))
    rows = [
        (k * 1000 + i, "bad" if i < failed else good, host)
        for k, (host, (n, failed)) in enumerate(hosts.items())
        for i in range(n)
    ]
    gone = plain_rejected(hosts)
    assert gone == ({"junk"} if "junk" in hosts else set())
    expected = {i for i, text, host in rows if text == good and host not in gone}
    judged = rules.quality_rules(documents(spark, rows)).where("kept").collect()
    assert {r.doc_id for r in judged} == expected
    assert {r.doc_id for r in rules.passing(documents(spark, rows)).collect()} == expected


def test_rules_take_ties_and_clashing_columns(spark):
    rows = [(1, "bad", "s"), (1, "bad", "s"), (None, None, None)]
    frame = documents(spark, rows).withColumn("n_words", F.lit(7)).withColumn("rate", F.lit(1))
    result = rules.quality_rules(frame.withColumn("words", F.lit("x")))
    assert result.count() == 3 and result.where("kept").count() == 0


def source_words(rows):
    out = defaultdict(int)
    for _, text, source in rows:
        out[source] += len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    return out


def plain_targets(rows):
    sizes = source_words(rows)
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode())
    order += [None] if None in sizes else []
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(order)}
    capped, total = set(), sum(sizes.values())
    while True:
        left = total - sum(3 * sizes[s] for s in capped)
        open_weight = sum(weight[s] for s in order if s not in capped)
        share = {s: left * weight[s] / open_weight for s in order if s not in capped}
        over = {s for s in share if share[s] >= 3 * sizes[s]}
        if not over:
            return {s: 3.0 * sizes[s] if s in capped else share[s] for s in order}
        capped |= over


def mix_rows():
    names = ["b", "a", "é", "", None, "Z", "tiny"]
    rows = [(i, " ".join(["w"] * (i * 7 % 50 + 1)), names[i % 6]) for i in range(900)]
    return [*rows, (900, "one two", "tiny"), (901, None, "a"), (902, " ", "b")]


def test_mix_reaches_targets(spark):
    rows = mix_rows()
    result = mixing.mix(documents(spark, rows), block=16).collect()
    assert sorted(r.doc_id for r in result) == list(range(903))
    by_id = {d: s for d, _, s in rows}
    targets, taken = plain_targets(rows), defaultdict(int)
    for r in result:
        assert r.target == pytest.approx(targets[by_id[r.doc_id]])
        assert r.source_size == source_words(rows)[by_id[r.doc_id]]
        assert 0 <= r.taken <= 3 * r.size and r.taken == r.copies * r.size
        taken[by_id[r.doc_id]] += r.taken
    for source, target in targets.items():
        assert abs(taken[source] - target) <= 50, source


def test_mix_does_not_depend_on_partitions(spark):
    frame = documents(spark, mix_rows())
    one = {tuple(r) for r in mixing.mix(frame.repartition(7), block=16).collect()}
    two = {tuple(r) for r in mixing.mix(frame.coalesce(1), block=16).collect()}
    assert one == two


def test_mix_takes_nulls_ties_and_empty_tables(spark):
    rows = [(None, "a b", None)] * 3 + [(1, "a b c", "s")] * 3 + [(2, None, "s")]
    result = mixing.mix(documents(spark, rows).withColumn("rank", F.lit(1))).collect()
    assert sorted((r.doc_id or 0, r.size) for r in result) == [(0, 2)] * 3 + [(1, 3)] * 3 + [(2, 0)]
    assert mixing.mix(documents(spark, rows[:0])).collect() == []
    blank = mixing.mix(documents(spark, [(1, "", "a"), (2, None, "b")])).collect()
    assert [(r.size, r.target, r.taken) for r in blank] == [(0, 0.0, 0)] * 2


def test_empty_tables(spark):
    empty = documents(spark, [])
    assert lines.drop_lines(empty).collect() == []
    assert rules.quality_rules(empty).collect() == []


def test_kept_text_digest(spark):
    result = lines.drop_lines(documents(spark, LINE_ROWS)).select(
        "doc_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("digest")
    )
    expected = {d: hashlib.sha256(t.encode()).hexdigest() for d, _, _, t in plain_lines(LINE_ROWS)}
    assert {r.doc_id: r.digest for r in result.collect()} == expected
