"""Spelling variants against a search over all pairs of words."""

import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.llm import spelling


def near(a, b):
    """Whether exactly one code point is inserted, deleted or replaced."""
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def plain_words(rows):
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'null' if doc is None else doc}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def plain_variants(rows):
    words = plain_words(rows)
    found, form = {}, {}
    for word, n in words.items():
        others = [o for o in words if near(word, o)]
        found[word] = len(others)
        best = min(others, key=lambda o: (-words[o], o), default=None)
        if best is not None and words[best] >= 2 * n:
            form[word] = best
    out = []
    for word, n in words.items():
        root = word
        while root in form:
            root = form[root]
        out.append((word, form.get(word), root, n, found[word], words.get(form.get(word))))
    return sorted(out)


def got(frame):
    columns = ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted(tuple(r) for r in frame.select(columns).collect())


def documents(spark, rows):
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    return frame.withColumns({"key": F.lit("x"), "word": F.lit(1), "n": F.lit("y")})


def typo(word, letters):
    i = random.randrange(len(word) + 1)
    kind = random.randrange(3)
    if kind == 0:
        return word[:i] + random.choice(letters) + word[i:]
    return word[:i] + (random.choice(letters) if kind == 1 else "") + word[i + 1 :]


@pytest.mark.parametrize("letters", ["abcé", "ab", "abcdefghijklmnopqrstuvwxyzÀßÿ×"])
def test_variants_equal_search_over_all_pairs(spark, letters):
    random.seed(len(letters))
    base = ["".join(random.choices(letters, k=random.randrange(5, 9))) for _ in range(40)]
    base += ["".join(random.choices(letters, k=n)) for n in (62, 63, 64, 65, 66, 300)]
    rows = [(None, None), (1, ""), (2, "Tiny WORDS a b c"), (2, "Tiny WORDS a b c")]
    for doc in range(260):
        words = random.choices(base, k=12)
        words += [typo(typo(w, letters), letters) for w in words] + [typo(w, letters) for w in words]
        words = [w.upper() if random.random() < 0.1 else w for w in words]
        rows.append((doc if doc % 3 else None, " 7".join(words)))
    rows += [(-5, rows[-1][1])] * 2
    assert got(spelling.variants(documents(spark, rows))) == plain_variants(rows)


def test_words_of_one_letter_and_of_great_length(spark):
    long = "ab" * 3000
    words = ["aaaaa", "aaaaaa", "aaaaab", long, long[1:], long + "c", "é" * 64, "é" * 65]
    rows = [(i, " ".join(w for k, w in enumerate(words) if i < 3 + 4 * k)) for i in range(40)]
    assert got(spelling.variants(documents(spark, rows))) == plain_variants(rows)


def test_empty_table(spark):
    assert got(spelling.variants(documents(spark, []))) == []


def test_pivots_share_no_letter_and_cost_least():
    order = {a + b: (ord(a) * 31 + ord(b) * 17) % 97 for a in "abc" for b in "abc"}
    random.seed(1)
    for _ in range(500):
        word = "".join(random.choices("abc", k=random.randrange(5, 12)))
        last, pivots, prefix = spelling.signature(word, order)
        ranks = [order[word[i : i + 2]] for i in range(len(word) - 1)]
        assert prefix == [i for i, r in enumerate(ranks) if r <= sorted(ranks)[2]] and last in ranks
        pairs = [(i, j) for i in prefix for j in prefix if j >= i + 2]
        assert sum(ranks[p] for p in pivots) == min(ranks[i] + ranks[j] for i, j in pairs)
        assert pivots[1] - pivots[0] >= 2
