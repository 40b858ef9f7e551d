"""The operators' queries against their SQL twins, and the pipeline stage by stage."""

import functools
import re
from collections import defaultdict

import compare
import pytest
from conftest import SMALL
from test_line_rules import plain_lines, plain_measures, plain_rejected, plain_targets
from test_search import brute_similar, least_edits

import __spark_entry__ as registry
import corpus_pipeline
from pyspark.sql import functions as F
from tidemark.llm import decontam, rules
from tidemark.llm.common import saved, table
from tidemark.llm.oracle import ORACLE
from tidemark.llm.queries import QUERIES


def test_queries_are_registered():
    assert set(QUERIES) | {"pipeline"} <= set(registry.queries())
    assert {name.split("_")[0] for name in QUERIES} == {f"op{n}" for n in range(1, 14)}
    assert "pipeline" not in registry.oracle_sql() and set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_as_sql(spark, name):
    duck = compare.connect(SMALL)
    assert compare.difference(QUERIES[name](spark, SMALL), duck, ORACLE[name]) is None


def terms(text):
    text = "".join(c.lower() if c < "\x80" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D!-/:-@\[-`{-~]+", text)


def test_stages_match_brute_force(spark):
    """Each stage on its own input, over the smallest tables."""
    docs = table(spark, SMALL, "documents")
    before = {r.doc_id: r for r in docs.collect()}
    names = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    assert len(stages) == 5

    docs = saved(stages["quality rules"](spark, docs, SMALL), "test")
    assert docs.columns == names
    failed = {d for d, r in before.items() if plain_measures(r.text)[-1]}
    by_host = defaultdict(list)
    for doc, row in before.items():
        by_host[row.source].append(doc in failed)
    gone = plain_rejected({h: (len(f), sum(f)) for h, f in by_host.items() if h is not None})
    rest = {d for d, r in before.items() if d not in failed and r.source not in gone}
    assert {r.doc_id for r in docs.collect()} == rest

    rows = sorted((r.doc_id, r.text, r.source) for r in docs.collect())
    docs = saved(stages["line dedup"](spark, docs, SMALL), "test")
    assert docs.columns == names
    cleaned = {r.doc_id: r for r in docs.collect()}
    assert {d: r.text for d, r in cleaned.items()} == {d: t for d, _, _, t in plain_lines(rows)}
    assert all(len(r.text) == r.n_chars for r in cleaned.values())

    docs = saved(stages["n-gram Jaccard join"](spark, docs, SMALL), "test")
    assert docs.columns == names
    plain = {d: " ".join(re.findall(r"[^\x20\x09-\x0D]+", r.text)) for d, r in cleaned.items()}
    classes = brute_similar(list(plain.items()))
    kept = {r.doc_id for r in docs.collect()}
    assert kept == {d for d, (root, _) in classes.items() if root == d}

    docs = saved(stages["benchmark decontamination"](spark, docs, SMALL), "test")
    assert docs.columns == names
    items = [terms(r.text) for r in table(spark, SMALL, "benchmark").collect()]
    grams = [{tuple(i[k : k + 3]) for k in range(len(i) - 2)} for i in items]
    held = set()
    for doc in kept:
        own = terms(cleaned[doc].text)
        own_grams = {tuple(own[k : k + 3]) for k in range(len(own) - 2)}
        for item, item_grams in zip(items, grams, strict=True):
            if item_grams & own_grams and least_edits(item, own) <= decontam.allowed(len(item)):
                held.add(doc)
    assert {r.doc_id for r in docs.collect()} == kept - held

    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    mixed = stages["mixing sources to target weights"](spark, docs, SMALL).collect()
    source_of = {d: s for d, _, s in rows}
    targets, taken = plain_targets(rows), defaultdict(int)
    for row in mixed:
        assert row.copies > 0 and row.taken == row.copies * row.size <= 3 * row.size
        assert row.text == cleaned[row.doc_id].text
        taken[source_of[row.doc_id]] += row.taken
    largest = max(row.size for row in mixed)
    assert all(abs(taken[s] - t) <= largest for s, t in targets.items())


def test_pipeline_runs_its_stages(spark):
    result = registry.queries()["pipeline"](spark, SMALL)
    assert {"doc_id", "text", "copies", "taken"} <= set(result.columns)
    assert result.count() > 0


def test_stages_judge_rows_without_an_id_or_with_a_shared_one(spark):
    """A verdict on one row leaves the other rows of its id, or without one, alone."""
    stages = dict(corpus_pipeline.STAGES)
    ids = (None, None, 7, 7)
    kind = "doc_id long, text string, lang string, source string, n_chars long"

    def after(name, rows):
        frame = spark.createDataFrame([(d, t, "en", "s", len(t)) for d, t in rows], kind)
        result = stages[name](spark, frame, SMALL)
        assert result.columns == frame.columns
        return sorted(((r.doc_id, r.text) for r in result.collect()), key=str)

    own = [" ".join(f"{name}{i}" for i in range(40)) for name in "abcd"]
    good = list(zip(ids, own, strict=True))
    short = [(None, "too short"), (7, "short too")]
    assert after("quality rules", good + short) == sorted(good, key=str)

    item = table(spark, SMALL, "benchmark").orderBy("item_id").first().text
    held = [(None, f"x {item}"), (7, f"y {item} z")]
    assert after("benchmark decontamination", good + held) == sorted(good, key=str)

    near = [(d, t + " more") for d, t in good]
    copies = [(None, own[0]), (3, own[1]), (None, own[3]), (7, own[2])]
    found = after("n-gram Jaccard join", good + near + copies)
    assert len(found) == 4 and {t[:2] for _, t in found} == {"a0", "b0", "c0", "d0"}
    assert {t[:2]: d for d, t in found} == {"a0": None, "b0": 3, "c0": 7, "d0": 7}

    line = "A line that five documents without an id have in common"
    rows = [(None, "\n" * i + f"{line}\nown {i}") for i in range(5)] + [(9, f"own\n{line}")]
    expected = [(None, "\n" * i + f"own {i}") for i in range(5)] + [rows[-1]]
    assert after("line dedup", rows) == sorted(expected, key=str)


def test_stages_pass_clashing_columns_on_and_take_empty_tables(spark):
    docs = table(spark, SMALL, "documents")
    mine = ["row", "k1", "n_lines", "n_dropped", "_key", "words", "base_failed", "class_id", "bitmap"]
    docs = docs.withColumns({name: F.lit(f"mine {name}") for name in mine})
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), SMALL).count() == 0, name
        result = saved(stage(spark, docs, SMALL), "test")
        assert result.columns[: len(docs.columns)] == docs.columns
        same = [F.col(c) == f"mine {c}" for c in mine]
        assert result.count() == result.where(functools.reduce(lambda a, b: a & b, same)).count() > 0
    docs = docs.withColumns({"size": F.lit("mine"), "copies": F.lit("mine")})
    assert corpus_pipeline.mixture(spark, docs, SMALL).where("copies > 0 AND size > 0").count() > 0
