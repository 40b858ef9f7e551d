"""Toxicity and quality scores: held-out accuracy and odd inputs."""

import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import features, pulearn, toxicity, words
from tidemark.llm.common import table

FOLDER = "/root/testdata/sf0.01"


def auc(truth, score):
    order = np.argsort(score, kind="stable")
    rank = np.empty(len(score))
    values, inverse, counts = np.unique(score[order], return_inverse=True, return_counts=True)
    rank[order] = (np.cumsum(counts) - (counts - 1) / 2)[inverse]
    good = truth == 1
    return (rank[good].sum() - good.sum() * (good.sum() + 1) / 2) / (good.sum() * (~good).sum())


@pytest.mark.parametrize(
    ("model", "label", "modulus", "part", "least"),
    [(toxicity, "toxic", 4, 2, 0.85), (pulearn, "quality", 3, 1, 0.95)],
)
def test_held_out_documents_are_told_apart(spark, model, label, modulus, part, least):
    documents, labels = table(spark, FOLDER, "documents"), table(spark, FOLDER, "labels")
    result = model.score(documents, labels).toPandas()
    assert len(result) == documents.count()
    out = [zlib.crc32(str(d).encode()) % modulus == part for d in result["doc_id"]]
    assert result["held_out"].tolist() == out
    assert result["score"].between(0, 1).all()
    assert (result["predicted"] == (result["score"] >= model.THRESHOLD)).all()
    known = result.merge(labels.toPandas(), on="doc_id")
    known = known[known["held_out"]]
    assert auc(known[label].to_numpy(), known["score"].to_numpy()) > least


@pytest.mark.parametrize(("model", "label"), [(toxicity, "toxic"), (pulearn, "quality")])
def test_held_out_labels_do_not_matter(spark, model, label):
    documents, labels = table(spark, FOLDER, "documents"), table(spark, FOLDER, "labels")
    out = features.crc_part(model.MODULUS) == model.HELD_OUT
    turned = labels.withColumn(label, F.when(out, 1 - F.col(label)).otherwise(F.col(label)))
    first = {r.doc_id: r.score for r in model.score(documents, labels).collect()}
    second = {r.doc_id: r.score for r in model.score(documents, turned).collect()}
    assert first == pytest.approx(second, abs=1e-9)


@pytest.mark.parametrize(("model", "label"), [(toxicity, "toxic"), (pulearn, "quality")])
def test_models_take_odd_tables(spark, model, label):
    rows = [(1, None), (2, ""), (3, " \n"), (None, "some text"), (4, "word " * 3000), (4, "twice")]
    documents = spark.createDataFrame(rows, "doc_id long, text string")
    documents = documents.withColumn("features", F.lit(1)).withColumn("score", F.lit("x"))
    labels = spark.createDataFrame(
        [(1, None), (2, 1), (3, 0), (9, 1), (None, 1)], f"doc_id long, {label} int"
    )
    result = model.score(documents, labels).collect()
    assert len(result) == len(rows) and all(0 <= r.score <= 1 for r in result)
    assert len(model.score(documents, labels.limit(0)).collect()) == len(rows)
    assert model.score(documents.limit(0), labels).collect() == []


def test_words_do_not_cross_texts():
    texts = ["One two", None, "", "two", "\ttwo\n", "ONE"]
    import pyarrow as pa

    ((_, _, data, offsets),) = words.chunks(pa.array(texts))
    folded, starts, ends, owner = words.words(data, offsets, words.TERMS)
    hashes = words.span_hashes(words.prefix_hashes(folded), starts, ends)
    assert owner.tolist() == [0, 0, 3, 4, 5]
    assert hashes[1] == hashes[2] == hashes[3] and hashes[0] == hashes[4] != hashes[1]


def test_risk_is_minimised_with_an_estimated_prior():
    rng = np.random.default_rng(0)
    truth = rng.random(4000) < 0.6
    unlabelled = np.column_stack([rng.normal(np.where(truth, 1.5, -1.5)), np.ones(4000)])
    positive = np.column_stack([rng.normal(1.5, size=1000), np.ones(1000)])
    weights = pulearn.fit(positive, unlabelled, 0.6)
    assert np.mean((unlabelled @ weights > 0) == truth) > 0.9


def test_second_person_and_obfuscation_are_measured():
    import pyarrow as pa

    ((_, _, data, offsets),) = words.chunks(pa.array(["you w0rd", "a*b c", "plain", ""]))
    rows = features.text_features(data, offsets)
    named = {n: rows[:, i].tolist() for i, n in enumerate(features.SHAPE)}
    assert named["second_person"] == [0.5, 0, 0, 0]
    assert named["odd_words"] == [0.5, 0, 0, 0]
    assert named["masked_letters"][1] > 0 and named["masked_letters"][0] == 0
    assert rows[3].tolist() == [0.0] * len(features.SHAPE)


def plain_risk(positive, unlabelled, weights, prior):
    """The unbiased risk, row by row, without and with the bound at zero of its second part."""

    def loss(rows, sign):
        return sum(math.log1p(math.exp(-sign * float(r @ weights))) for r in rows) / len(rows)

    rest = loss(unlabelled, -1) - prior * loss(positive, -1)
    return prior * loss(positive, 1) + rest, rest


@pytest.mark.parametrize("prior", [0.3, 0.95])
def test_risk_gradient_is_the_slope_of_the_risk(prior):
    rng = np.random.default_rng(4)
    positive, unlabelled = rng.normal(1, 1, (40, 5)), rng.normal(0, 1, (60, 5))
    for _ in range(6):
        weights = rng.normal(0, 1.5, 5)
        gradient = pulearn.risk_gradient(
            prior,
            (40, *pulearn.sums(positive, weights)),
            (60, *pulearn.sums(unlabelled, weights)),
            positive.sum(axis=0),
        )
        risk, rest = plain_risk(positive, unlabelled, weights, prior)
        for i in range(5):
            step = np.eye(5)[i] * 1e-6
            there, rest_there = plain_risk(positive, unlabelled, weights + step, prior)
            slope = (there - risk) / 1e-6 if rest >= 0 else -(rest_there - rest) / 1e-6
            assert gradient[i] == pytest.approx(slope, abs=1e-4)


def test_sums_over_partitions_are_the_sums_over_all_rows(spark):
    rng = np.random.default_rng(8)
    n = len(features.SHAPE)
    matrix, kinds = rng.normal(0, 1, (500, n)), rng.random(500) < 0.2
    edges = np.sort(rng.normal(0, 1, (n, 3)), axis=1)
    weights = rng.normal(0, 0.3, 3 * n + 1)
    rows = [(m.tolist(), bool(k)) for m, k in zip(matrix, kinds, strict=True)]
    frame = spark.createDataFrame(rows, "features array<double>, is_positive boolean")
    found = pulearn._all_sums(frame.repartition(7), weights, edges)
    for kind in (False, True):
        wide = pulearn.expanded(matrix[kinds == kind], edges)
        loss, pull = pulearn.sums(wide, weights)
        rows, total, pulled, ones = found[kind]
        assert rows == len(wide) and total == pytest.approx(loss)
        assert pulled == pytest.approx(pull) and ones == pytest.approx(wide.sum(axis=0))
    one = pulearn.refined(frame.coalesce(1), weights, edges, 0.6, steps=2)
    many = pulearn.refined(frame.repartition(5), weights, edges, 0.6, steps=2)
    assert one == pytest.approx(many) and not np.allclose(one, weights)


def test_edges_are_quantiles_over_all_rows(spark):
    n = len(features.SHAPE)
    frame = spark.range(20_001).select(
        F.array(*[F.col("id").cast("double") * (i + 1) for i in range(n)]).alias("features")
    )
    edges = pulearn.bin_edges(frame)
    expected = np.array(pulearn.edge_shares()) * 20_000
    for i in range(n):
        assert edges[i] == pytest.approx(expected * (i + 1), abs=3 * (i + 1))


def test_positive_unlabelled_learning_tells_a_known_mixture_apart():
    rng = np.random.default_rng(5)
    good, bad = rng.normal(1.5, 1, (1500, 3)), rng.normal(-1.5, 1, (500, 3))
    wide = [np.c_[m, np.ones(len(m))] for m in (good[:500], np.r_[good[500:], bad])]
    weights = pulearn.fit(*wide, prior=2 / 3)
    assert ((wide[1] @ weights > 0) == (np.arange(1500) < 1000)).mean() > 0.95
