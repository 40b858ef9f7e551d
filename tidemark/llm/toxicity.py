"""Toxicity scores: boosted trees over dense features, with isotonic calibration."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import features, words
from tidemark.llm.common import saved

HELD_OUT = 2
MODULUS = 4
THRESHOLD = 0.3
MAX_LABELLED = 20_000
MAX_TERMS = 4096
MIN_TOXIC = 5
MIN_LIFT = 30.0
TREES = 20
DEPTH = 3


def _term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents by term and label; each chunk of texts is added up before it is sent."""
    for batch in batches:
        labels = batch.column("toxic").to_numpy(zero_copy_only=False)
        for first, last, data, offsets in words.chunks(batch.column("text")):
            folded, starts, ends, owner = words.words(data, offsets, words.TERMS)
            if not len(starts):
                continue
            label = labels[first:last]
            terms = features.term_hashes(folded, starts, ends)
            term, text = np.concatenate(list(terms.values())), np.tile(owner, len(terms))
            order = np.lexsort((text, term))
            term, text = term[order], text[order]
            fresh = np.ones(len(term), bool)
            fresh[1:] = (term[1:] != term[:-1]) | (text[1:] != text[:-1])
            term, toxic = term[fresh], label[text[fresh]].astype(np.int64)
            heads = np.flatnonzero(np.r_[True, term[1:] != term[:-1]])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(term[heads].view(np.int64)),
                    pa.array(np.add.reduceat(toxic, heads)),
                    pa.array(np.add.reduceat(1 - toxic, heads)),
                ],
                ["term", "toxic", "clean"],
            )


def learn_lexicon(labelled: DataFrame, most: int = MAX_TERMS) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes and weights of the terms that mark toxic texts, at most ``most`` of them."""
    totals = labelled.groupBy("toxic").count().collect()
    sizes = {row["toxic"]: row["count"] for row in totals}
    n_toxic, n_clean = sizes.get(1, 0), sizes.get(0, 0)
    if not n_toxic or not n_clean:
        return np.empty(0, np.uint64), np.empty(0)
    counted = labelled.select("text", "toxic").mapInArrow(
        _term_counts, "term long, toxic long, clean long"
    )
    counted = counted.groupBy("term").agg(
        F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")
    )
    lift = (F.col("toxic") / n_toxic) / ((F.col("clean") + 0.1) / n_clean)
    marked = counted.where((F.col("toxic") >= MIN_TOXIC) & (lift >= MIN_LIFT))
    best = marked.withColumn("weight", F.log(lift) * F.log1p("toxic"))
    rows = best.orderBy(F.desc("weight"), "term").limit(most).collect()
    keys = np.array([row["term"] for row in rows], dtype=np.int64).view(np.uint64)
    weights = np.array([row["weight"] for row in rows], dtype=float)
    order = np.argsort(keys)
    return keys[order], weights[order]


def score(
    documents: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED
) -> DataFrame:
    """doc_id, held_out, score and predicted, one row per document.

    At most ``max_labelled`` labelled documents outside the held-out part are learned from, those
    with the smallest hash of their id. Two fifths give the lexicon, two fifths train the
    trees, one fifth calibrates them, so no stage is fitted on what the one before it has seen.
    The features of all whole texts are computed once and written; the model reads those.

    NULL and empty texts get the features of no words and are scored like others. Labels that are
    NULL are not learned from; if the sample lacks one of the two labels, every score is the share
    of label 1 in it (0 without labels). Labels of ids that ``documents`` lacks are ignored, a
    document listed twice gets a row each. Rows without doc_id are scored and never learned from.
    """
    held_out = features.crc_part(MODULUS) == HELD_OUT
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out)
    known = known.select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    sample = features.bounded_sample(known, max_labelled)
    sample = features.with_texts(sample, documents, "toxic-sample")
    fold = F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(5))
    lexicon = learn_lexicon(sample.where(fold < 2))
    spread = documents.select("doc_id", "text")
    scored = features.by_text(
        spread, ["doc_id"], lambda data, at: features.text_features(data, at, lexicon)
    )
    scored = saved(scored, "toxic-features").withColumn("features", array_to_vector("features"))
    fitted = features.by_text(
        sample, ["doc_id", "toxic"], lambda data, at: features.text_features(data, at, lexicon)
    )
    fitted = fitted.withColumn("features", array_to_vector("features"))
    fitted = saved(fitted.withColumn("fold", fold), "toxic-fitted")
    result = _model(fitted, scored)
    return result.select(
        "doc_id",
        held_out.alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def _model(fitted: DataFrame, scored: DataFrame) -> DataFrame:
    """Adds ``score`` to ``scored``."""
    parts = {
        (row["trees"], row["toxic"]): row["count"]
        for row in fitted.groupBy((F.col("fold") < 4).alias("trees"), "toxic").count().collect()
    }
    if any(parts.get((part, label), 0) == 0 for part in (True, False) for label in (0, 1)):
        total = sum(parts.values())
        share = sum(n for (_, label), n in parts.items() if label == 1) / total if total else 0.0
        return scored.withColumn("score", F.lit(float(share)))
    trees = GBTClassifier(
        labelCol="toxic", maxDepth=DEPTH, maxIter=TREES, stepSize=0.2, maxBins=64, seed=7
    ).fit(fitted.where("fold IN (2, 3)"))

    def raw(frame: DataFrame) -> DataFrame:
        probability = F.get(vector_to_array("probability"), 1)
        return trees.transform(frame).withColumn("raw", probability)

    calibrated = IsotonicRegression(
        featuresCol="raw", labelCol="toxic", predictionCol="level"
    ).fit(raw(fitted.where("fold = 4")))
    # The small share of the raw score keeps the order inside a level of the step function.
    blend = 0.98 * F.col("level") + 0.02 * F.col("raw")
    return calibrated.transform(raw(scored)).withColumn("score", blend)
