"""Quality scores from trusted positives and unlabelled text."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import features
from tidemark.llm.common import saved

HELD_OUT = 1
MODULUS = 3
THRESHOLD = 0.5
MAX_POSITIVE = 10_000
# Unlabelled documents that the weights start from; the steps after read every document.
START_UNLABELLED = 20_000
STEPS = 12
STEP_RATE = 0.02
ROWS = 2048
BINS = 12
EPOCHS = 400
RATE = 0.05
DECAY = 1e-4


def edge_shares(bins: int = BINS) -> list[float]:
    """Which quantiles of a feature are edges of its bins."""
    steps = np.linspace(0, 1, bins + 1)[1:-1]
    # The ends matter most: junk is rare, so half of the steps go to the outer tenths.
    return np.sort(np.r_[steps, 0.01, 0.03, 0.05, 0.95, 0.97, 0.99]).tolist()


def bin_edges(scored: DataFrame) -> np.ndarray:
    """Quantiles of every feature over all rows: one row of edges per feature."""
    shares = edge_shares()
    found = scored.agg(
        *[
            F.percentile_approx(F.get("features", F.lit(i)), shares, 10_000).alias(f"f{i}")
            for i in range(len(features.SHAPE))
        ]
    ).first()
    return np.array([row if row is not None else [0.0] * len(shares) for row in found])


def expanded(matrix: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """For every edge whether a feature is above it, and a constant."""
    above = matrix[:, :, None] > edges[None]
    flat = above.reshape(len(matrix), -1).astype(np.float64)
    return np.hstack([flat, np.ones((len(matrix), 1))])


def _sigmoid(values: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(values, -40, 40)))


def _followed(weights, moments, step: int, gradient: np.ndarray, rate: float) -> np.ndarray:
    """The weights after a step of Adam; ``moments`` are changed in place."""
    mean, square = moments
    gradient = gradient + DECAY * weights
    mean[:] = 0.9 * mean + 0.1 * gradient
    square[:] = 0.999 * square + 0.001 * gradient**2
    scaled = (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    return weights - rate * scaled


def sums(wide: np.ndarray, weights: np.ndarray) -> tuple[float, np.ndarray]:
    """Loss of calling the rows negative, and the gradient of it, summed over the rows."""
    at = _sigmoid(wide @ weights)
    return float(-np.log(np.maximum(1 - at, 1e-12)).sum()), wide.T @ at


def risk_gradient(
    prior: float,
    positive: tuple[int, float, np.ndarray],
    unlabelled: tuple[int, float, np.ndarray],
    ones: np.ndarray,
) -> np.ndarray:
    """Gradient of the non-negative unbiased risk from (rows, `sums`) of both kinds.

    The risk is prior * R(positive, +) + max(0, R(unlabelled, -) - prior * R(positive, -)). Where
    the second part is below zero, its gradient is followed upwards instead. ``ones`` is the sum
    of the positive rows.
    """
    (n_p, loss_p, pull_p), (n_u, loss_u, pull_u) = positive, unlabelled
    toward = prior * (pull_p - ones) / n_p
    away = pull_u / n_u - prior * pull_p / n_p
    return toward + away if loss_u / n_u - prior * loss_p / n_p >= 0 else -away


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float) -> np.ndarray:
    """Weights that minimise the non-negative unbiased risk of the rows with the logistic loss."""
    weights = np.zeros(positive.shape[1])
    moments = np.zeros((2, len(weights)))
    ones = positive.sum(axis=0)
    for step in range(1, EPOCHS + 1):
        gradient = risk_gradient(
            prior,
            (len(positive), *sums(positive, weights)),
            (len(unlabelled), *sums(unlabelled, weights)),
            ones,
        )
        weights = _followed(weights, moments, step, gradient, RATE)
    return weights


def _fit_rows(prior: float, edges: np.ndarray):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        is_positive = rows["is_positive"].to_numpy()
        wide = expanded(np.array(rows["features"].tolist()), edges)
        weights = fit(wide[is_positive], wide[~is_positive], prior)
        return pd.DataFrame({"weights": [weights.tolist()]})

    return run


def _partition_sums(weights: np.ndarray, edges: np.ndarray):
    """One row per partition and kind: rows, loss, and the sums `risk_gradient` is made of."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = {}
        for batch in batches:
            kinds = batch.column("is_positive").to_numpy(zero_copy_only=False)
            matrix = batch.column("features").flatten().to_numpy().reshape(len(kinds), -1)
            for first in range(0, len(kinds), ROWS):
                part, wide = kinds[first : first + ROWS], expanded(matrix[first : first + ROWS], edges)
                for kind in (False, True):
                    own = wide[part == kind]
                    if not len(own):
                        continue
                    loss, pull = sums(own, weights)
                    n, so_far, pulled, ones = total.get(kind, (0, 0.0, 0.0, 0.0))
                    total[kind] = (n + len(own), so_far + loss, pulled + pull, ones + own.sum(axis=0))
        if total:
            columns = [list(total), *zip(*total.values(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(columns[0], pa.bool_()),
                    pa.array(columns[1], pa.int64()),
                    pa.array(columns[2], pa.float64()),
                    pa.array(columns[3], pa.list_(pa.float64())),
                    pa.array(columns[4], pa.list_(pa.float64())),
                ],
                ["is_positive", "n", "loss", "pull", "ones"],
            )

    return run


_SUMS = "is_positive boolean, n long, loss double, pull array<double>, ones array<double>"


def _all_sums(rows: DataFrame, weights: np.ndarray, edges: np.ndarray) -> dict:
    """The sums of all partitions, added up in Spark: two rows of one weight's size come back."""

    def added(name: str):
        total = F.array(*[F.sum(F.get(name, F.lit(i))) for i in range(len(weights))])
        return total.alias(name)

    parts = rows.mapInArrow(_partition_sums(weights, edges), _SUMS)
    found = parts.groupBy("is_positive").agg(
        F.sum("n").alias("n"), F.sum("loss").alias("loss"), added("pull"), added("ones")
    )
    return {
        r["is_positive"]: (r["n"], r["loss"], np.array(r["pull"]), np.array(r["ones"]))
        for r in found.collect()
    }


def refined(
    rows: DataFrame, weights: np.ndarray, edges: np.ndarray, prior: float, steps: int = STEPS
) -> np.ndarray:
    """``weights`` after steps down the risk of all ``rows`` (features, is_positive)."""
    moments = np.zeros((2, len(weights)))
    for step in range(1, steps + 1):
        found = _all_sums(rows, weights, edges)
        (*positive, ones), (*unlabelled, _) = found[True], found[False]
        gradient = risk_gradient(prior, tuple(positive), tuple(unlabelled), ones)
        weights = _followed(weights, moments, step, gradient, STEP_RATE)
    return weights


def estimate_prior(labels: DataFrame) -> float:
    """Share of good documents among the labelled ones that may be learned from, smoothed."""
    row = labels.agg(F.count("*").alias("n"), F.sum("quality").alias("good")).first()
    return ((row["good"] or 0) + 1.0) / (row["n"] + 2.0)


def score(
    documents: DataFrame,
    labels: DataFrame,
    max_positive: int = MAX_POSITIVE,
    start_unlabelled: int = START_UNLABELLED,
) -> DataFrame:
    """doc_id, held_out, score and predicted, one row per document.

    The positives are at most ``max_positive`` documents labelled good outside the held-out part,
    by the smallest hash of the id; the unlabelled text is all documents. Labels of bad documents
    serve only to estimate the prior. The model is additive over binned features of the whole
    texts, which are computed once and written; bins are cut at quantiles over all documents. The
    weights start from a fit in one task, on the positives and ``start_unlabelled`` documents;
    then STEPS steps follow the gradient of the risk over all documents, summed by partition.

    NULL and empty texts get the features of no words. Labels that are NULL or name no document
    are ignored. Without a positive or an unlabelled document every score is the prior (0.5
    without labels). Documents listed twice get a row each; rows without doc_id are scored.
    """
    held_out = features.crc_part(MODULUS) == HELD_OUT
    known = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out)
    prior = estimate_prior(known)
    positives = features.bounded_sample(known.where("quality = 1").select("doc_id"), max_positive)
    scored = features.by_text(documents, ["doc_id"], features.text_features)
    scored = saved(scored, "quality-features")
    positive = scored.join(F.broadcast(positives), "doc_id")
    # Documents that repeat an id do not lengthen the sample.
    positive = features.bounded_sample(positive, max_positive).withColumn("is_positive", F.lit(True))
    unlabelled = features.bounded_sample(scored, start_unlabelled)
    unlabelled = unlabelled.withColumn("is_positive", F.lit(False))
    positive = saved(positive.select("features", "is_positive"), "quality-positive")
    rows = positive.unionByName(unlabelled.select("features", "is_positive"))
    rows = saved(rows, "quality-start")
    if rows.select("is_positive").distinct().count() < 2:
        result = scored.withColumn("score", F.lit(prior))
    else:
        edges = bin_edges(scored)
        start = rows.withColumn("all", F.lit(1)).groupBy("all").applyInPandas(
            _fit_rows(prior, edges), "weights array<double>"
        )
        weights = np.array(start.first()["weights"])
        everything = scored.select("features", F.lit(False).alias("is_positive"))
        weights = refined(everything.unionByName(positive), weights, edges, prior)
        result = _scored(scored, edges, weights)
    return result.select(
        "doc_id",
        held_out.alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def _scored(frame: DataFrame, edges: np.ndarray, weights: np.ndarray) -> DataFrame:
    @F.pandas_udf("double")
    def probability(column: pd.Series) -> pd.Series:
        if not len(column):
            return pd.Series([], dtype=float)
        return pd.Series(_sigmoid(expanded(np.array(column.tolist()), edges) @ weights))

    return frame.withColumn("score", probability("features"))
