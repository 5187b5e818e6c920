"""Document quality by naive Bayes support vectors.

Indicators of n-grams are scaled by the classes' log-count ratio, and a linear
hinge-loss model on the scaled indicators is fitted by dual coordinate descent.
Its margin becomes a probability by a logistic curve fitted on labelled
documents that the descent did not see.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tollstats.llm.shipping import ship_package
from tollstats.llm.staging import checkpointed
from tollstats.llm.tokens import BASE, mix, word_hashes

# At most this many labelled documents are fitted on, chosen by a hash of their id.
FIT_ROWS = 8000
FEATURE_BITS = 20
FOLDS = 5
CUT = 0.3
SMOOTHING = 1.0
COST = 1.0
EPOCHS = 10
CALIBRATION_SHARE = 5  # every fifth fitted document serves the curve only
TEXT_BLOCK = 1 << 18

_MASK = np.uint64((1 << FEATURE_BITS) - 1)


class QualityModel(NamedTuple):
    """score = 1 / (1 + exp(-(slope * margin + offset))), margin = mean-scaled weights + bias."""

    weights: np.ndarray
    bias: float
    slope: float
    offset: float


def _distinct(ids: np.ndarray, mark: np.ndarray) -> np.ndarray:
    """Each id once: every id keeps the last of its places."""
    places = np.arange(len(ids), dtype=np.int32)
    mark[ids] = places
    return ids[mark[ids] == places]


def indicators(text: str | None, mark: np.ndarray) -> np.ndarray:
    """Feature numbers present in a text: words, pairs of words, and runs of three bytes.

    ``mark`` is scratch space of one int32 per feature.
    """
    raw = np.frombuffer((text or "").encode(), dtype=np.uint8)
    words = word_hashes(raw.tobytes())
    found = [mix(words) & _MASK, mix(words[:-1] * np.uint64(BASE) + words[1:]) & _MASK]
    for at in range(0, max(len(raw) - 2, 0), TEXT_BLOCK):
        block = raw[at : at + TEXT_BLOCK + 2].astype(np.uint64)
        runs = block[:-2] << np.uint64(16) | block[1:-1] << np.uint64(8) | block[2:]
        found.append(_distinct((mix(runs) & _MASK).astype(np.int32), mark))
    return _distinct(np.concatenate(found).astype(np.int32), mark)


def log_count_ratio(rows: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    """log of (share of a feature in class 1) / (share in class 0), smoothed."""
    shares = []
    for label in (1, 0):
        counts = np.full(1 << FEATURE_BITS, SMOOTHING)
        for ids, own in zip(rows, labels):
            if own == label:
                counts[ids] += 1
        shares.append(counts / counts.sum())
    return np.log(shares[0] / shares[1]).astype(np.float32)


def dual_descent(
    rows: list[np.ndarray], labels: np.ndarray, ratio: np.ndarray, cost: float, epochs: int, seed: int
) -> tuple[np.ndarray, float]:
    """Weights and bias of the hinge-loss model on ratio-scaled indicators of unit mean square."""
    signs = np.where(labels == 1, 1.0, -1.0)
    values = [ratio[ids] / np.float32(np.sqrt(max(len(ids), 1))) for ids in rows]
    norms = np.array([float(v @ v) + 1.0 for v in values])
    weights, bias = np.zeros(len(ratio), dtype=np.float32), 0.0
    alphas = np.zeros(len(rows))
    random = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in random.permutation(len(rows)):
            ids, value = rows[i], values[i]
            gradient = signs[i] * (float(weights[ids] @ value) + bias) - 1.0
            alpha = min(max(alphas[i] - gradient / norms[i], 0.0), cost)
            change = (alpha - alphas[i]) * signs[i]
            if change:
                weights[ids] += np.float32(change) * value
                bias += change
                alphas[i] = alpha
    return weights, bias


def logistic_curve(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the probability of label 1, by Newton steps on smoothed targets."""
    ones, zeros = float((labels == 1).sum()), float((labels == 0).sum())
    target = np.where(labels == 1, (ones + 1) / (ones + 2), 1 / (zeros + 2))
    point = np.array([1.0, np.log((ones + 1) / (zeros + 1))])
    inputs = np.stack([margins, np.ones_like(margins)], axis=1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(inputs @ point, -30, 30)))
        gradient = inputs.T @ (p - target) + 1e-3 * point
        hessian = (inputs * (p * (1 - p))[:, None]).T @ inputs + 1e-3 * np.eye(2)
        point = point - np.linalg.solve(hessian, gradient)
    return max(float(point[0]), 0.0), float(point[1])


def fit(rows: list[np.ndarray], labels: np.ndarray, seed: int = 1234) -> QualityModel:
    """The model of labelled indicator rows; with one class or none, the smoothed share of label 1."""
    curve = np.arange(len(rows)) % CALIBRATION_SHARE == 0
    fitted = [ids for ids, held in zip(rows, curve) if not held]
    own = labels[~curve]
    if len(set(own.tolist())) < 2:
        share = (float((labels == 1).sum()) + 1) / (len(labels) + 2)
        return QualityModel(
            np.zeros(1 << FEATURE_BITS, dtype=np.float32), 0.0, 0.0, float(np.log(share / (1 - share)))
        )
    ratio = log_count_ratio(fitted, own)
    weights, bias = dual_descent(fitted, own, ratio, COST, EPOCHS, seed)
    scaled = weights * ratio
    margins = np.array([_margin(ids, scaled, bias) for ids, held in zip(rows, curve) if held])
    slope, offset = logistic_curve(margins, labels[curve])
    return QualityModel(scaled, bias, slope, offset)


def _margin(ids: np.ndarray, scaled: np.ndarray, bias: float) -> float:
    return float(scaled[ids].sum(dtype=np.float64) / np.sqrt(max(len(ids), 1))) + bias


def held_out(doc_id: Column) -> Column:
    """True for the fold kept for measuring; a null id is in no fold."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == 0, F.lit(False))


def fit_quality(documents: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> QualityModel:
    """Fit on at most ``rows`` labelled documents outside the held-out fold.

    An id labelled both ways counts as 0. The sample is taken among the
    labelled ids that have a document: those with the smallest hashes. Of an id
    with several texts one is fitted on, that of the smallest hash. The
    executors turn the sampled texts into feature numbers, and those, ``rows``
    at most, come to the driver.
    """
    ship_package(documents.sparkSession)
    labelled = (
        labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1))
        .where(~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"))
    )
    place, text_hash = F.xxhash64("doc_id"), F.xxhash64(F.coalesce("text", F.lit("")))
    present = documents.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min(text_hash).alias("chosen"))
    known = checkpointed(labelled.join(present, "doc_id").withColumn("place", place))
    # Of n even hashes about so many lie below the limit: enough of them, and few more.
    share = min(1.0, (rows + 6 * rows**0.5) / max(known.count(), 1))
    limit = int(-(2**63) + share * (2**64 - 1))
    sample = known.where(F.col("place") <= min(limit, 2**63 - 1)).orderBy("place", "doc_id").limit(rows)

    def features(batches):
        mark = np.zeros(1 << FEATURE_BITS, dtype=np.int32)
        for batch in batches:
            ids = [np.sort(indicators(t, mark)).tobytes() for t in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "quality": batch["quality"], "ids": ids})

    # The sample has at most `rows` rows of three numbers.
    texts = documents.select("doc_id", "text").join(F.broadcast(sample.drop("place")), "doc_id").where(text_hash == F.col("chosen"))
    once = texts.groupBy("doc_id", "quality").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"))
    found = once.mapInPandas(features, "doc_id long, quality int, ids binary").collect()
    found.sort(key=lambda r: r["doc_id"])
    numbers = [np.frombuffer(r["ids"], dtype=np.int32) for r in found]
    return fit(numbers, np.array([r["quality"] for r in found], dtype=np.int64))


def score_column(spark: SparkSession, model: QualityModel, text: Column) -> Column:
    """Probability of label 1 of whole texts."""
    ship_package(spark)
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(batches: pd.Series) -> pd.Series:
        m = shared.value
        mark = np.zeros(1 << FEATURE_BITS, dtype=np.int32)
        margins = np.array([_margin(indicators(t, mark), m.weights, m.bias) for t in batches])
        return pd.Series(1 / (1 + np.exp(-np.clip(m.slope * margins + m.offset, -30, 30))))

    return score(text)


def score_quality(
    documents: DataFrame, labels: DataFrame, rows: int = FIT_ROWS, cut: float = CUT
) -> DataFrame:
    """The documents with held_out, score and predicted (1 from ``cut`` upward).

    Columns of these names that the documents have already are replaced. A null
    or empty text scores by the model's bias; repeated rows score alike; empty
    documents give an empty result, and without labels of both classes every
    document gets the same score.
    """
    model = fit_quality(documents, labels, rows)
    scored = documents.withColumn("held_out", held_out(F.col("doc_id"))).withColumn(
        "score", score_column(documents.sparkSession, model, F.col("text"))
    )
    return scored.withColumn("predicted", F.when(F.col("score") >= cut, 1).otherwise(0))


def accepted_documents(
    documents: DataFrame, labels: DataFrame, rows: int = FIT_ROWS, cut: float = CUT
) -> DataFrame:
    """The documents that ``score_quality`` would predict as 1, with their own columns."""
    model = fit_quality(documents, labels, rows)
    return documents.where(score_column(documents.sparkSession, model, F.col("text")) >= cut)
