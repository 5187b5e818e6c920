"""Hard negatives by exact scores from a residue number system.

Vectors of whole numbers are reduced modulo several small primes. The residues
are multiplied as float32 matrices, whose sums stay below 2^24 and are exact,
and the signed scores come back by Chinese remaindering. A first pass finds the
positives of each anchor, a second the rows of other labels in the window that
each positive's score opens.
"""

from __future__ import annotations

from math import isqrt, prod

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tollstats.llm.blocked import AT_ONCE, block_numbers, block_of, largest, matrices, meet, usable_vectors
from tollstats.llm.shipping import ship_package
from tollstats.llm.staging import checkpointed, staged

POSITIVES, NEGATIVES = 5, 10
# A negative's score lies between these percentages of the positive's.
LOW, HIGH = 30, 90
SCALE = 256.0
# Residues of primes below this lie within 511 of 0.
PRIMES_BELOW = 1024
FLOAT32_EXACT = 1 << 24

POSITIVE = "anchor_id long, positive_id long, positive_score long"
NEGATIVE = f"{POSITIVE}, negative_id long, negative_score long"


def primes_below(n: int) -> list[int]:
    """Largest first."""
    return [p for p in range(n - 1, 1, -1) if all(p % d for d in range(2, isqrt(p) + 1))]


def moduli(bound: float) -> list[int]:
    """As many primes as tell apart all whole numbers from -bound to bound."""
    wanted, chosen = 2 * int(bound) + 2, []
    for p in primes_below(PRIMES_BELOW):
        if prod(chosen) > wanted:
            break
        chosen.append(p)
    return chosen


def balanced(x: np.ndarray, p: int) -> np.ndarray:
    """The residues of x modulo p that lie nearest to 0."""
    r = np.mod(x, p)
    return np.where(r > p // 2, r - p, r)


def residue_products(left: np.ndarray, right: np.ndarray, p: int) -> np.ndarray:
    """left x right^T modulo p, in float32 slices that no sum makes inexact."""
    a, b = balanced(left, p).astype(np.float32), balanced(right, p).astype(np.float32)
    slice_width = FLOAT32_EXACT // (p // 2) ** 2
    total = np.zeros((len(a), len(b)), dtype=np.int64)
    for at in range(0, a.shape[1], slice_width):
        total += (a[:, at : at + slice_width] @ b[:, at : at + slice_width].T).astype(np.int64)
    return balanced(total, p)


def reconstructed(residues: list[np.ndarray], primes: list[int]) -> np.ndarray:
    """The signed numbers with these residues, by balanced mixed-radix digits.

    Each digit is found modulo its prime from the digits before it. The sum wraps
    around in 64 bits, which leaves every result that fits them right.
    """
    digits: list[np.ndarray] = []
    weights = [prod(primes[:i]) for i in range(len(primes))]
    for residue, p, weight in zip(residues, primes, weights):
        known = sum((d * (w % p) for d, w in zip(digits, weights)), np.zeros_like(residue))
        digits.append(balanced((residue - known) % p * pow(weight, -1, p), p))
    total = np.zeros_like(residues[0])
    for digit, weight in zip(digits, weights):
        total += digit * np.uint64(weight % 2**64).astype(np.int64)
    return total


def exact_products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """left x right^T for matrices of whole numbers, as long integers."""

    def longest(side: np.ndarray) -> float:
        return float(np.sqrt((side**2).sum(axis=1)).max(initial=0.0))

    primes = moduli(1.000001 * longest(left) * longest(right))
    return reconstructed([residue_products(left, right, p) for p in primes], primes)


def _chunks(asked: pd.DataFrame, rows: pd.DataFrame, scale: float):
    """(queries, their scores with all rows) a few queries at a time."""
    if len(asked) and len(rows):
        left, right = matrices(asked["vector"], rows["vector"], scale)
        for at in range(0, len(asked), AT_ONCE):
            part = slice(at, at + AT_ONCE)
            yield asked[part], exact_products(left[part], right)


def positives_in(anchors: pd.DataFrame, rows: pd.DataFrame, k: int, scale: float) -> pd.DataFrame:
    found = [pd.DataFrame({"anchor_id": [], "positive_id": [], "positive_score": []}, dtype="int64")]
    ids, labels = rows["vec_id"].to_numpy(), rows["label"].to_numpy()
    for asked, scores in _chunks(anchors, rows, scale):
        own = asked["vec_id"].to_numpy()
        same = (asked["label"].to_numpy()[:, None] == labels[None, :]) & (own[:, None] != ids[None, :])
        row, column = largest(scores, same, ids, k)
        found.append(pd.DataFrame({"anchor_id": own[row], "positive_id": ids[column], "positive_score": scores[row, column]}))
    return pd.concat(found)


def negatives_in(anchors: pd.DataFrame, rows: pd.DataFrame, k: int, low: int, high: int, scale: float) -> pd.DataFrame:
    """The k first rows of other labels in the window of each positive; ``anchors`` holds arrays of positives."""
    names = [field.split(" ")[0] for field in NEGATIVE.split(", ")]
    found = [pd.DataFrame(dict.fromkeys(names, []), dtype="int64")]
    ids, labels = rows["vec_id"].to_numpy(), rows["label"].to_numpy()
    for asked, scores in _chunks(anchors, rows, scale):
        own = asked["vec_id"].to_numpy()
        other = asked["label"].to_numpy()[:, None] != labels[None, :]
        for place in range(max(len(p) for p in asked["positives"])):
            having = [i for i, p in enumerate(asked["positives"]) if len(p) > place]
            positive = [asked["positives"].iloc[i][place] for i in having]
            at = np.array([int(p["positive_score"]) for p in positive], dtype=np.int64)
            # low x positive <= 100 x negative <= high x positive, without leaving 64 bits.
            least = np.array([-(-low * s // 100) for s in at.tolist()], dtype=np.int64)
            most = np.array([high * s // 100 for s in at.tolist()], dtype=np.int64)
            seen = scores[having]
            inside = other[having] & (seen >= least[:, None]) & (seen <= most[:, None])
            row, column = largest(seen, inside, ids, k)
            positive_ids = np.array([int(p["positive_id"]) for p in positive], dtype=np.int64)
            columns = [own[having][row], positive_ids[row], at[row], ids[column], seen[row, column]]
            found.append(pd.DataFrame(dict(zip(names, columns))))
    return pd.concat(found)


def hard_negatives(
    vectors: DataFrame,
    anchors: Column,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    scale: float = SCALE,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id and both scores.

    ``vectors`` needs vec_id, embedding and label; ``anchors`` is the condition
    of the anchor rows, on vec_id. Scores are inner products of floor(scale x
    component); higher ones come first, ties by smaller vec_id. An anchor's
    positives are its first ``positives`` other rows of its label, and for each
    of them come back its first ``negatives`` rows of other labels whose score
    is from ``low`` to ``high`` per cent of the positive's. An anchor without
    other rows of its label, and a positive without such negatives, give none;
    nor does a positive with a score below 0, whose window is empty.

    Rows without a label take no part, nor do those that ``usable_vectors``
    leaves out, which also says what stands for a repeated id. Shorter vectors
    go on with zeros. Further columns are ignored; an empty table gives an
    empty result. Rows are dealt to blocks by id, so a label with most of the
    rows is spread over all of them.
    """
    spark = vectors.sparkSession
    ship_package(spark)
    usable = staged(usable_vectors(vectors.where(F.col("label").isNotNull()), scale, "label"), "vectors")
    row_blocks, query_blocks = block_numbers(usable, anchors)
    rows = usable.withColumn("row_block", block_of(row_blocks))
    asked, blocks = usable.where(anchors), list(range(row_blocks))
    near = meet(asked, rows, blocks, query_blocks, lambda q, x: positives_in(q, x, positives, scale), POSITIVE)
    best = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    kept = near.withColumn("place", F.row_number().over(best)).where(F.col("place") <= positives)
    # At most ``positives`` entries an anchor.
    listed = checkpointed(
        kept.groupBy(F.col("anchor_id").alias("vec_id")).agg(
            F.collect_list(F.struct("positive_id", "positive_score")).alias("positives")
        )
    )
    hard = meet(
        asked.join(listed, "vec_id"),
        rows,
        blocks,
        query_blocks,
        lambda q, x: negatives_in(q, x, negatives, low, high, scale),
        NEGATIVE,
    )
    first = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    return (
        hard.withColumn("rank", F.row_number().over(first))
        .where(F.col("rank") <= negatives)
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    )
