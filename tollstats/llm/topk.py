"""Exact top-k search that rules rows out by statistics of their segments.

A vector is cut into 1, 4, 16 and 32 segments of equal length, and each segment
keeps its mean and deviation. For two vectors q and x with segments of length m

    |q - x|^2 >= sum over segments of m ((mean_q - mean_x)^2 + (dev_q - dev_x)^2),

and as |q - x|^2 = |q|^2 + |x|^2 - 2 q.x, the lower bound of the distance is an
upper bound of the inner product: the sum of m (mean_q mean_x + dev_q dev_x).
Finer segments bound more tightly. Rows that a level cannot rule out go to the
next, and only those that all levels leave are scored exactly.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tollstats.llm.blocked import AT_ONCE, block_numbers, block_of, in_order, largest, matrices, meet, usable_vectors
from tollstats.llm.shipping import ship_package
from tollstats.llm.staging import checkpointed, staged

NEAREST = 5
SCALE = 256.0
LEVELS = (1, 4, 16, 32)
# Rounding of a bound, as a share of the product of both lengths.
ROUNDING = 1e-9
# From this share of pairs left downward single pairs are bounded and scored, above it all of a block.
SPARSE = 1 / 16
# Whole numbers below this are exact in double precision.
EXACT = 2.0**53
PAIRS_AT_ONCE = 1 << 17
# Rows scored at each level to raise the threshold, in multiples of k.
PROMISING = 8
FOUND = "query_id long, vec_id long, score long"


def statistics(x: np.ndarray, segments: int) -> np.ndarray:
    """Means and deviations of the segments, scaled so that the product of two rows bounds theirs."""
    width = -(-max(x.shape[1], 1) // segments)
    padded = np.zeros((len(x), segments * width))
    padded[:, : x.shape[1]] = x
    parts = padded.reshape(len(x), segments, width)
    return np.sqrt(width) * np.concatenate([parts.mean(axis=2), parts.std(axis=2)], axis=1)


def pair_products(queries: np.ndarray, rows: np.ndarray, q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Row by row products of the pairs (q, x)."""
    found = [np.zeros(0, dtype=queries.dtype)]
    for at in range(0, len(q), PAIRS_AT_ONCE):
        part = slice(at, at + PAIRS_AT_ONCE)
        found.append(np.einsum("ij,ij->i", queries[q[part]], rows[x[part]]))
    return np.concatenate(found)


class Block:
    """Rows with their statistics, ready to be asked."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray):
        self.rows, self.ids = rows, ids
        self.levels = [statistics(rows, n) for n in LEVELS]
        self.longest = float(np.sqrt((rows**2).sum(axis=1)).max(initial=0.0))
        self.scored = 0

    def largest_product(self, queries: np.ndarray) -> float:
        """No sum of products exceeds this."""
        largest = float(np.abs(queries).max(initial=0.0)) * float(np.abs(self.rows).max(initial=0.0))
        return largest * self.rows.shape[1]

    def exact(self, queries: np.ndarray, q: np.ndarray, x: np.ndarray) -> np.ndarray:
        """Scores as whole numbers; in Python's integers where doubles would round."""
        self.scored += len(q)
        if self.largest_product(queries) < EXACT:
            return pair_products(queries, self.rows, q, x).astype(np.int64)
        whole = [[[int(c) for c in v] for v in side] for side in (queries[q], self.rows[x])]
        return np.array([sum(a * b for a, b in zip(u, v)) for u, v in zip(*whole)], dtype=np.int64)

    def best(self, queries: np.ndarray, own: np.ndarray, least: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, row, score) of the k best rows of each query that reach ``least``."""
        alive = own[:, None] != self.ids[None, :]
        slack = 1.0 + ROUNDING * np.sqrt((queries**2).sum(axis=1)) * self.longest
        least = least.astype(float)
        for n, statistic in zip(LEVELS, self.levels):
            asked = statistics(queries, n)
            if alive.sum() > SPARSE * alive.size:
                bound = np.where(alive, asked @ statistic.T, -np.inf)
            else:
                bound = np.full(alive.shape, -np.inf)
                q, x = np.nonzero(alive)
                bound[q, x] = pair_products(asked, statistic, q, x)
            # Some of the most promising rows, scored, tell what the k-th best reaches at least.
            tried = min(PROMISING * k, alive.shape[1])
            if tried >= k:
                promising = np.argpartition(-bound, tried - 1, axis=1)[:, :tried]
                q = np.repeat(np.arange(len(queries)), tried)
                scores = self.exact(queries, q, promising.ravel()).astype(float).reshape(-1, tried)
                scores[~np.take_along_axis(alive, promising, axis=1)] = -np.inf
                least = np.maximum(least, np.partition(scores, -k, axis=1)[:, -k])
            alive &= bound + slack[:, None] >= least[:, None]
        if alive.sum() > SPARSE * alive.size and self.largest_product(queries) < EXACT:
            self.scored += int(alive.sum())
            scores = (queries @ self.rows.T).astype(np.int64)
            q, x = largest(scores, alive, self.ids, k)
            return q, x, scores[q, x]
        q, x = np.nonzero(alive)
        scores = self.exact(queries, q, x)
        order = in_order(q, self.ids[x], scores, k)
        return q[order], x[order], scores[order]


def search_block(queries: pd.DataFrame, rows: pd.DataFrame, k: int, scale: float) -> pd.DataFrame:
    found = [pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64")]
    if len(queries) and len(rows):
        asked, held = matrices(queries["vector"], rows["vector"], scale)
        block = Block(held, rows["vec_id"].to_numpy())
        ids, least = queries["vec_id"].to_numpy(), queries["least"].fillna(-np.inf).to_numpy(dtype=float)
        for at in range(0, len(asked), AT_ONCE):
            part = slice(at, at + AT_ONCE)
            q, x, score = block.best(asked[part], ids[part], least[part], k)
            found.append(pd.DataFrame({"query_id": ids[part][q], "vec_id": block.ids[x], "score": score}))
    return pd.concat(found)


def exact_top_k(vectors: DataFrame, asks: Column, k: int = NEAREST, scale: float = SCALE) -> DataFrame:
    """query_id, rank (from 1), vec_id and score of the k best rows of every query row.

    ``vectors`` needs vec_id and embedding; ``asks`` is the condition of the
    query rows, on vec_id. The score is the inner product of the whole numbers
    floor(scale x component); higher is better, ties go to the smaller vec_id,
    and a query's own row is no candidate. With fewer than k candidates all come
    back. Which rows take part, and what stands for a repeated id, is said in
    ``usable_vectors``; shorter vectors go on with zeros, so an empty one scores
    0. Further columns are ignored; an empty table gives an empty result.

    One block of rows is searched first. The k-th best score found there rules
    out rows of all other blocks before they are scored or sent on.
    """
    spark = vectors.sparkSession
    ship_package(spark)
    usable = staged(usable_vectors(vectors, scale), "vectors")
    row_blocks, query_blocks = block_numbers(usable, asks)
    rows = usable.withColumn("row_block", block_of(row_blocks))
    queries = usable.where(asks)

    def searched(asked: DataFrame, blocks: list[int]) -> DataFrame:
        return meet(asked, rows, blocks, query_blocks, lambda q, x: search_block(q, x, k, scale), FOUND)

    first = checkpointed(searched(queries.withColumn("least", F.lit(None).cast("double")), [0]))
    reached = first.groupBy(F.col("query_id").alias("vec_id")).agg(
        F.when(F.count("*") >= k, F.min("score").cast("double")).alias("least")
    )
    others = searched(queries.join(reached, "vec_id", "left"), list(range(1, row_blocks)))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        first.unionByName(others)
        .withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
