"""A stated set of query rows against all rows of a table of vectors, block against block."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Rows and queries that meet in one task at most. Few of them are cut further,
# down to so many rows, until there are blocks for every core.
ROWS, QUERIES, LEAST_ROWS, CELLS_PER_CORE = 16384, 2048, 1024, 4
AT_ONCE = 128
# Inner products with each other and with themselves stay below this.
LIMIT = 2.0**62


def usable_vectors(vectors: DataFrame, scale: float, *others: str) -> DataFrame:
    """vec_id, vector and the ``others``, one row per id, of the rows that take part.

    Rows whose id, vector or a component is null, or not finite, are left out,
    and rows that a 64-bit score could not hold: those whose scaled vector has
    a squared length of 2^62 or more. Of a repeated id the smallest row stays.
    """
    x = F.col("embedding")
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) != float("inf")))
    scaled = F.aggregate(
        x, F.lit(0.0), lambda total, c: total + F.pow(F.floor(c.cast("double") * scale).cast("double"), F.lit(2.0))
    )
    rows = vectors.where(F.col("vec_id").isNotNull() & x.isNotNull() & finite).where(scaled < LIMIT)
    kept = F.min(F.struct(x.alias("vector"), *others)).alias("kept")
    return rows.groupBy(F.col("vec_id").cast("bigint").alias("vec_id")).agg(kept).select("vec_id", "kept.*")


def block_numbers(rows: DataFrame, asks: Column) -> tuple[int, int]:
    """Into how many blocks the rows and the queries among them are cut."""
    n = rows.agg(F.count("*").alias("rows"), F.count_if(asks).alias("queries")).first()
    query_blocks = max(1, -(-n["queries"] // QUERIES))
    wanted = CELLS_PER_CORE * rows.sparkSession.sparkContext.defaultParallelism
    finest = max(1, -(-n["rows"] // LEAST_ROWS))
    return max(-(-n["rows"] // ROWS), min(finest, -(-wanted // query_blocks)), 1), query_blocks


def block_of(blocks: int) -> Column:
    return F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")


def meet(
    queries: DataFrame,
    rows: DataFrame,
    row_blocks: list[int],
    query_blocks: int,
    compare: Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame],
    schema: str,
) -> DataFrame:
    """``compare`` on every block of queries with each of the ``row_blocks``.

    ``rows`` carries its block as ``row_block``. Both sides name a vector as
    vec_id and vector; ids are dealt to blocks by hash, so blocks are even
    whatever the vectors and labels are.
    """
    spark = rows.sparkSession
    cell = F.col("row_block") * query_blocks + F.col("query_block")
    blocks = F.array(*[F.lit(b) for b in row_blocks]).cast("array<int>")
    held = rows.withColumn("query_block", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))))
    sent = queries.withColumn("query_block", block_of(query_blocks)).withColumn("row_block", F.explode(blocks))
    if not row_blocks:
        return spark.createDataFrame([], schema)

    def side(frame: DataFrame):
        # Named anew, as both sides come from one table.
        named = [F.col(c).alias(c) for c in frame.columns if c not in ("row_block", "query_block")]
        return frame.select(cell.alias("cell"), *named).groupBy("cell")

    return side(sent).cogroup(side(held.where(F.col("row_block").isin(row_blocks)))).applyInPandas(compare, schema)


def matrices(queries: pd.Series, rows: pd.Series, scale: float) -> tuple[np.ndarray, np.ndarray]:
    """floor(scale x component) of both sides; shorter vectors go on with zeros."""
    width = max((len(v) for side in (queries, rows) for v in side), default=0)

    def matrix(vectors: pd.Series) -> np.ndarray:
        filled = np.zeros((len(vectors), width))
        for row, v in zip(filled, vectors):
            row[: len(v)] = v
        return np.floor(filled * scale)

    return matrix(queries), matrix(rows)


def in_order(query: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of each query's k largest scores, equal ones by smaller id."""
    order = np.lexsort((ids, -scores, query))
    ranked = query[order]
    return order[np.arange(len(order)) - np.searchsorted(ranked, ranked) < k]


def largest(scores: np.ndarray, allowed: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the k largest allowed scores of every row, as ``in_order`` has them."""
    if not scores.size:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    k = min(k, scores.shape[1])
    masked = np.where(allowed, scores, np.iinfo(np.int64).min)
    least = np.partition(masked, -k, axis=1)[:, -k]
    row, column = np.nonzero(allowed & (masked >= least[:, None]))
    order = in_order(row, ids[column], scores[row, column], k)
    return row[order], column[order]
