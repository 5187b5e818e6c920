"""Approximate nearest neighbours by learned partitions.

On a bounded sample, the graph of nearest neighbours is cut into balanced
parts, and a small classifier learns in which parts a vector's neighbours are.
Every row is indexed in its most probable part; a query is compared with all
rows of the several parts most probable for it. How many parts that must be is
measured: for a bounded number of sampled queries the neighbours among all rows
are found exactly, and most of them must lie in the probed parts.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tollstats.llm.shipping import ship_package
from tollstats.llm.staging import checkpointed

NEAREST = 20
# The graph, the classifier and the number of probed parts come from at most so many rows.
FIT_ROWS = 8192
# The table is cut into so many parts, or into parts of so many rows where these are more, as
# far as the sample can tell so many apart: each needs LEAST_PER_PART sampled vectors. Every
# probed part returns k rows a query, so where the vectors do not cluster, more parts cost more.
PARTS, PART_ROWS = 32, 8192
LEAST_PER_PART = 64
GRAPH_NEIGHBOURS = 10
OVERFULL = 1.05
REFINEMENTS = 6
STEPS = 200
# Probed parts hold this share of the true neighbours, among all rows, of so many queries.
TARGET_RECALL = 0.95
PROBE_QUERIES = 512
# Rows and queries that meet in one task.
ROW_BLOCK, QUERY_BLOCK, SCORED_AT_ONCE = 8192, 2048, 256
SEED = 1234


class Router(NamedTuple):
    """Part probabilities of a vector v are softmax(v @ weights + bias); ``probes`` parts are searched."""

    weights: np.ndarray
    bias: np.ndarray
    probes: int


def nearest_in(queries: np.ndarray, rows: np.ndarray, own: np.ndarray, k: int) -> np.ndarray:
    """Row numbers of the k largest inner products of each query, without row number ``own``."""
    found = []
    for at in range(0, len(queries), SCORED_AT_ONCE):
        scores = queries[at : at + SCORED_AT_ONCE] @ rows.T
        scores[np.arange(len(scores)), own[at : at + SCORED_AT_ONCE]] = -np.inf
        found.append(np.argpartition(-scores, k - 1, axis=1)[:, :k])
    return np.concatenate(found)


def balanced_parts(vectors: np.ndarray, graph: np.ndarray, parts: int, random: np.random.Generator) -> np.ndarray:
    """Part of each node: nearest of drawn centres first, then by the majority of its neighbours.

    No part grows beyond ``OVERFULL`` times the mean, in either step.
    """
    n = len(vectors)
    room = int(np.ceil(OVERFULL * n / parts))
    centres = vectors[random.choice(n, parts, replace=False)]
    liking = vectors @ centres.T
    part, sizes = np.full(n, -1), np.zeros(parts, dtype=int)
    for i in np.argsort(-liking.max(axis=1), kind="stable"):
        for p in np.argsort(-liking[i], kind="stable"):
            if sizes[p] < room:
                part[i] = p
                sizes[p] += 1
                break
    linked = [[] for _ in range(n)]
    for i, row in enumerate(graph.tolist()):
        linked[i].extend(row)
        for j in row:
            linked[j].append(i)
    for _ in range(REFINEMENTS):
        for i in random.permutation(n):
            votes = np.bincount(part[linked[i]], minlength=parts)
            stay = votes[part[i]]
            votes[sizes >= room] = -1
            best = int(np.argmax(votes))
            if votes[best] > stay:
                sizes[part[i]] -= 1
                sizes[best] += 1
                part[i] = best
    return part


def learn_classifier(vectors: np.ndarray, targets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Softmax regression on target distributions, by full-batch steps with momentum and scaling."""
    weights, bias = np.zeros((vectors.shape[1], targets.shape[1])), np.zeros(targets.shape[1])
    spread = max(float(np.sqrt((vectors**2).sum(axis=1).mean())), 1e-12)
    inputs = vectors / spread
    state = [[np.zeros_like(x), np.zeros_like(x)] for x in (weights, bias)]
    for step in range(1, STEPS + 1):
        logits = inputs @ weights + bias
        p = np.exp(logits - logits.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        error = (p - targets) / len(inputs)
        for value, gradient, (m, v) in zip((weights, bias), (inputs.T @ error, error.sum(axis=0)), state):
            m += 0.1 * (gradient - m)
            v += 0.01 * (gradient**2 - v)
            value -= 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-9)
    return weights / spread, bias


def fit_router(vectors: np.ndarray, k: int = NEAREST, parts: int = PARTS, seed: int = SEED) -> Router:
    """Router of sampled vectors; a small sample gives a single part, which every query searches.

    ``probes`` holds for neighbours within the sample, which are farther than those among all rows.
    """
    n = len(vectors)
    parts = max(1, min(parts, n // LEAST_PER_PART))
    if parts == 1:
        return Router(np.zeros((vectors.shape[1] if n else 1, 1)), np.zeros(1), 1)
    random = np.random.default_rng(seed)
    k = min(k, n - 1)
    everyone = np.arange(n)
    graph = nearest_in(vectors, vectors, everyone, min(GRAPH_NEIGHBOURS, n - 1))
    part = balanced_parts(vectors, graph, parts, random)
    near = np.concatenate([part[graph], part[:, None]], axis=1)
    targets = np.stack([(near == p).mean(axis=1) for p in range(parts)], axis=1)
    weights, bias = learn_classifier(vectors, targets)
    logits = vectors @ weights + bias
    home = logits.argmax(axis=1)
    asked = random.choice(n, min(PROBE_QUERIES, n), replace=False)
    truth = home[nearest_in(vectors[asked], vectors, asked, k)]
    place = np.argsort(np.argsort(-logits[asked], axis=1, kind="stable"), axis=1, kind="stable")
    reached = np.take_along_axis(place, truth, axis=1)
    recall = [(reached < t).mean() for t in range(1, parts + 1)]
    probes = next(t for t, r in enumerate(recall, 1) if r >= TARGET_RECALL)
    return Router(weights, bias, probes)


def _matrix(vectors: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, dtype=np.float64) for v in vectors])


def _search(queries: pd.DataFrame, rows: pd.DataFrame, k: int) -> pd.DataFrame:
    """The k best rows of each query in one block; equal scores prefer smaller ids.

    Products are preselected by matrix multiplication and summed again in one
    fixed order, so that equal vectors score equally wherever they meet.
    """
    found = []
    if len(queries) and len(rows):
        q, x = _matrix(queries["vector"]), _matrix(rows["vector"])
        query_ids, ids = queries["query_id"].to_numpy(), rows["vec_id"].to_numpy()
        for at in range(0, len(q), SCORED_AT_ONCE):
            part, own = q[at : at + SCORED_AT_ONCE], query_ids[at : at + SCORED_AT_ONCE]
            scores = part @ x.T
            scores[own[:, None] == ids[None, :]] = -np.inf
            least = np.partition(scores, -min(k, len(x)), axis=1)[:, -min(k, len(x))]
            slack = 1e-9 * np.linalg.norm(part, axis=1) * np.linalg.norm(x, axis=1).max()
            row, column = np.nonzero((scores >= (least - slack)[:, None]) & np.isfinite(scores))
            exact = np.zeros(len(row))
            for j in range(x.shape[1]):
                exact += part[row, j] * x[column, j]
            order = np.lexsort((ids[column], -exact, row))
            row, column, exact = row[order], column[order], exact[order]
            rank = np.arange(len(row)) - np.searchsorted(row, row)
            best = rank < k
            found.append(pd.DataFrame({"query_id": own[row[best]], "vec_id": ids[column[best]], "score": exact[best]}))
    return pd.concat(found) if found else pd.DataFrame({"query_id": [], "vec_id": [], "score": []})


def probes_needed(router: Router, queries: np.ndarray, homes: np.ndarray, target: float = TARGET_RECALL) -> int:
    """Probed parts that hold the ``target`` share of the neighbours; ``homes`` has a neighbour's part and its query."""
    places = np.argsort(np.argsort(-(queries @ router.weights + router.bias), axis=1, kind="stable"), axis=1)
    reached = places[homes["query"], homes["part"]]
    held = np.cumsum(np.bincount(reached, minlength=len(router.bias))) / max(len(reached), 1)
    return int(np.argmax(held >= target)) + 1 if len(reached) else len(router.bias)


def _true_parts(rows: DataFrame, asked: pd.DataFrame, k: int) -> pd.DataFrame:
    """(query, part) of the k nearest rows of each asked vector, by comparing them with all rows.

    ``asked`` is bounded, and so is what a task returns: k rows a query.
    """
    numbers = pd.DataFrame({"query_id": asked["vec_id"], "vector": asked["vector"]})
    place = dict(zip(asked["vec_id"], range(len(asked))))

    def nearest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best = None
        for batch in batches:
            parts = batch.drop_duplicates("vec_id").set_index("vec_id")["part"]
            found = _search(numbers, batch, k).drop_duplicates(["query_id", "vec_id"])
            found["part"] = parts.reindex(found["vec_id"]).to_numpy()
            found = found if best is None else pd.concat([best, found])
            best = found.sort_values(["query_id", "score"], ascending=[True, False]).groupby("query_id").head(k)
        if best is not None:
            yield best[["query_id", "vec_id", "score", "part"]].astype({"query_id": "int64", "vec_id": "int64", "part": "int32"})

    found = rows.select("vec_id", "vector", "part").mapInPandas(nearest, "query_id long, vec_id long, score double, part int")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    kept = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "part").toPandas()
    return pd.DataFrame({"query": kept["query_id"].map(place).astype(int), "part": kept["part"].astype(int)})


def _usable(vector: Column) -> Column:
    """No null, no infinite or undefined component, not all zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def nearest_neighbours(
    vectors: DataFrame, queries: Column, k: int = NEAREST, fit_rows: int = FIT_ROWS, parts: int | None = None
) -> DataFrame:
    """query_id, rank (from 1), vec_id and score of the k rows found for every query row.

    ``vectors`` needs vec_id and embedding; ``queries`` is the condition of the
    query rows. Scores are inner products in double precision, ties go to the
    smaller vec_id, and a query's own id is no candidate. Rows whose id or
    vector is null, or whose vector is zero, of another length than most, or
    holds null or non-finite components, take no part. Of repeated ids the best
    score counts, and the smallest vector is the query. With fewer than k
    candidates all are returned; an empty table gives an empty result. Further
    columns are ignored.

    Without ``parts`` their number grows with the table, up to the one that a
    sample of ``fit_rows`` can tell apart.

    Parts are cut into blocks of rows and of queries, so a part that many equal
    vectors fill meets its queries in many tasks.
    """
    spark = vectors.sparkSession
    ship_package(spark)
    usable = vectors.where(F.col("vec_id").isNotNull() & _usable(F.col("embedding"))).select(
        F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").alias("vector"), queries.alias("asks")
    )
    widths = usable.groupBy(F.size("vector").alias("width")).count()
    usual = widths.orderBy(F.desc("count"), "width").first()
    usable = usable.where(F.size("vector") == (usual["width"] if usual else 0))
    n = usable.count()
    # Of n even hashes about so many lie below the limit: enough of them, and few more.
    limit = int(-(2**63) + min(1.0, (fit_rows + 6 * fit_rows**0.5) / max(n, 1)) * (2**64 - 1))
    drawn = usable.where(F.xxhash64("vec_id") <= min(limit, 2**63 - 1)).groupBy("vec_id").agg(F.min("vector").alias("vector"))
    sample = drawn.orderBy(F.xxhash64("vec_id"), "vec_id").limit(fit_rows).toPandas()
    parts = max(PARTS, -(-n // PART_ROWS)) if parts is None else parts
    router = fit_router(_matrix(sample["vector"]) if len(sample) else np.zeros((0, 1)), k, parts)

    @F.pandas_udf("int")
    def home(batch: pd.Series) -> pd.Series:
        return pd.Series((_matrix(batch) @ router.weights + router.bias).argmax(axis=1).astype(np.int32))

    rows = checkpointed(usable.withColumn("part", home("vector")))
    if len(router.bias) > 1:
        asked = sample.iloc[np.random.default_rng(SEED).choice(len(sample), min(PROBE_QUERIES, len(sample)), replace=False)]
        router = router._replace(probes=probes_needed(router, _matrix(asked["vector"]), _true_parts(rows, asked, k)))
    sizes = np.zeros(len(router.bias), dtype=np.int64)
    for r in rows.groupBy("part").count().collect():
        sizes[r["part"]] = r["count"]

    @F.pandas_udf("array<int>")
    def routes(batch: pd.Series) -> pd.Series:
        order = np.argsort(-(_matrix(batch) @ router.weights + router.bias), axis=1, kind="stable")
        enough = np.cumsum(sizes[order], axis=1) > k  # its own row among them
        probes = np.maximum(router.probes, np.where(enough.any(axis=1), enough.argmax(axis=1) + 1, len(sizes)))
        return pd.Series([o[:n].astype(np.int32) for o, n in zip(order, probes)])

    asking = rows.where(F.col("asks")).groupBy(F.col("vec_id").alias("query_id")).agg(F.min("vector").alias("vector"))
    asking = checkpointed(asking.withColumn("parts", routes("vector")))
    routed = asking.select("query_id", "vector", F.explode("parts").alias("part"))
    asked = np.zeros(len(sizes), dtype=np.int64)
    for r in routed.groupBy("part").count().collect():
        asked[r["part"]] = r["count"]

    def blocks(counts: np.ndarray, block: int) -> Column:
        numbers = F.array(*[F.lit(int(max(1, -(-c // block)))) for c in counts])
        return F.get(numbers, F.col("part"))

    row_blocks, query_blocks = blocks(sizes, ROW_BLOCK), blocks(asked, QUERY_BLOCK)

    def every(n: Column) -> Column:
        return F.explode(F.sequence(F.lit(0), n - 1))

    held = rows.withColumn("row_block", F.pmod(F.xxhash64("vec_id", "vector"), row_blocks).cast("int")).select(
        "part", "row_block", every(query_blocks).alias("query_block"), "vec_id", "vector"
    )
    sent = routed.withColumn("query_block", F.pmod(F.xxhash64("query_id"), query_blocks).cast("int")).select(
        "part", every(row_blocks).alias("row_block"), "query_block", "query_id", "vector"
    )
    keys = ["part", "row_block", "query_block"]
    found = (
        sent.groupBy(*keys)
        .cogroup(held.groupBy(*keys))
        .applyInPandas(lambda q, x: _search(q, x, k), "query_id long, vec_id long, score double")
    )
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.groupBy("query_id", "vec_id")
        .agg(F.max("score").alias("score"))
        .withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
