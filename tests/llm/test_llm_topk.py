from __future__ import annotations

from collections import defaultdict
from math import floor

import numpy as np
import pytest
from pyspark.sql import functions as F

from tollstats.llm import blocked, topk
from tollstats.llm.queries import op12_topk
from tollstats.llm.topk import Block, exact_top_k, statistics

SCHEMA = "vec_id long, embedding array<float>, label int, row_block string, cell int"
NAN, INF = float("nan"), float("inf")


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "own", 1) for i, v in rows], SCHEMA)


def whole(vector):
    return [floor(256 * float(np.float32(c))) for c in vector]


def brute(rows, ask, k):
    """Scores of all rows as whole numbers; one row per id."""
    kept = {}
    for i, v in rows:
        if i is not None and v is not None and all(c is not None and np.isfinite(c) for c in v):
            kept[i] = min(kept.get(i, v), v)
    kept = {i: whole(v) for i, v in kept.items()}
    found = {}
    for q, x in kept.items():
        if ask(q):
            scored = sorted((-sum(a * b for a, b in zip(x, y)), i) for i, y in kept.items() if i != q)
            found[q] = [(r, i, -s) for r, (s, i) in enumerate(scored[:k], 1)]
    return {q: f for q, f in found.items() if f}


def result(found):
    got = defaultdict(list)
    for r in sorted(found.collect(), key=lambda r: (r.query_id, r.rank)):
        got[r.query_id].append((r["rank"], r.vec_id, r.score))
    return dict(got)


@pytest.mark.parametrize("scale", ["0.001", "0.1"])
def test_whole_table_equals_brute_force(spark, scale):
    path = f"/root/testdata/sf{scale}"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{path}/embeddings.parquet").collect()]
    assert result(op12_topk(spark, path)) == brute(rows, lambda i: i % 50 == 0, 5)


def test_many_blocks_and_ties(spark, monkeypatch):
    monkeypatch.setattr(blocked, "ROWS", 90)
    monkeypatch.setattr(blocked, "QUERIES", 7)
    monkeypatch.setattr(topk, "AT_ONCE", 3)
    random = np.random.default_rng(6)
    same = random.normal(size=10).astype(np.float32).tolist()
    rows = [(i, same if i % 3 == 0 else random.normal(size=10).astype(np.float32).tolist()) for i in range(800)]
    ask = F.col("vec_id") % 40 == 0
    assert result(exact_top_k(frame(spark, rows), ask)) == brute(rows, lambda i: i % 40 == 0, 5)


def test_edges(spark):
    rows = [
        (0, [1.0, 0.0]), (50, [0.0, 1.0]), (1, [1.0, 1.0]), (2, None), (3, [0.0, 0.0]), (4, [None, 1.0]), (5, [NAN, 1.0]),
        (6, [INF, 1.0]), (None, [5.0, 5.0]), (7, [1.0, 2.0, 3.0]), (1, [1.0, 1.0]), (1, [0.5, 9.0]), (100, None), (8, []), (9, [1e30, 1.0]),
    ]
    ask = F.col("vec_id") % 50 == 0
    kept = [r for r in rows if r[0] != 9]  # its own score fits no long
    assert result(exact_top_k(frame(spark, rows), ask)) == brute(kept, lambda i: i % 50 == 0, 5)
    assert exact_top_k(frame(spark, []), ask).count() == 0
    assert exact_top_k(frame(spark, [(0, [1.0])]), ask).count() == 0


def test_large_components_are_scored_exactly(spark):
    random = np.random.default_rng(8)
    rows = [(i, random.integers(-(2**20), 2**20, 12).astype(float).tolist()) for i in range(0, 60)]
    got = result(exact_top_k(frame(spark, rows), F.col("vec_id") % 10 == 0))
    assert got == brute(rows, lambda i: i % 10 == 0, 5)
    assert max(abs(s) for f in got.values() for _, _, s in f) > 2**53


@pytest.mark.parametrize("width", [1, 5, 16, 64, 70])
def test_finer_segments_bound_more_tightly(width):
    random = np.random.default_rng(width)
    x = np.floor(random.normal(size=(200, width)) * 256)
    exact, looser = x @ x.T, None
    for n in (1, 4, 16, 32):
        bound = statistics(x, n) @ statistics(x, n).T
        assert (bound >= exact - 1e-6 * np.abs(exact).max()).all()
        if looser is not None and width % 32 == 0:
            assert (bound <= looser + 1e-6 * np.abs(exact).max()).all()
        looser = bound


def test_clustered_rows_are_mostly_ruled_out():
    random = np.random.default_rng(1)
    centres = np.repeat(random.normal(size=(40, 16)), 4, axis=1)
    x = np.floor((centres[random.integers(0, 40, 4000)] + 0.1 * random.normal(size=(4000, 64))) * 256)
    block = Block(x, np.arange(4000))
    block.best(x[:50], np.arange(50), np.full(50, -np.inf), 5)
    assert block.scored < 0.1 * 50 * 4000
