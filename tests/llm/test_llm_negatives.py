from __future__ import annotations

from math import floor

import numpy as np
import pytest
from pyspark.sql import functions as F

from tollstats.llm import blocked, negatives
from tollstats.llm.negatives import balanced, exact_products, hard_negatives, moduli, primes_below, residue_products
from tollstats.llm.queries import op13_negatives

SCHEMA = "vec_id long, embedding array<float>, label int, positives string, cell int"
NAN, INF = float("nan"), float("inf")


def frame(spark, rows):
    return spark.createDataFrame([(i, v, n, "own", 1) for i, v, n in rows], SCHEMA)


def brute(rows, ask, n_positives=5, n_negatives=10):
    """Every anchor against every row, as whole numbers."""
    kept = {}
    for i, v, n in rows:
        if i is not None and n is not None and v is not None and all(c is not None and np.isfinite(c) for c in v):
            kept[i] = min(kept.get(i, (v, n)), (v, n))
    kept = {i: ([floor(256 * float(np.float32(c))) for c in v], n) for i, (v, n) in kept.items()}
    found = set()
    for a, (x, label) in kept.items():
        if not ask(a):
            continue
        scored = sorted((-sum(p * q for p, q in zip(x, y)), i, n) for i, (y, n) in kept.items() if i != a)
        for s, p, _ in [row for row in scored if row[2] == label][:n_positives]:
            window = [row for row in scored if row[2] != label and 30 * -s <= 100 * -row[0] <= 90 * -s]
            found |= {(a, p, r, i, -s, -t) for r, (t, i, _) in enumerate(window[:n_negatives], 1)}
    return found


def result(found):
    rows = [(r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in found.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize("scale", ["0.001", "0.1"])
def test_whole_table_equals_brute_force(spark, scale):
    path = f"/root/testdata/sf{scale}"
    table = spark.read.parquet(f"{path}/embeddings.parquet").collect()
    rows = [(r.vec_id, r.embedding, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label) for r in table]
    assert result(op13_negatives(spark, path)) == brute(rows, lambda i: i % 100 == 0) != set()


def test_many_blocks_ties_and_a_hot_label(spark, monkeypatch):
    monkeypatch.setattr(blocked, "ROWS", 70)
    monkeypatch.setattr(blocked, "QUERIES", 4)
    monkeypatch.setattr(negatives, "AT_ONCE", 3)
    random = np.random.default_rng(3)
    kinds = [random.normal(size=6).astype(np.float32).tolist() for _ in range(40)]
    rows = [(i, kinds[int(random.integers(40))], 0 if i % 3 else int(random.integers(5))) for i in range(600)]
    got = result(hard_negatives(frame(spark, rows), F.col("vec_id") % 30 == 0))
    assert got == brute(rows, lambda i: i % 30 == 0) != set()


def test_edges(spark):
    rows = [
        (0, [1.0, 0.0], 1), (100, [0.0, 1.0], 1), (1, [0.6, 0.6], 2), (2, None, 1), (3, [0.0, 0.0], 2), (4, [None, 1.0], 2), (5, [NAN, 1.0], 1),
        (6, [INF, 1.0], 1), (None, [5.0, 5.0], 1), (7, [1.0, 2.0, 3.0], 1), (1, [0.6, 0.6], 2), (1, [0.7, 0.1], 3), (200, [1.0, 1.0], None),
        (300, [-1.0, 0.0], 9), (301, [1.0, 0.0], 9), (8, [], 2), (9, [1e30, 1.0], 1), (400, [0.0], 4), (401, [0.0], 4), (10, [0.5, 0.5], 2),
    ]
    ask = F.col("vec_id") % 100 == 0
    kept = [r for r in rows if r[0] != 9]  # its own score fits no long
    assert result(hard_negatives(frame(spark, rows), ask)) == brute(kept, lambda i: i % 100 == 0) != set()
    assert hard_negatives(frame(spark, []), ask).count() == 0
    assert hard_negatives(frame(spark, [(0, [1.0], 1)]), ask).count() == 0


@pytest.mark.parametrize("width", [1, 64, 65, 200])
@pytest.mark.parametrize("size", [1, 300, 2**20, 2**26])
def test_products_are_exact(width, size):
    random = np.random.default_rng(width)
    left, right = (random.integers(-size, size + 1, (5, width)) for _ in range(2))
    left[0], right[0], right[1] = size, size, -size
    want = [[sum(int(a) * int(b) for a, b in zip(u, v)) for v in right] for u in left]
    assert exact_products(left.astype(float), right.astype(float)).tolist() == want


def test_residues_stay_exact_in_float32():
    p = primes_below(1024)[0]
    worst = np.full((2, 500), p // 2, dtype=float)
    want = balanced(np.array([[500 * (p // 2) ** 2] * 2] * 2), p)
    assert (residue_products(worst, worst, p) == want).all()
    assert primes_below(30) == [29, 23, 19, 17, 13, 11, 7, 5, 3, 2]
    assert len(moduli(70000)) == 2 and len(moduli(2.0**62)) > 6
