from __future__ import annotations

import zlib

import numpy as np
from llm_checks import documents, edge_documents, no_documents, words

from tollstats.llm import quality
from tollstats.llm.registry import QUERIES

LABELS = "doc_id long, quality int, toxic int"


def test_held_out_accuracy(spark):
    path = "/root/testdata/sf0.1"
    scored = QUERIES["op3_quality"](spark, path)
    assert scored.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = scored.join(spark.read.parquet(f"{path}/labels.parquet"), "doc_id", "left").collect()
    assert len(rows) == 10_000
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)
    held = [r for r in rows if r.held_out and r.quality is not None]
    assert sum(r.predicted == r.quality for r in held) > 0.95 * len(held)
    refused = [r for r in held if not r.predicted]
    assert sum(r.quality == 0 for r in refused) > 0.9 * len(refused)


def test_ratio_and_descent_solve_the_stated_problem():
    """The dual solution satisfies the optimality conditions of the hinge loss."""
    rows = [np.array(x, dtype=np.int32) for x in ([1, 2], [1, 3], [4], [4, 5], [1, 4], [2])]
    labels = np.array([1, 1, 0, 0, 1, 1])
    ratio = quality.log_count_ratio(rows, labels)
    size = 1 << quality.FEATURE_BITS
    ones, zeros = size + 7, size + 3
    assert np.isclose(ratio[1], np.log((4 / ones) / (1 / zeros)))
    assert np.isclose(ratio[4], np.log((2 / ones) / (3 / zeros)))
    weights, bias = quality.dual_descent(rows, labels, ratio, cost=1.0, epochs=3000, seed=1)
    signs = np.where(labels == 1, 1, -1)
    values = np.zeros((6, size), dtype=np.float64)
    for i, ids in enumerate(rows):
        values[i, ids] = ratio[ids] / np.sqrt(len(ids))

    def objective(w, b):
        return (w @ w + b * b) / 2 + np.maximum(0, 1 - signs * (values @ w + b)).sum()

    best = objective(weights.astype(float), bias)
    random = np.random.default_rng(0)
    for _ in range(200):
        step = np.zeros(size)
        step[1:6] = random.normal(size=5) * 0.05
        assert objective(weights + step, bias + random.normal() * 0.05) >= best - 1e-4


def test_indicators_are_distinct_and_cover_long_texts():
    mark = np.zeros(1 << quality.FEATURE_BITS, dtype=np.int32)
    ids = quality.indicators(words(1, 200), mark)
    assert len(ids) == len(set(ids.tolist()))
    tail = words(1, 120_000) + " zzzyyyxxx"
    assert set(quality.indicators("zzzyyyxxx", mark)) <= set(quality.indicators(tail, mark))
    assert len(quality.indicators(None, mark)) == len(quality.indicators("", mark)) == 0


def test_edges(spark):
    frame = edge_documents(spark)
    labels = spark.createDataFrame(
        [(1, 1, 0), (1, 0, 0), (6, 0, 0), (5, 1, None), (None, 1, 0), (7, None, 1), (8, 1, 0), (99, 1, 0)], LABELS
    )
    scored = quality.score_quality(frame, labels)
    assert scored.columns == [*frame.columns, "held_out", "predicted"]
    rows = scored.collect()
    assert len(rows) == 12 and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if not (r.text or "")}) == 1
    none = spark.createDataFrame([], LABELS)
    assert {r.score for r in quality.score_quality(frame, none).collect()} == {0.5}
    assert quality.score_quality(no_documents(spark), labels).count() == 0
    kept = quality.accepted_documents(documents(spark, (1, "a"), (2, None)), none)
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"] and kept.count() == 2


def test_the_sample_is_bounded_and_taken_among_present_documents(spark, monkeypatch):
    """Repeated ids, ids with several texts, and labels of documents that are elsewhere."""
    repeated = spark.range(100_000).selectExpr("cast(3 as long) as doc_id", f"if(id % 2 = 0, '{words(1, 20)}', '{words(2, 20)}') as text")
    others = spark.range(100, 160).selectExpr("id as doc_id", "concat('some words of ', id) as text")
    labels = spark.range(0, 5000).selectExpr("id as doc_id", "cast(id % 2 as int) as quality", "0 as toxic")
    fitted = []
    monkeypatch.setattr(quality, "fit", lambda rows, own: fitted.append((len(rows), len(own))))
    for bound in (5, 40, 8000):
        quality.fit_quality(repeated.unionByName(others), labels, rows=bound)
    inside = sum(zlib.crc32(str(i).encode()) % 5 != 0 for i in [3, *range(100, 160)])
    assert fitted == [(5, 5), (40, 40), (inside, inside)]
