from __future__ import annotations

from collections import Counter

import pytest
from llm_checks import documents, edge_documents, no_documents, words
from pyspark.sql import functions as F

from tollstats.llm.mixing import fill_targets, mix_sources, mixed_documents


def rounds(sizes, weights=(3.0, 1.0, 2.0), share=1.5, cap=2.0):
    """Clamp and share again until no source is above its cap."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_, target = share * sum(sizes.values()), set(names), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if level * weight[s] > cap * sizes[s]}
        if not over:
            return target | {s: level * weight[s] for s in open_}
        for s in over:
            target[s] = cap * sizes[s]
            left -= target[s]
        open_ -= over
    return target


@pytest.mark.parametrize(
    "sizes", [{"a": 100, "b": 100}, {"a": 5, "b": 1000, "c": 7, None: 40, "é": 0}, {"x": 1}, {"a": 0}, {str(i): i * i for i in range(40)}]
)
def test_targets_equal_the_rounds(spark, sizes):
    frame = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in fill_targets(frame).collect()}
    assert got == pytest.approx(rounds(sizes))


def test_hot_source_and_rerun(spark):
    rows = [(i, words(i, 3 + i % 90), None if i % 3 == 0 else f"s{i % 7}") for i in range(3000)]
    frame = documents(spark, *rows)
    mix = mix_sources(frame).collect()
    assert sorted(mix) == sorted(mix_sources(frame.repartition(7)).collect())
    taken, target = Counter(), {}
    for r in mix:
        source = rows[r.doc_id][2]
        taken[source] += r.taken
        target[source] = r.target
        assert r.size == len(rows[r.doc_id][1].split()) and 0 <= r.taken <= 2 * r.size
    assert all(abs(taken[s] - target[s]) <= 1 for s in taken)


def test_mixed_texts_hold_the_words_taken(spark):
    rows = [(i, words(i, 3 + i % 50), f"s{i % 4}") for i in range(400)]
    frame = documents(spark, *rows).withColumns({"size": F.lit("own"), "draw": F.lit(1)})
    mixed = mixed_documents(frame)
    assert mixed.columns == frame.columns
    held = Counter()
    for r in mixed.collect():
        held[r.doc_id] += len(r.text.split())
        assert rows[r.doc_id][1].startswith(r.text) and r.n_chars == len(r.text) and r.size == "own"
    assert held == Counter({r.doc_id: r.taken for r in mix_sources(frame).collect() if r.taken})


def test_edges(spark):
    frame = edge_documents(spark)
    rows = mix_sources(frame).collect()
    assert len(rows) == 12 and all(r.taken <= 2 * r.size for r in rows)
    assert sum(r.taken for r in rows) == pytest.approx(1.5 * sum(r.size for r in rows), abs=6)
    assert mixed_documents(frame).columns == frame.columns
    assert mix_sources(no_documents(spark)).count() == mixed_documents(no_documents(spark)).count() == 0
    assert [(r.target, r.taken) for r in mix_sources(documents(spark, (1, None), (2, " "))).collect()] == [(0, 0)] * 2
