from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
from llm_checks import documents, edge_documents, no_documents, words

from tollstats.llm.packing import best_fit, pack_documents
from tollstats.llm.registry import QUERIES


def plain_best_fit(sizes, sources, clusters, capacity):
    """Every bin is looked at for every item."""
    bins, found = [], []
    for size, s, c in zip(sizes, sources, clusters):
        fits = [(b[0], i) for i, b in enumerate(bins) if b[0] >= size and s not in b[1] and c not in b[2]]
        i = min(fits)[1] if fits else len(bins)
        if not fits:
            bins.append([capacity, set(), set()])
        found.append((i, capacity - bins[i][0]))
        bins[i][0] -= size
        bins[i][1].add(s)
        bins[i][2].add(c)
    return found


def test_search_finds_the_tightest_compatible_bin():
    random = np.random.default_rng(3)
    for n, n_sources in ((200, 5), (200, 40), (50, 1), (1, 1)):
        sizes = np.sort(random.integers(1, 60, n))[::-1]
        sources, clusters = random.integers(0, n_sources, n), random.integers(0, 100, n)
        bins, offsets = best_fit(sizes, sources, clusters, 60)
        assert list(zip(bins.tolist(), offsets.tolist())) == plain_best_fit(sizes, sources, clusters, 60)


def check(rows, docs, capacity):
    total, bins = Counter(), defaultdict(list)
    for r in rows:
        total[r.doc_id] += r.words
        if r.bin is not None:
            bins[r.bin].append(r)
    assert sum(total.values()) == sum(len((t or "").split()) for _, t, _ in docs)
    source, text = {d: s for d, _, s in docs}, {d: t for d, t, _ in docs}
    for held in bins.values():
        held.sort(key=lambda r: r.bin_start)
        ends = np.cumsum([r.words for r in held]).tolist()
        assert [r.bin_start for r in held] == [0, *ends[:-1]] and ends[-1] <= capacity
        assert len({source[r.doc_id] for r in held}) == len({text[r.doc_id] for r in held}) == len(held)
    return bins


def test_whole_table(spark, medium):
    docs = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{medium}/documents.parquet").collect()]
    bins = check(QUERIES["op5_packing"](spark, medium).collect(), docs, 1024)
    words_in = sum(len(t.split()) for _, t, _ in docs)
    assert words_in / (1024 * len(bins)) > 0.95


def test_many_groups_and_a_hot_source(spark):
    docs = [(i, words(i if i % 4 else 0, 5 + i % 60), "hot" if i % 3 == 0 else f"s{i % 7}") for i in range(2000)]
    packed = pack_documents(documents(spark, *docs), capacity=100, group_rows=150)
    rows = packed.collect()
    check(rows, docs, 100)
    assert len({r.bin >> 32 for r in rows}) > 10
    assert sorted(rows, key=str) == sorted(packed.collect(), key=str)


def test_copies_of_one_row_are_dealt_over_the_groups(spark):
    """A hundred thousand equal rows: none of the groups, each searched by itself, holds many."""
    frame = spark.range(100_000).selectExpr("cast(5 as long) as doc_id", "'one two three' as text", "'s' as source")
    sizes = Counter(r.bin >> 32 for r in pack_documents(frame, group_rows=500).select("bin").collect())
    assert sum(sizes.values()) == 100_000 and len(sizes) == 200 and max(sizes.values()) < 1000


def test_edges(spark):
    frame = edge_documents(spark)
    rows = pack_documents(frame, capacity=50).collect()
    pieces = sorted((r.piece, r.first_word, r.words) for r in rows if r.doc_id == 5)
    assert [p for p, _, _ in pieces] == list(range(480)) and sum(w for _, _, w in pieces) == 24_000
    assert all(first == 50 * p for p, first, _ in pieces)
    assert sum(1 for r in rows if r.bin is None) == 4 and all(r.words == 0 for r in rows if r.bin is None)
    assert len({r.bin for r in rows if r.doc_id == 1}) == 2
    assert pack_documents(no_documents(spark)).count() == 0
