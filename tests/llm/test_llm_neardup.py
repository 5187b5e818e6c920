from __future__ import annotations

import numpy as np
import pandas as pd
from llm_checks import documents, edge_documents, near_classes, no_documents, words

from tollstats.llm import neardup
from tollstats.llm.components import connected_components
from tollstats.llm.darts import band_hashes, signature
from tollstats.llm.fingerprints import fingerprint
from tollstats.llm.registry import QUERIES
from tollstats.llm.tokens import word_hashes


def test_agreement_estimates_weighted_similarity():
    random = np.random.default_rng(1)
    for n in (2, 30, 3000):
        found, want = [], []
        for _ in range(30):
            ids, weights = random.integers(0, 2**63, 2 * n, dtype=np.uint64), random.random(2 * n) * 3 + 0.01
            a, b = np.zeros(2 * n), np.zeros(2 * n)
            a[: n + n // 2], b[n // 2 :] = weights[: n + n // 2], weights[n // 2 :] * 0.7
            x, y = (signature(ids[w > 0], w[w > 0]) for w in (a, b))
            found.append((x == y).mean())
            want.append(np.minimum(a, b).sum() / np.maximum(a, b).sum())
        assert abs(np.mean(found) - np.mean(want)) < 0.03


def test_signature_is_stable_and_whole():
    ids = np.arange(1, 200_001, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    whole = signature(ids, np.ones(len(ids)))
    assert (whole == signature(ids[::-1], np.ones(len(ids)))).all() and (whole != 0).all()
    assert signature(ids[:0], np.ones(0)) is None
    assert len(set(band_hashes(whole).tolist())) == 24


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 101), (103, 101)] + [(200, 200 + i) for i in range(1, 50)]
    links = spark.createDataFrame(chain, "a long, b long")
    got = {r.node: r.component for r in connected_components(links).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100, 103: 100} | {200 + i: 200 for i in range(50)}
    assert connected_components(links.where("a < 0")).count() == 0


def classes(frame):
    return {r.doc_id: r.class_id for r in neardup.near_duplicates(frame).collect()}


def test_whole_table(spark, medium):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{medium}/documents.parquet").collect()]
    got = {r.doc_id: r.class_id for r in QUERIES["op8_near_duplicates"](spark, medium).collect()}
    assert got == near_classes(docs)


def test_large_group_of_near_copies_around_the_threshold(spark):
    """A base text and copies with one to five changed words, in buckets larger than the small ones."""
    base, rows = words(7, 120).split(), [(0, words(7, 120))]
    random = np.random.default_rng(5)
    for i in range(1, 150):
        copy = list(base)
        for p in random.choice(120, random.integers(1, 6), replace=False):
            copy[p] = f"x{i}y{p}"
        rows.append((i, " ".join(copy)))
    rows += [(1000 + i, words(300 + i, 60)) for i in range(50)] + [(2000 + i, rows[3][1]) for i in range(100)]
    assert classes(documents(spark, *rows)) == near_classes(rows)


def test_copies_that_repeat_a_passage_more_often(spark):
    """Sets of shingles decide, so a passage repeated many times more in one of two texts hides no link."""
    rows = []
    for i in range(40):
        body, line = words(900 + i, 100), words(2000 + i, 12)
        rows.append((2 * i, "\n".join([body] + [line] * 2)))
        rows.append((2 * i + 1, "\n".join([body] + [line] * 60)))
    assert classes(documents(spark, *rows)) == near_classes(rows) == {i: i - i % 2 for i in range(80)}


def without(frame):
    return sorted(((r.doc_id, r.text) for r in neardup.without_near_duplicates(frame).collect()), key=str)


def test_every_class_keeps_one_document(spark):
    """Documents without an id, ids with several texts, and repeated rows."""
    a, b, c, d, e = (words(i, 40) for i in range(5))
    near_a = a.rsplit(" ", 1)[0] + " other"
    rows = [
        (1, a), (None, b), (None, None), (None, ""), (3, c), (3, c), (None, near_a), (None, b), (5, d), (5, e), (7, e), (2, near_a), (None, c),
    ]
    frame = documents(spark, *rows)
    got = [(r.doc_id, r.class_id, r.equal_id) for r in neardup.near_duplicates(frame).collect()]
    assert sorted(got, key=str) == sorted([
        (1, 1, 1), (None, None, None), (None, None, None), (None, None, None), (3, 3, 3), (3, 3, 3), (None, 1, 2), (None, None, None),
        (5, 5, 5), (5, 5, 5), (7, 5, 5), (2, 1, 2), (None, 3, 3),
    ], key=str)
    kept = without(frame)
    empty = [t for i, t in kept if i is None and not t]
    assert len(empty) == 1  # null and empty texts are equal
    assert [k for k in kept if k[1]] == sorted([(1, a), (3, c), (None, b), (5, d), (5, e)], key=str)
    assert without(frame.repartition(5)) == kept


def test_repeated_rows_of_one_id(spark):
    """A hundred thousand rows of one id: half of them one text, the others two."""
    frame = spark.range(100_000).selectExpr(
        "cast(if(id % 7 = 0, null, 4) as long) as doc_id",
        f"case when id % 2 = 0 then '{words(1, 30)}' when id % 3 = 0 then '{words(2, 30)}' else 'short' end as text",
        "'en' as lang", "cast(id % 5 as string) as source", "id as n_chars",
    )
    assert without(frame) == sorted([(4, words(1, 30)), (4, words(2, 30)), (4, "short")])


def test_links_of_a_block_are_fewer_than_components(spark):
    texts = [words(3, 60) + f" x{i}" for i in range(50)]
    block = pd.DataFrame({"node": [bytes([i]) for i in range(50)], "text": texts})
    block["own"] = block["node"]
    found = neardup._compare_blocks(block, block, 0.8)
    assert len(found) == 49 and set(found["a"]) | set(found["b"]) == set(block["node"])


def test_periodic_words_and_texts_are_told_apart():
    """Thue-Morse words and their complements, which polynomials modulo powers of two confuse."""
    for n in (1024, 2048, 4096):
        bits = [bin(i).count("1") % 2 for i in range(n)]
        one, two = ("".join("ab"[b ^ flip] for b in bits) for flip in (0, 1))
        assert word_hashes(one) != word_hashes(two)
        one, two = (" ".join("ab"[b ^ flip] for b in bits) for flip in (0, 1))
        assert fingerprint(one)["identity"].tolist() != fingerprint(two)["identity"].tolist()
        tail = words(1, 6)
        assert neardup.jaccard(pd.Series([f"{one} {tail}"]), pd.Series([f"{two} {tail}"]))[0] < 1


def test_edges(spark):
    frame = edge_documents(spark)
    rows = neardup.near_duplicates(frame).collect()
    got = sorted((str(r.doc_id), str(r.class_id)) for r in rows)
    assert got == sorted([
        ("1", "1"), ("1", "1"), ("2", "2"), ("3", "2"), ("None", "2"), ("4", "4"), ("None", "None"), ("5", "5"),
        ("6", "1"), ("7", "7"), ("2", "2"), ("8", "8"),
    ])
    kept = neardup.without_near_duplicates(frame)
    assert kept.columns[1:] == [c for c in frame.columns if c != "doc_id"]
    assert neardup.near_duplicates(no_documents(spark)).count() == 0
    assert neardup.without_near_duplicates(no_documents(spark)).count() == 0
    assert classes(documents(spark, (1, "a b"), (2, "a b"), (3, "a c"))) == {1: 1, 2: 1, 3: 3}
