from __future__ import annotations

import hashlib
import re

import numpy as np
import xxhash
from llm_checks import documents, edge_documents, no_documents, words
from pyspark.sql import functions as F

from tollstats.llm import fingerprints
from tollstats.llm.fingerprints import (
    IDENTITY_LANES,
    LIKENESS_LANES,
    combined,
    edited_column,
    fingerprint,
    from_text,
    likeness,
    neighbour_fingerprints,
    to_text,
    with_fingerprint,
)
from tollstats.llm.registry import QUERIES
from tollstats.llm.tokens import BASE, mix


def test_sums_know_no_order_but_count():
    parts = [words(i, 5 + i) for i in range(9)]
    whole = fingerprint("\n".join(parts))
    assert whole == fingerprint("\n\n".join(reversed(parts)))
    assert whole != fingerprint("\n".join([*parts, parts[0]]))
    assert whole != fingerprint(" ".join(parts))
    rest = fingerprint("\n".join(parts[1:]))
    assert combined(rest, fingerprint(parts[0])) == whole
    assert combined(whole, fingerprint(parts[0]), -1) == rest
    assert from_text(to_text(whole)) == whole


def test_long_texts_are_worked_through_in_blocks():
    lines = [words(i, 30) for i in range(4000)]
    total = fingerprint("")
    for line in lines:
        total = combined(total, fingerprint(line))
    assert fingerprint("\n".join(lines)) == total


def plain_vector(text):
    """Paragraph by paragraph and word by word."""
    identity, counts = [0] * IDENTITY_LANES, [0] * LIKENESS_LANES
    for line in (text or "").encode().split(b"\n"):
        w = re.findall(rb"[^\x20\x09-\x0D]+", line)
        if not w:
            continue
        digest = hashlib.shake_128(b" ".join(w)).digest(128)
        units = [int.from_bytes(digest[:8], "little")]
        for i in range(len(w) - 2):
            total = 0
            for x in w[i : i + 3]:
                total = (total * BASE + xxhash.xxh64_intdigest(x)) % 2**64
            units.append(int(mix(np.array([total], dtype=np.uint64))[0]))
        for i in range(IDENTITY_LANES):
            identity[i] = (identity[i] + int.from_bytes(digest[2 * i : 2 * i + 2], "little")) % 2**16
        for u in units:
            counts[u % LIKENESS_LANES] += 1 if u >> 63 else -1
    return identity, [c % 2**32 for c in counts]


def test_vectors_equal_a_plain_version(monkeypatch):
    texts = [words(1, 5), "a b", "a\rb \v c\n\n d  e f\ng", "", None, "\n".join(words(i, 1 + i % 9) for i in range(60)), "漢字 é 😀 " * 9]
    for size in (1 << 18, 16):
        monkeypatch.setattr(fingerprints, "BLOCK_BYTES", size)
        for text in texts:
            vector = fingerprint(text)
            assert (vector["identity"].tolist(), vector["likeness"].tolist()) == plain_vector(text)


def test_likeness_follows_what_is_shared():
    a, b = words(1, 400), words(2, 400)
    half = " ".join(a.split()[:200] + b.split()[200:])
    assert likeness(fingerprint(a), fingerprint(a)) == 1
    assert 0.35 < likeness(fingerprint(a), fingerprint(half)) < 0.65
    assert likeness(fingerprint(a), fingerprint(b)) < 0.25
    assert likeness(fingerprint(""), fingerprint(a)) == 0 and likeness(fingerprint(""), fingerprint(None)) == 1


def check(rows, docs):
    """Against the order of all documents, taken at once."""
    order = sorted(docs, key=lambda d: (d[0] is None, -(d[0] or 0), d[1] or ""))
    want = []
    for i, (doc_id, text) in enumerate(order):
        text, following = text or "", order[(i + 1) % len(order)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        want.append((
            doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), to_text(fingerprint(text)),
            to_text(fingerprint(edited)), likeness(fingerprint(text), fingerprint(edited)),
            likeness(fingerprint(text), fingerprint(following)),
        ))
    assert sorted((tuple(r) for r in rows), key=str) == sorted(want, key=str)


def test_whole_table(spark, medium):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{medium}/documents.parquet").collect()]
    check(QUERIES["op7_fingerprints"](spark, medium).collect(), docs)


def test_sparse_ids_and_edges(spark):
    docs = [(i * i * 977, words(i, 4 + i % 5)) for i in range(1200)]
    check(neighbour_fingerprints(documents(spark, *docs)).collect(), docs)
    frame = edge_documents(spark)
    check(neighbour_fingerprints(frame).collect(), [(r.doc_id, r.text) for r in frame.collect()])
    check(neighbour_fingerprints(documents(spark, (5, "only one"))).collect(), [(5, "only one")])
    check(neighbour_fingerprints(documents(spark, (5, "abc"), (5, "abc"))).collect(), [(5, "abc")] * 2)
    assert neighbour_fingerprints(no_documents(spark)).count() == 0


def test_incremental_edits_as_columns(spark):
    frame = with_fingerprint(documents(spark, (1, "one line\nanother line"), (2, None)))
    more = frame.select("doc_id", edited_column(F.col("fingerprint"), F.lit("third line")).alias("f"))
    got = {r.doc_id: r.f for r in more.collect()}
    assert got[1] == to_text(fingerprint("third line\none line\nanother line"))
    assert got[2] == to_text(fingerprint("third line"))
