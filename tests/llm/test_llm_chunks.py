from __future__ import annotations

from collections import Counter

import numpy as np
from llm_checks import documents, edge_documents, no_documents, words

from tollstats.llm import chunks
from tollstats.llm.registry import QUERIES


def test_gear_hash_equals_the_loop():
    data = np.frombuffer(words(3, 300).encode(), dtype=np.uint8)
    h, want = 0, []
    for byte in data.tolist():
        h = ((h << 1) + int(chunks._GEAR[byte])) % 2**32
        want.append(h)
    assert chunks.gear_hashes(data).tolist() == want


def test_chunks_keep_their_bounds_and_characters():
    text = (words(1, 3000) + "漢字😀é " * 400 + "a" * 3000 + "the " * 500) * 20
    raw = text.encode()
    ends, one, two = chunks.chunk(raw)
    sizes = np.diff(np.append(0, ends))
    assert sizes.sum() == len(raw) and sizes.max() <= chunks.MOST
    assert (sizes[:-1] < chunks.LEAST).sum() <= len(raw) // chunks.BLOCK + 1
    assert "".join(raw[a:b].decode() for a, b in zip(np.append(0, ends[:-1]), ends)) == text
    assert len(one) == len(two) == len(ends)


def test_insertions_shift_chunks_but_keep_most():
    text = words(5, 2000)
    before = set(chunks.chunk(text.encode())[1].tolist())
    after = set(chunks.chunk((text[:3000] + " inserted words " + text[3000:]).encode())[1].tolist())
    assert len(before & after) > 0.97 * len(before)


def windows(text, n=50):
    w = (text or "").split()
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}


def test_repeated_passages_go_and_others_stay(spark):
    """Against a brute-force search for windows of 50 words and for runs of 12."""
    passages = [words(1000 + i, 60) for i in range(5)]
    rows = []
    for i in range(200):
        body = [words(i, 80), words(5000 + i, 80)]
        if i % 3 == 0:
            body.insert(1, passages[i % 5])
        rows.append((i, " ".join(body)))
    rows.append((500, rows[0][1]))
    got = {r.doc_id: r for r in chunks.deduplicate_substrings(documents(spark, *rows)).collect()}
    seen = set()
    for doc_id, text in rows:
        r, repeats = got[doc_id], windows(text) & seen
        seen |= windows(text)
        if repeats:
            assert r.removed and not windows(r.text) & seen - windows(text) and not repeats & windows(r.text)
        elif not windows(text, 8) & {w for d, t in rows if d < doc_id for w in windows(t, 8)}:
            assert r.text == text and not r.removed
        kept, at = "", 0
        for s in r.removed:
            kept, at = kept + text[at : s.start], s.stop
        assert kept + text[at:] == r.text
    assert got[500].text == ""


def test_whole_table_leaves_no_repeated_passage(spark, medium):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{medium}/documents.parquet").collect()}
    rows = {r.doc_id: r for r in QUERIES["op6_substrings"](spark, medium).collect()}
    assert set(rows) == set(texts)
    seen, kept, repeated = set(), set(), 0
    for doc_id in sorted(texts):
        if windows(texts[doc_id]) & seen:
            repeated += 1
            assert rows[doc_id].removed
        assert not windows(rows[doc_id].text) & kept
        seen |= windows(texts[doc_id])
        kept |= windows(rows[doc_id].text)
    assert repeated > 50


def test_rows_that_repeat_an_id(spark):
    """Many rows of one id, with one text and with several: lists follow the text, not the rows."""
    long = words(1, 600)
    rows = [(7, long)] * 300 + [(7, words(50 + i, 60) + " " + words(2, 60)) for i in range(40)] + [(1, words(2, 60))] + [(9, long)]
    got = chunks.deduplicate_substrings(documents(spark, *rows)).collect()
    assert Counter(r.doc_id for r in got) == Counter(i for i, _ in rows)
    by_text = [r for r in got if r.doc_id == 7]
    assert sum(r.text == long for r in by_text) == 300
    assert sum(len(r.removed) == 1 and len(r.text.split()) < 80 for r in by_text) == 40  # the passage of id 1
    assert [r.text for r in got if r.doc_id == 9] == [""]
    assert all((r.repeated > 0) == bool(r.removed) for r in got)


def test_edges(spark):
    frame = edge_documents(spark)
    rows = chunks.deduplicate_substrings(frame).collect()
    assert len(rows) == 12 and rows[0].asDict().keys() == {*frame.columns, "chunks", "repeated", "removed"}
    by_id = {}
    for r in rows:
        by_id.setdefault(r.doc_id, []).append(r)
    assert [r.text for r in by_id[1]] == [words(1, 30)] * 2  # repeated rows are one document
    assert by_id[6][0].text == "" and by_id[4][0].text == " \n\t "
    assert None in [r.text for r in by_id[2]]
    assert chunks.deduplicate_substrings(no_documents(spark)).count() == 0
    plain = chunks.deduplicated_documents(documents(spark, (1, words(1, 90)), (2, "x " + words(1, 90)))).collect()
    assert [r.n_chars == len(r.text) for r in plain] == [True, True] and len(plain[0].asDict()) == 5
