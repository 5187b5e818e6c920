from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from llm_checks import CLASHING, DOCUMENTS, edge_documents, no_documents
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tollstats.llm import alignment
from tollstats.llm.alignment import BYTE_BPE, PIECE_BPE, TOKENIZERS, align_documents, byte_bpe, byte_letters
from tollstats.llm.csr import Csr, counted, product, starts_of
from tollstats.llm.queries import op11_alignment

ODD = [
    "plain words, and more words", "<|endoftext|> <s> </s> <unk> <0x41>", "aaaa" * 50 + " b" * 40, "▁marked▁",
    "naïve café 漢字かな 😀👩‍👩‍👧 \u0000 nul", "tab\tnew\r\nline      spaces ", "1234567890" * 9, " ", "\n",
]


@pytest.fixture(scope="module")
def tokenizers():
    a = Tokenizer.from_file(f"{TOKENIZERS}/{BYTE_BPE}")
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=f"{TOKENIZERS}/{PIECE_BPE}")


def brute(texts, tokenizers):
    """Groups and links of every text token by token, and their counts over all texts."""
    a, b = tokenizers
    letters = byte_letters()
    documents = []
    for text in texts:
        whole = b" " + (text or "").encode()
        a_ids = a.encode(" " + text, add_special_tokens=False).ids if text else []
        b_ids = b.encode(text) if text else []
        a_bytes = [bytes(letters[c] for c in a.id_to_token(i)) for i in a_ids]
        pieces = [b.id_to_piece(i) for i in b_ids]
        b_bytes = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(b_ids, pieces)]
        if not text or b"".join(a_bytes) != whole or b"".join(b_bytes) != whole:
            documents.append(None)
            continue
        ends = [np.cumsum([len(t) for t in tokens]).tolist() for tokens in (a_bytes, b_bytes)]
        groups, open_a, open_b = [], [], []
        cuts = sorted(set(ends[0]) & set(ends[1]))
        for cut in cuts:
            groups.append(([], []))
        for side, (ids, stops) in enumerate(zip((a_ids, b_ids), ends)):
            for i, stop in zip(ids, stops):
                groups[next(n for n, cut in enumerate(cuts) if stop <= cut)][side].append(i)
        overlaps = 0
        for x, y in zip([0, *ends[0]], ends[0]):
            overlaps += sum(1 for u, v in zip([0, *ends[1]], ends[1]) if x < v and u < y)
        documents.append((groups, overlaps))
    links = [Counter((i, j) for g in d[0] for i in g[0] for j in g[1]) if d else Counter() for d in documents]
    count = Counter(pair for link in links for pair in link)
    highest = defaultdict(int)
    for (i, _), n in count.items():
        highest[i] = max(highest[i], n)
    rows = []
    for d, link in zip(documents, links):
        if d is None:
            rows.append((0, 0, 0, 0, 0, 0, 0, ""))
            continue
        text = ";".join(",".join(map(str, g[0])) + "|" + ",".join(map(str, g[1])) for g in d[0])
        rows.append(
            (
                sum(len(g[0]) for g in d[0]), sum(len(g[1]) for g in d[0]), len(d[0]), d[1], sum(link.values()),
                sum(n for pair, n in link.items() if count[pair] == highest[pair[0]]),
                sum(n * count[pair] for pair, n in link.items()), hashlib.sha256(text.encode()).hexdigest(),
            )
        )
    return rows


COLUMNS = ["n_a", "n_b", "n_groups", "n_overlaps", "n_links", "n_best", "count_sum", "groups_sha256"]


def check(frame, texts, tokenizers):
    got = sorted(tuple(r[c] for c in COLUMNS) for r in frame.collect())
    assert got == sorted(brute(texts, tokenizers))


def test_equals_token_by_token(spark, tokenizers):
    given = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where(F.length("text") < 3000)
    texts = [r.text for r in given.select("text").collect()] + ODD + [None, "", ODD[0]]
    frame = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(texts)], DOCUMENTS)
    result = align_documents(frame)
    assert sorted(r.doc_id for r in result.select("doc_id").collect()) == list(range(len(texts)))
    check(result, texts, tokenizers)


def test_counts_reach_over_blocks(spark, tokenizers, monkeypatch):
    monkeypatch.setattr(alignment, "CHUNK_CHARS", 100)
    monkeypatch.setattr(alignment, "BLOCK_CHARS", 300)
    texts = ODD * 7 + ["the same text"] * 40
    frame = spark.createDataFrame([(i % 5, t, "en", "s", 0) for i, t in enumerate(texts)], DOCUMENTS).repartition(3)
    check(align_documents(frame), texts, tokenizers)


def test_whole_table_has_a_row_per_document(spark):
    path = "/root/testdata/sf0.001"
    documents = spark.read.parquet(f"{path}/documents.parquet")
    result = op11_alignment(spark, path)
    assert {r.doc_id for r in result.collect()} == {r.doc_id for r in documents.collect()}
    assert result.count() == documents.count()


def test_edges(spark, tokenizers):
    frame = edge_documents(spark).withColumns({c: F.lit(1) for c in ("block", "pairs", "times", "held", "documents", "pair")})
    assert set(CLASHING) <= set(frame.columns)
    rows = [r for r in frame.collect() if r.doc_id != 5]
    check(align_documents(frame.where("doc_id is null or doc_id <> 5")), [r.text for r in rows], tokenizers)
    assert align_documents(frame).count() == len(rows) + 1
    empty = align_documents(no_documents(spark))
    assert empty.count() == 0 and {"doc_id", *COLUMNS} == set(empty.columns)


def test_every_character_is_cut_as_the_file_says(tokenizers):
    """The file's own library and the merging by ids agree on the class of every code point."""
    encoding, _ = byte_bpe(f"{TOKENIZERS}/{BYTE_BPE}")
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for at in range(0, len(points), 50000):
        texts = [f" a{c}b 1{c}2  {c} {c}'{c}s!{c}{c}x\n{c}" for c in map(chr, points[at : at + 50000])]
        want = tokenizers[0].encode_batch_fast(texts, add_special_tokens=False)
        assert all(encoding.encode_ordinary(t) == w.ids for t, w in zip(texts, want))


def test_a_long_run_of_one_token_stays_one_link(tokenizers):
    words = alignment.vocabulary([b"aa", b"aaa"])
    tokens = alignment.Tokens(np.zeros(30000, int), np.ones(20000, int), np.array([30000]), np.array([20000]))
    found = alignment.align(tokens, words, words)
    assert found.n_groups.tolist() == [10000] and found.pairs.tolist() == [1] and found.times.tolist() == [60000]


def test_products_equal_dense_ones():
    random = np.random.default_rng(3)
    for _ in range(100):
        n, m, k = random.integers(1, 8, 3)
        left, right = random.integers(0, 3, (n, m)), random.integers(0, 3, (m, k))

        def rows(x):
            return Csr(starts_of((x > 0).sum(axis=1)), np.nonzero(x)[1], x[np.nonzero(x)])

        got = product(rows(left), rows(right), int(k), expanded=int(random.integers(1, 9)))
        dense = np.zeros((n, k), int)
        dense[got.row, got.column] = got.weight
        assert (dense == left @ right).all() and (got.weight > 0).all()
        again = counted(np.repeat(got.row, got.weight), np.repeat(got.column, got.weight), n, k)
        assert (again.columns == got.column).all() and (again.weights == got.weight).all()
