"""Links between the tokens of two tokenizers, and how common they are in the corpus.

Both tokenizers cover the same bytes of a text. With a row per token and a
column per byte, the incidence matrices A and B give in A x B^T every pair of
tokens that overlap. Where both tokenizers end a token at the same byte, a
group ends, so the overlap links also tell the groups apart. The products of
the group incidences give the links: all pairs of tokens that share a group.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterable, Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from tollstats.llm.csr import Csr, counted, product, starts_of
from tollstats.llm.shipping import ship_package
from tollstats.llm.staging import checkpointed, staged

TOKENIZERS = "/opt/tokenizers"
BYTE_BPE, PIECE_BPE = "byte_bpe_50k.json", "piece_bpe_32k.model"
# Fixed value: the pattern by which byte-level BPE cuts a text before it merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SPACE_MARK = "\u2581"
# Text that is aligned at a time, and text whose links are counted together.
CHUNK_CHARS, BLOCK_CHARS = 1 << 19, 1 << 24

ROW_CHARS = 64  # what a row counts besides its text

COUNTED = ["n_a", "n_b", "n_groups", "n_links", "n_overlaps"]
ENCODED = pa.schema(
    [("block", pa.int64()), ("doc_id", pa.int64()), *[(name, pa.int64()) for name in COUNTED]]
    + [("groups_sha256", pa.string()), ("pairs", pa.binary()), ("times", pa.binary())]
    + [("held", pa.list_(pa.int64())), ("documents", pa.list_(pa.int64()))]
)
RESULT = f"doc_id long, {', '.join(f'{name} long' for name in COUNTED)}, n_best long, count_sum long, groups_sha256 string"


class Vocabulary(NamedTuple):
    """The bytes of every token, and its id as text before a comma, a bar and a semicolon."""

    tokens: list[bytes]
    lengths: np.ndarray
    inside: np.ndarray
    before_bar: np.ndarray
    before_semicolon: np.ndarray


class Tokens(NamedTuple):
    """Ids of both tokenizers for the documents that have tokens, one after another."""

    a: np.ndarray
    b: np.ndarray
    n_a: np.ndarray
    n_b: np.ndarray


class Aligned(NamedTuple):
    """Per document: groups, links, overlapping pairs, digest; and its distinct linked id pairs."""

    n_groups: np.ndarray
    n_links: np.ndarray
    n_overlaps: np.ndarray
    digests: list[str]
    pair_starts: np.ndarray
    pairs: np.ndarray
    times: np.ndarray


def vocabulary(tokens: list[bytes]) -> Vocabulary:
    def texts(end: str) -> np.ndarray:
        return np.array([f"{i}{end}" for i in range(len(tokens))], dtype=object)

    return Vocabulary(tokens, np.array([len(t) for t in tokens]), texts(","), texts("|"), texts(";"))


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary.

    Printable bytes of Latin-1 stand for themselves; the others follow from 256 on.
    """
    printable = [*range(ord("!"), ord("~") + 1), *range(ord("\u00a1"), ord("\u00ac") + 1), *range(ord("\u00ae"), 256)]
    others = [byte for byte in range(256) if byte not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


@lru_cache(maxsize=2)
def byte_bpe(path: str) -> tuple[tiktoken.Encoding, Vocabulary]:
    """A byte-level BPE file, without its special tokens.

    Its ids grow with the order of its merges, which is checked here, so merging
    the smallest id first gives the same tokens as the list of merges.
    """
    with open(path, encoding="utf-8") as file:
        model = json.load(file)["model"]
    letters = byte_letters()
    ranks = {bytes(letters[c] for c in token): i for token, i in model["vocab"].items() if all(c in letters for c in token)}
    merged = [model["vocab"]["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
    known = [token for token, _ in sorted(ranks.items(), key=lambda item: item[1])]
    known = known[: 256 + len(merged)]
    if merged != list(range(256, 256 + len(merged))) or any(ranks[t] != i for i, t in enumerate(known)):
        raise ValueError(f"{path}: ids do not follow the merges")
    encoding = tiktoken.Encoding(
        path, pat_str=PATTERN, mergeable_ranks={t: i for i, t in enumerate(known)}, special_tokens={}
    )
    return encoding, vocabulary(known)


@lru_cache(maxsize=2)
def piece_bpe(path: str) -> tuple[sentencepiece.SentencePieceProcessor, Vocabulary]:
    """A BPE of pieces that falls back to bytes."""
    processor = sentencepiece.SentencePieceProcessor(model_file=path)

    def token(i: int) -> bytes:
        piece = processor.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if processor.is_byte(i) else piece.replace(SPACE_MARK, " ").encode()

    return processor, vocabulary([token(i) for i in range(processor.get_piece_size())])


def tokenize(texts: list[str | None], a_path: str, b_path: str) -> tuple[Tokens, np.ndarray]:
    """Tokens of the texts that have some, and the numbers of these texts.

    A null or empty text has none, nor has one whose tokens' bytes are not a
    space and the text in both tokenizers.
    """
    (a_encoding, a_words), (b_processor, b_words) = byte_bpe(a_path), piece_bpe(b_path)
    given = [i for i, text in enumerate(texts) if text]
    a_ids = [a_encoding.encode_ordinary(" " + texts[i]) for i in given]
    b_ids = b_processor.encode([texts[i] for i in given], num_threads=1) if given else []
    kept = []
    for at, i in enumerate(given):
        whole = b" " + texts[i].encode()
        joined_a, joined_b = (b"".join([t[x] for x in ids]) for t, ids in ((a_words.tokens, a_ids[at]), (b_words.tokens, b_ids[at])))
        if joined_a == whole and joined_b == whole:
            kept.append(at)

    def flat(ids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
        lengths = np.array([len(ids[at]) for at in kept], dtype=np.int64)
        parts = [np.array(ids[at], dtype=np.int64) for at in kept]
        return np.concatenate(parts) if parts else np.zeros(0, dtype=np.int64), lengths

    (a, n_a), (b, n_b) = flat(a_ids), flat(b_ids)
    return Tokens(a, b, n_a, n_b), np.array([given[at] for at in kept], dtype=np.int64)


def align(tokens: Tokens, a_words: Vocabulary, b_words: Vocabulary) -> Aligned:
    """Groups and links of documents whose tokens cover the same bytes in both tokenizers.

    The matrices of all the documents stand along one diagonal: no group and no
    overlap reaches beyond a document. Within a group, equal ids are counted
    before they are linked, so a long run of one token stays one entry.
    """
    docs, n_a, n_b = len(tokens.n_a), len(tokens.a), len(tokens.b)
    if not n_a:
        zeros = np.zeros(docs, dtype=np.int64)
        none = np.zeros(0, dtype=np.int64)
        return Aligned(zeros, zeros, zeros, [""] * docs, np.zeros(docs + 1, dtype=np.int64), none, none)
    a_bytes, b_bytes = a_words.lengths[tokens.a], b_words.lengths[tokens.b]
    n_bytes = int(a_bytes.sum())
    by_byte = np.repeat(np.arange(n_b, dtype=np.int64), b_bytes)
    overlaps = product(
        Csr(starts_of(a_bytes), np.arange(n_bytes, dtype=np.int64)), Csr(np.arange(n_bytes + 1), by_byte), n_b
    )
    doc_of_a = np.repeat(np.arange(docs), tokens.n_a)
    n_overlaps = np.bincount(doc_of_a[overlaps.row], minlength=docs)
    # From one overlap to the next both tokens change exactly where a group ends.
    changes = (np.diff(overlaps.row) > 0) & (np.diff(overlaps.column) > 0)
    group = starts_of(changes)
    groups = int(group[-1]) + 1
    group_of_a, group_of_b = np.empty(n_a, dtype=np.int64), np.empty(n_b, dtype=np.int64)
    group_of_a[overlaps.row], group_of_b[overlaps.column] = group, group
    doc_of_group = np.empty(groups, dtype=np.int64)
    doc_of_group[group_of_a] = doc_of_a

    n_ids = len(a_words.tokens), len(b_words.tokens)
    key = doc_of_a * n_ids[0] + tokens.a
    names, row_of_a = np.unique(key, return_inverse=True)
    ids_in_groups = counted(row_of_a, group_of_a, len(names), groups)
    groups_of_ids = counted(group_of_b, tokens.b, groups, n_ids[1])
    links = product(ids_in_groups, groups_of_ids, n_ids[1])
    name = names[links.row]
    doc_of_link = name // n_ids[0]
    pairs = name % n_ids[0] * n_ids[1] + links.column
    return Aligned(
        np.bincount(doc_of_group, minlength=docs),
        np.bincount(doc_of_link, weights=links.weight, minlength=docs).astype(np.int64),
        n_overlaps,
        _digests(tokens, group_of_a, group_of_b, a_words, b_words),
        starts_of(np.bincount(doc_of_link, minlength=docs)),
        pairs,
        links.weight,
    )


def _digests(
    tokens: Tokens, group_of_a: np.ndarray, group_of_b: np.ndarray, a_words: Vocabulary, b_words: Vocabulary
) -> list[str]:
    """SHA-256 of every document's groups as ``a1,a2|b1;a3|b2,b3``."""
    last_a = np.append(group_of_a[1:] != group_of_a[:-1], True)
    last_b = np.append(group_of_b[1:] != group_of_b[:-1], True)
    a_starts = starts_of(np.bincount(group_of_a))
    b_starts = starts_of(np.bincount(group_of_b))
    texts = np.empty(len(tokens.a) + len(tokens.b), dtype=object)
    a_texts, b_texts = a_words.inside[tokens.a], b_words.inside[tokens.b]
    a_texts[last_a], b_texts[last_b] = a_words.before_bar[tokens.a[last_a]], b_words.before_semicolon[tokens.b[last_b]]
    texts[np.arange(len(tokens.a)) + b_starts[group_of_a]] = a_texts
    texts[np.arange(len(tokens.b)) + a_starts[group_of_b + 1]] = b_texts
    ends = np.cumsum(tokens.n_a + tokens.n_b)
    return [
        hashlib.sha256("".join(texts[end - n : end].tolist())[:-1].encode()).hexdigest()
        for end, n in zip(ends, tokens.n_a + tokens.n_b)
    ]



def encode_documents(batches: Iterable[pa.RecordBatch], a_path: str, b_path: str) -> Iterator[pa.RecordBatch]:
    """A row per document and, after each block of them, a row with the block's id pairs.

    Blocks follow the order of a task's rows and carry its partition's number,
    so a task that runs again writes the same blocks.
    """
    a_words, b_words = byte_bpe(a_path)[1], piece_bpe(b_path)[1]
    block, size, held = TaskContext.get().partitionId() << 32, 0, []

    def rows(ids: list[int | None], texts: list[str | None]) -> pa.RecordBatch:
        tokens, where = tokenize(texts, a_path, b_path)
        found = align(tokens, a_words, b_words)
        held.append(np.unique(found.pairs, return_counts=True))
        counts = [tokens.n_a, tokens.n_b, found.n_groups, found.n_links, found.n_overlaps]
        cuts = list(zip(found.pair_starts, found.pair_starts[1:]))

        def placed(values: list, empty) -> list:
            column = [empty] * len(ids)
            for i, value in zip(where, values):
                column[i] = value
            return column

        return pa.RecordBatch.from_arrays(
            [
                pa.array([block] * len(ids), pa.int64()),
                pa.array(ids, pa.int64()),
                *[pa.array(placed(c.tolist(), 0), pa.int64()) for c in counts],
                pa.array(placed(found.digests, ""), pa.string()),
                pa.array(placed([found.pairs[s:e].tobytes() for s, e in cuts], b""), pa.binary()),
                pa.array(placed([found.times[s:e].tobytes() for s, e in cuts], b""), pa.binary()),
                *[pa.nulls(len(ids), ENCODED.field(name).type) for name in ("held", "documents")],
            ],
            schema=ENCODED,
        )

    def counts_of_block() -> pa.RecordBatch:
        pairs, inverse = np.unique(np.concatenate([pairs for pairs, _ in held]), return_inverse=True)
        totals = np.zeros(len(pairs), dtype=np.int64)
        np.add.at(totals, inverse, np.concatenate([n for _, n in held]))
        row = {name: None for name in ENCODED.names}
        row |= {"block": block, "held": pairs.tolist(), "documents": totals.tolist()}
        return pa.RecordBatch.from_pylist([row], schema=ENCODED)

    for batch in batches:
        ids, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
        at = 0
        while at < len(ids):
            to, chars = at, 0
            while to < len(ids) and chars < CHUNK_CHARS:
                chars += ROW_CHARS + len(texts[to] or "")
                to += 1
            yield rows(ids[at:to], texts[at:to])
            size, at = size + chars, to
            if size >= BLOCK_CHARS:
                yield counts_of_block()
                block, size, held[:] = block + 1, 0, []
    if held:
        yield counts_of_block()


def _with_counts(docs: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
    """What the corpus-wide counts say of a block's documents."""
    known = known.sort_values("pair")
    pairs, times = (np.frombuffer(b"".join(docs[name]), dtype=np.int64) for name in ("pairs", "times"))
    at = np.searchsorted(known["pair"].to_numpy(), pairs)
    ends = np.cumsum([len(p) // 8 for p in docs["pairs"]], dtype=np.int64)
    starts = np.append(0, ends[:-1])

    def summed(name: str) -> np.ndarray:
        totals = starts_of(times * known[name].to_numpy(dtype=np.int64)[at])
        return totals[ends] - totals[starts]

    docs = docs.assign(n_best=summed("best"), count_sum=summed("documents"))
    return docs[[field.split(" ")[0] for field in RESULT.split(", ")]]


def pair_counts(encoded: DataFrame, b_ids: int) -> DataFrame:
    """pair (a id x ``b_ids`` + b id), documents that hold it linked, best: 1 if no pair of its a id has more."""
    held = encoded.where("held is not null").select(F.inline(F.arrays_zip("held", "documents")))
    totals = checkpointed(held.groupBy(F.col("held").alias("pair")).agg(F.sum("documents").alias("documents")))
    a_id = F.expr(f"pair div {b_ids}")
    highest = totals.groupBy(a_id.alias("a_id")).agg(F.max("documents").alias("highest"))
    # One row of two numbers per id of the first vocabulary at most.
    return totals.join(F.broadcast(highest), a_id == F.col("a_id")).select(
        "pair", "documents", (F.col("documents") == F.col("highest")).cast("int").alias("best")
    )


def align_documents(
    documents: DataFrame, folder: str = TOKENIZERS, a_file: str = BYTE_BPE, b_file: str = PIECE_BPE
) -> DataFrame:
    """Tokens, groups and links of every document under two tokenizers.

    ``documents`` needs doc_id and text; ``folder`` must exist on every
    executor. Per row come back n_a and n_b tokens, n_groups, n_links (pairs of
    token occurrences that share a group), n_overlaps (pairs that share a byte),
    n_best (links whose id pair is held linked by as many documents as any pair
    of its a id, ties included), count_sum (over the links, the documents that
    hold their id pair linked) and groups_sha256.

    A text that is null, empty or not given back by both tokenizers has no
    tokens: zeros, and '' instead of a digest. Every row is a document, also a
    repeated one and one without an id. Strings of special tokens are ordinary
    text. Further columns are ignored; an empty table gives an empty result.

    A document's pairs stay in one row, and pairs are counted per block of
    documents before they are shuffled: a pair that every document has costs one
    row a block. The counts return to each block in the same way.
    """
    spark = documents.sparkSession
    ship_package(spark)
    a_path, b_path = f"{folder}/{a_file}", f"{folder}/{b_file}"
    texts = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    encoded = staged(
        texts.mapInArrow(lambda batches: encode_documents(batches, a_path, b_path), from_arrow_schema(ENCODED)),
        "alignment",
    )
    counts = pair_counts(encoded, len(piece_bpe(b_path)[1].tokens))
    held = encoded.where("held is not null").select(
        F.col("block").alias("held_in"), F.explode("held").alias("pair")
    )
    known = held.join(counts, "pair").select("held_in", "pair", "documents", "best")
    docs = encoded.where("held is null").drop("held", "documents")
    return docs.groupBy("block").cogroup(known.groupBy("held_in")).applyInPandas(_with_counts, RESULT)
