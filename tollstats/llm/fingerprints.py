"""Homomorphic multiset fingerprints of documents.

A document is the multiset of its paragraphs (lines that hold a word; blanks
between words do not count). Each paragraph is hashed to a wide vector, and the
fingerprint is the sum of these vectors modulo powers of two. Sums do not know
an order, so rearranged paragraphs give the same fingerprint, and a paragraph
is inserted or deleted by adding or subtracting its vector.

A vector has two parts. ``IDENTITY_LANES`` numbers modulo 2^16, all from one
SHAKE-128 digest of the whole paragraph, decide equality. ``LIKENESS_LANES`` numbers modulo
2^32 sum a signed unit for the paragraph and for each of its runs of three
words; as expected inner products count shared runs, their cosine estimates how
alike two documents are.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from hashlib import shake_128
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tollstats.llm.shipping import ship_package
from tollstats.llm.tokens import BLOCK_BYTES, shingle_hashes, word_hashes

IDENTITY_LANES = 64
LIKENESS_LANES = 256
RUN_WORDS = 3
# About this many documents meet in one bucket of neighbouring ids.
BUCKET_ROWS = 500
MAX_BUCKETS = 4096
SMALLEST = -(2**63)

_KINDS = [("identity", "<u2", (IDENTITY_LANES,)), ("likeness", "<u4", (LIKENESS_LANES,))]
VECTOR = np.dtype(_KINDS)


def fingerprint(text: str | None) -> np.ndarray:
    """The vector of a whole text; a text without words has the zero vector."""
    vector = np.zeros((), dtype=VECTOR)
    counts = np.zeros(LIKENESS_LANES)
    for lines in _line_blocks((text or "").encode()):
        words = [split for line in lines if (split := line.split())]
        if not words:
            continue
        # One digest as wide as all lanes together: each lane has bits of its own.
        wide = np.frombuffer(
            b"".join(shake_128(b" ".join(w)).digest(2 * IDENTITY_LANES) for w in words), dtype="<u2"
        ).reshape(-1, IDENTITY_LANES)
        vector["identity"] += wide.sum(axis=0, dtype=np.uint16)
        found = [np.ascontiguousarray(wide[:, :4]).view("<u8")[:, 0]]
        hashes = word_hashes(b" ".join(chain.from_iterable(words)))
        if len(hashes) >= RUN_WORDS:
            last = len(hashes) - RUN_WORDS + 1
            line = np.repeat(np.arange(len(words)), [len(w) for w in words])
            runs = shingle_hashes(hashes, RUN_WORDS)
            found.append(runs[line[:last] == line[RUN_WORDS - 1 :]])
        units = np.concatenate(found)
        sign = np.where(units >> np.uint64(63), 1.0, -1.0)
        counts += np.bincount((units % np.uint64(LIKENESS_LANES)).astype(np.int64), weights=sign, minlength=LIKENESS_LANES)
    vector["likeness"] = counts.astype(np.int64).astype(np.uint32)
    return vector


def _line_blocks(raw: bytes) -> Iterator[list[bytes]]:
    """The lines, in blocks of about BLOCK_BYTES: memory follows the longest line, not the text."""
    at = 0
    while at < len(raw):
        stop = raw.find(b"\n", at + BLOCK_BYTES)
        stop = len(raw) if stop < 0 else stop
        yield raw[at:stop].split(b"\n")
        at = stop + 1


def combined(base: np.ndarray, change: np.ndarray, times: int = 1) -> np.ndarray:
    """``base`` with the paragraphs of ``change`` inserted (times=1) or deleted (times=-1)."""
    result = base.copy()
    for name, kind, _ in _KINDS:
        result[name] = base[name] + change[name] * np.array(times).astype(np.dtype(kind))
    return result


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """1 for equal vectors, else the cosine of the likeness parts, at least 0."""
    if a.tobytes() == b.tobytes():
        return 1.0
    x = a["likeness"].view(np.int32).astype(np.float64)
    y = b["likeness"].view(np.int32).astype(np.float64)
    size = np.sqrt((x @ x) * (y @ y))
    return float(np.clip(x @ y / size, 0.0, 1.0)) if size else 0.0


def to_text(vector: np.ndarray) -> str:
    return base64.b64encode(vector.tobytes()).decode()


def from_text(text: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(text), dtype=VECTOR)[0]


def fingerprint_column(text: Column) -> Column:
    """Fingerprints of a text column; null is an empty text."""

    @F.pandas_udf("string")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([to_text(fingerprint(t)) for t in texts], dtype=object)

    return of(text)


def edited_column(base: Column, paragraphs: Column, times: int = 1) -> Column:
    """Fingerprints after inserting (times=1) or deleting (times=-1) the paragraphs of a text."""

    @F.pandas_udf("string")
    def of(bases: pd.Series, texts: pd.Series) -> pd.Series:
        return pd.Series(
            [to_text(combined(from_text(b), fingerprint(t), times)) for b, t in zip(bases, texts)],
            dtype=object,
        )

    return of(base, paragraphs)


def with_fingerprint(documents: DataFrame) -> DataFrame:
    """The documents and their fingerprint, which replaces a column of that name."""
    ship_package(documents.sparkSession)
    return documents.withColumn("fingerprint", fingerprint_column(F.col("text")))


def _placed(documents: DataFrame) -> DataFrame:
    """Rows (bucket, guest, key, doc_id, text) such that sorting a bucket by (guest, key
    descending, text) puts behind every own row the row that follows it among all documents.

    Buckets are ranges of ids that end at quantiles, which are ids themselves.
    The first row below a bucket is therefore known: it has the quantile that
    ends the range below, and is a guest at the end of the bucket. The largest
    id is the guest of the lowest bucket, as the order is a ring.
    """
    keyed = documents.select(
        F.coalesce("doc_id", F.lit(SMALLEST)).alias("key"),
        "doc_id",
        F.coalesce("text", F.lit("")).alias("text"),
    )
    size = keyed.agg(F.count("*").alias("rows"), F.max("key").alias("top")).first()
    if not size["rows"]:
        return keyed.select(F.lit(0).alias("bucket"), F.lit(False).alias("guest"), "*")
    buckets = min(MAX_BUCKETS, -(-size["rows"] // BUCKET_ROWS))
    steps = [i / buckets for i in range(1, buckets)]
    inner = keyed.agg(F.percentile_approx("key", steps, 10 * MAX_BUCKETS)).first()[0] if steps else []
    # Sorted upper ends of the buckets, at most MAX_BUCKETS of them.
    tops = sorted({*inner, size["top"]})
    hosts = {top: i + 1 for i, top in enumerate(tops[:-1])} | {tops[-1]: 0}

    @F.pandas_udf("array<struct<bucket: int, guest: boolean>>")
    def stays(keys: pd.Series) -> pd.Series:
        own = np.searchsorted(np.array(tops), keys.to_numpy())
        return pd.Series(
            [
                [{"bucket": b, "guest": False}]
                + ([{"bucket": hosts[k], "guest": True}] if k in hosts else [])
                for k, b in zip(keys.tolist(), own.tolist())
            ]
        )

    return keyed.select(F.inline(stays("key")), "key", "doc_id", "text")


def neighbour_fingerprints(documents: DataFrame) -> DataFrame:
    """Every document's fingerprint, that of its edited text, and how alike they and its neighbour are.

    The edited text has the last floor(n_chars / 2) characters replaced by the
    first as many (or all) of the next document in descending doc_id; the one
    after the last is the first. Columns: doc_id, n_chars, edited_sha256,
    fingerprint, edited_fingerprint, near_edited, near_next.

    Texts are shuffled once, into buckets of neighbouring ids, and read in
    order. A null text is empty; a null doc_id comes last; rows of one id
    follow in the order of their texts; a single document is its own
    neighbour; an empty table gives an empty result; further columns are
    ignored.
    """
    spark = documents.sparkSession
    ship_package(spark)
    placed = _placed(documents)
    ordered = placed.repartition("bucket").sortWithinPartitions(
        "bucket", "guest", F.desc("key"), "text"
    )
    return ordered.select("bucket", "guest", "doc_id", "text").mapInPandas(
        _compare_in_order,
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double",
    )


def _compare_in_order(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    waiting = None  # the previous row, until the next one of its bucket is known
    for batch in batches:
        done = []
        ids = batch["doc_id"].astype("Int64")
        for bucket, guest, doc_id, text in zip(batch["bucket"], batch["guest"], ids, batch["text"]):
            vector = fingerprint(text)
            if waiting is not None and waiting[0] == bucket:
                done.append(_compared(*waiting[1:], text, vector))
            waiting = None if guest else (bucket, doc_id, text, vector)
        result = pd.DataFrame(done, columns=_COLUMNS)
        result["doc_id"] = result["doc_id"].astype("Int64")
        yield result


_COLUMNS = [
    "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next",
]


def _compared(doc_id, text: str, vector: np.ndarray, next_text: str, next_vector: np.ndarray) -> tuple:
    half = len(text) // 2
    edited = text[: len(text) - half] + next_text[:half]
    other = fingerprint(edited)
    digest = hashlib.sha256(edited.encode()).hexdigest()
    return (
        doc_id, len(text), digest, to_text(vector), to_text(other),
        likeness(vector, other), likeness(vector, next_vector),
    )
