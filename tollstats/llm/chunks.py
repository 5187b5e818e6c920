"""Substring deduplication by content-defined chunks.

A gear hash rolls over the bytes of a text, and a chunk ends where it falls
below a threshold. Such ends depend on the preceding bytes only, so a passage
is cut alike wherever it stands, apart from its first and last chunk. Chunks
that an earlier document has as well are found by their digests, and runs of
them that are long enough are removed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tollstats.llm.shipping import ship_package
from tollstats.llm.staging import staged
from tollstats.llm.tokens import mix, prefix_hashes, slice_hashes, word_bounds

# Bytes of a chunk: at least, beyond that on average, at most.
LEAST, SPREAD, MOST = 16, 32, 128
# A run of repeated chunks is removed if it has this many words.
RUN_WORDS = 12
BLOCK = 1 << 18

_GEAR = (mix(np.arange(1, 257, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32)
_SECOND = mix(np.arange(1001, 1257, dtype=np.uint64))
_CUT_BELOW = np.uint32(2**32 // SPREAD)


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """The rolling hash h = 2 h + gear[byte] modulo 2^32 behind every byte.

    Shifting makes bytes older than 32 vanish, so five doublings of the window
    give what the loop over the bytes would.
    """
    h = _GEAR[data]
    for window in (1, 2, 4, 8, 16):
        h[window:] = h[window:] + (h[:-window] << np.uint32(window))
    return h


def _block_cuts(data: np.ndarray) -> list[int]:
    """Ends of the chunks of one block; never inside a character.

    A chunk that would grow too long ends at the last of its lowest hashes, so
    words repeated over and over are cut in step wherever they stand.
    """
    hashes = gear_hashes(data)
    hashes[:-1][(data[1:] & 0xC0) == 0x80] = 2**32 - 1
    ends = np.flatnonzero(hashes < _CUT_BELOW) + 1
    cuts, last = [], 0
    for end in [*ends.tolist(), len(data)]:
        while end - last > MOST:
            window = hashes[last + LEAST - 1 : last + MOST]
            last += MOST - int(np.argmin(window[::-1]))
            cuts.append(last)
        if end - last >= LEAST or (end == len(data) and end > last):
            cuts.append(end)
            last = end
    return cuts


def chunk(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """End, first and second digest of every chunk. Blocks bound the memory of long texts."""
    data = np.frombuffer(raw, dtype=np.uint8)
    ends, one, two = [], [], []
    at = 0
    while at < len(data):
        stop = min(len(data), at + BLOCK)
        while stop < len(data) and (data[stop] & 0xC0) == 0x80:
            stop += 1
        block = data[at:stop]
        cuts = np.array(_block_cuts(block))
        starts = np.append(0, cuts[:-1])
        one.append(slice_hashes(prefix_hashes(block), starts, cuts))
        two.append(slice_hashes(prefix_hashes(block, _SECOND), starts, cuts))
        ends.append(cuts + at)
        at = stop
    if not ends:
        none = np.zeros(0, dtype=np.int64)
        return none, none, none
    return (
        np.concatenate(ends),
        np.concatenate(one).view(np.int64),
        np.concatenate(two).view(np.int64),
    )


def _digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The distinct chunks of each document."""
    for batch in batches:
        found = [np.unique(chunk((text or "").encode())[1]) for text in batch["text"]]
        yield pd.DataFrame({"owner": batch["owner"], "row_key": batch["row_key"], "digests": found})


def _runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and behind-last index of every run of true flags."""
    step = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


def remove_repeats(text: str | None, repeated: np.ndarray, run_words: int = RUN_WORDS) -> tuple:
    """(kept text, number of chunks, removed chunks, removed spans in characters)."""
    if text is None:
        return None, 0, 0, []
    raw = text.encode()
    ends, one, _ = chunk(raw)
    flags = np.isin(one, repeated)
    if not flags.any():
        return text, len(ends), 0, []
    starts = np.append(0, ends[:-1])
    data = np.frombuffer(raw, dtype=np.uint8)
    words, _ = word_bounds(data)
    spans, removed = [], 0
    for first, last in zip(*_runs(flags)):
        start, stop = starts[first], ends[last - 1]
        if np.searchsorted(words, stop) - np.searchsorted(words, start) >= run_words:
            spans.append((start, stop))
            removed += int(last - first)
    if not spans:
        return text, len(ends), 0, []
    characters = np.append(0, np.cumsum((data & 0xC0) != 0x80))
    places = [(int(characters[a]), int(characters[b])) for a, b in spans]
    kept, at = [], 0
    for a, b in places:
        kept.append(text[at:a])
        at = b
    kept.append(text[at:])
    return "".join(kept), len(ends), removed, places


def _owner(doc_id: Column, text: Column) -> Column:
    """The id; where it is null, a number from the text behind all usual ids."""
    hashed = F.xxhash64(text).bitwiseAND(F.lit(2**61 - 1))
    return F.coalesce(doc_id.cast("bigint"), F.lit(2**63 - 1) - hashed)


def deduplicate_substrings(documents: DataFrame, run_words: int = RUN_WORDS) -> DataFrame:
    """The documents without passages that a document of a smaller id has as well.

    All columns stay; ``text`` is what is kept of the text, and ``chunks``,
    ``repeated`` (chunks that went with a passage) and ``removed`` (spans
    of the original text in characters) are added, replacing columns of these
    names. A passage goes if its repeated chunks in a row hold ``run_words``
    words or more; repeats within a document stay. Every digest keeps its
    smallest and largest document only, so a passage of any number of documents
    is one row per map task.

    A null text stays null and an empty one empty. Documents without an id
    come behind all others, in the order of a hash of their text. Texts of one
    id repeat nothing from each other, and rows that repeat both id and text
    (or the text, without an id) are one document. A copy under another id
    loses its whole text but keeps its row. An empty table gives an empty
    result.

    Texts are chunked twice: once for the digests, which are staged, and once
    for the edit. A digest is 64 bits wide; a chance collision of single
    chunks removes nothing, as only runs of chunks go.
    """
    ship_package(documents.sparkSession)
    names = [c for c in documents.columns if c not in ("chunks", "repeated", "removed")]
    owner = _owner(F.col("doc_id"), F.col("text"))
    row_key = F.xxhash64(owner, F.coalesce("text", F.lit("")))
    owned = documents.select(owner.alias("owner"), row_key.alias("row_key"), F.struct(*names).alias("row"))
    chunked = staged(
        owned.select("owner", "row_key", F.col("row.text").alias("text")).mapInPandas(
            _digests, "owner long, row_key long, digests array<long>"
        ),
        "chunks",
    )
    digests = chunked.select("owner", "row_key", F.explode("digests").alias("digest"))
    shared = (
        digests.groupBy("digest")
        .agg(F.min("owner").alias("first"), F.max("owner").alias("last"))
        .where(F.col("first") < F.col("last"))
        .select("digest", "first")
    )
    # A set of one text's chunks, however often its row is repeated.
    repeated = (
        digests.join(shared, "digest")
        .where(F.col("owner") > F.col("first"))
        .groupBy("row_key")
        .agg(F.collect_set("digest").alias("digests"))
    )

    @F.pandas_udf(
        "text string, chunks int, repeated int, removed array<struct<start: int, stop: int>>"
    )
    def edited(texts: pd.Series, digests: pd.Series) -> pd.DataFrame:
        none = np.zeros(0, dtype=np.int64)
        rows = [
            remove_repeats(t, none if d is None else np.asarray(d), run_words)
            for t, d in zip(texts, digests)
        ]
        done = pd.DataFrame(rows, columns=["text", "chunks", "repeated", "removed"])
        done["removed"] = [[{"start": a, "stop": b} for a, b in r] for r in done["removed"]]
        return done

    joined = owned.join(repeated, "row_key", "left").select(
        "row", edited("row.text", "digests").alias("done")
    )
    return joined.select(
        *[F.col("done.text").alias(c) if c == "text" else F.col(f"row.{c}").alias(c) for c in names],
        "done.chunks",
        "done.repeated",
        "done.removed",
    )


def deduplicated_documents(documents: DataFrame, run_words: int = RUN_WORDS) -> DataFrame:
    """The edited documents with the columns they came with; n_chars follows the text."""
    edited = deduplicate_substrings(documents, run_words)
    if "n_chars" in documents.columns:
        kind = documents.schema["n_chars"].dataType
        changed = F.when(F.size("removed") > 0, F.length("text")).otherwise(F.col("n_chars"))
        edited = edited.withColumn("n_chars", changed.cast(kind))
    return edited.select(*documents.columns)
