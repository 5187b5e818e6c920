"""Best-fit packing of documents into bins of equal capacity, under conflicts.

A bin never holds two pieces of one source nor of one cluster of duplicates.
Documents are dealt into many groups of bounded size by a hash, and each group
is packed by itself: pieces by falling size, every one into the compatible bin
that it leaves the least room in.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tollstats.llm.mixing import word_count
from tollstats.llm.shipping import ship_package
from tollstats.llm.staging import checkpointed

CAPACITY = 1024
GROUP_ROWS = 2048
COPY_BLOCK = 1000


def best_fit(sizes: np.ndarray, sources: np.ndarray, clusters: np.ndarray, capacity: int) -> tuple:
    """(bin, offset) of every item, for items in the order in which they are placed.

    Bins are kept by residual room; each carries a bitmap of its sources and
    one of its clusters. The search starts at the smallest residual that fits
    and goes on to the next larger one until a bin has neither bit set, so the
    tightest compatible bin is found; otherwise a bin is opened.
    """
    rooms: list[int] = []  # residuals that occur, rising
    at: dict[int, list[int]] = {}  # bins of each residual
    source_bits: list[int] = []
    cluster_bits: list[int] = []
    left: list[int] = []
    bins, offsets = [], []
    for size, source, cluster in zip(sizes.tolist(), sources.tolist(), clusters.tolist()):
        s, c = 1 << source, 1 << cluster
        chosen = None
        for i in range(bisect_left(rooms, size), len(rooms)):
            for b in at[rooms[i]]:
                if not (source_bits[b] & s or cluster_bits[b] & c):
                    chosen = b
                    break
            if chosen is not None:
                break
        if chosen is None:
            chosen = len(left)
            left.append(capacity)
            source_bits.append(0)
            cluster_bits.append(0)
        else:
            room = left[chosen]
            at[room].remove(chosen)
            if not at[room]:
                del at[room]
                rooms.pop(bisect_left(rooms, room))
        bins.append(chosen)
        offsets.append(capacity - left[chosen])
        left[chosen] -= size
        source_bits[chosen] |= s
        cluster_bits[chosen] |= c
        if left[chosen]:
            if left[chosen] not in at:
                insort(rooms, left[chosen])
                at[left[chosen]] = []
            insort(at[left[chosen]], chosen)
    return np.array(bins, dtype=np.int64), np.array(offsets, dtype=np.int64)


def _numbered(values: pd.Series) -> np.ndarray:
    """Bit positions of values; a missing value is a value of its own."""
    codes, _ = pd.factorize(values.fillna("\0missing"), sort=True)
    return codes


def pack_documents(
    documents: DataFrame,
    capacity: int = CAPACITY,
    cluster: Column | None = None,
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """One row per piece: doc_id, piece, first_word, words, bin and bin_start.

    ``documents`` needs doc_id, text and source; ``cluster`` is an expression
    of their duplicate cluster, by default a hash of the text. A document
    longer than ``capacity`` words is cut into pieces; full pieces fill bins
    alone. ``bin`` numbers the bins (the number of the group in its upper 32
    bits), ``bin_start`` is where the piece begins in its bin, in words.

    A document without words, or with a null text, is in no bin: its row has
    piece 0, no words and a null bin. Null sources are one source. Repeated
    rows are packed once each, in different bins, as they share their cluster,
    and are dealt over all groups.
    Further columns are ignored; an empty table gives an empty result.
    """
    spark = documents.sparkSession
    ship_package(spark)
    cluster = F.xxhash64(F.coalesce("text", F.lit(""))) if cluster is None else cluster
    narrow = documents.select(
        "doc_id",
        F.col("source").cast("string").alias("source"),
        F.coalesce(cluster.cast("string"), F.lit("")).alias("cluster"),
        word_count(F.col("text")).alias("total"),
    )
    # Repeated rows are counted before they are dealt out, so that copies of one row, which
    # all conflict, are numbered and do not fall into one group.
    same = checkpointed(narrow.groupBy(*narrow.columns).agg(F.count("*").alias("copies")))
    blocks = same.withColumn("block", F.explode(F.sequence(F.lit(0), F.expr(f"(copies - 1) div {COPY_BLOCK}"))))
    until = F.least("copies", (F.col("block") + 1) * COPY_BLOCK)
    numbered = blocks.withColumn("copy", F.explode(F.sequence(F.col("block") * COPY_BLOCK + 1, until)))
    last = F.greatest(F.lit(0), F.ceil(F.col("total") / capacity) - 1)
    pieces = numbered.select(
        "doc_id", "source", "cluster", "total", "copy", F.explode(F.sequence(F.lit(0).cast("bigint"), last)).alias("piece")
    ).withColumn("first_word", F.col("piece") * capacity)
    pieces = pieces.withColumn("words", F.least(F.lit(capacity), F.col("total") - F.col("first_word")))
    groups = max(1, -(-pieces.count() // group_rows))
    placed = pieces.withColumn(
        "group", F.pmod(F.xxhash64("doc_id", "cluster", "piece", "copy"), F.lit(groups))
    )

    def pack(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["words", "doc_id", "piece", "cluster"], ascending=[False, True, True, True])
        bins, offsets = best_fit(
            group["words"].to_numpy(), _numbered(group["source"]), _numbered(group["cluster"]), capacity
        )
        group["bin"] = (int(key[0]) << 32) + bins
        group["bin_start"] = offsets
        group["doc_id"] = group["doc_id"].astype("Int64")
        return group[["doc_id", "piece", "first_word", "words", "bin", "bin_start"]]

    columns = ["doc_id", "source", "cluster", "piece", "first_word", "words"]
    packed = (
        placed.where(F.col("words") > 0)
        .select("group", *columns)
        .groupBy("group")
        .applyInPandas(pack, "doc_id long, piece long, first_word long, words long, bin long, bin_start long")
    )
    unplaced = placed.where(F.col("words") == 0).select(
        "doc_id", "piece", "first_word", "words",
        F.lit(None).cast("bigint").alias("bin"), F.lit(None).cast("bigint").alias("bin_start"),
    )
    return packed.unionByName(unplaced)
