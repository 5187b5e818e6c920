"""One row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dedup_key(frame: DataFrame, key: str) -> DataFrame:
    """Keep the smallest row of each key, comparing the other columns in order, nulls first.

    A minimum combines before the shuffle, so a key with any number of copies
    sends at most one row per map task; ranking in a window would gather them
    all. Spark has no hash buffer for such structs and sorts each map task's rows
    instead. Null keys form one group, so leave out rows without a key first.
    """
    others = [c for c in frame.columns if c != key]
    kept = frame.groupBy(key).agg(F.min(F.struct(*others)).alias("kept"))
    return kept.select(key, "kept.*").select(*frame.columns)


def dedup_counted(frame: DataFrame, key: str) -> DataFrame:
    """As ``dedup_key``, and what was left out: ``copies`` of the key, and whether any ``differing``.

    The smallest and the largest row come from the same aggregate; rows of a key
    differ exactly if these two do, missing values being equal to each other.
    """
    others = [c for c in frame.columns if c != key]
    row = F.struct(*others)
    counted = frame.groupBy(key).agg(
        F.min(row).alias("kept"), F.max(row).alias("last"), F.count("*").alias("copies")
    )
    differing = (~F.col("kept").eqNullSafe(F.col("last"))).alias("differing")
    return counted.select(key, "kept.*", "copies", differing)
