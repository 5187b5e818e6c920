"""Dense surrogate ids without a global sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tollstats.functions.hashing import hash_bucket, key_text

ID_BUCKETS = 1024


def assign_ids(
    frame: DataFrame,
    keys: Sequence[str],
    id_column: str,
    after: Column | int = 0,
    buckets: int = ID_BUCKETS,
) -> DataFrame:
    """Number the rows of a key-distinct frame after+1, after+2, ... without gaps.

    Rows are numbered inside hash buckets and shifted by the sizes of the
    earlier buckets; only those ``buckets`` sizes meet in one task. The ids
    depend on the keys alone, so every run and partitioning gives the same.
    """
    bucketed = frame.withColumn("_bucket", hash_bucket(key_text(keys), buckets))
    earlier = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    shifts = (
        bucketed.groupBy("_bucket")
        .count()
        .select("_bucket", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("_shift"))
    )
    inside = Window.partitionBy("_bucket").orderBy(*keys)
    start = after if isinstance(after, Column) else F.lit(after)
    # shifts holds at most `buckets` rows of two numbers.
    return (
        bucketed.withColumn("_rank", F.row_number().over(inside))
        .join(F.broadcast(shifts), "_bucket")
        .withColumn(id_column, (start + F.col("_shift") + F.col("_rank")).cast("bigint"))
        .select(id_column, *frame.columns)
    )
