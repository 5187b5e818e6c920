"""Hash buckets that depend on key values only, never on the partitioning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

NULL_MARK = "<null>"


def key_text(keys: Sequence[str]) -> Column:
    """The key columns as one text; nulls keep their place."""
    parts = [F.coalesce(F.col(k).cast("string"), F.lit(NULL_MARK)) for k in keys]
    return F.concat_ws("|", *parts)


def hash_bucket(text: Column, buckets: int) -> Column:
    """Bucket 0..buckets-1 from the leading 32 bits of the MD5 of ``text``.

    Declared free of nulls, so that joining on it adds no filter to one side
    and Spark can share the shuffle of both.
    """
    head = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
    return F.coalesce(F.pmod(head, F.lit(buckets)), F.lit(0))
