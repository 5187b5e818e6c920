"""Dimension joins whose broadcast side is measured first."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

BROADCAST_BYTES = 64 * 1024 * 1024
ROW_BYTES = 16
FIELD_BYTES = 8


def measured_bytes(frame: DataFrame) -> int:
    """Upper estimate of a frame's size in memory: one distributed aggregate, one row back."""
    texts = [f.name for f in frame.schema if isinstance(f.dataType, StringType)]
    text_bytes = [F.coalesce(F.octet_length(F.col(t)), F.lit(0)).cast("bigint") for t in texts]
    fixed = F.lit(ROW_BYTES + 2 * FIELD_BYTES * len(frame.columns)).cast("bigint")
    row = frame.agg(F.sum(sum(text_bytes, fixed)).alias("bytes")).first()
    return row["bytes"] or 0


def broadcast_if_small(frame: DataFrame, budget: int | None = None) -> DataFrame:
    """The frame with a broadcast hint if it was measured to fit ``budget`` (BROADCAST_BYTES).

    Otherwise it comes back without a hint: the join shuffles both sides on the
    key, and adaptive execution splits a partition that one busy key fills.
    """
    limit = BROADCAST_BYTES if budget is None else budget
    return F.broadcast(frame) if measured_bytes(frame) <= limit else frame
