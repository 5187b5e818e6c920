"""Total orders and top-k."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame


def ordered(
    frame: DataFrame, keys: Sequence[Column], ties: Sequence[str], n: int | None = None
) -> DataFrame:
    """Sort by ``keys`` then ``ties``; with ``n`` only the first n rows (a top-k).

    The tie-breakers make the first n rows well defined, and let the range
    partitioner split rows whose keys are equal.
    """
    result = frame.orderBy(*keys, *ties)
    return result if n is None else result.limit(n)
