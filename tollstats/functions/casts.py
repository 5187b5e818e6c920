"""Casts from raw text that never raise under ANSI mode and never bend a value.

What cannot be read, or lies outside the target's range, gives null.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# 20 digits before the point hold every bigint, 18 behind it whatever is cut off.
NUMBER = "decimal(38,18)"


def to_bigint(col: Column) -> Column:
    """A number, with or without decimals, to bigint, toward zero and without losing digits.

    '12.0' gives 12 and '3e9' 3000000000; NaN and infinity give null.
    """
    return col.try_cast(NUMBER).try_cast("bigint")


def to_int(col: Column) -> Column:
    return to_bigint(col).try_cast("int")


def to_double(col: Column) -> Column:
    return col.try_cast("double")


def unreadable(col: Column, kind: str) -> Column:
    """True where a value is given and its cast is null; blank text is no value."""
    given = F.coalesce(F.trim(col.cast("string")) != "", F.lit(False))
    return given & CASTS[kind](col).isNull()


CASTS = {"bigint": to_bigint, "int": to_int, "double": to_double}
