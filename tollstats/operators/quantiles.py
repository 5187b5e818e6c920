"""Exact quantiles: a sketch proposes where they lie, counting finds them."""

from __future__ import annotations

import math
from collections.abc import Mapping
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, IntegralType

from tollstats.sources.staging import staged_table

# Size of the sketch, and how far, as a share of all values, its answers are taken to lie off at most.
SKETCH_K = 8192
MARGIN = 4 / SKETCH_K**0.9
# Distinct values between the proposed bounds that are counted one by one.
COUNTED_VALUES = 1 << 16


class Gap(NamedTuple):
    """An open interval that holds a quantile (None: no end), and at which share of its values."""

    low: object
    high: object
    share: float

    def holds(self) -> Column:
        x = F.col("x")
        above = F.lit(True) if self.low is None else x > F.lit(self.low)
        return above if self.high is None else above & (x < F.lit(self.high))


def _sketched(kind: DataType) -> tuple:
    """The kind that is sketched, its aggregate and its question for a quantile."""
    if isinstance(kind, IntegralType):
        return "bigint", F.kll_sketch_agg_bigint, F.kll_sketch_get_quantile_bigint
    return "double", F.kll_sketch_agg_double, F.kll_sketch_get_quantile_double


def _proposed(values: DataFrame, gaps: Mapping[str, Gap]) -> tuple[int, list]:
    """Number of values, and the bounds between which the quantiles should lie, in order.

    One aggregate with map-side combining: a task sends one sketch of bounded
    size per interval, however many values it has.
    """
    kind, aggregate, quantile = _sketched(values.schema["x"].dataType)
    places = list(dict.fromkeys((gap.low, gap.high) for gap in gaps.values()))
    sketches = [
        aggregate(F.when(Gap(low, high, 0).holds(), F.col("x").cast(kind)), F.lit(SKETCH_K)).alias(f"s{i}")
        for i, (low, high) in enumerate(places)
    ]
    bounds = [
        quantile(f"s{places.index((gap.low, gap.high))}", F.lit(min(1.0, max(0.0, gap.share + off))))
        for gap in gaps.values()
        for off in (-MARGIN, MARGIN)
    ]
    summary = values.agg(F.count("*").alias("n"), *sketches)
    row = summary.select("n", F.when(F.col("n") > 0, F.array(*bounds)).alias("bounds")).first()
    return row["n"], row["bounds"] or []


def _cells(values: DataFrame, bounds: list) -> list:
    """(cell, x, n) in order, where bound i is cell 2i + 1 and what lies around it 2i and 2i + 2.

    Cells between a quantile's two bounds are counted value by value, unless
    they hold too many values: then x is null, as in all other cells.
    """
    ends = sorted(set(bounds))
    cell = sum(((F.col("x") >= F.lit(e)).cast("int") + (F.col("x") > F.lit(e)).cast("int") for e in ends), F.lit(0))
    wanted = {c for at in range(0, len(bounds), 2) for c in range(2 * ends.index(bounds[at]) + 1, 2 * ends.index(bounds[at + 1]) + 2)}
    placed = values.select(cell.alias("cell"), "x")
    counted = placed.groupBy("cell", F.when(F.col("cell").isin(*wanted), F.col("x")).alias("x")).agg(F.count("*").alias("n"))
    rows = counted.limit(COUNTED_VALUES + 1).collect()
    if len(rows) > COUNTED_VALUES:
        alone = F.when(F.col("cell") % 2 == 1, F.col("x")).alias("x")
        rows = placed.groupBy("cell", alone).agg(F.count("*").alias("n")).collect()
    return sorted(rows, key=lambda r: (r["cell"], r["x"] is not None, r["x"] if r["x"] is not None else 0))


def _found(values: DataFrame, probabilities: Mapping[str, float]) -> dict[str, object]:
    found: dict[str, object] = {}
    gaps = {name: Gap(None, None, p) for name, p in probabilities.items()}
    while gaps:
        total, bounds = _proposed(values, gaps)
        if not total:
            return {}
        rows, ends, still = _cells(values, bounds), sorted(set(bounds)), {}
        for name in gaps:
            below, rank = 0, max(1, _rank(probabilities[name], total))
            for cell, x, n in rows:
                if rank <= below + n:
                    break
                below += n
            if x is not None:
                found[name] = x
            else:
                low, high = (ends[i] if 0 <= i < len(ends) else None for i in (cell // 2 - 1, cell // 2))
                still[name] = Gap(low, high, (rank - below - 0.5) / n)
        gaps = still
    return found


def exact_quantiles(
    frame: DataFrame, column: str, probabilities: Mapping[str, float]
) -> DataFrame:
    """One row with, per named probability p, the ceil(p*n)-th smallest value.

    Nulls and NaN are left out; without values the row holds nulls. The values
    alone are staged, so the frame is read once, and they are never shuffled as
    such. A first pass sketches them, a second counts what lies between the two
    bounds that the sketch gives for each quantile, where it finds the value.
    Only where a sketch was farther off than ``MARGIN``, or more than
    ``COUNTED_VALUES`` distinct values lie there, both are repeated on the
    interval that holds the rank; so the result is exact whatever the sketch says.
    """
    spark = frame.sparkSession
    value = F.col(column)
    given = frame.where(value.isNotNull() & ~F.isnan(value.cast("double"))).select(value.alias("x"))
    kind = given.schema["x"].dataType
    with staged_table(given, "quantile") as values:
        found = _found(values, probabilities)
    return spark.range(1).select(*[F.lit(found.get(name)).cast(kind).alias(name) for name in probabilities])


def _rank(p: float, total: int) -> int:
    """ceil(p * total) in double precision, as SQL engines take it."""
    return math.ceil(p * total)


def with_quantiles(
    frame: DataFrame, column: str, probabilities: Mapping[str, float], name: str
) -> DataFrame:
    """Add the quantiles as a struct column: one scalar subquery, however often it is used."""
    quantiles = exact_quantiles(frame, column, probabilities)
    return frame.withColumn(name, quantiles.select(F.struct(*probabilities)).scalar())
