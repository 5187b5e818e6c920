"""Class balancing and reproducible splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tollstats.functions.hashing import hash_bucket, key_text

SEED = 1234
COPY_BLOCK = 1000


def split_side(keys: Sequence[str], weights: Sequence[int] = (80, 20), seed: int = SEED):
    """Number of the part (0, 1, ...) a row falls in; weights are percentages summing to 100."""
    if sum(weights) != 100:
        raise ValueError("weights must sum to 100")
    bucket = hash_bucket(F.concat(F.lit(f"{seed}:"), key_text(keys)), 100)
    side, bound = None, 0
    for i, weight in enumerate(weights[:-1]):
        bound += weight
        side = F.when(bucket < bound, i) if side is None else side.when(bucket < bound, i)
    return F.lit(0) if side is None else side.otherwise(len(weights) - 1)


def key_split(
    frame: DataFrame, keys: Sequence[str], weights: Sequence[int] = (80, 20), seed: int = SEED
) -> list[DataFrame]:
    """Split rows at random by a hash of their key: the same rows under any partitioning."""
    side = split_side(keys, weights, seed)
    return [frame.where(side == i) for i in range(len(weights))]


def _ratio(frame: DataFrame, label: str, minority: float, majority: float) -> Column:
    """max(1, majority rows div minority rows), as a scalar subquery."""
    sizes = frame.agg(
        F.count_if(F.col(label) == minority).alias("small"), F.count_if(F.col(label) == majority).alias("large")
    )
    ratio = F.when(F.col("small") > 0, F.greatest(F.lit(1), F.expr("large div small"))).otherwise(1)
    return sizes.select(ratio.cast("bigint")).scalar()


def class_weights(
    frame: DataFrame, label: str, minority: float, majority: float, weight_column: str = "weight"
) -> DataFrame:
    """Give each minority row the weight max(1, majority rows div minority rows), others 1.

    For estimators that take weights this is ``oversample`` without the copies:
    no row more is staged, shuffled or trained on. Rows of neither class are
    left out.
    """
    is_minority, is_majority = F.col(label) == minority, F.col(label) == majority
    weight = F.when(is_minority, _ratio(frame, label, minority, majority)).otherwise(1)
    return frame.where(is_minority | is_majority).withColumn(weight_column, weight.cast("double"))


def oversample(
    frame: DataFrame,
    label: str,
    minority: float,
    majority: float,
    copy_column: str | None = None,
) -> DataFrame:
    """Repeat each minority row max(1, majority rows div minority rows) times.

    One scan: the ratio is a scalar subquery, and the copies come from two
    explodes of bounded arrays, whatever the ratio. Rows of neither class are left out. ``copy_column`` numbers the
    copies from 1.
    """
    is_minority, is_majority = F.col(label) == minority, F.col(label) == majority
    ratio = _ratio(frame, label, minority, majority)
    wanted = F.when(is_minority, ratio).otherwise(F.lit(1).cast("bigint"))
    name = copy_column or "_copy"
    whole = F.sequence(F.lit(0).cast("bigint"), F.expr(f"(_wanted - 1) div {COPY_BLOCK}"))
    last = F.least(F.col("_wanted"), (F.col("_block") + 1) * COPY_BLOCK)
    repeated = (
        frame.where(is_minority | is_majority)
        .withColumn("_wanted", wanted)
        .withColumn("_block", F.explode(whole))
        .withColumn(name, F.explode(F.sequence(F.col("_block") * COPY_BLOCK + 1, last)))
        .drop("_wanted", "_block")
    )
    return repeated if copy_column else repeated.drop(name)
