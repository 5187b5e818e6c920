"""Labels and per-row log-loss as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: probabilities are kept this far from 0 and 1.
EPSILON = 1e-15


def label_from(value: Column, cut: Column) -> Column:
    """1.0 from the cut upward, else 0.0; null while there is no cut."""
    return F.when(cut.isNotNull(), F.when(value >= cut, 1.0).otherwise(0.0))


def label_between(value: Column, cuts: Sequence[Column]) -> Column:
    """Class i below the i-th cut, the last class from the last cut upward."""
    label = F.when(cuts[0].isNull(), F.lit(None).cast("double"))
    for i, cut in enumerate(cuts):
        label = label.when(value < cut, float(i))
    return label.otherwise(float(len(cuts)))


def _clip(probability: Column) -> Column:
    return F.greatest(F.lit(EPSILON), F.least(F.lit(1.0 - EPSILON), probability))


def binary_log_loss(label: Column, probability: Column, compat: bool = False) -> Column:
    """Log-loss of one row; ``probability`` is an array [p0, p1].

    A missing or one-element array counts as p1 = 0.5. With ``compat`` the
    cross-entropy formula is applied to the probability of the true class,
    which charges label-0 rows with -log(p1); the default charges every row
    with -log of its true class.
    """
    p1 = F.when(F.size(probability) > 1, F.get(probability, F.lit(1))).otherwise(0.5)
    p_true = _clip(F.when(label == 1.0, p1).otherwise(1.0 - p1))
    if compat:
        return -(label * F.log(p_true) + (1.0 - label) * F.log(1.0 - p_true))
    return -F.log(p_true)


def multiclass_log_loss(label: Column, probability: Column, n_classes: int) -> Column:
    """-log of the true-class probability; a label outside the array, or no array, is uniform."""
    position = F.floor(label + 0.5).cast("int")
    uniform = F.when(F.size(probability) > 0, 1.0 / F.size(probability)).otherwise(1.0 / n_classes)
    return -F.log(_clip(F.coalesce(F.get(probability, position), uniform)))
