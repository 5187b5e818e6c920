"""Classifier metrics from one pass over the scored rows.

A scored frame has the columns modelo, label, prediction and loss (the log-loss
of the row). It is reduced once to its confusion cells, and every metric follows
from those few rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

METRICS = ["accuracy", "recall", "f1_score", "loss"]


def confusion_cells(scored: DataFrame) -> DataFrame:
    """Rows and summed loss per model, label and prediction."""
    return scored.groupBy("modelo", "label", "prediction").agg(
        F.count("*").alias("count"), F.sum("loss").alias("loss_sum")
    )


def confusion_matrix(scored: DataFrame) -> DataFrame:
    return (
        scored.groupBy("modelo", "label", "prediction")
        .agg(F.count("*").alias("count"))
        .orderBy("modelo", "label", "prediction")
    )


def metrics_table(scored: DataFrame) -> DataFrame:
    """One row per model: accuracy, weighted recall, weighted F1 and mean log-loss.

    Classes weigh by their number of labels. A class that is never predicted,
    or never hit, adds 0. The windows run over the confusion cells only.
    """
    rows = F.sum("count")
    cells = (
        confusion_cells(scored)
        .withColumn("of_label", rows.over(Window.partitionBy("modelo", "label")))
        .withColumn("of_prediction", rows.over(Window.partitionBy("modelo", "prediction")))
        .withColumn("of_model", rows.over(Window.partitionBy("modelo")))
    )
    hits = F.col("count")
    weight = F.col("of_label") / F.col("of_model")
    recall = hits / F.col("of_label")
    precision = hits / F.col("of_prediction")
    f1 = 2 * precision * recall / (precision + recall)
    hit = F.col("label") == F.col("prediction")

    def over_hits(term):
        return F.coalesce(F.sum(F.when(hit, term)), F.lit(0.0))

    return cells.groupBy("modelo").agg(
        over_hits(hits / F.col("of_model")).alias("accuracy"),
        over_hits(weight * recall).alias("recall"),
        over_hits(weight * f1).alias("f1_score"),
        (F.sum("loss_sum") / rows).alias("loss"),
    )


def recall_by_class(scored: DataFrame) -> DataFrame:
    """Recall of each class, which the weighted recall (equal to accuracy) hides."""
    hits = F.sum(F.when(F.col("label") == F.col("prediction"), F.col("count")).otherwise(0))
    return (
        confusion_cells(scored)
        .groupBy("modelo", "label")
        .agg((hits / F.sum("count")).alias("class_recall"))
    )
