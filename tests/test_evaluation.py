from __future__ import annotations

import math

import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from tollstats.functions.scoring import binary_log_loss, multiclass_log_loss
from tollstats.operators.evaluation import confusion_matrix, metrics_table, recall_by_class

SCORED = [
    ("a", 0.0, 0.0, 0.1), ("a", 0.0, 1.0, 0.9), ("a", 1.0, 1.0, 0.2), ("a", 1.0, 1.0, 0.2),
    ("a", 2.0, 0.0, 1.5), ("b", 0.0, 1.0, 2.0), ("b", 1.0, 0.0, 2.0),
]


@pytest.fixture
def scored(spark):
    return spark.createDataFrame(SCORED, "modelo string, label double, prediction double, loss double")


def test_metrics_equal_the_library_evaluator(scored):
    for row in metrics_table(scored).collect():
        one = scored.where(F.col("modelo") == row.modelo)
        for metric, name in [("accuracy", "accuracy"), ("weightedRecall", "recall"), ("f1", "f1_score")]:
            expected = MulticlassClassificationEvaluator(metricName=metric).evaluate(one)
            assert row[name] == pytest.approx(expected, abs=1e-12)
        assert row.recall == pytest.approx(row.accuracy)
        assert row.loss == pytest.approx(one.agg(F.avg("loss")).first()[0])


def test_model_without_a_hit_scores_zero(scored):
    row = metrics_table(scored).where("modelo = 'b'").first()
    assert (row.accuracy, row.recall, row.f1_score, row.loss) == (0.0, 0.0, 0.0, 2.0)


def test_recall_of_each_class(scored):
    got = {(r.modelo, r.label): r.class_recall for r in recall_by_class(scored).collect()}
    assert got == {("a", 0.0): 0.5, ("a", 1.0): 1.0, ("a", 2.0): 0.0, ("b", 0.0): 0.0, ("b", 1.0): 0.0}


def test_confusion_is_sorted(scored):
    rows = [tuple(r) for r in confusion_matrix(scored).collect()]
    assert rows == sorted(rows)
    assert ("a", 1.0, 1.0, 2) in rows


def losses(spark, data, expression):
    frame = spark.createDataFrame(data, "label double, p array<double>")
    return [r.loss for r in frame.coalesce(1).select(expression.alias("loss")).collect()]


def test_binary_loss_and_its_compatible_form(spark):
    data = [(1.0, [0.2, 0.8]), (0.0, [0.2, 0.8]), (1.0, None), (0.0, [1.0]), (1.0, [1.0, 0.0]), (0.0, [1.0, 0.0])]
    eps = 1e-15
    standard = losses(spark, data, binary_log_loss(F.col("label"), F.col("p")))
    assert standard == pytest.approx(
        [-math.log(0.8), -math.log(0.2), math.log(2), math.log(2), -math.log(eps), -math.log(1 - eps)]
    )
    compat = losses(spark, data, binary_log_loss(F.col("label"), F.col("p"), compat=True))
    assert compat == pytest.approx(
        [-math.log(0.8), -math.log(0.8), math.log(2), math.log(2), -math.log(eps), -math.log(1 - (1 - eps))]
    )


def test_multiclass_loss(spark):
    data = [
        (2.0, [0.1, 0.2, 0.7]), (5.0, [0.1, 0.2, 0.7]), (-1.0, [0.5, 0.5]), (0.0, None), (0.0, [0.0, 1.0]), (0.6, [0.1, 0.9]),
    ]
    got = losses(spark, data, multiclass_log_loss(F.col("label"), F.col("p"), 4))
    assert got == pytest.approx(
        [-math.log(0.7), math.log(3), math.log(2), math.log(4), -math.log(1e-15), -math.log(0.9)]
    )
