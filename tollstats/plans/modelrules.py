"""Fitted models as rules: coefficients, weights and tree nodes, scored by column expressions.

These restate what a model says without its own scoring, so that a prediction
can be explained, checked, or made where no ML library runs.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.ml.classification import (
    DecisionTreeClassificationModel,
    LogisticRegressionModel,
    MultilayerPerceptronClassificationModel,
    RandomForestClassificationModel,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tollstats.sources.staging import remove_at_exit, staging_path

LEAST_ERROR = 1e-3

#: A node as the rules read it; its number is its place in the tree.
NODE = T.StructType(
    [
        T.StructField("feature", T.IntegerType()),
        T.StructField("cuts", T.ArrayType(T.DoubleType())),
        T.StructField("categorical", T.BooleanType()),
        T.StructField("left", T.IntegerType()),
        T.StructField("right", T.IntegerType()),
        T.StructField("votes", T.ArrayType(T.DoubleType())),
    ]
)


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that each row computes once, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def weighted_sum(features: Column, weights: Sequence[float], constant: float) -> Column:
    products = F.zip_with(features, F.lit([float(w) for w in weights]), lambda x, w: x * w)
    return F.aggregate(products, F.lit(float(constant)), lambda total, term: total + term)


def softmax(margins: Sequence[Column]) -> Column:
    """Class probabilities; the largest margin is taken off first, so that none overflows."""

    def shares(each: Column) -> Column:
        return bound(F.array_max(each), lambda top: F.transform(each, lambda margin: F.exp(margin - top)))

    def normed(each: Column) -> Column:
        total = F.aggregate(each, F.lit(0.0), lambda a, b: a + b)
        return bound(total, lambda whole: F.transform(each, lambda share: share / whole))

    return bound(bound(F.array(*margins), shares), normed)


def sigmoid(margin: Column) -> Column:
    return 1.0 / (1.0 + F.exp(-margin))


def most_probable(probability: Column) -> Column:
    """The class of the largest probability, the first of equal ones."""
    return (F.array_position(probability, F.array_max(probability)) - 1).cast("double")


# --- logistic regression ----------------------------------------------------------


def logistic_probabilities(model: LogisticRegressionModel, features: Column) -> Column:
    """Of a binary model, or of a multinomial one."""
    rows, constants = model.coefficientMatrix.toArray().tolist(), model.interceptVector.toArray().tolist()

    def probabilities(inputs: Column) -> Column:
        margins = [weighted_sum(inputs, row, constant) for row, constant in zip(rows, constants)]
        if len(margins) > 1:
            return softmax(margins)
        return bound(margins[0], lambda margin: F.array(sigmoid(-margin), sigmoid(margin)))

    return bound(features, probabilities)


def score_equations(rows: DataFrame, probability: Column, classes: Sequence[int], weight: Column | None = None) -> DataFrame:
    """class, position and residual: how far each score equation is from 0 on the training rows.

    At the optimum of an unpenalised logistic regression the errors
    (probability - label) of every class are orthogonal to every feature. The
    residual is the cosine between the two, from -1 to 1 whatever the number
    and scale of the rows. Where a model separates the classes its errors vanish
    and have no direction, so errors count as ``LEAST_ERROR`` at least (root of
    the mean square). Position 0 is the intercept, i the i-th feature. ``weight`` repeats rows as the training
    did. Each row costs one entry per feature that is not 0, added up before the shuffle.
    """
    w = F.lit(1.0) if weight is None else weight
    inputs = F.concat(F.array(F.lit(1.0)), vector_to_array("features"))

    def errors(each: Column) -> Column:
        return F.array(*[F.get(each, F.lit(c)) - (F.col("label") == c).cast("double") for c in classes])

    per_row = rows.select(w.alias("w"), bound(probability, errors).alias("e"), inputs.alias("inputs"))
    entries = per_row.select("w", "e", F.size("inputs").alias("width"), F.posexplode("inputs").alias("position", "x"))
    # A feature of 0 adds nothing to its equation; position 0 has an entry of every row.
    x, products, sizes = F.col("x"), [], []
    for i in range(len(classes)):
        error = F.get("e", F.lit(i))
        products.append(F.sum(F.col("w") * error * x).alias(f"p{i}"))
        sizes.append(F.sum(F.col("w") * error * error).alias(f"e{i}"))
    sums = [*products, F.sum(F.col("w") * x * x).alias("xx")]
    totals = (
        entries.where((F.col("position") == 0) | (x != 0))
        .groupBy("position")
        .agg(*sums, *sizes, F.sum("w").alias("n"), F.max("width").alias("width"))
    )
    # One row per feature is left: of these, all equations, also where every entry is 0.
    of_rows = [f"e{i}" for i in range(len(classes))] + ["n", "width"]
    of_position = [f"p{i}" for i in range(len(classes))] + ["xx"]
    whole = totals.agg(
        F.map_from_entries(F.collect_list(F.struct("position", F.struct(*of_position)))).alias("sums"),
        *[F.max(F.when(F.col("position") == 0, F.col(name))).alias(name) for name in of_rows],
    )
    equations = whole.select("*", F.explode(F.sequence(F.lit(0), F.col("width") - 1)).alias("position"))
    equations = equations.withColumn("of", F.try_element_at("sums", F.col("position")))

    def error_size(i: int) -> Column:
        return F.greatest(F.col(f"e{i}"), F.col("n") * LEAST_ERROR**2)

    def cosine(i: int) -> Column:
        product, square = (F.coalesce(F.col(f"of.{name}"), F.lit(0.0)) for name in (f"p{i}", "xx"))
        return F.coalesce(F.try_divide(product, F.sqrt(error_size(i) * square)), F.lit(0.0))

    each = [F.struct(F.lit(int(c)).alias("class"), "position", cosine(i).alias("residual")) for i, c in enumerate(classes)]
    return equations.select(F.inline(F.array(*each)))


# --- perceptron --------------------------------------------------------------------


def perceptron_probabilities(model: MultilayerPerceptronClassificationModel, features: Column) -> Column:
    """Forward pass: sigmoid layers and a softmax.

    The weight vector holds for each layer the weights of input 1 to all
    outputs, of input 2, and so on, and then the outputs' constants.
    """
    layers, weights = model.getLayers(), model.weights.toArray().tolist()

    def layer(i: int, at: int) -> Callable[[Column], Column]:
        inputs, outputs = layers[i], layers[i + 1]
        constants = weights[at + inputs * outputs : at + (inputs + 1) * outputs]

        def pass_on(values: Column) -> Column:
            margins = [
                weighted_sum(values, weights[at + o : at + inputs * outputs : outputs], constants[o]) for o in range(outputs)
            ]
            return softmax(margins) if i == len(layers) - 2 else F.array(*[sigmoid(m) for m in margins])

        return pass_on

    values, at = features, 0
    for i, (inputs, outputs) in enumerate(zip(layers, layers[1:])):
        values = bound(values, layer(i, at))
        at += (inputs + 1) * outputs
    return values


# --- trees ---------------------------------------------------------------------------


def tree_nodes(spark: SparkSession, model: DecisionTreeClassificationModel | RandomForestClassificationModel) -> DataFrame:
    """The nodes of a tree or forest: tree, node, feature, cuts, categorical, left, right, votes.

    The model is written and read back as rows. A node without children has left
    and right -1. A continuous feature goes left up to its single cut, another
    if its value is among the cuts. ``votes`` are the training rows of each class.
    """
    path = staging_path(spark, "model")
    model.write().save(path)
    remove_at_exit(spark, path)
    saved = spark.read.parquet(f"{path}/data")
    nodes = saved.select("treeID", "nodeData.*") if "treeID" in saved.columns else saved.withColumn("treeID", F.lit(0))
    return nodes.select(
        F.col("treeID").alias("tree"),
        F.col("id").alias("node"),
        F.col("split.featureIndex").alias("feature"),
        F.col("split.leftCategoriesOrThreshold").alias("cuts"),
        (F.col("split.numCategories") >= 0).alias("categorical"),
        F.col("leftChild").alias("left"),
        F.col("rightChild").alias("right"),
        F.col("impurityStats").alias("votes"),
    )


def forest_column(nodes: DataFrame) -> Column:
    """All trees as one constant: an array of arrays of nodes, in order.

    Its size is that of the model, bounded by the number and depth of its trees.
    """
    trees: dict[int, list[dict]] = {}
    for row in nodes.orderBy("tree", "node").collect():
        trees.setdefault(row["tree"], []).append({name: row[name] for name in NODE.names})
    return F.from_json(F.lit(json.dumps(list(trees.values()))), T.ArrayType(T.ArrayType(NODE)))


def leaf(features: Column, tree: Column, depth: int) -> Column:
    """The leaf in which a row ends: ``depth`` steps from node 0, a leaf staying where it is."""

    def walk(inputs: Column) -> Column:
        def step(at: Column, _: Column) -> Column:
            node = F.get(tree, at)
            value = F.get(inputs, node["feature"])
            goes_left = F.when(node["categorical"], F.array_contains(node["cuts"], value)).otherwise(
                value <= F.get(node["cuts"], F.lit(0))
            )
            return F.when(node["left"] < 0, at).when(goes_left, node["left"]).otherwise(node["right"])

        return F.aggregate(F.sequence(F.lit(1), F.lit(depth)), F.lit(0), step)

    return bound(features, walk)


def forest_probabilities(trees: Column, features: Column, depth: int, classes: int) -> Column:
    """Every tree's leaf gives its shares of the classes; their mean is the probability."""

    def normed(votes: Column) -> Column:
        total = F.aggregate(votes, F.lit(0.0), lambda a, b: a + b)
        return bound(total, lambda whole: F.transform(votes, lambda v: v / whole))

    def mean(inputs: Column) -> Column:
        each = F.transform(trees, lambda tree: bound(F.get(tree, leaf(inputs, tree, depth))["votes"], normed))
        zeros = F.array(*[F.lit(0.0)] * classes)
        summed = F.aggregate(each, zeros, lambda a, b: F.zip_with(a, b, lambda x, y: x + y))
        return F.transform(summed, lambda v: v / F.size(trees))

    return bound(features, mean)


def leaf_counts(rows: DataFrame, trees: Column, depth: int) -> DataFrame:
    """Rows by leaf of the first tree and label."""
    located = rows.select("label", leaf(vector_to_array("features"), F.get(trees, F.lit(0)), depth).alias("node"))
    return located.groupBy("node", "label").agg(F.count("*").alias("rows"))


# --- any of them ------------------------------------------------------------------------


def rule_probabilities(spark: SparkSession, model, features: Column, classes: int) -> Column:
    """Class probabilities of any fitted model of this package, without the model's own scoring."""
    if isinstance(model, LogisticRegressionModel):
        return logistic_probabilities(model, features)
    if isinstance(model, MultilayerPerceptronClassificationModel):
        return perceptron_probabilities(model, features)
    return forest_probabilities(forest_column(tree_nodes(spark, model)), features, model.getMaxDepth(), classes)


def with_rules(scored: DataFrame, model, classes: int) -> DataFrame:
    """Add ``rule_probability`` and ``rule_prediction`` to rows that the model has scored."""
    probability = rule_probabilities(scored.sparkSession, model, vector_to_array("features"), classes)
    ruled = scored.withColumn("rule_probability", probability)
    return ruled.withColumn("rule_prediction", most_probable(F.col("rule_probability")))


def rule_gaps(scored: DataFrame, tolerance: float = 1e-9) -> DataFrame:
    """Rows of a scored frame (see ``with_rules``), and those on which rules and model differ.

    They differ by a class, or by more than ``tolerance`` in a probability.
    """
    gaps = F.zip_with(vector_to_array("probability"), F.col("rule_probability"), lambda a, b: F.abs(a - b))
    # A missing or undefined probability is a difference too.
    close = F.coalesce(F.forall(gaps, lambda gap: gap <= tolerance), F.lit(False))
    same = close & (F.col("prediction") == F.col("rule_prediction"))
    return scored.agg(F.count("*").alias("rows"), F.count_if(~same).alias("differing"))
