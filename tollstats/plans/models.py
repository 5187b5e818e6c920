"""The five classifiers and the two comparisons."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark import StorageLevel
from pyspark.ml import Estimator
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    RandomForestClassifier,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tollstats.functions.scoring import binary_log_loss, multiclass_log_loss
from tollstats.operators.evaluation import metrics_table
from tollstats.operators.sampling import SEED, class_weights, key_split, oversample
from tollstats.plans.features import (
    feature_pipeline,
    label_median,
    label_terciles,
    ml_base,
    vector_width,
)
from tollstats.schema import Tables
from tollstats.sources.staging import columnar, ensure_checkpoint_dir

# Model names and training parameters.
LOGISTIC_NAME = "Regresión logística"
PERCEPTRON_NAME = "Multilayer Perceptron"
TREE_NAME = "Árbol de decisión"
FOREST_NAME = "Random Forest"
MULTINOMIAL_NAME = "Reg. Log. Multic."
LOGISTIC_ITERATIONS = 50
PERCEPTRON_HIDDEN = [8, 4]
PERCEPTRON_ITERATIONS = 100
TREE_DEPTH = 6
FOREST_TREES = 50
FOREST_DEPTH = 8
MULTINOMIAL_ITERATIONS = 80
BINARY_CLASSES = 2
TERCILE_CLASSES = 3
# Parameters of an estimator that name the columns it reads.
TRAINED_ON = ["featuresCol", "labelCol", "weightCol"]


def logistic(weight_column: str | None = None) -> LogisticRegression:
    estimator = LogisticRegression(maxIter=LOGISTIC_ITERATIONS)
    return estimator.setWeightCol(weight_column) if weight_column else estimator


def perceptron(inputs: int) -> MultilayerPerceptronClassifier:
    layers = [inputs, *PERCEPTRON_HIDDEN, BINARY_CLASSES]
    return MultilayerPerceptronClassifier(layers=layers, maxIter=PERCEPTRON_ITERATIONS, seed=SEED)


def decision_tree() -> DecisionTreeClassifier:
    return DecisionTreeClassifier(maxDepth=TREE_DEPTH, seed=SEED)


def random_forest() -> RandomForestClassifier:
    return RandomForestClassifier(numTrees=FOREST_TREES, maxDepth=FOREST_DEPTH, seed=SEED)


def multinomial() -> LogisticRegression:
    return LogisticRegression(maxIter=MULTINOMIAL_ITERATIONS, family="multinomial")


def staged_base(tables: Tables) -> DataFrame:
    """The feature table, joined once, spread evenly and kept as columns in the shared folder.

    Quantiles, class sizes and labels each read what they need of it, from there
    and not from the tables behind it.
    """
    return columnar(ml_base(tables), "base")


def feature_frame(labelled: DataFrame, scale: bool = False) -> DataFrame:
    """Features of a labelled frame.

    The labelled rows are checkpointed: indexing, every training pass and the
    scoring start from them, and losing an executor repeats neither joins nor
    quantiles.
    """
    ensure_checkpoint_dir(labelled.sparkSession)
    rows = labelled.checkpoint()
    return feature_pipeline(scale).fit(rows).transform(rows)


def binary_features(
    tables: Tables,
    scale: bool = False,
    balance: bool = True,
    weight_column: str | None = None,
    probability: float = 0.5,
    base: DataFrame | None = None,
) -> DataFrame:
    """Features labelled by the median, or by another quantile.

    The median label leaves class 1 at least as large as class 0, so balancing
    repeats its rows once; it acts where a label is rarer. With
    ``weight_column`` balancing sets weights instead of making copies, for the
    models that take them (``logistic``, not the perceptron). ``base`` is the
    staged base of the tables, where other features start from it too.
    """
    labelled = label_median(staged_base(tables) if base is None else base, probability=probability)
    if balance and weight_column:
        labelled = class_weights(labelled, "label", minority=1.0, majority=0.0, weight_column=weight_column)
    elif balance:
        labelled = oversample(labelled, "label", minority=1.0, majority=0.0)
    return feature_frame(labelled, scale)


def tercile_features(tables: Tables, scale: bool = False, base: DataFrame | None = None) -> DataFrame:
    """Features labelled by the terciles; ``base`` as for ``binary_features``."""
    return feature_frame(label_terciles(staged_base(tables) if base is None else base), scale)


def binary_models(features: DataFrame) -> dict[str, Estimator]:
    return {
        LOGISTIC_NAME: logistic(),
        PERCEPTRON_NAME: perceptron(vector_width(features)),
    }


def tercile_models(features: DataFrame) -> dict[str, Estimator]:
    return {
        TREE_NAME: decision_tree(),
        FOREST_NAME: random_forest(),
        MULTINOMIAL_NAME: multinomial(),
    }


def fitted(features: DataFrame, models: Mapping[str, Estimator], seed: int = SEED) -> tuple[dict, DataFrame, DataFrame]:
    """Each model fitted on the 80 % side, and both sides.

    All copies of a record fall on one side, so no test row was trained on. Each
    estimator goes over its rows several times before it keeps them in its own
    form, so the columns that training reads are kept on the executors' disks
    until all are fitted.
    """
    train, test = key_split(features, ["id_flujo"], seed=seed)
    read = {e.getOrDefault(p) for e in models.values() for p in e.params if p.name in TRAINED_ON and e.isDefined(p)}
    kept = train.select(*[name for name in train.columns if name in read]).persist(StorageLevel.DISK_ONLY)
    try:
        return {name: estimator.fit(kept) for name, estimator in models.items()}, train, test
    finally:
        kept.unpersist()


def train_and_score(
    features: DataFrame, models: Mapping[str, Estimator], seed: int = SEED
) -> DataFrame:
    """Fit each model on the 80 % side and score the 20 % side, one block of rows per model."""
    trained, _, test = fitted(features, models, seed)
    scored = None
    for name, model in trained.items():
        rows = model.transform(test).select(
            F.lit(name).alias("modelo"),
            "id_flujo",
            "anio",
            "mes",
            "departamento",
            "veh_total",
            "label",
            "prediction",
            vector_to_array("probability").alias("probability"),
        )
        scored = rows if scored is None else scored.unionByName(rows)
    return scored


def with_loss(scored: DataFrame, n_classes: int, compat: bool = False) -> DataFrame:
    """Add the log-loss of each scored row."""
    label, probability = F.col("label"), F.col("probability")
    loss: Column = (
        binary_log_loss(label, probability, compat)
        if n_classes == BINARY_CLASSES
        else multiclass_log_loss(label, probability, n_classes)
    )
    return scored.withColumn("loss", loss)


def compare_binary(tables: Tables, scale: bool = False, compat: bool = False) -> DataFrame:
    """Metrics of logistic regression and perceptron on the median label."""
    features = binary_features(tables, scale)
    scored = train_and_score(features, binary_models(features))
    return metrics_table(with_loss(scored, BINARY_CLASSES, compat))


def compare_multi(tables: Tables, scale: bool = False) -> DataFrame:
    """Metrics of tree, forest and multinomial regression on the tercile label."""
    features = tercile_features(tables, scale)
    scored = train_and_score(features, tercile_models(features))
    return metrics_table(with_loss(scored, TERCILE_CLASSES))
