"""Feature table, labels and the feature pipeline."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollstats.functions.scoring import label_between, label_from
from tollstats.operators.joins import broadcast_if_small
from tollstats.operators.quantiles import with_quantiles
from tollstats.schema import Tables

# Model inputs and quantile cuts.
NUMERIC_FEATURES = ["anio", "mes", "veh_ligeros_imd", "veh_pesados_imd"]
CATEGORIES = ["departamento", "administracion"]
TARGET = "veh_total"
MEDIAN = {"mediana": 0.5}
TERCILES = {"q33": 0.33, "q66": 0.66}


def ml_base(tables: Tables) -> DataFrame:
    """Numbers as doubles with nulls as 0, categories left as they are, and the record id."""
    numbers = [*NUMERIC_FEATURES, TARGET]
    return (
        tables.flujo_peaje.join(broadcast_if_small(tables.peaje), "id_peaje")
        .select("id_flujo", *[F.col(c).cast("double").alias(c) for c in numbers], *CATEGORIES)
        .na.fill(0, subset=numbers)
    )


def label_median(base: DataFrame, column: str = TARGET, probability: float = 0.5) -> DataFrame:
    """Label 1.0 from the quantile upward, else 0.0."""
    cuts = with_quantiles(base, column, {"cut": probability}, "_cuts")
    return cuts.withColumn("label", label_from(F.col(column), F.col("_cuts.cut"))).drop("_cuts")


def label_terciles(base: DataFrame, column: str = TARGET) -> DataFrame:
    """Labels 0.0, 1.0 and 2.0 by the two tercile cuts."""
    cuts = with_quantiles(base, column, TERCILES, "_cuts")
    bounds = [F.col(f"_cuts.{name}") for name in TERCILES]
    return cuts.withColumn("label", label_between(F.col(column), bounds)).drop("_cuts")


def label_distribution(labelled: DataFrame) -> DataFrame:
    return labelled.groupBy("label").count()


def string_indexer() -> StringIndexer:
    """Indices by falling frequency; an unseen or missing value gets one more index."""
    return StringIndexer(
        inputCols=CATEGORIES,
        outputCols=[f"{c}_idx" for c in CATEGORIES],
        handleInvalid="keep",
    )


def one_hot_encoder() -> OneHotEncoder:
    return OneHotEncoder(
        inputCols=[f"{c}_idx" for c in CATEGORIES], outputCols=[f"{c}_vec" for c in CATEGORIES]
    )


def feature_pipeline(scale: bool = False) -> Pipeline:
    """Index, encode and assemble; ``scale`` standardises the assembled vector.

    Both categories are indexed by one stage, hence counted in one pass.
    """
    inputs = [*NUMERIC_FEATURES, *[f"{c}_vec" for c in CATEGORIES]]
    assembled = "features_raw" if scale else "features"
    stages = [
        string_indexer(),
        one_hot_encoder(),
        VectorAssembler(inputCols=inputs, outputCol=assembled),
    ]
    if scale:
        stages.append(StandardScaler(inputCol=assembled, outputCol="features", withMean=True))
    return Pipeline(stages=stages)


def vector_width(frame: DataFrame, column: str = "features") -> int:
    """Size of an assembled vector, from the column's metadata: no row is read."""
    return frame.schema[column].metadata["ml_attr"]["num_attrs"]


def vector_entries(frame: DataFrame, key: str, column: str) -> DataFrame:
    """The non-zero entries of a vector column: key, position, value."""
    entries = F.posexplode(vector_to_array(column)).alias("position", "value")
    return frame.select(key, entries).where(F.col("value") != 0)
