"""From documents to packed training sequences: five stages, each written and read again.

Documents that the quality classifier rejects go; one document of each
near-duplicate class stays; passages that an earlier document has go; sources
are mixed to their targets; and the mix is packed into bins.

All stages take nulls in any column and further columns, which the first four
hand on. Empty documents give empty results. A null text counts as an empty one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tollstats.llm.chunks import deduplicated_documents
from tollstats.llm.mixing import mixed_documents
from tollstats.llm.neardup import without_near_duplicates
from tollstats.llm.packing import pack_documents
from tollstats.llm.quality import accepted_documents
from tollstats.llm.staging import staged

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the classifier, trained on the folder's labels, accepts.

    Null and empty texts share one score and go or stay together, and so do
    repeated rows and equal texts; ids, null ones too, make no difference.
    """
    return accepted_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each near-duplicate class.

    Where no document of a class has an id, one of them stays. Of repeated rows
    one stays. Null and empty texts are one class.
    """
    return without_near_duplicates(docs)


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages that a document of a smaller id has.

    Documents without an id come behind all others. Every row stays, also one
    that loses its whole text; rows that repeat id and text are one document.
    """
    return deduplicated_documents(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as their source's target asks.

    A null source is a source. A document without words is never taken; rows
    that repeat an id share the cut in proportion to their sizes.
    """
    return mixed_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of a document lies: its bin and place.

    A document without words has a row without a bin. Repeated rows, as the mix
    makes them, lie in different bins.
    """
    return pack_documents(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("substrings", substrings),
    ("mixing", mixing),
    ("packing", packing),
]

#: Fitted models and signatures have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the folder's documents; each reads what the one before wrote."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
