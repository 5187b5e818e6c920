"""The queries of the numbered operators: each takes a session and a folder of given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tollstats.llm.alignment import align_documents
from tollstats.llm.chunks import deduplicate_substrings
from tollstats.llm.fingerprints import neighbour_fingerprints
from tollstats.llm.mixing import mix_sources
from tollstats.llm.neardup import near_duplicates
from tollstats.llm.negatives import hard_negatives
from tollstats.llm.neighbours import nearest_neighbours
from tollstats.llm.packing import pack_documents
from tollstats.llm.perspectives import rotate_perspectives
from tollstats.llm.quality import score_quality
from tollstats.llm.shards import assign_shards
from tollstats.llm.topk import exact_top_k
from tollstats.llm.warc import archived_pages

# Queries are the rows whose id these divide.
ANN_QUERIES, EXACT_QUERIES, ANCHORS = 20, 50, 100
RELABELLED, LABELS = 7, 10

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, path: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{path}/{name}.parquet")


def op1_shards(spark: SparkSession, path: str) -> DataFrame:
    return assign_shards(table(spark, path, "documents")).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op2_perspectives(spark: SparkSession, path: str) -> DataFrame:
    return rotate_perspectives(table(spark, path, "conversations"))


def op3_quality(spark: SparkSession, path: str) -> DataFrame:
    scored = score_quality(table(spark, path, "documents"), table(spark, path, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted")


def op4_warc(spark: SparkSession, path: str) -> DataFrame:
    return archived_pages(table(spark, path, "pages")).drop("payload")


def op5_packing(spark: SparkSession, path: str) -> DataFrame:
    return pack_documents(table(spark, path, "documents"))


def op6_substrings(spark: SparkSession, path: str) -> DataFrame:
    edited = deduplicate_substrings(table(spark, path, "documents"))
    return edited.select("doc_id", "chunks", "repeated", "removed", "text")


def op7_fingerprints(spark: SparkSession, path: str) -> DataFrame:
    return neighbour_fingerprints(table(spark, path, "documents"))


def op8_near_duplicates(spark: SparkSession, path: str) -> DataFrame:
    return near_duplicates(table(spark, path, "documents"))


def op9_mixing(spark: SparkSession, path: str) -> DataFrame:
    return mix_sources(table(spark, path, "documents"))


def op10_neighbours(spark: SparkSession, path: str) -> DataFrame:
    return nearest_neighbours(table(spark, path, "embeddings"), F.col("vec_id") % ANN_QUERIES == 0)


def op11_alignment(spark: SparkSession, path: str) -> DataFrame:
    return align_documents(table(spark, path, "documents"))


def op12_topk(spark: SparkSession, path: str) -> DataFrame:
    return exact_top_k(table(spark, path, "embeddings"), F.col("vec_id") % EXACT_QUERIES == 0)


def op13_negatives(spark: SparkSession, path: str) -> DataFrame:
    """Labels of some rows are moved on first, so that they are wrong."""
    moved = F.when(F.col("vec_id") % RELABELLED == 0, (F.col("label") + 1) % LABELS).otherwise(F.col("label"))
    vectors = table(spark, path, "embeddings").withColumn("label", moved)
    return hard_negatives(vectors, F.col("vec_id") % ANCHORS == 0)


QUERIES: dict[str, Query] = {
    "op1_shards": op1_shards,
    "op2_perspectives": op2_perspectives,
    "op3_quality": op3_quality,
    "op4_warc": op4_warc,
    "op5_packing": op5_packing,
    "op6_substrings": op6_substrings,
    "op7_fingerprints": op7_fingerprints,
    "op8_near_duplicates": op8_near_duplicates,
    "op9_mixing": op9_mixing,
    "op10_neighbours": op10_neighbours,
    "op11_alignment": op11_alignment,
    "op12_topk": op12_topk,
    "op13_negatives": op13_negatives,
}
