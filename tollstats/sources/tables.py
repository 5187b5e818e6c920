"""Where the two tables come from, and their registration as SQL views."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession

from tollstats.schema import Tables
from tollstats.sources.jdbc import JdbcRange, JdbcSettings
from tollstats.sources.jdbc_store import JdbcStore
from tollstats.sources.parquet_store import ParquetStore


def stored_tables(spark: SparkSession, root: str) -> Tables:
    """Tables of a parquet store; Catalyst knows their sizes from the files."""
    return ParquetStore(spark, root).tables()


def jdbc_tables(
    spark: SparkSession,
    settings: JdbcSettings,
    flujo_split: JdbcRange | Sequence[str] | None = None,
) -> Tables:
    """Tables of a database."""
    return JdbcStore(spark, settings, flujo_split).tables()


def register_views(
    tables: Tables, peaje_view: str = "peaje", flujo_view: str = "flujo_peaje"
) -> None:
    tables.peaje.createOrReplaceTempView(peaje_view)
    tables.flujo_peaje.createOrReplaceTempView(flujo_view)
