"""The two tables kept in a database."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tollstats.operators.joins import broadcast_if_small
from tollstats.schema import FLUJO_NAMES, PEAJE_SCHEMA, STATION_KEY, Tables
from tollstats.sources.jdbc import JdbcRange, JdbcSettings, append_jdbc, id_range, id_strides, scan_jdbc

# Rows of one scan task, and scans at a time that the database may get.
SCAN_ROWS, SCAN_PARTITIONS = 1_000_000, 512


@dataclass(frozen=True)
class JdbcStore:
    """Same use as the parquet store.

    ``assigns_ids`` says that the database numbers new stations itself (a
    serial or identity column): only their three key columns are written then.
    ``flujo_split`` spreads scans of the fact over tasks; without one their number
    follows its rows, and they end at quantiles of its ids (``id_strides``). ``connections`` bounds the writers.
    """

    spark: SparkSession
    settings: JdbcSettings
    flujo_split: JdbcRange | Sequence[str] | None = None
    connections: int | None = None
    assigns_ids: bool = True
    peaje_table: str = "peaje"
    flujo_table: str = "flujo_peaje"

    def peaje(self) -> DataFrame:
        stations = scan_jdbc(self.spark, self.settings, self.peaje_table)
        return stations.select(*PEAJE_SCHEMA.names)

    def flujo_peaje(self) -> DataFrame:
        split = self.flujo_split
        if split is None:
            bounds = id_range(self.spark, self.settings, self.flujo_table, "id_flujo", 1)
            split = bounds and id_strides(
                self.spark, self.settings, self.flujo_table, bounds, SCAN_ROWS, SCAN_PARTITIONS
            )
        fact = scan_jdbc(self.spark, self.settings, self.flujo_table, split)
        return fact.select(*FLUJO_NAMES)

    def tables(self) -> Tables:
        """Both tables; the dimension's size is measured, as JDBC reports none."""
        return Tables(broadcast_if_small(self.peaje()), self.flujo_peaje())

    def append_peaje(self, rows: DataFrame) -> None:
        columns = STATION_KEY if self.assigns_ids else PEAJE_SCHEMA.names
        append_jdbc(rows.select(*columns), self.settings, self.peaje_table, self.connections)

    def append_flujo(self, rows: DataFrame) -> None:
        append_jdbc(rows.select(*FLUJO_NAMES), self.settings, self.flujo_table, self.connections)
