"""The two tables kept as parquet under one root folder."""

from __future__ import annotations

from dataclasses import dataclass
from typing import ClassVar

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tollstats.schema import ACTIVITY_SCHEMA, FLUJO_SCHEMA, PEAJE_SCHEMA, Tables


def append_parquet(frame: DataFrame, path: str, partition_by: str | None = None) -> None:
    """Append to a parquet folder.

    With ``partition_by`` the rows are rebalanced on that column first: few
    files for small values, several for one that holds much of the data.
    """
    writer = frame
    if partition_by:
        writer = frame.hint("rebalance", partition_by)
    writer = writer.write.mode("append")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)


@dataclass(frozen=True)
class ParquetStore:
    """Both tables under ``root``; the fact is partitioned by year.

    Beside them, loads that are asked to keep the stations' activity as bitmaps.
    """

    spark: SparkSession
    root: str
    assigns_ids: ClassVar[bool] = False

    def _read(self, name: str, schema: StructType) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.root}/{name}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def peaje(self) -> DataFrame:
        return self._read("peaje", PEAJE_SCHEMA)

    def flujo_peaje(self) -> DataFrame:
        fact = self._read("flujo_peaje", FLUJO_SCHEMA)
        return fact.select(*FLUJO_SCHEMA.names)

    def tables(self) -> Tables:
        return Tables(self.peaje(), self.flujo_peaje())

    def append_peaje(self, rows: DataFrame) -> None:
        append_parquet(rows.select(*PEAJE_SCHEMA.names), f"{self.root}/peaje")

    def append_flujo(self, rows: DataFrame) -> None:
        append_parquet(
            rows.select(*FLUJO_SCHEMA.names), f"{self.root}/flujo_peaje", partition_by="anio"
        )

    def activity(self) -> DataFrame:
        """The bitmaps of all loads that kept them; reports merge them."""
        return self._read("actividad", ACTIVITY_SCHEMA)

    def append_activity(self, rows: DataFrame) -> None:
        append_parquet(rows.select(*ACTIVITY_SCHEMA.names), f"{self.root}/actividad")
