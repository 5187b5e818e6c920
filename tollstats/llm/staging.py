"""Cutting lineage in the shared folder, so that a lost executor repeats one step only."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tollstats.sources.staging import ensure_checkpoint_dir, staging_path


def checkpointed(frame: DataFrame) -> DataFrame:
    """For narrow rows that are read several times; Spark's cleaner may remove the files."""
    ensure_checkpoint_dir(frame.sparkSession)
    return frame.checkpoint()


def staged(frame: DataFrame, name: str) -> DataFrame:
    """For larger rows: a compressed columnar copy of which later steps read single columns."""
    path = staging_path(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)
