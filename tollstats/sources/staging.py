"""Shared scratch space for staged tables and checkpoints."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder; one of our own only where none is set and one process is all."""
    configured = spark.conf.get(CHECKPOINT_CONF, None)
    if configured:
        return configured
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError(f"set {CHECKPOINT_CONF} to a folder every executor can reach")
    return tempfile.mkdtemp(prefix="tollstats-")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Checkpoints go to a folder of this application, which is removed when it ends."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
        remove_at_exit(spark, spark.sparkContext.getCheckpointDir())


def staging_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/tollstats-{name}-{uuid.uuid4().hex}"


def _store_of(spark: SparkSession, path: str) -> tuple:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def remove_path(spark: SparkSession, path: str) -> None:
    """Remove a staged table, in whichever store it lies."""
    store, place = _store_of(spark, path)
    store.delete(place, True)


def remove_at_exit(spark: SparkSession, path: str) -> None:
    """Remove a staged table when the application ends, for results that still read it."""
    store, place = _store_of(spark, path)
    store.deleteOnExit(place)


@contextmanager
def staged_table(frame: DataFrame, name: str) -> Iterator[DataFrame]:
    """The frame written once, as compressed columns, and read from there; gone afterwards."""
    spark = frame.sparkSession
    path = staging_path(spark, name)
    frame.write.parquet(path)
    try:
        yield spark.read.schema(frame.schema).parquet(path)
    finally:
        remove_path(spark, path)



def columnar(frame: DataFrame, name: str) -> DataFrame:
    """The frame written once as compressed columns, and removed when the application ends.

    Rows that fill fewer files than there are cores are dealt over them evenly.
    """
    spark = frame.sparkSession
    path = staging_path(spark, name)
    frame.write.parquet(path)
    remove_at_exit(spark, path)
    back = spark.read.schema(frame.schema).parquet(path)
    cores = spark.sparkContext.defaultParallelism
    return back.repartition(cores) if back.rdd.getNumPartitions() < cores else back
