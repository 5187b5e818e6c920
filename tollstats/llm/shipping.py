"""Making this package importable in Python workers, wherever they run."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

PACKAGE = Path(__file__).resolve().parent.parent

_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Hand the package to Spark, once per application; Spark sends it to every executor."""
    application = spark.sparkContext.applicationId
    if application not in _shipped:
        archive = str(Path(tempfile.mkdtemp(prefix="tollstats-")) / PACKAGE.name)
        packed = shutil.make_archive(archive, "zip", PACKAGE.parent, PACKAGE.name)
        spark.sparkContext.addPyFile(packed)
        _shipped.add(application)
