"""The raw monthly records as CSV."""

from __future__ import annotations

import csv
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tollstats.schema import MALFORMED, RAW_NAMES

BYTE_ORDER_MARK = b"\xef\xbb\xbf".decode("latin-1")


def csv_headers(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """path and header: the first line of every file that has one, blank lines left out.

    One job, whatever the number of files: each file's first block is scanned as
    text, and the line of the smallest position stays, with map-side combining.
    Bytes above 127 are taken as Latin-1, so the names the record needs come
    out right in every encoding that extends ASCII.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("start"),
        F.decode(F.col("value").cast("binary"), "ISO-8859-1").alias("line"),
        F.monotonically_increasing_id().alias("place"),
    )
    first = lines.where((F.col("start") == 0) & (F.trim("line") != ""))
    return first.groupBy("path").agg(F.min_by("line", "place").alias("header"))


def header_names(line: str) -> tuple[str, ...]:
    """The column names of a header line."""
    return tuple(next(csv.reader([line.removeprefix(BYTE_ORDER_MARK)])))


def _schema(names: Sequence[str]) -> StructType:
    """All columns as text; those the record does not need get names of their own."""
    fields = [name if name in RAW_NAMES else f"_other_{i}" for i, name in enumerate(names)]
    return StructType([StructField(name, StringType()) for name in [*fields, MALFORMED]])


def scan_csv(
    spark: SparkSession,
    path: str | list[str],
    encoding: str = "UTF-8",
    infer_types: bool = False,
    malformed: bool = False,
) -> DataFrame:
    """Headed CSV reduced to the raw record's columns.

    Names come from each file's own header line, so column order and further
    columns do not matter, and files may differ in both. Files of equal header
    are one scan; one job finds the headers (``csv_headers``). Where all files
    have the same header, no list of files comes to the driver.

    Values stay text, as the load casts every column itself; ``infer_types``
    asks Spark for its additional typing pass. With ``malformed`` the column
    ``MALFORMED`` holds every line that has fewer or more fields than its file's
    header, whole, and null for all others. The load leaves such lines out and
    reports them; without that column their missing fields are null and
    further ones are cut.
    """
    headers = csv_headers(spark, path)
    lines = [r["header"] for r in headers.select("header").distinct().collect()]
    if not lines:
        raise ValueError("no CSV file with a header")
    for names in map(header_names, lines):
        missing = [name for name in RAW_NAMES if names.count(name) != 1]
        if missing:
            raise ValueError(f"CSV header lacks, or repeats, {', '.join(missing)}")

    def scan(names: Sequence[str], files: str | list[str]) -> DataFrame:
        # Without pruning every field of a line is counted, also of columns that no one asks for.
        options = {"header": True, "encoding": encoding, "columnPruning": False, "columnNameOfCorruptRecord": MALFORMED}
        schema = _schema(names)
        if infer_types:
            inferred = spark.read.options(**options, inferSchema=True).csv(files).schema
            schema = StructType(
                [StructField(f.name, inferred[i].dataType) for i, f in enumerate(schema[:-1])] + [schema[MALFORMED]]
            )
        return spark.read.options(**options).schema(schema).csv(files).select(*RAW_NAMES, *([MALFORMED] if malformed else []))

    if len(lines) == 1:
        return scan(header_names(lines[0]), path)
    files: dict[tuple[str, ...], list[str]] = {}
    for r in headers.collect():
        files.setdefault(header_names(r["header"]), []).append(r["path"])
    return reduce(DataFrame.unionByName, [scan(names, group) for names, group in files.items()])


def write_csv(frame: DataFrame, path: str) -> None:
    frame.write.mode("errorifexists").csv(path, header=True, encoding="UTF-8")
