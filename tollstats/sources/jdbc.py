"""JDBC tables: partitioned scans and appends."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class JdbcSettings:
    """Where the database is and how to sign in; always supplied by the caller."""

    url: str
    user: str
    password: str = field(repr=False)
    driver: str = "org.postgresql.Driver"
    fetchsize: int = 10_000
    batchsize: int = 10_000

    def properties(self) -> dict[str, str]:
        return {
            "user": self.user,
            "password": self.password,
            "driver": self.driver,
            "fetchsize": str(self.fetchsize),
            "batchsize": str(self.batchsize),
        }


@dataclass(frozen=True)
class JdbcRange:
    """Split of a scan into ``partitions`` strides of a numeric column."""

    column: str
    lower: int
    upper: int
    partitions: int


def year_predicates(years: Sequence[int], column: str = "anio") -> list[str]:
    """One scan task per year, plus one for every row outside the list."""
    wanted = sorted(set(years))
    listed = ", ".join(str(y) for y in wanted)
    rest = f"{column} IS NULL OR {column} NOT IN ({listed})"
    return [f"{column} = {y}" for y in wanted] + [rest]


def scan_jdbc(
    spark: SparkSession,
    settings: JdbcSettings,
    table: str,
    split: JdbcRange | Sequence[str] | None = None,
) -> DataFrame:
    """A database table, read by one task unless ``split`` gives a range or predicates.

    Predicates must be disjoint and cover the table (see ``year_predicates``).
    Column names come back in lower case whatever the database reports.
    """
    if isinstance(split, JdbcRange):
        frame = spark.read.jdbc(
            settings.url,
            table,
            column=split.column,
            lowerBound=split.lower,
            upperBound=split.upper,
            numPartitions=split.partitions,
            properties=settings.properties(),
        )
    elif split:
        frame = spark.read.jdbc(
            settings.url, table, predicates=list(split), properties=settings.properties()
        )
    else:
        frame = spark.read.jdbc(settings.url, table, properties=settings.properties())
    return frame.toDF(*[name.lower() for name in frame.columns])


def id_range(
    spark: SparkSession, settings: JdbcSettings, table: str, column: str, partitions: int
) -> JdbcRange | None:
    """Strides over the ids a table holds now; None for an empty table."""
    bounds = f"(SELECT min({column}) AS low, max({column}) AS high FROM {table}) bounds"
    row = scan_jdbc(spark, settings, bounds).first()
    if row is None or row["low"] is None:
        return None
    return JdbcRange(column, int(row["low"]), int(row["high"]) + 1, partitions)


def id_strides(
    spark: SparkSession,
    settings: JdbcSettings,
    table: str,
    bounds: JdbcRange,
    rows_per_task: int,
    most: int,
) -> JdbcRange | list[str]:
    """Scan tasks of about ``rows_per_task`` rows each, ``most`` at most.

    Their number follows the rows that the database counts. Where the ids fill
    at least half of their range, equal strides of it hold about equally many
    rows. Elsewhere the strides end at quantiles of the ids, which the database
    finds by cutting its ordered ids into tiles: one row per task comes back.
    """
    column = bounds.column
    counted = scan_jdbc(spark, settings, f"(SELECT count({column}) AS ids FROM {table}) counted").first()
    tasks = max(1, min(most, -(-int(counted["ids"]) // rows_per_task)))
    if 2 * int(counted["ids"]) >= bounds.upper - bounds.lower or tasks == 1:
        return JdbcRange(column, bounds.lower, bounds.upper, tasks)
    tiles = f"SELECT {column}, ntile({tasks}) OVER (ORDER BY {column}) AS tile FROM {table} WHERE {column} IS NOT NULL"
    starts = scan_jdbc(
        spark, settings, f"(SELECT tile, min({column}) AS low FROM ({tiles}) tiles GROUP BY tile) starts"
    ).collect()
    return stride_predicates(column, [int(r["low"]) for r in starts])


def stride_predicates(column: str, starts: Sequence[int]) -> list[str]:
    """Disjoint predicates that cover a table: the first also takes missing ids and what lies before."""
    cuts = sorted(set(starts))[1:]
    if not cuts:
        return ["1 = 1"]
    between = [f"{column} >= {low} AND {column} < {high}" for low, high in zip(cuts, cuts[1:])]
    return [f"{column} < {cuts[0]} OR {column} IS NULL", *between, f"{column} >= {cuts[-1]}"]


def append_jdbc(
    frame: DataFrame, settings: JdbcSettings, table: str, connections: int | None = None
) -> None:
    """Append rows to a table, with at most ``connections`` writers at a time.

    Each task commits by itself and a lost executor's task is run again, so
    the target should hold a unique key: a repeat then fails, it cannot double.
    """
    properties = settings.properties()
    if connections:
        properties["numPartitions"] = str(connections)
    frame.write.jdbc(settings.url, table, mode="append", properties=properties)
