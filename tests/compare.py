"""Order-free comparison of a Spark result with a second engine's."""

from __future__ import annotations

import math

import duckdb

TABLES = ["region", "nation", "supplier", "lineitem"]


def oracle_rows(path: str, sql: str) -> tuple[list[str], list[tuple]]:
    with duckdb.connect() as engine:
        for table in TABLES:
            engine.sql(f"CREATE VIEW {table} AS SELECT * FROM '{path}/{table}.parquet'")
        result = engine.sql(sql)
        return result.columns, result.fetchall()


def _value(v):
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else v + 0.0
    return v


def normal(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    table = [tuple(_value(row[i]) for i in order) for row in rows]
    return sorted(table, key=lambda row: tuple((v is None, str(type(v)), v) if v is not None else (True, "", 0) for v in row))


def assert_same(frame, path: str, sql: str) -> int:
    columns, expected = oracle_rows(path, sql)
    assert sorted(frame.columns) == sorted(columns)
    got = normal(frame.columns, frame.collect())
    want = normal(columns, expected)
    assert len(got) == len(want)
    assert got == want
    return len(got)
