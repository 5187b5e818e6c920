"""Hand-made frames for the edge cases."""

from __future__ import annotations

from tollstats.schema import FLUJO_NAMES, MEASURE_COLUMNS, PEAJE_SCHEMA, RAW_NAMES, RAW_SCHEMA, Tables

FLUJO_TYPES = ", ".join(
    f"{n} {'double' if n.endswith('_imd') else 'bigint'}" for n in FLUJO_NAMES
)


def raw(spark, *records: dict):
    """Raw text records; measures not given are '0'."""
    measures = {c.raw for c in MEASURE_COLUMNS}
    rows = [
        tuple(r.get(name, "0" if name in measures else None) for name in RAW_NAMES) for r in records
    ]
    return spark.createDataFrame(rows, RAW_SCHEMA)


def station(spark, *rows):
    return spark.createDataFrame(list(rows), PEAJE_SCHEMA)


def flujo(spark, *records: dict):
    """Fact rows; measures not given are 0."""
    rows = [
        tuple(r.get(n, 0.0 if n.endswith("_imd") else 0) for n in FLUJO_NAMES) for r in records
    ]
    return spark.createDataFrame(rows, FLUJO_TYPES)


def tables(spark, stations, facts) -> Tables:
    return Tables(station(spark, *stations), flujo(spark, *facts))


def rows(frame):
    return [tuple(r) for r in frame.collect()]
