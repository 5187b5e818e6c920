"""The toll tables bound onto order line items.

A supplier is a station, its nation the department and its region the
administration. A line item is traffic of the day it shipped: the quantity
counts vehicles, line number 1 is light traffic, 2 to 7 are heavy vehicles with
that many axles, and a discount above 5 % marks the differential tariff.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tollstats.operators.joins import broadcast_if_small
from tollstats.schema import FLUJO_NAMES, ID_COLUMN, MEASURE_COLUMNS, STATION_COLUMNS, Tables

# Counts are bigint: one busy station's month may add up billions of line items.
VEHICLES = "cast(l_quantity as bigint)"
LIGHT, HEAVY = "l_linenumber = 1", "l_linenumber > 1"
DIFFERENTIAL, FULL_TARIFF = "l_discount > 0.05", "l_discount <= 0.05"
COUNTED = {
    "veh_ligeros_tar_dif": f"{LIGHT} and {DIFFERENTIAL}",
    "veh_ligeros_automoviles": f"{LIGHT} and {FULL_TARIFF}",
    "veh_ligeros_total": LIGHT,
    "veh_pesados_tar_dif": f"{HEAVY} and {DIFFERENTIAL}",
    **{f"veh_pesados_{n}e": f"l_linenumber = {n} and {FULL_TARIFF}" for n in range(2, 8)},
    "veh_pesados_total": HEAVY,
    "veh_total": "true",
}
DAYS = "cast(day(last_day(make_date(anio, mes, 1))) as double)"


def _read(spark: SparkSession, path: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{path}/{name}.parquet")


def stations(spark: SparkSession, path: str) -> DataFrame:
    """One row per supplier.

    Its size follows the supplier table: row-level joins measure it first and
    broadcast it only while it is small.
    """
    supplier = _read(spark, path, "supplier")
    nation = _read(spark, path, "nation")
    region = _read(spark, path, "region")
    return (
        supplier.join(nation, supplier.s_nationkey == nation.n_nationkey)
        .join(region, nation.n_regionkey == region.r_regionkey)
        .selectExpr(
            "s_suppkey as id_peaje",
            "s_name as nombre_peaje",
            "n_name as departamento",
            "r_name as administracion",
        )
    )


def traffic(spark: SparkSession, path: str, anio: int | None = None) -> DataFrame:
    """One row per station and month.

    ``anio`` restricts the scan by ship date, which parquet can use to skip row
    groups; a filter on the derived year could not reach it. The bounds have
    the column's own type, so no time zone moves them.
    """
    items = _read(spark, path, "lineitem")
    if anio is not None:
        shipped, kind = F.col("l_shipdate"), items.schema["l_shipdate"].dataType
        first, next_year = (F.lit(date(y, 1, 1)).cast(kind) for y in (anio, anio + 1))
        items = items.where((shipped >= first) & (shipped < next_year))
    monthly = items.groupBy(
        F.expr("l_suppkey as id_peaje"),
        F.expr("year(l_shipdate) as anio"),
        F.expr("month(l_shipdate) as mes"),
    ).agg(
        *[
            F.expr(f"sum(case when {condition} then {VEHICLES} else 0 end) as {name}")
            for name, condition in COUNTED.items()
        ]
    )
    derived = {
        "id_flujo": "id_peaje * 10000 + (anio - 1990) * 12 + mes as id_flujo",
        "veh_ligeros_imd": f"veh_ligeros_total / {DAYS} as veh_ligeros_imd",
        "veh_pesados_imd": f"veh_pesados_total / {DAYS} as veh_pesados_imd",
        "veh_imd": f"veh_total / {DAYS} as veh_imd",
    }
    return monthly.selectExpr(*[derived.get(name, name) for name in FLUJO_NAMES])


def traffic_tables(spark: SparkSession, path: str, anio: int | None = None) -> Tables:
    return Tables(stations(spark, path), traffic(spark, path, anio))


def raw_records(tables: Tables) -> DataFrame:
    """The wide record as text: fact and station attributes under the raw names."""
    joined = tables.flujo_peaje.join(broadcast_if_small(tables.peaje), "id_peaje")
    return joined.select(
        F.col(ID_COLUMN.name).cast("string").alias(ID_COLUMN.raw),
        *[F.col(name).alias(raw) for raw, name in STATION_COLUMNS],
        *[
            # Counts come with decimals, as in the raw files.
            (F.concat(F.col(c.name), F.lit(".0")) if c.kind == "bigint" else F.col(c.name).cast("string")).alias(c.raw)
            for c in MEASURE_COLUMNS
        ],
    )
