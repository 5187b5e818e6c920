"""The DataFrame reports.

Reports that group by station attributes sum per station first: the fact then
meets the dimension with one row per station (and year), whatever share of the
rows a single station holds. Every report returns its whole result unless ``n``
asks for the first n rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollstats.operators.joins import broadcast_if_small
from tollstats.operators.ordering import ordered
from tollstats.schema import Tables
from tollstats.sources.staging import ensure_checkpoint_dir


def station_columns(tables: Tables) -> DataFrame:
    """q1: name and department of every station."""
    return tables.peaje.select("nombre_peaje", "departamento")


def traffic_columns(tables: Tables) -> DataFrame:
    """q1: month, vehicles and daily mean of every record."""
    return tables.flujo_peaje.select("anio", "mes", "veh_total", "veh_imd")


def busy_months(tables: Tables, anio: int, more_than: int) -> DataFrame:
    """q2: records of a year with more vehicles than a threshold."""
    flujo = tables.flujo_peaje
    return flujo.where((flujo.anio == anio) & (flujo.veh_total > more_than)).select(
        "id_flujo", "anio", "mes", "veh_total"
    )


def busiest_stations(
    tables: Tables, anio: int, total_name: str = "vehiculos", n: int | None = None
) -> DataFrame:
    """q3: vehicles of a year by station name and department, largest first."""
    per_station = (
        tables.flujo_peaje.where(F.col("anio") == anio)
        .groupBy("id_peaje")
        .agg(F.sum("veh_total").alias("vehicles"))
    )
    totals = (
        per_station.join(tables.peaje, "id_peaje")
        .groupBy("nombre_peaje", "departamento")
        .agg(F.sum("vehicles").alias(total_name))
    )
    return ordered(totals, [F.desc(total_name)], ["nombre_peaje", "departamento"], n)


def stations_per_year(tables: Tables) -> DataFrame:
    """q4 in long form: distinct stations by year and administration."""
    return _stations_per_year(tables.flujo_peaje, tables.peaje)


def _stations_per_year(flujo: DataFrame, peaje: DataFrame) -> DataFrame:
    active = flujo.select("anio", "id_peaje").distinct()
    return (
        active.join(peaje, "id_peaje")
        .groupBy("anio", "administracion")
        .agg(F.countDistinct("id_peaje").alias("num_peajes"))
    )


def stations_per_year_wide(
    tables: Tables,
    administrations: Sequence[str] | None = None,
    null_label: str = "null",
    rest_label: str = "rest",
    n: int | None = None,
) -> DataFrame:
    """q4: one row per year, one column per administration, 0 where there is none.

    The administrations found in the data become columns. To find them without
    computing the counts twice, the long form (years times administrations) is
    checkpointed first. A caller who lists them saves that step; all others
    then count under ``rest_label``. Stations without one count under
    ``null_label``, together with those that are really called so; the year
    itself is never filled.
    """
    name = F.coalesce("administracion", F.lit(null_label))
    if administrations:
        name = F.when(name.isin(*administrations), name).otherwise(rest_label)
        administrations = [a for a in administrations if a != rest_label] + [rest_label]
    long = _stations_per_year(tables.flujo_peaje, tables.peaje.withColumn("administracion", name))
    if not administrations:
        ensure_checkpoint_dir(long.sparkSession)
        long = long.checkpoint()
    by_year = long.groupBy("anio")
    pivoted = (
        by_year.pivot("administracion", list(administrations))
        if administrations
        else by_year.pivot("administracion")
    )
    wide = pivoted.agg(F.sum("num_peajes"))
    filled = wide.na.fill(0, subset=[c for c in wide.columns if c != "anio"])
    return ordered(filled, [F.asc("anio")], [], n)


def mean_daily_traffic(tables: Tables, n: int | None = None) -> DataFrame:
    """q5: mean of the daily index by year."""
    means = tables.flujo_peaje.groupBy("anio").agg(F.avg("veh_imd").alias("promedio_veh_imd"))
    return ordered(means, [F.asc("anio")], [], n)


def joined_records(tables: Tables) -> DataFrame:
    """Fact and dimension on the shared id, which appears once."""
    return tables.flujo_peaje.join(broadcast_if_small(tables.peaje), "id_peaje")


def monthly_traffic(tables: Tables, n: int | None = None) -> DataFrame:
    """q6: monthly vehicles with station name and department, in time order."""
    columns = ["anio", "mes", "nombre_peaje", "departamento", "veh_total"]
    rows = joined_records(tables).select("id_flujo", *columns)
    keys = [F.asc(c) for c in columns[:3]]
    return ordered(rows, keys, ["departamento", "veh_total", "id_flujo"], n).select(*columns)


def light_share(tables: Tables, n: int | None = None) -> DataFrame:
    """q7: percentage of light vehicles by year and station, largest first."""
    light, total = "total_ligeros", "total_vehiculos"
    per_station = tables.flujo_peaje.groupBy("anio", "id_peaje").agg(
        F.sum("veh_ligeros_total").alias("light"), F.sum("veh_total").alias("vehicles")
    )
    share = (
        per_station.join(tables.peaje, "id_peaje")
        .groupBy("anio", "nombre_peaje", "departamento")
        .agg(F.sum("light").alias(light), F.sum("vehicles").alias(total))
        .withColumn(
            "pct_ligeros",
            F.when(F.col(total) > 0, F.round(F.col(light) / F.col(total) * 100.0, 2)).otherwise(0.0),
        )
    )
    ties = ["anio", "nombre_peaje", "departamento", light, total]
    return ordered(share, [F.desc("pct_ligeros")], ties, n)
