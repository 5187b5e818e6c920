"""The SQL reports, over the two tables as frames: no view stays in the session.

The year is a named parameter. Sorts end in tie-breakers, and aggregates over the join
reduce the fact to one row per station first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from tollstats.schema import Tables

JOINED_YEAR = """
SELECT anio, mes, nombre_peaje, departamento, veh_total
FROM {flujo_peaje} JOIN {peaje} USING (id_peaje)
WHERE anio = :anio
"""

RECORDS_PER_YEAR = """
SELECT anio, count(*) AS registros
FROM {flujo_peaje}
GROUP BY anio
ORDER BY anio
"""

STATIONS_PER_YEAR = """
WITH active AS (SELECT DISTINCT anio, id_peaje FROM {flujo_peaje})
SELECT anio, administracion, count(DISTINCT id_peaje) AS num_peajes
FROM active JOIN {peaje} USING (id_peaje)
GROUP BY anio, administracion
ORDER BY anio, administracion
"""

MEAN_BY_DEPARTMENT = """
WITH station AS (
  SELECT anio, id_peaje, sum(veh_total) AS vehicles, count(veh_total) AS months
  FROM {flujo_peaje}
  WHERE anio = :anio
  GROUP BY anio, id_peaje)
SELECT anio, departamento,
       try_divide(sum(vehicles), sum(months)) AS promedio_veh_total
FROM station JOIN {peaje} USING (id_peaje)
GROUP BY anio, departamento
ORDER BY promedio_veh_total DESC, anio, departamento
"""


def _report(tables: Tables, text: str, n: int | None, **parameters: int) -> DataFrame:
    frame = tables.peaje.sparkSession.sql(text, args=parameters, **tables._asdict())
    return frame if n is None else frame.limit(n)


def year_by_month(tables: Tables, anio: int, n: int | None = None) -> DataFrame:
    """q8: a year's records with station attributes, by month and station name."""
    text = JOINED_YEAR + "ORDER BY mes, nombre_peaje, departamento, veh_total, id_flujo"
    return _report(tables, text, n, anio=anio)


def records_per_year(tables: Tables, n: int | None = None) -> DataFrame:
    """q9: number of records by year."""
    return _report(tables, RECORDS_PER_YEAR, n)


def stations_per_year(tables: Tables, n: int | None = None) -> DataFrame:
    """q10: distinct stations by year and administration."""
    return _report(tables, STATIONS_PER_YEAR, n)


def year_by_traffic(tables: Tables, anio: int, n: int | None = None) -> DataFrame:
    """q11: a year's records, busiest month first."""
    text = JOINED_YEAR + "ORDER BY veh_total DESC, mes, nombre_peaje, departamento, id_flujo"
    return _report(tables, text, n, anio=anio)


def mean_by_department(tables: Tables, anio: int, n: int | None = None) -> DataFrame:
    """q12: mean monthly vehicles of a year by department, largest first."""
    return _report(tables, MEAN_BY_DEPARTMENT, n, anio=anio)
