from __future__ import annotations

import frames
import pytest
from frames import rows
from pyspark.sql import functions as F

from tollstats.plans import reports, sqlreports
from tollstats.registry.queries import QUERIES
from tollstats.schema import Tables
from tollstats.sources.lineitems import traffic_tables
from tollstats.sources.tables import register_views

STATIONS = [
    (1, "Norte", "Lima", "Estado"),
    (2, "Norte", "Lima", "Privado"),  # equal to 1 but for the administration
    (3, "Sur", "Ica", None),
]


def fact(i, station, anio=2020, mes=1, light=0, total=0, imd=0.0):
    return {
        "id_flujo": i, "id_peaje": station, "anio": anio, "mes": mes,
        "veh_ligeros_total": light, "veh_total": total, "veh_imd": imd,
    }


def test_stations_equal_in_name_are_merged(spark):
    t = frames.tables(spark, STATIONS, [fact(1, 1, total=5), fact(2, 2, total=6), fact(3, 3, total=1)])
    assert rows(reports.busiest_stations(t, 2020, "vehiculos_2020")) == [("Norte", "Lima", 11), ("Sur", "Ica", 1)]
    assert reports.busiest_stations(t, 2020, "vehiculos_2020").columns[-1] == "vehiculos_2020"


def test_share_of_zero_and_missing_totals_is_zero(spark):
    t = frames.tables(
        spark,
        STATIONS,
        [fact(1, 1, light=1, total=3), fact(2, 3, anio=2021), fact(3, 3, anio=2022, light=None, total=None)],
    )
    got = {r.anio: (r.total_vehiculos, r.pct_ligeros) for r in reports.light_share(t).collect()}
    assert got == {2020: (3, 33.33), 2021: (0, 0.0), 2022: (None, 0.0)}


def test_round_half_up(spark):
    t = frames.tables(spark, STATIONS, [fact(1, 1, light=1, total=1600)])  # 0.0625 %
    assert reports.light_share(t).first().pct_ligeros == 0.06
    t = frames.tables(spark, STATIONS, [fact(1, 1, light=1, total=800)])  # 0.125 %
    assert reports.light_share(t).first().pct_ligeros == 0.13


def test_pivot_keeps_null_year_and_null_administration(spark):
    t = frames.tables(spark, STATIONS, [fact(1, 1), fact(2, 2), fact(3, 3, anio=None), fact(4, 1, mes=2)])
    wide = reports.stations_per_year_wide(t)
    assert wide.columns == ["anio", "Estado", "Privado", "null"]
    assert rows(wide) == [(None, 0, 0, 1), (2020, 1, 1, 0)]
    named = reports.stations_per_year_wide(t, null_label="sin dato")
    assert "sin dato" in named.columns
    listed = reports.stations_per_year_wide(t, ["Privado", "Estado", "Mixto"])
    assert listed.columns == ["anio", "Privado", "Estado", "Mixto", "rest"]


def test_wide_and_long_agree(spark, small):
    t = traffic_tables(spark, small)
    wide = reports.stations_per_year_wide(t)
    names = [c for c in wide.columns if c != "anio"]
    unpivoted = wide.unpivot("anio", names, "administracion", "num_peajes").where("num_peajes > 0")
    assert sorted(rows(unpivoted)) == sorted(rows(sqlreports.stations_per_year(t)))
    assert sorted(rows(unpivoted)) == sorted(rows(reports.stations_per_year(t)))


def test_frame_and_sql_reports_agree(spark, small):
    t = traffic_tables(spark, small)
    year = reports.monthly_traffic(t).where(F.col("anio") == 1999)
    assert sorted(rows(year)) == sorted(rows(sqlreports.year_by_month(t, 1999)))
    assert sorted(rows(year)) == sorted(rows(sqlreports.year_by_traffic(t, 1999)))
    counted = {r.anio: r.registros for r in sqlreports.records_per_year(t).collect()}
    assert sum(counted.values()) == t.flujo_peaje.count()


def test_totals_of_the_year(spark, small):
    t = traffic_tables(spark, small)
    total = t.flujo_peaje.where("anio = 1998").agg(F.sum("veh_total")).first()[0]
    assert reports.busiest_stations(t, 1998).agg(F.sum("vehiculos")).first()[0] == total


def test_narrowed_scan_holds_the_same_year(spark, small):
    whole = traffic_tables(spark, small).flujo_peaje.where("anio = 1998")
    narrowed = traffic_tables(spark, small, 1998).flujo_peaje
    assert sorted(rows(whole)) == sorted(rows(narrowed))


def test_additive_identities(spark, small):
    facts = traffic_tables(spark, small).flujo_peaje
    heavy = "veh_pesados_tar_dif + veh_pesados_2e + veh_pesados_3e + veh_pesados_4e + veh_pesados_5e + veh_pesados_6e + veh_pesados_7e"
    broken = facts.where(
        f"veh_ligeros_total != veh_ligeros_tar_dif + veh_ligeros_automoviles or "
        f"veh_pesados_total != {heavy} or veh_total != veh_ligeros_total + veh_pesados_total"
    )
    assert broken.count() == 0


@pytest.mark.parametrize("partitions", [1, 4])
def test_ties_do_not_depend_on_the_partitioning(spark, partitions):
    stations = [(i, f"P{i:02d}", "Lima", "Estado") for i in range(40)]
    facts = [fact(i, i, total=7, light=7) for i in range(40)]
    t = frames.tables(spark, stations, facts)
    t = Tables(t.peaje, t.flujo_peaje.repartition(partitions))
    assert [r.nombre_peaje for r in reports.busiest_stations(t, 2020, n=20).collect()] == [
        f"P{i:02d}" for i in range(20)
    ]
    assert [r.nombre_peaje for r in sqlreports.year_by_traffic(t, 2020, n=30).collect()] == [
        f"P{i:02d}" for i in range(30)
    ]
    assert [r.nombre_peaje for r in reports.light_share(t, n=25).collect()][-1] == "P24"


def test_mean_by_department_ignores_missing_counts(spark):
    t = frames.tables(
        spark, STATIONS, [fact(1, 1, total=4), fact(2, 2, total=None), fact(3, 1, mes=2, total=8), fact(4, 3, total=None)]
    )
    assert rows(sqlreports.mean_by_department(t, 2020)) == [(2020, "Lima", 6.0), (2020, "Ica", None)]


def test_preview_and_limits(spark, small):
    t = traffic_tables(spark, small)
    assert reports.station_columns(t).limit(10).count() == 10
    assert reports.mean_daily_traffic(t, n=3).count() == 3
    register_views(t, "estaciones", "flujos")
    assert spark.sql("SELECT count(*) AS n FROM flujos JOIN estaciones USING (id_peaje)").first().n == 826


def test_sql_reports_leave_no_view_behind(spark, small):
    spark.range(3).createOrReplaceTempView("flujo_peaje")
    before = {t.name for t in spark.catalog.listTables()}
    for name in ("q8", "q9", "q10", "q11", "q12", "topk_q8"):
        assert QUERIES[name](spark, small).count() > 0
    assert {t.name for t in spark.catalog.listTables()} == before
    assert spark.table("flujo_peaje").count() == 3
    spark.catalog.dropTempView("flujo_peaje")


@pytest.mark.parametrize("name", ["q2", "q3", "q8", "q11", "q12"])
def test_years_do_not_depend_on_the_zone(spark, small, name):
    results = []
    try:
        for zone in ("UTC", "Asia/Tokyo", "America/Lima"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            results.append(rows(QUERIES[name](spark, small)))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert sorted(results[0], key=str) == sorted(results[1], key=str) == sorted(results[2], key=str)


def test_year_filter_reaches_the_files(spark, small):
    plan = traffic_tables(spark, small, 1998).flujo_peaje._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(l_shipdate,1998-01-01T00:00)" in plan and "LessThan(l_shipdate,1999" in plan


def test_pivot_adds_missing_and_so_named_administrations(spark):
    stations = [(1, "A", "Lima", None), (2, "B", "Lima", "null"), (3, "C", "Lima", "null"), (4, "D", "Lima", "Estado")]
    t = frames.tables(spark, stations, [fact(i, i) for i in (1, 2, 3, 4)])
    assert reports.stations_per_year_wide(t).first().asDict() == {"anio": 2020, "null": 3, "Estado": 1}
    listed = reports.stations_per_year_wide(t, ["Estado"]).first().asDict()
    assert listed == {"anio": 2020, "Estado": 1, "rest": 3}
