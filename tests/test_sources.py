from __future__ import annotations

from types import SimpleNamespace
from unittest.mock import MagicMock

import pytest
from pyspark.sql import functions as F

from tollstats.operators.joins import broadcast_if_small, measured_bytes
from tollstats.operators.surrogate import assign_ids
from tollstats.plans import ingest
from tollstats.schema import FLUJO_NAMES, FLUJO_SCHEMA, PEAJE_SCHEMA, STATION_KEY
from tollstats.sources import jdbc, jdbc_store, staging
from tollstats.sources.lineitems import raw_records, traffic_tables
from tollstats.sources.tables import jdbc_tables, stored_tables

SETTINGS = jdbc.JdbcSettings("jdbc:postgresql://host/db", "reader", "secret")


def fake_session(frame):
    session = MagicMock()
    session.read.jdbc.return_value = frame
    return session


def test_settings_do_not_show_the_password():
    assert "secret" not in repr(SETTINGS)
    assert SETTINGS.properties()["driver"] == "org.postgresql.Driver"


def test_whole_table_scan_lowers_names(spark):
    session = fake_session(spark.range(1).withColumnRenamed("id", "ID_PEAJE"))
    frame = jdbc.scan_jdbc(session, SETTINGS, "peaje")
    assert frame.columns == ["id_peaje"]
    (url, table), options = session.read.jdbc.call_args
    assert (url, table) == (SETTINGS.url, "peaje")
    assert options == {"properties": SETTINGS.properties()}


def test_range_scan(spark):
    session = fake_session(spark.range(1))
    jdbc.scan_jdbc(session, SETTINGS, "flujo_peaje", jdbc.JdbcRange("id_flujo", 1, 1000, 16))
    options = session.read.jdbc.call_args.kwargs
    assert (options["column"], options["lowerBound"], options["upperBound"], options["numPartitions"]) == ("id_flujo", 1, 1000, 16)


def test_year_predicates_are_disjoint_and_complete(spark):
    predicates = jdbc.year_predicates([2021, 2020, 2020])
    assert predicates == ["anio = 2020", "anio = 2021", "anio IS NULL OR anio NOT IN (2020, 2021)"]
    frame = spark.createDataFrame([(2019,), (2020,), (2021,), (None,)], "anio int")
    parts = [frame.where(p).count() for p in predicates]
    assert parts == [1, 1, 2]
    session = fake_session(spark.range(1))
    jdbc.scan_jdbc(session, SETTINGS, "flujo_peaje", predicates)
    assert session.read.jdbc.call_args.kwargs["predicates"] == predicates


def test_scan_is_split_by_the_stored_ids(spark):
    session = fake_session(spark.createDataFrame([(5, 90)], "LOW bigint, HIGH bigint"))
    assert jdbc.id_range(session, SETTINGS, "flujo_peaje", "id_flujo", 8) == jdbc.JdbcRange("id_flujo", 5, 91, 8)
    empty = fake_session(spark.createDataFrame([(None, None)], "LOW bigint, HIGH bigint"))
    assert jdbc.id_range(empty, SETTINGS, "flujo_peaje", "id_flujo", 8) is None


def test_append():
    frame = MagicMock()
    jdbc.append_jdbc(frame, SETTINGS, "flujo_peaje", connections=8)
    (url, table), options = frame.write.jdbc.call_args
    assert (url, table, options["mode"]) == (SETTINGS.url, "flujo_peaje", "append")
    assert options["properties"]["numPartitions"] == "8"
    assert "numPartitions" not in SETTINGS.properties()


def test_jdbc_dimension_is_measured_before_it_is_broadcast(spark):
    upper = [c.upper() for c in [*FLUJO_NAMES, *STATION_KEY]]
    session = fake_session(spark.range(1).select(*[F.lit("1").alias(c) for c in upper]))
    tables = jdbc_tables(session, SETTINGS, jdbc.year_predicates([2020]))
    assert tables.flujo_peaje.columns == FLUJO_NAMES
    assert "ResolvedHint (strategy=broadcast)" in plan(tables.peaje)
    assert "ResolvedHint" not in plan(tables.flujo_peaje)


@pytest.mark.parametrize("assigns_ids", [True, False])
def test_load_into_a_database(spark, small, tmp_path, monkeypatch, assigns_ids):
    """The load against a stand-in for the database: parquet folders behind scan and append."""
    schemas = {"peaje": PEAJE_SCHEMA, "flujo_peaje": FLUJO_SCHEMA}
    written = []

    def scan(session, settings, table, split=None):
        folder = tmp_path / table
        if not folder.exists():
            return spark.createDataFrame([], schemas[table])
        return spark.read.schema(schemas[table]).parquet(str(folder))

    def append(frame, settings, table, connections=None):
        written.append((table, frame.columns))
        if "id_peaje" not in frame.columns:
            frame = assign_ids(frame, STATION_KEY, "id_peaje", after=100 * len(written))
        frame.write.mode("append").parquet(str(tmp_path / table))

    monkeypatch.setattr(jdbc_store, "scan_jdbc", scan)
    monkeypatch.setattr(jdbc_store, "id_range", lambda *args: None)
    monkeypatch.setattr(jdbc_store, "append_jdbc", append)
    raw = raw_records(traffic_tables(spark, small))
    store = jdbc_store.JdbcStore(spark, SETTINGS, assigns_ids=assigns_ids)
    ingest.load(store, raw)
    ingest.load(store, raw)
    expected = STATION_KEY if assigns_ids else PEAJE_SCHEMA.names
    assert written == [("peaje", expected), ("flujo_peaje", FLUJO_NAMES)] * 2
    tables = store.tables()
    assert (tables.peaje.count(), tables.flujo_peaje.count()) == (10, 826)
    assert tables.flujo_peaje.join(tables.peaje, "id_peaje").count() == 826


def plan(frame):
    return frame._jdf.queryExecution().analyzed().toString()


def test_measure_grows_with_rows_and_text(spark):
    short = spark.range(1000).select(F.lit("a").alias("t"))
    long = spark.range(1000).select(F.repeat(F.lit("a"), F.lit(5000)).alias("t"))
    assert measured_bytes(short.where("t = 'b'")) == 0
    assert measured_bytes(short) < 100_000 < 5_000_000 < measured_bytes(long)
    assert "ResolvedHint" in plan(broadcast_if_small(short, 100_000))
    assert "ResolvedHint" not in plan(broadcast_if_small(long, 100_000))


def test_empty_store_has_the_schemas(spark, tmp_path):
    tables = stored_tables(spark, str(tmp_path / "none"))
    assert tables.peaje.count() == tables.flujo_peaje.count() == 0
    assert tables.peaje.columns == ["id_peaje", "nombre_peaje", "departamento", "administracion"]


def test_shared_folder_is_the_configured_one(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    assert staging.shared_dir(spark) == (configured or spark.sparkContext.getCheckpointDir())
    first, second = staging.staging_path(spark, "x"), staging.staging_path(spark, "x")
    assert first != second and first.startswith(staging.shared_dir(spark))


def session_without_folder(master):
    conf = SimpleNamespace(get=lambda key, default: default)
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master, getCheckpointDir=lambda: None))


def test_cluster_without_shared_folder_is_refused():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        staging.shared_dir(session_without_folder("spark://host:7077"))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        staging.shared_dir(session_without_folder("local-cluster[2,1,1024]"))
    assert staging.shared_dir(session_without_folder("local[2]"))
