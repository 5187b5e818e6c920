from __future__ import annotations

import frames
import pytest
from frames import rows
from pyspark.sql import functions as F

from tollstats.operators.dedup import dedup_key
from tollstats.operators.surrogate import assign_ids
from tollstats.plans import ingest
from tollstats.schema import FLUJO_NAMES, STATION_KEY
from tollstats.sources.csv_files import scan_csv, write_csv
from tollstats.sources.lineitems import raw_records, traffic_tables
from tollstats.sources.parquet_store import ParquetStore


def record(i, name="Norte", department="Lima", administration="Estado", **measures):
    return {
        "ID": i, "NOMBRE_PEAJE": name, "DEPARTAMENTO": department, "ADMINIST": administration,
        "ANIO": "2020", "MES": "1", **measures,
    }


def test_missing_key_parts_match_each_other(spark):
    old = frames.station(spark, (1, "Norte", None, "Estado"), (2, "Sur", "Ica", "Estado"))
    raw = frames.raw(spark, record("1", department=None), record("2", "Sur", "Ica"), record("3", "Este", None))
    candidates = ingest.dim_extract(raw)
    assert rows(ingest.dim_new(candidates, old)) == [("Este", None, "Estado")]
    plain = ingest.dim_new(candidates, old, null_safe=False)
    assert sorted(rows(plain)) == [("Este", None, "Estado"), ("Norte", None, "Estado")]


def test_lookup_and_rejected_rows(spark):
    stations = frames.station(spark, (7, "Norte", None, "Estado"))
    typed = ingest.fact_typed(frames.raw(spark, record("1", department=None), record("2", "Otro")))
    assert [(r.id_flujo, r.id_peaje) for r in ingest.fact_lookup(typed, stations).collect()] == [(1, 7)]
    assert [r.id_flujo for r in ingest.fact_rejected(typed, stations).collect()] == [2]
    assert ingest.fact_lookup(typed, stations, null_safe=False).count() == 0
    assert ingest.fact_rejected(typed, stations, null_safe=False).count() == 2


def test_typed_columns(spark):
    raw = frames.raw(spark, record("5", VEH_TOTAL="12.7", VEH_LIGEROS_TAR_DIF="12.0", VEH_IMD="0.41", MES="bad"))
    row = ingest.fact_typed(raw).first()
    assert (row.id_flujo, row.veh_total, row.veh_ligeros_tar_dif, row.veh_imd, row.mes) == (5, 12, 12, 0.41, None)


@pytest.mark.parametrize("partitions", [1, 3])
def test_dedup_keeps_the_smallest_row_and_one_missing_id(spark, partitions):
    frame = spark.createDataFrame(
        [(1, 5, "b"), (1, 4, "z"), (1, 4, None), (None, 2, "x"), (None, 1, "y"), (2, 9, "q")],
        "id bigint, a int, b string",
    ).repartition(partitions)
    assert set(rows(dedup_key(frame, "id"))) == {(1, 4, None), (None, 1, "y"), (2, 9, "q")}


def test_dedup_of_a_dominant_key(spark):
    """A third of the rows share one id: each map task forwards one row for it."""
    frame = spark.range(30_000).selectExpr("if(id % 3 = 0, -1, id) as id", "cast(id as int) as a")
    kept = dedup_key(frame, "id")
    assert kept.count() == 20_001
    assert kept.where("id = -1").first().a == 0
    plan = kept._jdf.queryExecution().toString()
    assert "partial_min" in plan and "Window" not in plan


@pytest.mark.parametrize("partitions", [1, 5])
def test_ids_are_dense_and_reproducible(spark, medium, partitions):
    stations = traffic_tables(spark, medium).peaje.select(*STATION_KEY).repartition(partitions)
    numbered = assign_ids(stations, STATION_KEY, "id", after=10, buckets=16)
    got = sorted(rows(numbered))
    assert [r[0] for r in got] == list(range(11, 111))
    again = sorted(rows(assign_ids(stations.repartition(7), STATION_KEY, "id", after=10, buckets=16)))
    assert got == again


def test_load_twice_adds_nothing(spark, small, tmp_path):
    tables = traffic_tables(spark, small)
    raw = raw_records(tables)
    raw = raw.unionByName(raw.limit(5))  # a few records come twice
    store = ParquetStore(spark, str(tmp_path / "store"))
    assert store.peaje().count() == 0
    ingest.load(store, raw)
    first = sorted(rows(store.flujo_peaje())), sorted(rows(store.peaje()))
    ingest.load(store, raw)
    assert (sorted(rows(store.flujo_peaje())), sorted(rows(store.peaje()))) == first
    assert [r[0] for r in first[1]] == list(range(1, 11))
    joined = store.flujo_peaje().join(store.peaje(), "id_peaje").select("id_flujo", "nombre_peaje", "veh_total")
    source = tables.flujo_peaje.join(tables.peaje, "id_peaje").select("id_flujo", "nombre_peaje", "veh_total")
    assert sorted(rows(joined)) == sorted(rows(source))


def test_later_load_continues_the_ids(spark, tmp_path):
    store = ParquetStore(spark, str(tmp_path / "store"))
    ingest.load(store, frames.raw(spark, record("1"), record("3", "Sur", None)))
    ingest.load(store, frames.raw(spark, record("1"), record("3", "Sur", None), record("2", "Este")))
    assert sorted(r.id_peaje for r in store.peaje().collect()) == [1, 2, 3]
    assert store.peaje().where("nombre_peaje = 'Este'").first().id_peaje == 3
    assert store.flujo_peaje().count() == 3
    assert store.flujo_peaje().columns == FLUJO_NAMES


def test_load_keeps_large_counts_and_reports_what_it_cannot_read(spark, tmp_path):
    store = ParquetStore(spark, str(tmp_path / "store"))
    records = [
        record("1.0", VEH_TOTAL="3000000000"), record("2.0", VEH_TOTAL="3e9"), record("3", VEH_TOTAL="NaN"),
        record("x", MES="?"), record(None), record("y"), record("4", VEH_IMD="bad"), record("5"),
    ]
    rejected = ingest.load(store, frames.raw(spark, *records))
    stored = {r.id_flujo: r.veh_total for r in store.flujo_peaje().collect()}
    assert stored == {1: 3_000_000_000, 2: 3_000_000_000, 3: None, 4: 0, 5: 0}
    reasons = sorted(((r.ID or "", r.reasons) for r in rejected.collect()), key=str)
    assert reasons == [
        ("", ["ID"]), ("3", ["VEH_TOTAL"]), ("4", ["VEH_IMD"]), ("x", ["ID", "MES"]), ("y", ["ID"]),
    ]


def test_rejected_without_a_station(spark):
    raw = frames.raw(spark, record("1"), record("2", "Otro", None))
    rejected = ingest.load_rejected(raw, frames.station(spark, (7, "Norte", "Lima", "Estado")))
    assert [(r.ID, r.reasons) for r in rejected.collect()] == [("2", ["station"])]


def test_csv_files_of_different_headers(spark, tmp_path):
    one = frames.raw(spark, record("1", VEH_TOTAL="5"))
    two = frames.raw(spark, record("2", "Sur", VEH_TOTAL="6")).select(F.lit("z").alias("EXTRA"), *reversed(one.columns))
    for i, frame in enumerate([one, two, one]):
        write_csv(frame, str(tmp_path / f"m{i}"))
    got = scan_csv(spark, str(tmp_path / "m*"))
    assert got.columns == one.columns
    assert sorted(rows(got.select("ID", "NOMBRE_PEAJE", "VEH_TOTAL"))) == [
        ("1", "Norte", "5"), ("1", "Norte", "5"), ("2", "Sur", "6"),
    ]


def test_append_is_partitioned_by_year_and_prunes(spark, small, tmp_path):
    store = ParquetStore(spark, str(tmp_path / "store"))
    ingest.load(store, raw_records(traffic_tables(spark, small)))
    assert {p.name for p in (tmp_path / "store/flujo_peaje").iterdir() if p.is_dir()} == {
        f"anio={y}" for y in range(1995, 2002)
    }
    plan = store.flujo_peaje().where("anio = 1998")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(anio" in plan


def test_csv_header_order_and_further_columns(spark, tmp_path):
    raw = frames.raw(spark, record("1", name="Peñón"), record("2"))
    shuffled = raw.select(F.lit("x").alias("EXTRA"), *reversed(raw.columns))
    write_csv(shuffled, str(tmp_path / "csv"))
    back = scan_csv(spark, str(tmp_path / "csv"))
    assert back.columns == raw.columns
    assert sorted(rows(back)) == sorted(rows(raw))
    typed = scan_csv(spark, str(tmp_path / "csv"), infer_types=True)
    assert dict(typed.dtypes)["ID"] == "int"
    assert sorted(rows(ingest.fact_typed(typed))) == sorted(rows(ingest.fact_typed(back)))


def test_csv_without_a_needed_column(spark, tmp_path):
    write_csv(frames.raw(spark, record("1")).drop("MES"), str(tmp_path / "csv"))
    with pytest.raises(ValueError, match="MES"):
        scan_csv(spark, str(tmp_path / "csv"))
