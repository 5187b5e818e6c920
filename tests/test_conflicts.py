"""What a load cannot take: malformed lines, duplicates, records that changed or moved."""

from __future__ import annotations

import frames
import pytest
from frames import rows
from test_ingest import record

from tollstats.operators.dedup import dedup_counted, dedup_key
from tollstats.plans import ingest
from tollstats.schema import FLUJO_NAMES, MALFORMED, RAW_NAMES
from tollstats.sources.csv_files import csv_headers, header_names, scan_csv
from tollstats.sources.lineitems import raw_records, traffic_tables
from tollstats.sources.parquet_store import ParquetStore


def reasons(rejected):
    return sorted((r.ID, r.VEH_TOTAL, *r.reasons) for r in rejected.collect())


def totals(store):
    return {r.id_flujo: r.veh_total for r in store.flujo_peaje().collect()}


@pytest.fixture
def store(spark, tmp_path):
    return ParquetStore(spark, str(tmp_path / "store"))


def test_duplicates_of_an_id_come_back(spark, store):
    raw = frames.raw(
        spark, record("1", VEH_TOTAL="9"), record("1", VEH_TOTAL="5"), record("1.0", VEH_TOTAL="5.0"),
        record("1", VEH_TOTAL="?"), record("2", VEH_TOTAL="7"), record("2", VEH_TOTAL="7"),
    )
    rejected = ingest.load(store, raw)
    # A missing value is the smallest; the two equal records of id 2 lose nothing.
    assert totals(store) == {1: None, 2: 7}
    assert reasons(rejected) == [
        ("1", "5", "duplicate"), ("1", "9", "duplicate"), ("1", "?", "VEH_TOTAL"), ("1.0", "5.0", "duplicate"),
    ]


def test_changed_records_come_back(spark, store):
    ingest.load(store, frames.raw(spark, record("1", VEH_TOTAL="5"), record("2", VEH_TOTAL="7"), record("3")))
    later = frames.raw(
        spark, record("1", VEH_TOTAL="5"), record("1", VEH_TOTAL="4"), record("2", VEH_TOTAL="70"), record("4", VEH_TOTAL="1"),
        record("4", VEH_TOTAL="2"), record("3", "Otro"),
    )
    rejected = ingest.load(store, later)
    assert totals(store) == {1: 5, 2: 7, 3: 0, 4: 1}
    assert reasons(rejected) == [
        ("1", "4", "changed"), ("2", "70", "changed"), ("3", "0", "changed"), ("4", "2", "duplicate"),
    ]
    assert reasons(ingest.load(store, frames.raw(spark, record("1", VEH_TOTAL="5")))) == []


@pytest.mark.parametrize("fixed_years", [False, True])
def test_an_id_that_moved_to_another_year(spark, store, fixed_years):
    ingest.load(store, frames.raw(spark, record("1", ANIO="2019"), record("2", ANIO="2020")))
    rejected = ingest.load(store, frames.raw(spark, record("1", ANIO="2020"), record("2", ANIO="2020")), fixed_years)
    if fixed_years:  # the caller's rule: an id keeps its year
        assert store.flujo_peaje().count() == 3 and rejected.count() == 0
    else:
        assert store.flujo_peaje().count() == 2
        assert reasons(rejected) == [("1", "0", "changed")]


def test_only_the_batch_of_years_is_read(spark, small, store):
    tables = traffic_tables(spark, small)
    ingest.load(store, raw_records(tables))
    year = tables.flujo_peaje.where("anio = 1998")
    bounds = ingest.batch_bounds(year)
    assert bounds.years == [1998]

    def scans(frame):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        return [line for line in plan.splitlines() if "FileScan" in line and "id_flujo" in line]

    pruned = ingest.fact_new(year, store.flujo_peaje(), bounds, fixed_years=True)
    (scan,) = scans(pruned)
    assert "PartitionFilters: [" in scan and "1998" in scan.split("PartitionFilters")[1]
    assert "GreaterThanOrEqual(id_flujo" in scan and "veh_total" not in scan
    assert pruned.inputFiles() and pruned.count() == 0
    whole, ids = scans(ingest.judged(dedup_counted(year.select(*FLUJO_NAMES), "id_flujo"), store.flujo_peaje(), bounds))
    assert "veh_total" in whole and "1998" in whole.split("PartitionFilters")[1]
    assert "veh_total" not in ids.split("ReadSchema")[1]


def test_missing_and_many_years(spark, monkeypatch):
    rows_ = [{"id_flujo": i, "anio": y} for i, y in enumerate([None, 2000, 2001, None])]
    stored = frames.flujo(spark, *rows_)
    for batch, listed in (([0], {None}), ([1], {2000}), ([0, 1], {None, 2000})):
        bounds = ingest.batch_bounds(stored.where(stored.id_flujo.isin(batch)))
        got = {r.anio for r in stored.where(bounds.in_years()).collect()}
        assert set(bounds.years) == listed == got
        assert {r.anio for r in stored.where(~bounds.in_years()).collect()} == {None, 2000, 2001} - listed
    monkeypatch.setattr(ingest, "LISTED_YEARS", 1)
    assert ingest.batch_bounds(stored).years is None
    assert stored.where(ingest.batch_bounds(stored).in_years()).count() == 4
    assert ingest.batch_bounds(stored.where("id_flujo < 0")) is None


def test_dominant_id_with_conflicts(spark):
    frame = spark.range(30_000).selectExpr("if(id % 3 = 0, -1, id) as id", "cast(id % 5 as int) as a", "cast(null as string) as b")
    counted = dedup_counted(frame, "id")
    assert counted.where("id = -1").select("a", "copies", "differing").first() == (0, 10_000, True)
    assert counted.where("differing").count() == 1
    assert sorted(rows(counted.select("id", "a", "b"))) == sorted(rows(dedup_key(frame, "id")))
    assert "Window" not in counted._jdf.queryExecution().toString()


def write_lines(path, *lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")


def line(i, extra=0):
    values = [i if n == "ID" else "X" if n in ("NOMBRE_PEAJE", "DEPARTAMENTO", "ADMINIST") else "1" for n in RAW_NAMES]
    return ",".join(values[:extra] if extra < 0 else values + ["9"] * extra)


def test_malformed_lines_are_kept_out_and_reported(spark, store, tmp_path):
    header = ",".join(RAW_NAMES)
    write_lines(tmp_path / "csv/a.csv", header, line("1"), line("2", -3), line("3", 2), "4", line("5"))
    write_lines(tmp_path / "csv/b.csv", "", header + ",EXTRA", line("6", 1), line("7"), line("8", 2))
    raw = scan_csv(spark, str(tmp_path / "csv"), malformed=True)
    assert raw.columns == [*RAW_NAMES, MALFORMED]
    rejected = ingest.load(store, raw)
    assert {r[MALFORMED]: r.reasons for r in rejected.collect()} == {
        text: ["fields"] for text in (line("2", -3), line("3", 2), "4", line("7"), line("8", 2))
    }
    assert set(totals(store)) == {1, 5, 6} and store.peaje().count() == 1
    assert scan_csv(spark, str(tmp_path / "csv")).columns == RAW_NAMES


def test_quoted_and_odd_headers(spark, tmp_path):
    quoted = ",".join(f'"{n}"' for n in RAW_NAMES)
    write_lines(tmp_path / "csv/a.csv", "﻿" + quoted + ',"a, b"', line("1", 1))
    write_lines(tmp_path / "csv/b.csv", ",".join(["Ñandú", "same", "same", *reversed(RAW_NAMES)]), "x,y,z," + ",".join(["5"] * 21))
    (tmp_path / "csv/empty.csv").write_text("")
    write_lines(tmp_path / "csv/_hidden.csv", "no header")
    got = scan_csv(spark, str(tmp_path / "csv"))
    assert sorted(r.ID for r in got.collect()) == ["1", "5"]
    assert header_names('a,"b ""c"", d",') == ("a", 'b "c", d', "")
    write_lines(tmp_path / "twice/a.csv", ",".join([*RAW_NAMES, "ID"]), line("1", 1))
    with pytest.raises(ValueError, match="repeats, ID"):
        scan_csv(spark, str(tmp_path / "twice"))
    write_lines(tmp_path / "none/a.csv", "", "")
    with pytest.raises(ValueError, match="no CSV file"):
        scan_csv(spark, str(tmp_path / "none"))


def test_the_number_of_jobs_does_not_follow_the_number_of_files(spark, tmp_path):
    def jobs(files):
        folder = tmp_path / f"csv{files}"
        for i in range(files):
            names = RAW_NAMES if i % 2 else list(reversed(RAW_NAMES))
            write_lines(folder / f"{i}.csv", ",".join(names), ",".join(["1"] * 21))
        group = f"scan of {files}"
        spark.sparkContext.setJobGroup(group, group)
        assert scan_csv(spark, str(folder)).count() == files
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        assert csv_headers(spark, str(folder)).count() == files
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))

    # Each of the two lists has over 32 files, beyond which Spark lists them by a job.
    assert jobs(70) == jobs(280)
