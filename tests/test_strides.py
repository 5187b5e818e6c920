"""Database scans that follow the rows, mergeable distinct counts, quantiles by sketch and count."""

from __future__ import annotations

import random
from unittest.mock import MagicMock

import duckdb
import frames
import pytest
from frames import rows
from pyspark.sql import functions as F
from test_sources import SETTINGS

from tollstats.operators import quantiles
from tollstats.operators.bitmaps import bitmap_distinct, id_bitmaps, merged_bitmaps
from tollstats.operators.quantiles import exact_quantiles
from tollstats.plans import activity, ingest, reports
from tollstats.sources import jdbc, jdbc_store
from tollstats.sources.lineitems import raw_records, traffic_tables
from tollstats.sources.parquet_store import ParquetStore


def database(spark, ids):
    """A session whose scans answer the queries it is given, by an engine inside this process."""
    engine = duckdb.connect()
    engine.execute("CREATE TABLE flujo_peaje (id_flujo BIGINT)")
    engine.executemany("INSERT INTO flujo_peaje VALUES (?)", [(i,) for i in ids]) if ids else None

    def scan(url, table, predicates=None, column=None, lowerBound=None, upperBound=None, numPartitions=None, properties=None):
        result = engine.sql(f"SELECT * FROM {table}")
        names = ", ".join(f"{c} bigint" for c in result.columns)
        return spark.createDataFrame(result.fetchall(), names)

    session = MagicMock()
    session.read.jdbc.side_effect = scan
    return session, engine


@pytest.mark.parametrize(
    ("ids", "tasks"),
    [
        ([*range(1000)] + [10**12], 10),  # one id far off
        ([i * i * i for i in range(500)], 5),
        ([-5, None, 7, 10**9] * 25, 1),
    ],
)
def test_strides_hold_equally_many_rows(spark, ids, tasks):
    session, engine = database(spark, ids)
    bounds = jdbc.id_range(session, SETTINGS, "flujo_peaje", "id_flujo", 1)
    split = jdbc.id_strides(session, SETTINGS, "flujo_peaje", bounds, 110, 64)
    if tasks == 1:
        assert split.partitions == 1
        return
    counts = [engine.sql(f"SELECT count(*) FROM flujo_peaje WHERE {p}").fetchall()[0][0] for p in split]
    assert sum(counts) == len(ids) and len(counts) == tasks
    assert max(counts) - min(counts) <= 2
    assert len(jdbc.id_strides(session, SETTINGS, "flujo_peaje", bounds, 1, 3)) == 3


def test_dense_ids_keep_equal_strides(spark):
    session, _ = database(spark, list(range(100, 1100)))
    bounds = jdbc.id_range(session, SETTINGS, "flujo_peaje", "id_flujo", 1)
    assert jdbc.id_strides(session, SETTINGS, "flujo_peaje", bounds, 300, 64) == jdbc.JdbcRange("id_flujo", 100, 1100, 4)
    assert session.read.jdbc.call_count == 2  # bounds and count, no tiles


def test_predicates_cover_missing_ids_and_repeated_starts():
    assert jdbc.stride_predicates("i", [5, 9, 9, 7]) == ["i < 7 OR i IS NULL", "i >= 7 AND i < 9", "i >= 9"]
    assert jdbc.stride_predicates("i", [5]) == jdbc.stride_predicates("i", []) == ["1 = 1"]


def test_store_scans_by_strides(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(jdbc_store, "id_range", lambda *a: jdbc.JdbcRange("id_flujo", 1, 9, 1))
    monkeypatch.setattr(jdbc_store, "id_strides", lambda *a: ["id_flujo < 5 OR id_flujo IS NULL", "id_flujo >= 5"])
    monkeypatch.setattr(jdbc_store, "scan_jdbc", lambda *a: seen.append(a) or frames.flujo(spark))
    jdbc_store.JdbcStore(spark, SETTINGS).flujo_peaje()
    assert seen[-1][-1] == ["id_flujo < 5 OR id_flujo IS NULL", "id_flujo >= 5"]


def test_bitmaps_add_up_over_loads(spark, small):
    tables = traffic_tables(spark, small)
    parts = [tables.flujo_peaje.where(F.col("mes") % 3 == i) for i in range(3)]
    loads = [activity.station_activity(tables._replace(flujo_peaje=p)) for p in [*parts, parts[0]]]
    union = loads[0].unionByName(loads[1]).unionByName(loads[2]).unionByName(loads[3])
    want = sorted(rows(reports.stations_per_year(tables)))
    assert sorted(rows(activity.stations_per_year(union))) == want
    by_year = {r.anio: r.num_peajes for r in activity.stations_by(union, "anio").collect()}
    distinct = tables.flujo_peaje.groupBy("anio").agg(F.countDistinct("id_peaje").alias("n"))
    assert by_year == {r.anio: r.n for r in distinct.collect()}
    plan = activity.stations_per_year(union)._jdf.queryExecution().toString()
    assert "bitmap_or_agg" in plan


def test_loads_keep_the_activity(spark, small, tmp_path):
    """Two loads that overlap, and one that adds nothing: the stored bitmaps give the report."""
    store = ParquetStore(spark, str(tmp_path / "store"))
    assert activity.stations_per_year(store.activity()).count() == 0
    raw = raw_records(traffic_tables(spark, small))
    early = F.col("ANIO").cast("int") < 1998
    for part in (raw.where(early), raw.where(~early | (F.col("MES").cast("int") == 3)), raw):
        ingest.load(store, part, activity=True)
    assert rows(activity.stations_per_year(store.activity())) == sorted(rows(reports.stations_per_year(store.tables())))
    plan = activity.stations_per_year(store.activity())._jdf.queryExecution().toString()
    assert "flujo_peaje" not in plan


def test_bitmaps_of_odd_ids(spark):
    ids = [0, 1, -1, 32767, 32768, 32769, -32768, 2**40, 2**40, None, 5, 5]
    frame = spark.createDataFrame([("a" if i % 2 else None, x) for i, x in enumerate(ids)], "k string, id bigint")
    bitmaps = id_bitmaps(frame, ["k"], "id")
    got = {r.k: r.n for r in bitmap_distinct(bitmaps, ["k"], "n").collect()}
    assert got == {k: len({x for i, x in enumerate(ids) if (i % 2 == 1) == (k == "a") and x is not None}) for k in ("a", None)}
    assert merged_bitmaps(bitmaps.unionByName(bitmaps), ["k"]).count() == bitmaps.count()


def passes(monkeypatch):
    calls = []
    for name in ("_proposed", "_cells"):
        monkeypatch.setattr(quantiles, name, lambda *a, f=getattr(quantiles, name), n=name: calls.append(n) or f(*a))
    return calls


def test_one_sketch_and_one_count_of_many_distinct_values(spark, monkeypatch):
    calls = passes(monkeypatch)
    n = 3_000_000
    frame = spark.range(n).selectExpr(f"(id * 7919 % {n}) * 1e-7 as x")
    got = exact_quantiles(frame, "x", {"a": 0.33, "b": 0.5, "c": 0.66}).first()
    assert list(got) == [(n * p // 100 - 1) * 1e-7 for p in (33, 50, 66)]
    assert calls == ["_proposed", "_cells"]


@pytest.mark.parametrize("margin", [0.0, -0.3, 0.4])
@pytest.mark.parametrize("kind", ["double", "bigint", "int", "float", "decimal(20,4)"])
def test_exact_whatever_the_sketch_says(spark, monkeypatch, margin, kind):
    monkeypatch.setattr(quantiles, "MARGIN", margin)
    monkeypatch.setattr(quantiles, "COUNTED_VALUES", 5)
    rng = random.Random(3)
    values = [rng.choice([7, rng.randint(-10**6, 10**6)]) for _ in range(400)]
    frame = spark.createDataFrame([(v,) for v in values], "x bigint").select(F.col("x").cast(kind))
    got = exact_quantiles(frame, "x", {"a": 0.1, "b": 0.5, "c": 0.9, "d": 0.0, "e": 1.0})
    assert got.schema["a"].dataType == frame.schema["x"].dataType
    ordered = sorted(values)
    assert [int(v) for v in got.first()] == [ordered[i] for i in (39, 199, 359, 0, 399)]
