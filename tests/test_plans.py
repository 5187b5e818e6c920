"""The physical plans behind the reports: what is read, pushed, shuffled and joined."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from tollstats.operators import joins
from tollstats.plans import ingest, reports
from tollstats.schema import Tables
from tollstats.sources.lineitems import raw_records, traffic_tables
from tollstats.sources.parquet_store import ParquetStore
from tollstats.sources.tables import stored_tables


def physical(frame) -> str:
    return frame._jdf.queryExecution().toString()


def executed(frame) -> str:
    frame.collect()
    return frame._jdf.queryExecution().executedPlan().toString().split("\n+- == Initial Plan ==")[0]


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("store"))
    tables = traffic_tables(spark, "/root/testdata/sf0.001")
    ingest.load(ParquetStore(spark, root), raw_records(tables))
    return stored_tables(spark, root)



@pytest.mark.parametrize("name", ["q3", "q7", "q10", "q12", "oversample", "label_terciles", "surrogate_ids"])
def test_no_cross_or_nested_loop_join(spark, small, name):
    plan = physical(contract.queries()[name](spark, small))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    assert "PythonUDF" not in plan and "ArrowEvalPython" not in plan


def test_year_reaches_the_scan(spark, small):
    plan = physical(contract.queries()["q3"](spark, small))
    assert "GreaterThanOrEqual(l_shipdate,1998-01-01T00:00)" in plan
    assert re.search(r"ReadSchema: struct<l_suppkey:bigint,l_quantity:double,l_shipdate:\w+>", plan)


def test_stored_year_prunes_partitions_through_the_join(store):
    plan = physical(reports.busiest_stations(store, 1998))
    assert "PartitionFilters: [isnotnull(anio" in plan
    assert "ReadSchema: struct<id_peaje:bigint,veh_total:bigint>" in plan


def test_stored_dimension_is_broadcast_by_its_file_size(store):
    plan = physical(reports.monthly_traffic(store))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_large_dimension_is_shuffled_instead(spark, store, monkeypatch):
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 0)
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "SortMergeJoin" in physical(reports.monthly_traffic(store))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)


def test_fact_is_summed_before_it_meets_the_dimension(store):
    plan = physical(reports.light_share(store)).split("Physical Plan")[-1]
    join, partial = plan.index("Join"), plan.rindex("partial_sum")
    assert partial > join  # the inner aggregation lies below the join
    assert plan.count("partial_sum(veh_total") == 1


def test_top_k_needs_no_global_sort(store):
    plan = physical(reports.busiest_stations(store, 1998, n=20))
    assert "TakeOrderedAndProject" in plan
    assert "rangepartitioning" not in plan


@pytest.mark.parametrize("name", ["quantile_terciles", "label_terciles", "metrics_table", "string_index"])
def test_line_items_are_read_before_and_not_again(spark, small, name):
    """Values, counts or features are kept once, and the result starts from there."""
    assert "lineitem.parquet" not in executed(contract.queries()[name](spark, small))


def test_new_stations_are_read_once(spark, small, tmp_path):
    raw_records(traffic_tables(spark, small)).write.parquet(str(tmp_path / "raw"))
    raw = spark.read.parquet(str(tmp_path / "raw"))
    store = ParquetStore(spark, str(tmp_path / "empty"))
    new = ingest.number_stations(ingest.dim_new(ingest.dim_extract(raw), store.peaje()), store.peaje())
    assert executed(new).count("FileScan parquet") == 1


def test_bound_dimension_is_measured_and_broadcast(spark, small):
    for name in ("join_using", "fact_lookup"):
        plan = executed(contract.queries()[name](spark, small))
        assert "BroadcastHashJoin" in plan and plan.count("SortMergeJoin") == 0


def test_busy_station_is_split(spark, monkeypatch):
    """A third of the fact belongs to one station and the dimension is too large to broadcast."""
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 0)
    stations = spark.range(2000).selectExpr(
        "id as id_peaje", "concat('P', id) as nombre_peaje", "'D' as departamento", "'A' as administracion"
    )
    facts = spark.range(0, 600_000, 1, 8).select(
        F.col("id").alias("id_flujo"),
        F.expr("if(id % 3 = 0, 5, id % 2000)").alias("id_peaje"),
        F.lit(2020).alias("anio"),
        F.lit(1).alias("mes"),
        (F.col("id") % 97).alias("veh_total"),
        F.sha2(F.col("id").cast("string"), 256).alias("note"),
    )
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.shuffle.partitions": "16",
    }
    kept = {k: spark.conf.get(k, None) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        joined = reports.joined_records(Tables(stations, facts))
        joined.write.format("noop").mode("overwrite").save()
        rows = joined.groupBy("id_peaje").count().where("id_peaje = 5").first()["count"]
        assert rows == facts.where("id_peaje = 5").count()
        frame = joined.select("id_flujo", "nombre_peaje", "note")
        assert "skew=true" in executed(frame)
    finally:
        for key, value in kept.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
