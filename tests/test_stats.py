from __future__ import annotations

import math
import random

import frames
import pytest
from frames import rows
from pyspark.sql import functions as F

from tollstats.operators.quantiles import exact_quantiles
from tollstats.operators.sampling import key_split, oversample
from tollstats.plans import features
from tollstats.sources.lineitems import traffic_tables

PROBABILITIES = {"p0": 0.0, "p01": 0.01, "p33": 0.33, "p50": 0.5, "p66": 0.66, "p99": 0.99, "p100": 1.0}


def brute(values, p):
    ordered = sorted(values)
    return ordered[max(1, math.ceil(p * len(ordered))) - 1]


@pytest.mark.parametrize("size", [1, 2, 3, 4, 5, 10, 11, 1000])
@pytest.mark.parametrize("kind", ["ints", "doubles", "dominant", "negative", "wide"])
def test_quantiles_equal_brute_force(spark, size, kind):
    rng = random.Random(size)
    draw = {
        "ints": lambda: rng.randint(0, 50),
        "doubles": lambda: rng.uniform(0, 1),
        "dominant": lambda: 7 if rng.random() < 0.4 else rng.randint(0, 10**6),
        "negative": lambda: rng.randint(-1000, 1000),
        "wide": lambda: rng.choice([-1, 1]) * 10 ** rng.uniform(-300, 300),
    }[kind]
    values = [float(draw()) for _ in range(size)]
    frame = spark.createDataFrame([(v,) for v in values], "x double").repartition(3)
    got = exact_quantiles(frame, "x", PROBABILITIES).first().asDict()
    assert got == {name: brute(values, p) for name, p in PROBABILITIES.items()}


def test_quantiles_equal_exact_approx_quantile(spark, small):
    base = features.ml_base(traffic_tables(spark, small))
    expected = base.approxQuantile("veh_total", [0.33, 0.5, 0.66], 0.0)
    got = exact_quantiles(base, "veh_total", {"a": 0.33, "b": 0.5, "c": 0.66}).first()
    assert list(got) == expected


def test_quantiles_skip_missing_values_and_keep_the_type(spark):
    frame = spark.createDataFrame([(1.0,), (None,), (float("nan"),), (3.0,)], "x double")
    assert rows(exact_quantiles(frame, "x", {"m": 0.5})) == [(1.0,)]
    ints = exact_quantiles(spark.range(2**40, 2**40 + 5), "id", {"m": 0.5})
    assert rows(ints) == [(2**40 + 2,)]


def test_quantiles_of_nothing(spark):
    empty = spark.createDataFrame([], "x double")
    assert rows(exact_quantiles(empty, "x", {"m": 0.5})) == [(None,)]
    assert features.label_median(empty, "x").count() == 0
    missing = spark.createDataFrame([(None,)], "x double")
    assert rows(features.label_median(missing, "x").select("label")) == [(None,)]
    assert rows(features.label_terciles(missing, "x").select("label")) == [(None,)]


def test_equal_values_leave_a_class_empty(spark):
    frame = spark.createDataFrame([(5.0,)] * 6, "x double")
    assert {r.label for r in features.label_terciles(frame, "x").collect()} == {2.0}
    assert {r.label for r in features.label_median(frame, "x").collect()} == {1.0}


def labelled(spark, zeros, ones, others=0):
    rows_ = [(0.0, i) for i in range(zeros)] + [(1.0, i) for i in range(ones)] + [(2.0, i) for i in range(others)]
    return spark.createDataFrame(rows_, "label double, i int")


@pytest.mark.parametrize(
    ("zeros", "ones", "expected"),
    [(10, 3, {0.0: 10, 1.0: 9}), (3, 10, {0.0: 3, 1.0: 10}), (4, 0, {0.0: 4}), (0, 4, {1.0: 4}), (9, 3, {0.0: 9, 1.0: 9})],
)
def test_oversample_ratio(spark, zeros, ones, expected):
    grown = oversample(labelled(spark, zeros, ones, 2), "label", minority=1.0, majority=0.0)
    assert grown.columns == ["label", "i"]
    assert {r.label: r["count"] for r in features.label_distribution(grown).collect()} == expected


def test_oversample_copies_are_whole(spark):
    grown = oversample(labelled(spark, 6, 2), "label", 1.0, 0.0, copy_column="copy")
    assert sorted(rows(grown.where("label = 1").select("i", "copy"))) == [
        (i, c) for i in range(2) for c in range(1, 4)
    ]


@pytest.mark.parametrize("partitions", [1, 4, 8])
def test_split_does_not_depend_on_the_partitioning(spark, medium, partitions):
    facts = traffic_tables(spark, medium).flujo_peaje.repartition(partitions)
    train, test = key_split(facts, ["id_flujo"])
    assert (train.count(), test.count()) == (6589, 1672)


def test_split_weights(spark):
    frame = spark.range(3000).withColumnRenamed("id", "k")
    parts = key_split(frame, ["k"], weights=(50, 30, 20), seed=7)
    sizes = [p.count() for p in parts]
    assert sum(sizes) == 3000
    assert all(abs(s - w) < 120 for s, w in zip(sizes, (1500, 900, 600), strict=True))
    assert parts[0].intersect(parts[1]).count() == 0
    with pytest.raises(ValueError):
        key_split(frame, ["k"], weights=(50, 30))


def test_known_class_sizes(spark, medium):
    base = features.ml_base(traffic_tables(spark, medium))
    sizes = lambda frame: {r.label: r["count"] for r in features.label_distribution(frame).collect()}
    assert sizes(features.label_median(base)) == {0.0: 4122, 1.0: 4139}
    assert sizes(features.label_median(base, probability=0.9)) == {0.0: 7419, 1.0: 842}
    assert sizes(features.label_terciles(base)) == {0.0: 2716, 1.0: 2728, 2.0: 2817}


def test_base_fills_numbers_only(spark):
    t = frames.tables(
        spark,
        [(1, "Norte", None, "Estado")],
        [{"id_flujo": 1, "id_peaje": 1, "anio": None, "veh_total": None, "veh_ligeros_imd": float("nan")}],
    )
    row = features.ml_base(t).first()
    assert (row.anio, row.veh_total, row.veh_ligeros_imd, row.departamento) == (0.0, 0.0, 0.0, None)


@pytest.mark.parametrize("partitions", ["1", "4"])
def test_results_do_not_depend_on_shuffle_partitions(spark, small, partitions):
    import __spark_entry__ as contract

    names = ["q4", "q7", "q12", "surrogate_ids", "dedup_key", "label_terciles"]
    before = {n: sorted(rows(contract.queries()[n](spark, small)), key=str) for n in names}
    kept = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        after = {n: sorted(rows(contract.queries()[n](spark, small)), key=str) for n in names}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", kept)
    assert before == after


def test_fill_touches_only_numeric_columns(spark):
    frame = spark.createDataFrame([(None, None, None)], "a int, b double, c string")
    assert rows(frame.na.fill(0)) == [(0, 0.0, None)]
    assert rows(frame.na.fill(0).select(F.col("c"))) == [(None,)]


def test_quantiles_of_distinct_values_in_a_narrow_range(spark):
    """A million distinct doubles within 0.05, far more than fit one coarse bucket."""
    frame = spark.range(1_000_000).selectExpr("100 + (id * 7919 % 1000000) * 5e-8 as x")
    got = exact_quantiles(frame, "x", {"a": 0.25, "b": 0.5}).first()
    values = sorted(100 + i * 5e-8 for i in range(1_000_000))
    assert (got.a, got.b) == (values[249_999], values[499_999])
    ends = spark.createDataFrame([(float("inf"),), (-float("inf"),), (1e308,), (-1e308,), (0.0,)], "x double")
    assert exact_quantiles(ends, "x", {"a": 0.2, "b": 0.4, "c": 0.6, "d": 1.0}).first() == (
        -float("inf"), -1e308, 0.0, float("inf"),
    )
    longs = spark.range(2**62, 2**62 + 1000)
    assert exact_quantiles(longs, "id", {"a": 0.5}).first().a == 2**62 + 499


def test_metrics_read_the_line_items_once(spark, small):
    from tollstats.registry.queries import QUERIES

    plan = QUERIES["metrics_table"](spark, small)._jdf.queryExecution().toString()
    assert "lineitem" not in plan  # all that follows starts from the kept counts
