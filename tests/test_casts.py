from __future__ import annotations

import math

from pyspark.sql import functions as F

from tollstats.functions.casts import to_bigint, to_double, to_int, unreadable

TEXTS = {
    "12.0": 12, "12.7": 12, "-12.7": -12, " 7 ": 7, "1,234": None, "": None, None: None,
    "NaN": None, "3e9": 3000000000, "-3e9": -3000000000, "Infinity": None, "1e30": None,
    "9223372036854775807": 2**63 - 1, "9223372036854775808": None, "9007199254740993.0": 9007199254740993,
}


def test_truncating_bigint_under_ansi(spark):
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    frame = spark.createDataFrame([(t,) for t in TEXTS], "t string")
    got = {r.t: r.v for r in frame.select("t", to_bigint(F.col("t")).alias("v")).collect()}
    assert got == TEXTS


def test_typed_columns_pass_through(spark):
    row = spark.range(3, 4).select(to_bigint(F.col("id")).alias("a"), to_double(F.col("id")).alias("b"))
    assert tuple(row.first()) == (3, 3.0)


def test_bigint_keeps_digits_beyond_double(spark):
    frame = spark.createDataFrame([("9007199254740993",), ("x",)], "t string")
    assert [r.v for r in frame.select(to_bigint(F.col("t")).alias("v")).collect()] == [9007199254740993, None]


def test_int_and_unreadable_text(spark):
    frame = spark.createDataFrame([("12.9",), ("3e9",), ("x",), ("  ",), (None,)], "t string")
    got = [tuple(r) for r in frame.select(to_int(F.col("t")), unreadable(F.col("t"), "int")).collect()]
    assert got == [(12, False), (None, True), (None, True), (None, False), (None, False)]


def test_double_keeps_nan(spark):
    frame = spark.createDataFrame([("NaN",), ("bad",), ("2.5",)], "t string")
    got = [r.v for r in frame.select(to_double(F.col("t")).alias("v")).collect()]
    assert math.isnan(got[0]) and got[1:] == [None, 2.5]
