import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ridelake.operators.staging import typed_sql
from ridelake.functions import (
    hours_between,
    in_window,
    month_start,
    on_day,
    parse_day,
    surrogate_key,
)


def test_integer_cast_rounds_half_to_even(spark):
    df = spark.createDataFrame([(1.5,), (2.5,), (-1.7,), (None,)], "x double")
    got = [r[0] for r in df.selectExpr(typed_sql("x", "int")).collect()]
    assert got == [2, 2, -2, None]


def test_money_keeps_cents(spark):
    df = spark.createDataFrame([(12.345,), (0.1,)], "x double")
    assert [r[0] for r in df.selectExpr(typed_sql("x", "money")).collect()] == [
        Decimal("12.345"), Decimal("0.100")]


def test_window_edges_half_open(spark):
    start, end = dt.datetime(2024, 3, 1), dt.datetime(2024, 3, 2)
    rows = [(start,), (end - dt.timedelta(microseconds=1),), (end,), (None,)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz")
    got = [r[0] for r in df.select(in_window("ts", start, end)).collect()]
    assert got == [True, True, False, None]


def test_between_upper_bound_is_midnight(spark):
    rows = [(dt.datetime(2024, 3, 15, 0, 0, 0),), (dt.datetime(2024, 3, 15, 0, 0, 1),)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz")
    lo, hi = F.lit("2024-03-01").cast("timestamp_ntz"), F.lit("2024-03-15").cast("timestamp_ntz")
    assert [r[0] for r in df.select(F.col("ts").between(lo, hi)).collect()] == [True, False]


def test_on_day_is_a_pushed_range(spark, sf_dir):
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet").filter(on_day("l_shipdate", "1997-02-01"))
    plan = li._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(l_shipdate" in plan and "LessThan(l_shipdate" in plan


def test_parse_day_requires_value():
    with pytest.raises(ValueError):
        parse_day(None)
    assert parse_day("2022-01-15") == dt.date(2022, 1, 15)


def test_month_start_is_zone_less(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 3, 17, 13, 5),)], "ts timestamp_ntz")
    out = df.select(month_start("ts").alias("m"))
    assert out.schema["m"].dataType.simpleString() == "timestamp_ntz"
    assert out.first()[0] == dt.datetime(2024, 3, 1)


def test_hours_between_whole_seconds(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1, 1, 30, 0, 900))],
                               "a timestamp_ntz, b timestamp_ntz")
    assert df.select(hours_between("a", "b")).first()[0] == pytest.approx(1.5)


def test_surrogate_key_null_and_empty_collide(spark):
    df = spark.createDataFrame([(None, "a"), ("", "a"), ("x", "a")], "p string, q string")
    keys = [r[0] for r in df.select(surrogate_key(df, ["p", "q"])).collect()]
    assert keys[0] == keys[1] != keys[2]


def test_distinct_doubles_have_distinct_keys(spark):
    values = [1.0001, 1.0002, 1e16, 1e16 + 2, 12345678.0, 0.07, 1e-7, 0.0, -0.5, 1 / 3, 1e-5 / 3, None,
              float("nan"), float("inf"), 123456789012345.6]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    keys = [r[0] for r in df.select(surrogate_key(df, ["x"])).collect()]
    assert len(set(keys)) == len(values)
    import hashlib

    assert keys[4] == hashlib.md5(b"12345678").hexdigest() and keys[5] == hashlib.md5(b"0.07").hexdigest()
