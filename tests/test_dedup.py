import datetime as dt

from pyspark.sql import functions as F

from ridelake.operators.dedup import keep_first, keep_latest
from ridelake.operators.marts import staging_trips
from ridelake.plans.tables import payment_lookup

D = dt.datetime(2024, 1, 1, 8, 0)


def _rows(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_ties_have_one_survivor_whatever_the_order(spark):
    schema = "k int, ts timestamp_ntz, passengers int"
    rows = [(1, D, p) for p in (3, 1, 2)]
    results = set()
    for perm in (rows, rows[::-1], rows[1:] + rows[:1]):
        for parts in (1, 3):
            df = _rows(spark, perm, schema).repartition(parts)
            results.add(tuple(keep_latest(df, ["k"], "ts").collect()[0]))
    assert results == {(1, D, 1)}


def test_distinct_on_prefers_non_null_order_value(spark):
    df = _rows(spark, [(1, None), (1, D)], "k int, dropoff timestamp_ntz")
    assert keep_first(df, ["k"], ["dropoff"]).collect()[0]["dropoff"] == D


def test_null_keys_group_together(spark):
    df = _rows(spark, [(None, 1), (None, 2)], "vendor int, x int")
    out = keep_first(df, ["vendor"], ["x"]).collect()
    assert len(out) == 1 and out[0]["x"] == 1


def test_dedup_plan_limits_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    plan = keep_first(df, ["k"], ["v"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2


def _canonical_row(tip, extracted):
    return ("yellow", D, D + dt.timedelta(minutes=10), 1, 2, 1, 1.0, 1, "N", 1,
            10.0, 0.0, 0.0, tip, 0.0, 0.0, 12.0, 0.0, 0.0, 1, extracted)


def test_newest_copy_invalid_removes_the_trip(spark):
    from ridelake.operators.staging import CANONICAL_SCHEMA
    raw = spark.createDataFrame([_canonical_row(1.0, dt.datetime(2024, 2, 1)),
                                 _canonical_row(-1.0, dt.datetime(2024, 2, 2))],
                                CANONICAL_SCHEMA)
    out = staging_trips(raw, payment_lookup(spark), "2024-01-01", "2024-02-01")
    assert out.count() == 0
    older_wins = spark.createDataFrame([_canonical_row(-1.0, dt.datetime(2024, 2, 1)),
                                        _canonical_row(1.0, dt.datetime(2024, 2, 2))],
                                       CANONICAL_SCHEMA)
    got = staging_trips(older_wins, payment_lookup(spark), "2024-01-01", "2024-02-01").collect()
    assert len(got) == 1 and got[0]["tip_amount"] == 1.0
    assert got[0]["payment_type_name"] == "Credit card"
