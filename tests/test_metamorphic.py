"""Metamorphic and skew properties: different routes, same answer."""

import datetime as dt

from pyspark.sql import functions as F

from ridelake.operators import dedup, diagnostics, load, marts
from ridelake.plans import models
from ridelake.plans import tables as tb
from ridelake.session import scratch_path


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_window_split_in_two_equals_one_window(spark, sf_dir):
    raw = tb.raw_two_extractions(spark, sf_dir)
    pay = tb.payment_lookup(spark)
    whole = marts.staging_trips(raw, pay, "1996-01-01", "1998-01-01")
    first = marts.staging_trips(raw, pay, "1996-01-01", "1997-03-17 12:00:00")
    second = marts.staging_trips(raw, pay, "1997-03-17 12:00:00", "1998-01-01")
    assert _rows(whole) == _rows(first.unionByName(second))


def test_rerunning_a_window_load_changes_nothing(spark, sf_dir):
    stg = models.staging_of(spark, sf_dir).withColumn(
        "pickup_month", F.trunc("pickup_datetime", "month"))
    target = scratch_path(spark, "rerun")
    load.time_interval(stg, target, "pickup_datetime", models.RUN_START, models.RUN_END,
                       "pickup_month")
    before = _rows(spark.read.parquet(target))
    load.time_interval(stg, target, "pickup_datetime", "1997-01-01", "1997-07-01",
                       "pickup_month")
    assert _rows(spark.read.parquet(target)) == before


def _skewed(spark, n=30_000):
    # key 0 holds a third of all rows; the rest are spread over many keys
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
        (F.col("id") * 7 % 1000).alias("v"))


def test_dedup_is_exact_under_a_hot_key(spark):
    df = _skewed(spark).repartition(8)
    out = dedup.keep_latest(df, ["k"], "v")
    hot = out.filter("k = 0").collect()
    assert len(hot) == 1 and hot[0]["v"] == 999
    assert out.count() == df.select("k").distinct().count()


def test_duplicate_summary_under_a_hot_key(spark):
    s = diagnostics.duplicate_summary(_skewed(spark), ["k"]).first()
    assert s["total_rows"] == 30_000
    assert s["distinct_keys"] == 20_001
    assert s["duplicate_count"] == 30_000 - 20_001


def test_stream_dedup_drops_late_copies(spark):
    from ridelake.streaming import ingest as st

    schema = "event_id long, ts timestamp_ntz, v double"
    src, out, ckpt = (scratch_path(spark, n) for n in ("late-src", "late-out", "late-ckpt"))
    base = dt.datetime(2024, 1, 1)
    first = [(i, base + dt.timedelta(days=i), 1.0) for i in range(20)]
    spark.createDataFrame(first, schema).coalesce(1).write.mode("append").parquet(src)
    st.dedup_stream(spark, src, out, ckpt, spark.createDataFrame([], schema).schema,
                    ["event_id"], "ts", delay="2 days")
    again = [(0, base, 1.0), (19, base + dt.timedelta(days=19), 1.0),
             (20, base + dt.timedelta(days=20), 1.0)]
    spark.createDataFrame(again, schema).coalesce(1).write.mode("append").parquet(src)
    st.dedup_stream(spark, src, out, ckpt, spark.createDataFrame([], schema).schema,
                    ["event_id"], "ts", delay="2 days")
    ids = sorted(r[0] for r in spark.read.parquet(out).select("event_id").collect())
    assert ids == list(range(21))


def test_ingest_of_a_window_without_files_is_empty_but_typed(spark, sf_dir):
    from ridelake.operators.staging import CANONICAL_COLUMNS
    from ridelake.plans import landing
    root = landing.build(spark, sf_dir)
    out = landing.ingest(spark, root, "1980-01-01", "1980-03-01", ["yellow", "green"], tb.T0)
    assert out.count() == 0 and out.columns == CANONICAL_COLUMNS


def test_unknown_zone_is_grouped_in_the_mart(spark):
    from ridelake.operators.staging import GREEN_STAGING, YELLOW_STAGING
    d = dt.datetime(2024, 1, 5, 8)
    zones = spark.createDataFrame([(1, "B", "Known", "Boro Zone")],
                                  "location_id int, borough string, zone string, service_zone string")

    def staged(mapping, loc, vendor):
        cols = {dst: None for _, dst, _ in mapping}
        cols.update(vendor_id=vendor, pickup_location_id=loc, dropoff_location_id=1,
                    pickup_datetime=d, dropoff_datetime=d, passenger_count=1,
                    trip_distance=1, fare_amount=1, total_amount=1)
        types = {"int": "int", "money": "decimal(18,3)", "timestamp": "timestamp_ntz",
                 "string": "string"}
        schema = ", ".join(f"{dst} {types[k]}" for _, dst, k in mapping)
        from decimal import Decimal
        row = tuple(Decimal(cols[dst]) if k == "money" and cols[dst] is not None else cols[dst]
                    for _, dst, k in mapping)
        return spark.createDataFrame([row], schema)

    green = staged(GREEN_STAGING, 1, 1).unionByName(staged(GREEN_STAGING, 99, 2)) \
        .unionByName(staged(GREEN_STAGING, None, 3))
    yellow = staged(YELLOW_STAGING, 1, 1)
    mart = marts.monthly_zone_revenue(marts.fct_trips(green, yellow, zones))
    got = {(r["pickup_zone"], r["service_type"]): r["total_monthly_trips"] for r in mart.collect()}
    assert got == {("Known", "Green"): 1, ("Unknown Zone", "Green"): 2, ("Known", "Yellow"): 1}
