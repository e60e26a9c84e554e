"""Results kept current, layouts that later reads use, plans as data."""

import datetime as dt
import os

from pyspark.sql import functions as F

from ridelake.operators import incremental as inc
from ridelake.operators import marts
from ridelake.plans import incremental as plans
from ridelake.plans import landing, models
from ridelake.plans import tables as tb
from ridelake.session import scratch_path
from ridelake.sources import files
from ridelake.sources.footers import schema_groups


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_refreshed_mart_equals_a_full_rebuild(spark, sf_dir):
    pay, zones = tb.payment_lookup(spark), models.zones(spark, sf_dir)
    old = marts.staging_trips(tb.canonical_rows(tb.trips(spark, sf_dir), tb.T0), pay, models.RUN_START, models.RUN_END)
    new = models.staging_of(spark, sf_dir)
    states, mart, fresh = (scratch_path(spark, n) for n in ("st", "mt", "fr"))
    inc.refresh_mart(old, zones, states, mart, models.RUN_START, models.RUN_END)
    before = _rows(spark.read.parquet(mart))
    for start, end in [("1995-01-01", "1996-02-11"), ("1996-02-11", "1998-07-04"), ("1998-07-04", "2002-01-01")]:
        window = new.where((F.col("pickup_datetime") >= start) & (F.col("pickup_datetime") < end))
        for _ in range(2):  # a repeated refresh changes nothing
            inc.refresh_mart(window, zones, states, mart, start, end)
    inc.refresh_mart(new, zones, scratch_path(spark, "fs"), fresh, models.RUN_START, models.RUN_END)
    after = _rows(spark.read.parquet(mart))
    assert after == _rows(spark.read.parquet(fresh)) and after != before


def test_refresh_rewrites_touched_months_only(spark, sf_dir):
    pay, zones = tb.payment_lookup(spark), models.zones(spark, sf_dir)
    stg = models.staging_of(spark, sf_dir)
    states, mart = scratch_path(spark, "st2"), scratch_path(spark, "mt2")
    inc.refresh_mart(stg, zones, states, mart, models.RUN_START, models.RUN_END)

    def written():
        return {r[0]: r[1] for r in spark.read.parquet(mart).groupBy("month").agg(
            F.max(F.col("_metadata.file_name"))).collect()}

    first = written()
    inc.refresh_mart(stg.where("1 = 0"), zones, states, mart, "1997-03-05", "1997-04-10")  # all trips retracted
    second = written()
    changed = {m for m in first if first[m] != second.get(m)}
    assert changed == {dt.date(1997, 3, 1), dt.date(1997, 4, 1)}
    gone = spark.read.parquet(states).where("day >= DATE'1997-03-05' AND day < DATE'1997-04-10'")
    assert gone.count() == 0 and spark.read.parquet(states).where("day = DATE'1997-03-04'").count() > 0


def test_sketches_merge_as_if_counted_at_once(spark):
    df = spark.range(200_000).select((F.col("id") % 7).alias("g"), (F.col("id") % 60_000).alias("v"))
    parts = inc.distinct_sketches(df.where("id % 2 = 0" if "id" in df.columns else "v % 2 = 0"), ["g"], "v").unionByName(
        inc.distinct_sketches(df, ["g"], "v"))
    whole = inc.distinct_estimates(parts.withColumn("all", F.lit(1)), ["all"], "n").first().n
    assert abs(whole - 60_000) <= 60_000 * inc.relative_bound()
    one = {r.g: r.n for r in inc.distinct_estimates(parts, ["g"], "n").collect()}
    again = {r.g: r.n for r in inc.distinct_estimates(inc.distinct_sketches(df, ["g"], "v"), ["g"], "n").collect()}
    assert one == again  # what is counted twice counts once


def test_bucketed_join_and_aggregation_do_not_shuffle(spark, sf_dir):
    df = plans.q_bucketed_day_layout(spark, sf_dir)
    plan = _plan(df)
    assert "Exchange" not in plan and "SortMergeJoin" in plan
    assert "PartitionFilters: [isnotnull(day" in plan and f"SelectedBucketsCount: {plans.BUCKETS} out of" in plan


def test_run_table_prunes_at_run_time(spark, sf_dir):
    df = plans.q_run_table_window(spark, sf_dir)
    assert "dynamicpruning" in _plan(df)
    lines, runs = plans.lines_of_run(spark, sf_dir)
    picked = lines.join(runs.where(F.col("run_id") == plans.RUN_ID), "month")
    assert picked.select(F.col("month")).distinct().count() == 3
    picked.write.format("noop").mode("overwrite").save()


def test_landing_files_of_one_month_differ(spark, sf_dir):
    root = landing.build(spark, sf_dir)
    groups = landing._by_schema(spark, root, "yellow", ["1996-03", "1997-03", "1998-03"])
    assert len(groups) == 3
    months = [{os.path.basename(os.path.dirname(p)) for p in paths} for _, paths in groups]
    assert sum("month=1996-03" in m for m in months) == 2  # with and without the fee column
    out = landing.ingest(spark, root, "1995-01-01", "2002-01-01", ["yellow", "green"], tb.T0)
    fee = out.where("taxi_type = 'yellow' AND airport_fee IS NULL").agg(
        F.count("*"), F.min("pickup_datetime"), F.max(F.day("pickup_datetime"))).first()
    assert fee[0] > 0 and fee[1].year == landing.NO_FEE_YEAR and fee[2] < landing.NO_FEE_BEFORE_DAY
    assert out.count() == tb.trips(spark, sf_dir).count()


def test_schema_groups_are_in_path_order(spark):
    root = scratch_path(spark, "groups")
    spark.range(3).write.parquet(f"{root}/b")
    spark.range(3).selectExpr("id", "'x' AS s").write.parquet(f"{root}/a")
    spark.range(2).selectExpr("id", "'x' AS s").write.parquet(f"{root}/c")
    found = schema_groups(spark, [root])
    assert [s.names for s, _ in found] == [["id", "s"], ["id"]]
    assert {p.split("/")[-2] for p in found[0][1]} == {"a", "c"}


def test_month_plan_is_made_by_spark(spark):
    root = scratch_path(spark, "plan")
    for name in ("taxi_type=green/month=2022-12", "taxi_type=yellow/month=2023-01", "taxi_type=yellow/month=2023-04"):
        spark.range(1).write.parquet(f"{root}/{name}")
    pattern = root + "/taxi_type={type}/month={year}-{month}"
    plan = files.month_plan(spark, "2022-12-15", "2023-02-01", ["green", "yellow"], pattern)
    assert "LocalTableScan" not in _plan(plan)  # no row comes from the driver
    got = sorted((r.taxi_type, str(r.month), r.exists) for r in plan.collect())
    assert got == [("green", "2022-12-01", True), ("green", "2023-01-01", False),
                   ("yellow", "2022-12-01", False), ("yellow", "2023-01-01", True)]
    want = [p for _, _, p in files.month_paths("2022-12-15", "2023-02-01", ["green", "yellow"], pattern)]
    assert sorted(r.path for r in plan.collect()) == sorted(want)
    assert files.month_plan(spark, "2022-12-15", "2022-12-01", ["green"], pattern).count() == 0
    absent = files.month_plan(spark, "2022-12-15", "2023-02-01", ["green"], "/no/such/{type}/{year}-{month}")
    assert [r.exists for r in absent.collect()] == [False, False]
