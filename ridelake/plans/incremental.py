"""Registered queries that keep results current, and layouts that later reads use."""

from __future__ import annotations

import uuid

from pyspark import StorageLevel
from pyspark.sql import functions as F

from ridelake.operators import incremental as inc
from ridelake.operators import load, marts
from ridelake.plans import models
from ridelake.plans import sqlbits as sb
from ridelake.plans import tables as tb
from ridelake.session import scratch_path

SPLIT_MONTH = "1998-01-01"
REFRESH_START, REFRESH_END = "1998-03-05 00:00:00", "1998-04-10 00:00:00"
BUCKETS = 4
DAY_FROM, DAY_TO = "2024-01-08", "2024-01-15"
RUN_ID = "1997Q2"


def q_distinct_rollup(spark, sf):
    """Orders shipped a status and year: exact, and whether the estimate from
    monthly sketches is within its bound.  Sketches of later months are added
    by a second load; the roll-up reads sketches only."""
    li = tb.table(spark, sf, "lineitem").withColumn("month", F.trunc("l_shipdate", "month"))
    target = scratch_path(spark, "sketches")
    split = F.lit(SPLIT_MONTH).cast("date")
    for part in (li.where(F.col("month") < split), li.where(F.col("month") >= split)):
        load.append(inc.distinct_sketches(part, ["l_linestatus", "month"], "l_orderkey"), target, ["month"])
    sketches = spark.read.parquet(target).withColumn("year", F.year("month"))
    estimates = inc.distinct_estimates(sketches, ["l_linestatus", "year"], "estimate")
    exact = (li.withColumn("year", F.year("month")).groupBy("l_linestatus", "year")
             .agg(F.countDistinct("l_orderkey").alias("orders")))
    off = F.abs(F.col("estimate") - F.col("orders"))
    return (exact.join(estimates, ["l_linestatus", "year"], "left")
            .select("l_linestatus", "year", "orders",
                    (off <= F.col("orders") * inc.relative_bound()).alias("within_bound")))


def q_mart_refresh(spark, sf):
    """The mart of the first extraction, then one window refreshed from both
    extractions: changed tips, and trips whose newest copy is invalid."""
    t = tb.trips(spark, sf).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        pay, zones = tb.payment_lookup(spark), models.zones(spark, sf)
        states, mart = scratch_path(spark, "states"), scratch_path(spark, "mart")
        first = marts.staging_trips(tb.canonical_rows(t, tb.T0), pay, models.RUN_START, models.RUN_END)
        inc.refresh_mart(first, zones, states, mart, models.RUN_START, models.RUN_END)
        both = tb.raw_two_extractions(spark, sf, t)
        again = marts.staging_trips(both, pay, REFRESH_START, REFRESH_END)
        inc.refresh_mart(again, zones, states, mart, REFRESH_START, REFRESH_END)
    finally:
        t.unpersist()
    return spark.read.parquet(mart)


def bucketed_events(spark, sf):
    """Events by day, bucketed by user, and the users' totals in equal buckets."""
    ev = tb.table(spark, sf, "events")
    tag = uuid.uuid4().hex[:8]
    by_day = load.write_bucketed(ev.withColumn("day", F.to_date("ts")), f"events_by_day_{tag}",
                                 scratch_path(spark, "byday"), BUCKETS, ["user_id"], partition_by=["day"])
    totals = load.write_bucketed(ev.groupBy("user_id").agg(F.sum("value").alias("all_value")),
                                 f"user_totals_{tag}", scratch_path(spark, "totals"), BUCKETS, ["user_id"])
    return by_day, totals


def q_bucketed_day_layout(spark, sf):
    """Each user's share of value in a week: day folders are pruned, and join
    and aggregation run bucket by bucket without a shuffle."""
    by_day, totals = bucketed_events(spark, sf)
    week = by_day.where(F.col("day").between(F.lit(DAY_FROM).cast("date"), F.lit(DAY_TO).cast("date")))
    return (week.join(totals.hint("merge"), "user_id")
            .groupBy("user_id").agg(F.count(F.lit(1)).alias("n_events"),
                                    F.round(F.sum("value"), 4).alias("week_value"),
                                    F.round(F.max("all_value"), 4).alias("all_value")))


def lines_of_run(spark, sf):
    """(line items by ship month, the months of each run)."""
    li = tb.table(spark, sf, "lineitem").withColumn("month", F.trunc("l_shipdate", "month"))
    lines, runs = scratch_path(spark, "bymonth"), scratch_path(spark, "runs")
    load.append(li, lines, ["month"])
    quarter = F.concat(F.year("month"), F.lit("Q"), F.quarter("month"))
    li.select(quarter.alias("run_id"), "month").distinct().write.parquet(runs)
    return spark.read.parquet(lines), spark.read.parquet(runs)


def q_run_table_window(spark, sf):
    """Line items of the months that a run table names for one run: the months
    reach the scan when the run table has been read, not as literals."""
    lines, runs = lines_of_run(spark, sf)
    return (lines.join(runs.where(F.col("run_id") == RUN_ID), "month")
            .groupBy("run_id", "month", "l_returnflag")
            .agg(F.count(F.lit(1)).alias("lines"), F.round(F.sum("l_quantity"), 4).alias("quantity")))


QUERIES = {
    "distinct_rollup": q_distinct_rollup,
    "mart_refresh": q_mart_refresh,
    "bucketed_day_layout": q_bucketed_day_layout,
    "run_table_window": q_run_table_window,
}

_win = (f"pickup_datetime >= TIMESTAMP '{REFRESH_START}' "
        f"AND pickup_datetime < TIMESTAMP '{REFRESH_END}'")

ORACLE = {
    "distinct_rollup": """
        SELECT l_linestatus, CAST(year(l_shipdate) AS INT) AS year, COUNT(DISTINCT l_orderkey) AS orders,
               true AS within_bound
        FROM lineitem GROUP BY 1, 2""",
    "mart_refresh": tb.with_ctes("", "R", "P", "Z").rstrip()
        + f",\nR1 AS ({tb.sql_canonical('T', tb.T0)}),\n"
        + f"S1 AS ({sb.sql_staging('R1', models.RUN_START, models.RUN_END)}),\n"
        + f"S2 AS ({sb.sql_staging('R', REFRESH_START, REFRESH_END)}),\n"
        + f"S AS (SELECT * FROM S1 WHERE NOT ({_win}) UNION ALL SELECT * FROM S2)\n"
        + "SELECT COALESCE(z.zone, 'Unknown Zone') AS zone, taxi_type, "
        + ", ".join(f"SUM(CAST({c} AS DECIMAL(18,3))) AS {d}" for c, d in inc.STATE_SUMS)
        + ", COUNT(*) AS trips, "
        + ", ".join(f"ROUND(AVG(CAST({c} AS DOUBLE)), 6) AS {d}" for c, d in inc.STATE_MEANS)
        + ", CAST(date_trunc('month', pickup_datetime) AS DATE) AS month "
        + "FROM S LEFT JOIN Z z ON S.pickup_location_id = z.location_id "
        + "GROUP BY 1, 2, CAST(date_trunc('month', pickup_datetime) AS DATE)",
    "bucketed_day_layout": f"""
        SELECT e.user_id, COUNT(*) AS n_events, ROUND(SUM(value), 4) AS week_value,
               ROUND(MAX(all_value), 4) AS all_value
        FROM events e JOIN (SELECT user_id, SUM(value) AS all_value FROM events GROUP BY 1) t ON e.user_id = t.user_id
        WHERE CAST(ts AS DATE) BETWEEN DATE '{DAY_FROM}' AND DATE '{DAY_TO}' GROUP BY 1""",
    "run_table_window": f"""
        SELECT '{RUN_ID}' AS run_id, CAST(date_trunc('month', l_shipdate) AS DATE) AS month, l_returnflag,
               COUNT(*) AS lines, ROUND(SUM(l_quantity), 4) AS quantity
        FROM lineitem WHERE year(l_shipdate) || 'Q' || quarter(l_shipdate) = '{RUN_ID}' GROUP BY ALL""",
}
