"""Aggregates kept current without reading again what they already counted.

* ``distinct_sketches`` / ``distinct_estimates``: mergeable distinct counts.
* ``refresh_mart``: a monthly mart derived from daily partial states; a
  refreshed window is the only part of the trips that is read.
"""

from __future__ import annotations

import datetime as dt
import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridelake.functions.sqltext import ident, sql
from ridelake.operators import load
from ridelake.operators.joins import join_dim

#: log2 of the sketch's registers: 16 KiB at most, about 0.8 % standard error.
LG_REGISTERS = 14


def distinct_sketches(df: DataFrame, groups: list[str], column: str, lg_registers: int = LG_REGISTERS) -> DataFrame:
    """One sketch (``sketch``) a group; built before the shuffle, so a hot
    group moves one sketch a task."""
    return df.groupBy(*groups).agg(F.hll_sketch_agg(column, lg_registers).alias("sketch"))


def distinct_estimates(sketches: DataFrame, groups: list[str], name: str) -> DataFrame:
    """Estimated distinct counts of coarser groups, from sketches alone."""
    return sketches.groupBy(*groups).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias(name))


def relative_bound(lg_registers: int = LG_REGISTERS, deviations: float = 4.0) -> float:
    """Relative error that a merged sketch exceeds about once in 16,000
    (``deviations`` standard errors of 1.04 / sqrt(registers))."""
    return deviations * 1.04 / math.sqrt(1 << lg_registers)


# Summed columns of the mart and their names.
STATE_SUMS = [("fare_amount", "revenue_fare"), ("total_amount", "revenue_total"), ("tip_amount", "revenue_tip")]
# Averaged columns; a state keeps their sum and non-NULL count.
STATE_MEANS = [("passenger_count", "avg_passenger_count"), ("trip_distance", "avg_trip_distance")]


def day_states(staging: DataFrame, zones: DataFrame) -> DataFrame:
    """Partial states of staged trips by (day, zone, type): exact sums, counts
    and non-NULL counts, and the month that partitions them."""
    named = join_dim(staging, zones.select(F.col("location_id").alias("_zone_id"), "zone"),
                     F.col("pickup_location_id") == F.col("_zone_id"))
    sums = ", ".join(f"SUM(CAST({ident(c)} AS DECIMAL(18,3))) AS {ident(c)}" for c, _ in STATE_SUMS)
    means = ", ".join(f"SUM(CAST({ident(c)} AS DECIMAL(18,3))) AS {ident(c)}, COUNT({ident(c)}) AS {ident('n_' + c)}"
                      for c, _ in STATE_MEANS)
    return sql(named, f"""
        SELECT CAST(pickup_datetime AS DATE) AS day, COALESCE(zone, 'Unknown Zone') AS zone, taxi_type,
               {sums}, {means}, COUNT(1) AS trips, CAST(trunc(CAST(pickup_datetime AS DATE), 'month') AS DATE) AS month
        FROM {{t}} GROUP BY ALL""", t=named)


def months_of(states: DataFrame) -> DataFrame:
    """The mart: states merged by month, averages derived from the merged parts."""
    sums = ", ".join(f"CAST(SUM({ident(c)}) AS DECIMAL(38,3)) AS {ident(d)}" for c, d in STATE_SUMS)
    means = ", ".join(f"ROUND(CAST(SUM({ident(c)}) AS DOUBLE) / NULLIF(SUM({ident('n_' + c)}), 0), 6) AS {ident(d)}"
                      for c, d in STATE_MEANS)
    return sql(states, f"""
        SELECT zone, taxi_type, {sums}, SUM(trips) AS trips, {means}, month
        FROM {{s}} GROUP BY zone, taxi_type, month""", s=states)


def refresh_mart(staging: DataFrame, zones: DataFrame, state_target: str, mart_target: str,
                 start, end) -> None:
    """Bring the mart up to date for the days [start, end): ``staging`` holds
    the valid newest trips of that window and no others are read.

    States of the window's days are replaced, so a trip that became invalid or
    moved away leaves no trace; months the window touches are merged anew from
    the states of their days.  A repeated refresh gives the same tables.  The
    window starts and ends at midnight."""
    spark = staging.sparkSession
    load.time_interval(day_states(staging, zones), state_target, "day", start, end, "month", "date")
    months = load.window_months(start, end)
    states = spark.read.parquet(state_target)
    touched = states.where(load._in_partitions("month", months))
    load.replace_partitions(months_of(touched), mart_target, "month", months)
