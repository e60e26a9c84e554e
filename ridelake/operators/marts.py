"""Fact tables, marts and reports composed from the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridelake.functions.sqltext import ident, sql, window_sql
from ridelake.functions.time import in_window
from ridelake.operators.dedup import keep_first, keep_latest
from ridelake.operators.joins import join_dim, with_zone

# Columns of the fact table.
FACT_COLUMNS = [
    "vendor_id", "rate_code_id", "pickup_location_id", "dropoff_location_id",
    "pickup_datetime", "dropoff_datetime", "store_and_fwd_flag", "passenger_count",
    "trip_distance", "trip_type", "fare_amount", "extra", "mta_tax", "tip_amount",
    "tolls_amount", "ehail_fee", "improvement_surcharge", "total_amount",
    "payment_type", "service_type",
]
# First-wins key of the fact table.
FACT_DEDUP_KEYS = ["vendor_id", "pickup_datetime", "pickup_location_id", "service_type"]
# Latest-wins key of the staging table.
STAGING_DEDUP_KEYS = [
    "taxi_type", "pickup_datetime", "dropoff_datetime", "pickup_location_id",
    "dropoff_location_id", "fare_amount", "total_amount", "payment_type",
]
# Columns of the staging table.
STAGING_COLUMNS = [
    "taxi_type", "pickup_datetime", "dropoff_datetime", "pickup_location_id",
    "dropoff_location_id", "passenger_count", "trip_distance", "payment_type",
    "payment_type_name", "fare_amount", "total_amount", "tip_amount",
]
# Summed column and its name in the mart.
MART_SUMS = [
    ("fare_amount", "revenue_monthly_fare_amount"),
    ("extra", "revenue_monthly_extra"),
    ("mta_tax", "revenue_monthly_mta_tax"),
    ("tip_amount", "revenue_monthly_tip_amount"),
    ("tolls_amount", "revenue_monthly_tolls_amount"),
    ("ehail_fee", "revenue_monthly_ehail_fee"),
    ("improvement_surcharge", "revenue_monthly_improvement_surcharge"),
    ("total_amount", "revenue_monthly_total_amount"),
]


def dim_zones(zone_lookup: DataFrame) -> DataFrame:
    """Zone lookup with model column names."""
    return sql(zone_lookup, "SELECT CAST(LocationID AS INT) AS location_id, Borough AS borough, "
                            "Zone AS zone, service_zone FROM {z}", z=zone_lookup)


def union_trips(stg_green: DataFrame, stg_yellow: DataFrame) -> DataFrame:
    """Align green and yellow staging on one column list and stack them."""
    yellow_cols = {"trip_type": "CAST(1 AS INT) AS trip_type",
                   "ehail_fee": "CAST(0 AS DECIMAL(18,3)) AS ehail_fee"}
    green = ", ".join(ident(c) for c in FACT_COLUMNS[:-1])
    yellow = ", ".join(yellow_cols.get(c, ident(c)) for c in FACT_COLUMNS[:-1])
    return sql(stg_green, f"SELECT {green}, 'Green' AS service_type FROM {{g}} "
                          f"UNION ALL SELECT {yellow}, 'Yellow' AS service_type FROM {{y}}",
               g=stg_green, y=stg_yellow)


def dedup_trips(unioned: DataFrame) -> DataFrame:
    """First trip per (vendor, pickup time, pickup zone, service) by dropoff."""
    return keep_first(unioned, FACT_DEDUP_KEYS, ["dropoff_datetime"])


def fct_trips(stg_green: DataFrame, stg_yellow: DataFrame, zones: DataFrame) -> DataFrame:
    """One row a trip with the names of both its zones; trips of unknown zones
    stay.  The zone key must be unique (``check_unique``)."""
    trips = dedup_trips(union_trips(stg_green, stg_yellow))
    for role in ("pickup", "dropoff"):
        trips = with_zone(trips, zones, f"{role}_location_id", role)
    return trips


def monthly_zone_revenue(fct: DataFrame) -> DataFrame:
    sums = ", ".join(f"CAST(SUM(CAST({ident(s)} AS DECIMAL(18,3))) AS DECIMAL(38,3)) AS {ident(d)}"
                     for s, d in MART_SUMS)
    return sql(fct, f"""
        SELECT COALESCE(pickup_zone, 'Unknown Zone') AS pickup_zone,
               CAST(date_trunc('month', pickup_datetime) AS TIMESTAMP_NTZ) AS revenue_month,
               service_type, {sums},
               COUNT(1) AS total_monthly_trips,
               ROUND(AVG(CAST(passenger_count AS DOUBLE)), 6) AS avg_monthly_passenger_count,
               ROUND(AVG(CAST(trip_distance AS DOUBLE)), 6) AS avg_monthly_trip_distance
        FROM {{f}}
        GROUP BY 1, 2, 3""", f=fct)


def staging_trips(raw: DataFrame, payments: DataFrame, start, end) -> DataFrame:
    """The newest copy of each trip of the window, with the name of its payment
    type; left out where that copy ends before it starts, charges less than
    nothing, or lacks a value that tells."""
    newest = keep_latest(raw.where(in_window("pickup_datetime", start, end)),
                         STAGING_DEDUP_KEYS, "extracted_at")
    names = payments.withColumnRenamed("payment_type_id", "_type")
    valid = newest.where("dropoff_datetime >= pickup_datetime AND fare_amount >= 0 "
                         "AND total_amount >= 0 AND tip_amount >= 0")
    named = join_dim(valid, names,
                     F.col("payment_type") == F.col("_type"))
    return named.select(*STAGING_COLUMNS)


def trips_report(staging: DataFrame, start, end) -> DataFrame:
    return sql(staging, f"""
        SELECT taxi_type, payment_type_name, CAST(pickup_datetime AS DATE) AS pickup_date,
               COUNT(1) AS trip_count, ROUND(SUM(total_amount), 2) AS total_amount_sum
        FROM {{s}}
        WHERE {window_sql('pickup_datetime', start, end)}
        GROUP BY 1, 2, 3""", s=staging)
