"""Model queries: staging, fact, mart, incremental staging and report."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridelake.operators import dedup, marts, staging
from ridelake.plans import sqlbits as sb
from ridelake.plans import tables as tb
from ridelake.session import scratch_path
from ridelake.sources import named

#: The raw tables that the staging models are built on.
RAW_TRIPS = named.RawSource("trips", "raw_trips", ("yellow_tripdata", "green_tripdata"))

# Run window of the incremental models.  It spans every trip in the test
# tables, so the registered queries process the whole input; narrower
# windows are exercised by ``load_time_interval`` and the unit tests.
RUN_START = "1995-01-01 00:00:00"
RUN_END = "2002-01-01 00:00:00"


def _stg_pair(spark: SparkSession, sf: str):
    t = tb.trips(spark, sf)
    return staging.stg_green(tb.green_raw(t)), staging.stg_yellow(tb.yellow_raw(t))


def zones(spark: SparkSession, sf: str) -> DataFrame:
    return marts.dim_zones(tb.zone_lookup(spark, sf))


def fct(spark: SparkSession, sf: str) -> DataFrame:
    green, yellow = _stg_pair(spark, sf)
    return marts.fct_trips(green, yellow, zones(spark, sf))


def mart(spark: SparkSession, sf: str) -> DataFrame:
    return marts.monthly_zone_revenue(fct(spark, sf))


def q_stg_yellow(spark, sf):
    return staging.stg_yellow(tb.yellow_raw(tb.trips(spark, sf)))


def q_stg_green(spark, sf):
    return staging.stg_green(tb.green_raw(tb.trips(spark, sf)))


def q_stg_fhv(spark, sf):
    return staging.stg_fhv(tb.fhv_raw(spark, sf))


def q_dim_zones(spark, sf):
    return zones(spark, sf)


def q_union_trips(spark, sf):
    green, yellow = _stg_pair(spark, sf)
    return marts.union_trips(green, yellow)


def q_named_raw_sources(spark, sf):
    """The union of both staging models, over raw tables found by name."""
    t = tb.trips(spark, sf)
    raw = {"yellow_tripdata": tb.yellow_raw(t), "green_tripdata": tb.green_raw(t)}
    places = {name: scratch_path(spark, name) for name in raw}
    for name, rows in raw.items():
        rows.write.parquet(places[name])
    named.attach(spark, RAW_TRIPS, places)
    return marts.union_trips(staging.stg_green(named.lookup(spark, RAW_TRIPS, "green_tripdata")),
                             staging.stg_yellow(named.lookup(spark, RAW_TRIPS, "yellow_tripdata")))


def q_dedup_first(spark, sf):
    green, yellow = _stg_pair(spark, sf)
    return marts.dedup_trips(marts.union_trips(green, yellow))


def q_fct_trips(spark, sf):
    return fct(spark, sf)


def q_monthly_zone_revenue(spark, sf):
    return mart(spark, sf)


def q_mart_row_count(spark, sf):
    return mart(spark, sf).agg(F.count(F.lit(1)).alias("mart_rows"))


def q_best_zone_by_revenue(spark, sf, year: int = 1997, service: str = "Green"):
    m = mart(spark, sf).filter(
        (F.year("revenue_month") == year) & (F.col("service_type") == service))
    return (m.groupBy("pickup_zone")
            .agg(F.sum("revenue_monthly_total_amount").cast("decimal(38,3)").alias("revenue"))
            .orderBy(F.col("revenue").desc(), F.col("pickup_zone").asc())
            .limit(1))


def q_green_trips_in_month(spark, sf, month_start: str = "1997-10-01 00:00:00",
                           month_end: str = "1997-11-01 00:00:00"):
    from ridelake.functions.time import in_window
    return (fct(spark, sf)
            .filter((F.col("service_type") == "Green")
                    & in_window("pickup_datetime", month_start, month_end))
            .agg(F.count(F.lit(1)).alias("trips")))


def q_trips_per_year(spark, sf):
    return (fct(spark, sf)
            .groupBy("service_type", F.year("pickup_datetime").alias("pickup_year"))
            .agg(F.count(F.lit(1)).alias("trips")))


def q_dedup_latest(spark, sf):
    return dedup.keep_first(tb.raw_two_extractions(spark, sf), marts.STAGING_DEDUP_KEYS,
                            [("extracted_at", "desc")])


def q_dedup_by_columns(spark, sf):
    """Latest shipment per natural line-item key; the key is columns, not a hash."""
    li = tb.table(spark, sf, "lineitem")
    return dedup.keep_latest(li, ["l_orderkey", "l_linenumber"], "l_shipdate")


def staging_of(spark, sf, raw=None) -> DataFrame:
    raw = raw if raw is not None else tb.raw_two_extractions(spark, sf)
    return marts.staging_trips(raw, tb.payment_lookup(spark), RUN_START, RUN_END)


def q_staging_trips(spark, sf):
    return staging_of(spark, sf)


def q_trips_report(spark, sf):
    return marts.trips_report(staging_of(spark, sf), RUN_START, RUN_END)


def q_report_top10(spark, sf):
    rep = marts.trips_report(staging_of(spark, sf), RUN_START, RUN_END)
    return (rep.orderBy(F.col("trip_count").desc(), F.col("pickup_date").asc(),
                        F.col("taxi_type").asc(), F.col("payment_type_name").asc_nulls_first())
            .limit(10))


QUERIES = {
    "stg_yellow": q_stg_yellow,
    "stg_green": q_stg_green,
    "stg_fhv": q_stg_fhv,
    "dim_zones": q_dim_zones,
    "union_trips": q_union_trips,
    "named_raw_sources": q_named_raw_sources,
    "dedup_first": q_dedup_first,
    "fct_trips": q_fct_trips,
    "monthly_zone_revenue": q_monthly_zone_revenue,
    "mart_row_count": q_mart_row_count,
    "best_zone_by_revenue": q_best_zone_by_revenue,
    "green_trips_in_month": q_green_trips_in_month,
    "trips_per_year": q_trips_per_year,
    "dedup_latest": q_dedup_latest,
    "dedup_by_columns": q_dedup_by_columns,
    "staging_trips": q_staging_trips,
    "trips_report": q_trips_report,
    "report_top10": q_report_top10,
}

_R_STAGE = f"STG AS ({sb.sql_staging('R', RUN_START, RUN_END)})"


def _with_r(body: str, *extra: str) -> str:
    base = tb.with_ctes("", "R", "P").rstrip()
    more = "".join(f",\n{e}" for e in extra)
    return f"{base}{more}\n{body}"


_LI_ORDER = sb.order_all(
    ["l_shipdate DESC"],
    ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
     "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"],
    ["l_orderkey", "l_linenumber"])

ORACLE = {
    "stg_yellow": tb.with_ctes(sb.SQL_STG_YELLOW, "T"),
    "stg_green": tb.with_ctes(sb.SQL_STG_GREEN, "T"),
    "stg_fhv": tb.with_ctes(sb.SQL_STG_FHV, "H"),
    "dim_zones": tb.with_ctes("SELECT * FROM Z", "Z"),
    "union_trips": sb.with_fct("SELECT * FROM U"),
    "named_raw_sources": sb.with_fct("SELECT * FROM U"),
    "dedup_first": sb.with_fct("SELECT * FROM D"),
    "fct_trips": sb.with_fct("SELECT * FROM FCT"),
    "monthly_zone_revenue": sb.with_fct(sb.SQL_MART),
    "mart_row_count": sb.with_fct(f"SELECT COUNT(*) AS mart_rows FROM ({sb.SQL_MART})"),
    "best_zone_by_revenue": sb.with_fct(f"""
        SELECT pickup_zone, CAST(SUM(revenue_monthly_total_amount) AS DECIMAL(38,3)) AS revenue
        FROM ({sb.SQL_MART}) m
        WHERE year(revenue_month) = 1997 AND service_type = 'Green'
        GROUP BY pickup_zone ORDER BY revenue DESC, pickup_zone ASC LIMIT 1"""),
    "green_trips_in_month": sb.with_fct("""
        SELECT COUNT(*) AS trips FROM FCT WHERE service_type = 'Green'
          AND pickup_datetime >= TIMESTAMP '1997-10-01' AND pickup_datetime < TIMESTAMP '1997-11-01'"""),
    "trips_per_year": sb.with_fct("""
        SELECT service_type, CAST(year(pickup_datetime) AS INTEGER) AS pickup_year,
               COUNT(*) AS trips FROM FCT GROUP BY 1, 2"""),
    "dedup_latest": _with_r(f"""
        SELECT * EXCLUDE (rn) FROM (
          SELECT *, ROW_NUMBER() OVER (PARTITION BY {', '.join(marts.STAGING_DEDUP_KEYS)}
            ORDER BY {sb.order_all(['extracted_at DESC'], staging.CANONICAL_COLUMNS,
                                   marts.STAGING_DEDUP_KEYS)}) AS rn
          FROM R) WHERE rn = 1"""),
    "dedup_by_columns": f"""
        SELECT * EXCLUDE (rn) FROM (
          SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber
                                       ORDER BY {_LI_ORDER}) AS rn
          FROM lineitem) WHERE rn = 1""",
    "staging_trips": _with_r("SELECT * FROM STG", _R_STAGE),
    "trips_report": _with_r(sb.sql_report("STG", RUN_START, RUN_END), _R_STAGE),
    "report_top10": _with_r(f"""
        SELECT * FROM ({sb.sql_report('STG', RUN_START, RUN_END)}) r
        ORDER BY trip_count DESC, pickup_date ASC, taxi_type ASC,
                 payment_type_name ASC NULLS FIRST LIMIT 10""", _R_STAGE),
}
