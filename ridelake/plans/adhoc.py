"""Ad-hoc questions over the raw trip sources, and the diagnostics.

Each question reads the whole raw table and filters it; the filters are
the questions' own parameters.  Top-1 answers carry an explicit tie-break
so the result is deterministic.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ridelake.functions.keys import surrogate_key
from ridelake.functions.time import hours_between, in_window, on_day
from ridelake.operators import diagnostics as dg
from ridelake.operators.joins import maybe_broadcast
from ridelake.plans import tables as tb

# Fixed parameters of the questions.
YEAR_START, YEAR_END = "1997-01-01", "1998-01-01"
SHORT_TRIP_MAX = 5
LONG_TRIP_LIMIT = 45
BUSY_DAY = "1997-02-01"
TIP_PICKUP_ZONE = "NATION_1"
RANGE_LO, RANGE_HI = "1997-03-01", "1997-03-15"
LINE_KEY = ["l_orderkey", "l_linenumber"]
SURROGATE_COLS = ["l_orderkey", "l_linenumber", "l_suppkey", "l_shipdate", "unit_price"]
FHV_KEY = ["dispatching_base_num", "pickup_datetime", "dropOff_datetime",
           "PUlocationID", "DOlocationID"]


def _green(spark, sf):
    return tb.green_raw(tb.trips(spark, sf))


def _yellow(spark, sf):
    return tb.yellow_raw(tb.trips(spark, sf))


def q_short_trip_count(spark, sf):
    g = _green(spark, sf)
    return (g.filter(in_window("lpep_pickup_datetime", YEAR_START, YEAR_END)
                     & (F.col("trip_distance") <= SHORT_TRIP_MAX))
            .agg(F.count(F.lit(1)).alias("trips")))


def q_longest_trip_day(spark, sf):
    g = _green(spark, sf)
    return (g.filter(in_window("lpep_pickup_datetime", YEAR_START, YEAR_END)
                     & (F.col("trip_distance") < LONG_TRIP_LIMIT))
            .groupBy(F.to_date("lpep_pickup_datetime").alias("pickup_day"))
            .agg(F.max("trip_distance").alias("max_distance"))
            .orderBy(F.col("max_distance").desc(), F.col("pickup_day").asc())
            .limit(1))


def q_biggest_pickup_zone(spark, sf):
    g = _green(spark, sf).filter(on_day("lpep_pickup_datetime", BUSY_DAY))
    z = maybe_broadcast(tb.zone_lookup(spark, sf))
    return (g.join(z, g["PULocationID"] == z["LocationID"], "inner")
            .groupBy(F.col("Zone").alias("zone"))
            .agg(F.sum(F.col("total_amount").cast("decimal(18,3)"))
                 .cast("decimal(38,3)").alias("total"))
            .orderBy(F.col("total").desc(), F.col("zone").asc())
            .limit(1))


def q_largest_tip_zone(spark, sf):
    g = _green(spark, sf).filter(in_window("lpep_pickup_datetime", YEAR_START, YEAR_END))
    z = tb.zone_lookup(spark, sf)
    pu = maybe_broadcast(z.filter(F.col("Zone") == TIP_PICKUP_ZONE)
                         .select(F.col("LocationID").alias("pu_id")))
    do = maybe_broadcast(z.select(F.col("LocationID").alias("do_id"),
                                  F.col("Zone").alias("zone")))
    return (g.join(pu, g["PULocationID"] == pu["pu_id"], "inner")
            .join(do, g["DOLocationID"] == do["do_id"], "inner")
            .groupBy("zone").agg(F.max("tip_amount").alias("max_tip"))
            .orderBy(F.col("max_tip").desc(), F.col("zone").asc())
            .limit(1))


def q_trips_on_day(spark, sf):
    return (_yellow(spark, sf).filter(on_day("tpep_pickup_datetime", BUSY_DAY))
            .agg(F.count(F.lit(1)).alias("trips")))


def q_longest_trip_hours(spark, sf):
    y = _yellow(spark, sf)
    return y.agg(F.round(F.max(hours_between("tpep_pickup_datetime", "tpep_dropoff_datetime")),
                         6).alias("max_trip_hours"))


def q_least_frequent_zone(spark, sf):
    """Pre-aggregate by location id (partial aggregation absorbs hot ids),
    then look the ids up and re-aggregate by name: several ids may share a
    name, and unknown ids fall into one NULL group."""
    y = _yellow(spark, sf)
    per_id = y.groupBy("PULocationID").agg(F.count(F.lit(1)).alias("n"))
    z = maybe_broadcast(tb.zone_lookup(spark, sf))
    return (per_id.join(z, per_id["PULocationID"] == z["LocationID"], "left")
            .groupBy(F.col("Zone").alias("zone"))
            .agg(F.sum("n").cast("bigint").alias("trips"))
            .orderBy(F.col("trips").asc(), F.col("zone").asc_nulls_first())
            .limit(1))


def q_zero_fare_count(spark, sf):
    """Count of trips with a zero amount (tip: the adapted fare is never 0)."""
    return (_yellow(spark, sf).filter(F.col("tip_amount") == 0)
            .agg(F.count(F.lit(1)).alias("zero_amount_trips")))


def q_distinct_vendor_in_range(spark, sf):
    """Closed BETWEEN on a timestamp: the upper bound is midnight of its day."""
    y = _yellow(spark, sf)
    lo = F.lit(RANGE_LO).cast("timestamp_ntz")
    hi = F.lit(RANGE_HI).cast("timestamp_ntz")
    return (y.filter(F.col("tpep_dropoff_datetime").between(lo, hi))
            .select(F.col("VendorID").alias("vendor_id")).distinct())


def q_distinct_pickup_locations(spark, sf):
    return _yellow(spark, sf).agg(
        F.countDistinct("PULocationID").alias("distinct_pickup_locations"))


def q_surrogate_key(spark, sf):
    li = tb.table(spark, sf, "lineitem")
    li = li.withColumn("unit_price", F.col("l_extendedprice") / F.col("l_quantity"))
    return li.select(*LINE_KEY, surrogate_key(li, SURROGATE_COLS).alias("trip_id"))


def q_duplicate_summary(spark, sf):
    return dg.duplicate_summary(tb.table(spark, sf, "lineitem"), LINE_KEY)


def q_duplicate_rows(spark, sf):
    return dg.duplicate_rows(tb.table(spark, sf, "lineitem"), LINE_KEY)


def q_null_location_profile(spark, sf):
    h = tb.fhv_raw(spark, sf).filter(
        F.col("pickup_datetime").isNotNull() & F.col("dropOff_datetime").isNotNull())
    return dg.null_profile(h, "PUlocationID", "DOlocationID").select(
        "total", F.col("null_a").alias("null_pu"), F.col("null_b").alias("null_do"),
        "null_both")


def q_hash_collisions(spark, sf):
    return dg.hash_collisions(tb.fhv_raw(spark, sf), ["dispatching_base_num", "PUlocationID"])


def q_out_of_period_rows(spark, sf):
    """Trips whose dropoff is outside the pickup month they are filed under."""
    t = tb.trips(spark, sf).withColumn("period", F.trunc("pickup_datetime", "month"))
    return dg.out_of_period(t, "dropoff_datetime", "period", ["taxi_type"])


def q_describe_sample(spark, sf):
    """Schema of the line items plus a stated-order sample of 5 rows."""
    li = tb.table(spark, sf, "lineitem")
    return dg.sample_rows(li, 5, LINE_KEY + ["l_shipdate", "l_partkey"])


QUERIES = {
    "short_trip_count": q_short_trip_count,
    "longest_trip_day": q_longest_trip_day,
    "biggest_pickup_zone": q_biggest_pickup_zone,
    "largest_tip_zone": q_largest_tip_zone,
    "trips_on_day": q_trips_on_day,
    "longest_trip_hours": q_longest_trip_hours,
    "least_frequent_zone": q_least_frequent_zone,
    "zero_fare_count": q_zero_fare_count,
    "distinct_vendor_in_range": q_distinct_vendor_in_range,
    "distinct_pickup_locations": q_distinct_pickup_locations,
    "surrogate_key": q_surrogate_key,
    "duplicate_summary": q_duplicate_summary,
    "duplicate_rows": q_duplicate_rows,
    "null_location_profile": q_null_location_profile,
    "hash_collisions": q_hash_collisions,
    "out_of_period_rows": q_out_of_period_rows,
    "describe_sample": q_describe_sample,
}


def _t(body):
    return tb.with_ctes(body, "T")


def _md5(cols, rel=""):
    parts = []
    for c in cols:
        expr = f"{rel}{c}"
        text = f"CAST({expr} AS VARCHAR)"
        if c == "unit_price":  # a double with all its digits
            text = f"regexp_replace(CAST(l_extendedprice / l_quantity AS VARCHAR), '\\.0$', '')"
        parts.append(f"COALESCE({text}, '')")
    return "md5(" + " || '-' || ".join(parts) + ")"


ORACLE = {
    "short_trip_count": _t(f"""
        SELECT COUNT(*) AS trips FROM T WHERE taxi_type = 'green'
          AND pickup_datetime >= TIMESTAMP '{YEAR_START}' AND pickup_datetime < TIMESTAMP '{YEAR_END}'
          AND trip_distance <= {SHORT_TRIP_MAX}"""),
    "longest_trip_day": _t(f"""
        SELECT CAST(pickup_datetime AS DATE) AS pickup_day, MAX(trip_distance) AS max_distance
        FROM T WHERE taxi_type = 'green'
          AND pickup_datetime >= TIMESTAMP '{YEAR_START}' AND pickup_datetime < TIMESTAMP '{YEAR_END}'
          AND trip_distance < {LONG_TRIP_LIMIT}
        GROUP BY 1 ORDER BY 2 DESC, 1 ASC LIMIT 1"""),
    "biggest_pickup_zone": tb.with_ctes(f"""
        SELECT z.zone AS zone, CAST(SUM(CAST(t.total_amount AS DECIMAL(18,3))) AS DECIMAL(38,3)) AS total
        FROM T t JOIN Z z ON t.pickup_location_id = z.location_id
        WHERE t.taxi_type = 'green' AND CAST(t.pickup_datetime AS DATE) = DATE '{BUSY_DAY}'
        GROUP BY 1 ORDER BY 2 DESC, 1 ASC LIMIT 1""", "T", "Z"),
    "largest_tip_zone": tb.with_ctes(f"""
        SELECT z_do.zone AS zone, MAX(t.tip_amount) AS max_tip
        FROM T t JOIN Z z_pu ON t.pickup_location_id = z_pu.location_id
                 JOIN Z z_do ON t.dropoff_location_id = z_do.location_id
        WHERE z_pu.zone = '{TIP_PICKUP_ZONE}' AND t.taxi_type = 'green'
          AND t.pickup_datetime >= TIMESTAMP '{YEAR_START}' AND t.pickup_datetime < TIMESTAMP '{YEAR_END}'
        GROUP BY 1 ORDER BY 2 DESC, 1 ASC LIMIT 1""", "T", "Z"),
    "trips_on_day": _t(f"""
        SELECT COUNT(*) AS trips FROM T
        WHERE taxi_type = 'yellow' AND CAST(pickup_datetime AS DATE) = DATE '{BUSY_DAY}'"""),
    "longest_trip_hours": _t("""
        SELECT ROUND(MAX((epoch(dropoff_datetime) - epoch(pickup_datetime)) / 3600.0), 6)
               AS max_trip_hours FROM T WHERE taxi_type = 'yellow'"""),
    "least_frequent_zone": tb.with_ctes("""
        SELECT z.zone AS zone, COUNT(*) AS trips
        FROM T t LEFT JOIN Z z ON t.pickup_location_id = z.location_id
        WHERE t.taxi_type = 'yellow'
        GROUP BY 1 ORDER BY 2 ASC, 1 ASC NULLS FIRST LIMIT 1""", "T", "Z"),
    "zero_fare_count": _t("""
        SELECT COUNT(*) AS zero_amount_trips FROM T
        WHERE taxi_type = 'yellow' AND tip_amount = 0"""),
    "distinct_vendor_in_range": _t(f"""
        SELECT DISTINCT vendor_id FROM T WHERE taxi_type = 'yellow'
          AND dropoff_datetime BETWEEN TIMESTAMP '{RANGE_LO}' AND TIMESTAMP '{RANGE_HI}'"""),
    "distinct_pickup_locations": _t("""
        SELECT COUNT(DISTINCT pickup_location_id) AS distinct_pickup_locations
        FROM T WHERE taxi_type = 'yellow'"""),
    "surrogate_key": f"SELECT l_orderkey, l_linenumber, {_md5(SURROGATE_COLS)} AS trip_id FROM lineitem",
    "duplicate_summary": """
        SELECT COUNT(*) AS total_rows,
               COUNT(DISTINCT (l_orderkey, l_linenumber)) AS distinct_keys,
               COUNT(*) - COUNT(DISTINCT (l_orderkey, l_linenumber)) AS duplicate_count
        FROM lineitem""",
    "duplicate_rows": f"""
        SELECT k.*, {_md5(LINE_KEY, 'k.')} AS row_key
        FROM lineitem k
        JOIN (SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY 1, 2 HAVING COUNT(*) > 1) d
          ON k.l_orderkey = d.l_orderkey AND k.l_linenumber = d.l_linenumber""",
    "null_location_profile": tb.with_ctes("""
        SELECT COUNT(*) AS total,
               COUNT(*) FILTER (WHERE PUlocationID IS NULL) AS null_pu,
               COUNT(*) FILTER (WHERE DOlocationID IS NULL) AS null_do,
               COUNT(*) FILTER (WHERE PUlocationID IS NULL AND DOlocationID IS NULL) AS null_both
        FROM H WHERE pickup_datetime IS NOT NULL AND dropOff_datetime IS NOT NULL""", "H"),
    "hash_collisions": tb.with_ctes(f"""
        SELECT {_md5(['dispatching_base_num', 'PUlocationID'])} AS row_key,
               COUNT(DISTINCT (dispatching_base_num, PUlocationID)) AS distinct_rows,
               COUNT(*) AS rows
        FROM H GROUP BY 1
        HAVING COUNT(DISTINCT (dispatching_base_num, PUlocationID)) > 1""", "H"),
    "out_of_period_rows": _t("""
        SELECT taxi_type, CAST(year(dropoff_datetime) AS INTEGER) AS ts_year,
               COUNT(*) AS rows_outside
        FROM T
        WHERE dropoff_datetime < date_trunc('month', pickup_datetime)
           OR dropoff_datetime >= date_trunc('month', pickup_datetime) + INTERVAL 1 MONTH
        GROUP BY 1, 2"""),
    "describe_sample": """
        SELECT * FROM lineitem
        ORDER BY l_orderkey, l_linenumber, l_shipdate, l_partkey LIMIT 5""",
}
