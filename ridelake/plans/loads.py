"""Registered load-strategy queries: each writes, then returns the table."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import functions as F

from ridelake.operators import load, marts
from ridelake.plans import models
from ridelake.plans import sqlbits as sb
from ridelake.plans import tables as tb
from ridelake.session import scratch_path

# Fixed parameters: the refreshed window, the changed and the new customers.
REFRESH_START, REFRESH_END = "1998-03-05 00:00:00", "1998-04-10 00:00:00"
CHANGED_SEGMENT, NEW_SEGMENT = "BUILDING", "AUTOMOBILE"
NEW_KEY_OFFSET = 1_000_000_000
MOVED_SEGMENT, MOVED_NATION, MOVED_TO = "HOUSEHOLD", 5, "MOVED"
NULL_SEGMENT_NATION, NULL_KEY_NATION = 3, 4
CUSTOMER_COLS = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]


def _staging_with_month(df):
    return df.withColumn("pickup_month", F.trunc("pickup_datetime", "month"))


def q_load_time_interval(spark, sf):
    """Stage everything from the first extraction, then refresh one window
    from the raw table that holds both extractions."""
    # both loads read the trip join: keep it for their duration, then release
    t = tb.trips(spark, sf).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        target = scratch_path(spark, "staging")
        pay = tb.payment_lookup(spark)
        first = marts.staging_trips(tb.canonical_rows(t, tb.T0), pay,
                                    models.RUN_START, models.RUN_END)
        load.time_interval(_staging_with_month(first), target, "pickup_datetime",
                           models.RUN_START, models.RUN_END, "pickup_month")
        both = tb.raw_two_extractions(spark, sf, t)
        again = marts.staging_trips(both, pay, REFRESH_START, REFRESH_END)
        load.time_interval(_staging_with_month(again), target, "pickup_datetime",
                           REFRESH_START, REFRESH_END, "pickup_month")
    finally:
        t.unpersist()
    return spark.read.parquet(target).select(*marts.STAGING_COLUMNS)


def _customers(spark, sf):
    """Customers; those of one nation have no segment (the partition column),
    those of another no key."""
    return (tb.table(spark, sf, "customer")
            .withColumn("c_mktsegment", F.when(F.col("c_nationkey") != NULL_SEGMENT_NATION,
                                               F.col("c_mktsegment")))
            .withColumn("c_custkey", F.when(F.col("c_nationkey") != NULL_KEY_NATION,
                                            F.col("c_custkey")))
            .select(*CUSTOMER_COLS))


def _changes(spark, sf):
    """Changed balances (and names) of one segment and of customers without
    one, customers that move to another segment, and new customers."""
    c = _customers(spark, sf)
    moved = (c.filter((F.col("c_mktsegment") == MOVED_SEGMENT) & (F.col("c_nationkey") == MOVED_NATION))
             .withColumn("c_mktsegment", F.lit(MOVED_TO)))
    changed = (c.filter((F.col("c_mktsegment") == CHANGED_SEGMENT) | F.col("c_mktsegment").isNull())
               .withColumn("c_acctbal", F.col("c_acctbal") + 100.0)
               .withColumn("c_name", F.concat(F.col("c_name"), F.lit("*"))))
    new = (c.filter(F.col("c_mktsegment") == NEW_SEGMENT)
           .withColumn("c_custkey", F.col("c_custkey") + NEW_KEY_OFFSET))
    return changed.unionByName(moved).unionByName(new)


def _customer_table(spark, sf) -> str:
    target = scratch_path(spark, "customers")
    _customers(spark, sf).write.partitionBy("c_mktsegment").parquet(target)
    return target


def _read_customers(spark, target):
    return spark.read.parquet(target).select(*CUSTOMER_COLS)


def q_load_delete_insert(spark, sf):
    target = _customer_table(spark, sf)
    load.delete_insert(_changes(spark, sf), target, ["c_custkey"], "c_mktsegment")
    return _read_customers(spark, target)


def q_load_merge(spark, sf):
    """Upsert that updates the balance and the segment of matched customers."""
    target = _customer_table(spark, sf)
    load.merge(_changes(spark, sf), target, ["c_custkey"], "c_mktsegment",
               update_columns=["c_acctbal", "c_mktsegment"])
    return _read_customers(spark, target)


def q_load_full_refresh(spark, sf):
    target = _customer_table(spark, sf)
    load.full_refresh(_changes(spark, sf), target, ["c_mktsegment"])
    return _read_customers(spark, target)


def q_load_view(spark, sf):
    solvent = _customers(spark, sf).filter(F.col("c_acctbal") >= 0)
    return load.as_view(solvent, "solvent_customers")


QUERIES = {
    "load_time_interval": q_load_time_interval,
    "load_delete_insert": q_load_delete_insert,
    "load_merge": q_load_merge,
    "load_full_refresh": q_load_full_refresh,
    "load_view": q_load_view,
}

_BASE = f"""
  SELECT CASE WHEN c_nationkey <> {NULL_KEY_NATION} THEN c_custkey END AS c_custkey, c_name,
         c_nationkey, c_acctbal,
         CASE WHEN c_nationkey <> {NULL_SEGMENT_NATION} THEN c_mktsegment END AS c_mktsegment
  FROM customer"""

_CHANGES = f"""
  SELECT c_custkey, c_name || '*' AS c_name, c_nationkey, c_acctbal + 100.0 AS c_acctbal,
         c_mktsegment
  FROM BASE WHERE c_mktsegment = '{CHANGED_SEGMENT}' OR c_mktsegment IS NULL
  UNION ALL
  SELECT c_custkey, c_name, c_nationkey, c_acctbal, '{MOVED_TO}' AS c_mktsegment
  FROM BASE WHERE c_mktsegment = '{MOVED_SEGMENT}' AND c_nationkey = {MOVED_NATION}
  UNION ALL
  SELECT c_custkey + {NEW_KEY_OFFSET} AS c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment
  FROM BASE WHERE c_mktsegment = '{NEW_SEGMENT}'"""

_win = (f"pickup_datetime >= TIMESTAMP '{REFRESH_START}' "
        f"AND pickup_datetime < TIMESTAMP '{REFRESH_END}'")

ORACLE = {
    "load_time_interval": tb.with_ctes("", "R", "P").rstrip()
        + f",\nR1 AS ({tb.sql_canonical('T', tb.T0)}),\n"
        + f"S1 AS ({sb.sql_staging('R1', models.RUN_START, models.RUN_END)}),\n"
        + f"S2 AS ({sb.sql_staging('R', REFRESH_START, REFRESH_END)})\n"
        + f"SELECT * FROM S1 WHERE NOT ({_win}) UNION ALL SELECT * FROM S2",
    "load_delete_insert": f"""
        WITH BASE AS ({_BASE}), N AS ({_CHANGES})
        SELECT * FROM BASE b WHERE NOT EXISTS (SELECT 1 FROM N WHERE N.c_custkey = b.c_custkey)
        UNION ALL SELECT * FROM N""",
    "load_merge": f"""
        WITH BASE AS ({_BASE}), N AS ({_CHANGES})
        SELECT o.c_custkey, o.c_name, o.c_nationkey,
               CASE WHEN n.c_custkey IS NOT NULL THEN n.c_acctbal ELSE o.c_acctbal END AS c_acctbal,
               CASE WHEN n.c_custkey IS NOT NULL THEN n.c_mktsegment ELSE o.c_mktsegment END
                 AS c_mktsegment
        FROM BASE o LEFT JOIN N n ON o.c_custkey = n.c_custkey
        UNION ALL
        SELECT * FROM N WHERE NOT EXISTS (SELECT 1 FROM BASE b WHERE b.c_custkey = N.c_custkey)""",
    "load_full_refresh": f"WITH BASE AS ({_BASE}) {_CHANGES}",
    "load_view": f"WITH BASE AS ({_BASE}) SELECT * FROM BASE WHERE c_acctbal >= 0",
}
