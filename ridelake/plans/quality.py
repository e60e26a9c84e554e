"""Registered data-quality checks."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ridelake.operators import checks as ck
from ridelake.operators import guarded, marts
from ridelake.plans import models, sqlbits as sb
from ridelake.plans import tables as tb
from ridelake.session import scratch_path

# The staging table's declared contract (name, type, nullable).
STAGING_CONTRACT = StructType.fromJson({"type": "struct", "fields": [
    {"name": n, "type": t, "nullable": nullable, "metadata": {}} for n, t, nullable in [
        ("taxi_type", "string", False), ("pickup_datetime", "timestamp_ntz", False),
        ("dropoff_datetime", "timestamp_ntz", False), ("pickup_location_id", "integer", True),
        ("dropoff_location_id", "integer", True), ("passenger_count", "integer", True),
        ("trip_distance", "double", True), ("payment_type", "integer", True),
        ("payment_type_name", "string", True), ("fare_amount", "double", True),
        ("total_amount", "double", True), ("tip_amount", "double", True)]]})
STAGING_KEY = ["taxi_type", "pickup_datetime", "dropoff_datetime",
               "pickup_location_id", "dropoff_location_id"]


def q_check_not_null(spark, sf):
    raw = tb.raw_two_extractions(spark, sf)
    return ck.run_checks(raw, [ck.not_null(c) for c in
                               ["taxi_type", "pickup_datetime", "dropoff_datetime", "vendor_id"]],
                         "ingestion.trips")


def q_check_unique(spark, sf):
    zones = ck.run_checks(models.zones(spark, sf), [ck.unique("location_id")], "dim_zones")
    lines = ck.run_checks(tb.table(spark, sf, "lineitem"),
                          [ck.unique("l_orderkey", "l_linenumber")], "lineitem")
    return zones.unionByName(lines)


def q_check_non_negative(spark, sf):
    return ck.run_checks(tb.table(spark, sf, "customer"),
                         [ck.non_negative("c_acctbal"), ck.positive("c_acctbal"),
                          ck.positive("c_custkey")], "customer")


def q_check_accepted_values(spark, sf):
    raw = tb.raw_two_extractions(spark, sf)
    return ck.run_checks(raw, [ck.accepted_values("taxi_type", ["yellow", "green"]),
                               ck.accepted_values("payment_type", [1, 2])],
                         "ingestion.trips")


def _materialized(spark, df, name, **options):
    """Write the model once (as the pipeline does before testing it) and
    return the written table, so several checks scan it instead of
    recomputing its plan."""
    path = scratch_path(spark, name)  # a fresh folder: one direct write
    df.write.parquet(path, **options)
    table = spark.read.parquet(path)
    table.createOrReplaceTempView(name)
    return table


def q_check_custom_sql(spark, sf):
    fct = _materialized(spark, models.fct(spark, sf), "fct_trips")
    return ck.run_checks(
        fct,
        [ck.sql_equals("dropoff_after_pickup",
                       "SELECT COUNT(*) FROM fct_trips WHERE dropoff_datetime < pickup_datetime",
                       0)],
        "fct_trips")


def q_check_schema_contract(spark, sf):
    return ck.check_schema(models.staging_of(spark, sf), STAGING_CONTRACT)


def q_check_suite(spark, sf):
    stg = _materialized(spark, models.staging_of(spark, sf), "staging_trips")
    checks = [ck.not_null("taxi_type"), ck.not_null("pickup_datetime"),
              ck.not_null("dropoff_datetime"),
              ck.non_negative("trip_distance"), ck.non_negative("fare_amount"),
              ck.non_negative("total_amount"), ck.non_negative("tip_amount"),
              ck.accepted_values("taxi_type", ["yellow", "green"]),
              ck.unique(*STAGING_KEY),
              ck.sql_equals("dropoff_after_pickup",
                            "SELECT COUNT(*) FROM staging_trips "
                            "WHERE dropoff_datetime < pickup_datetime", 0)]
    return ck.run_checks(stg, checks, "staging.trips")


def q_load_checked(spark, sf):
    """Customers loaded under checks: the first load passes, the second (all
    balances) breaks one and leaves the table as it was."""
    cust = tb.table(spark, sf, "customer")
    target = scratch_path(spark, "guarded")
    checks = [ck.not_null("c_custkey"), ck.non_negative("c_acctbal"), ck.unique("c_custkey")]
    out = None
    for number, rows in enumerate([cust.where("c_acctbal >= 0"), cust], 1):
        found = guarded.checked_refresh(rows, target, checks, "customer")
        now = spark.read.schema(cust.schema).parquet(target).count()  # after each load
        found = found.withColumns({"load": F.lit(number), "target_rows": F.lit(now).cast("long")})
        out = found if out is None else out.unionByName(found)
    return out


REPEAT_KEY = marts.STAGING_DEDUP_KEYS
QUARANTINE_CHECKS = [ck.not_null("vendor_id"), ck.accepted_values("payment_type", [1, 2]),
                     ck.non_negative("tip_amount"), ck.unique(*REPEAT_KEY)]


def _split(spark, sf):
    """The join is stored, each column once; the raw trips, twice as wide and
    some of them twice, are derived from it whenever they are read."""
    parts = _materialized(spark, tb.trip_parts(spark, sf), "trip_parts", compression="zstd")
    raw = tb.raw_two_extractions(spark, sf, tb.as_trips(parts))
    return guarded.quarantine(raw, QUARANTINE_CHECKS, scratch_path(spark, "quarantine"), compression="zstd")


def q_quarantine_accepted(spark, sf):
    """Raw trips that break no check."""
    return _split(spark, sf)[0]


def q_quarantine_rejected(spark, sf):
    """Raw trips that break a check, with the checks they break."""
    rejected = _split(spark, sf)[1]
    return rejected.withColumn("failed_checks", F.concat_ws(";", "failed_checks"))


QUERIES = {
    "load_checked": q_load_checked,
    "quarantine_accepted": q_quarantine_accepted,
    "quarantine_rejected": q_quarantine_rejected,
    "check_not_null": q_check_not_null,
    "check_unique": q_check_unique,
    "check_non_negative": q_check_non_negative,
    "check_accepted_values": q_check_accepted_values,
    "check_custom_sql": q_check_custom_sql,
    "check_schema_contract": q_check_schema_contract,
    "check_suite": q_check_suite,
}


def _rows(table, items):
    """SQL for check rows given (check, column, failures-expression) items."""
    sel = " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{c}' AS check_name, '{col}' AS column_name, "
        f"CAST(({expr}) AS BIGINT) AS failures" for c, col, expr in items)
    return f"SELECT *, failures = 0 AS passed FROM ({sel})"


def _cnt(rel, cond):
    return f"SELECT COUNT(*) FROM {rel} WHERE {cond}"


_R = "R"
_STG_CTE = f"STG AS ({sb.sql_staging('R', models.RUN_START, models.RUN_END)})"

_REPEATED = f"count(*) OVER (PARTITION BY {', '.join(REPEAT_KEY)}) > 1"
_FAILED = "concat_ws(';', " + ", ".join(
    f"CASE WHEN {cond} THEN '{guarded.check_label(c)}' END" for c, cond in zip(QUARANTINE_CHECKS, [
        "vendor_id IS NULL", "payment_type IS NOT NULL AND payment_type NOT IN (1, 2)", "tip_amount < 0",
        _REPEATED])) + ")"


def _loaded(number, rel):
    """Checks of one load of customers, beside the table's rows afterwards."""
    return f"""SELECT *, {number} AS load, (SELECT COUNT(*) FROM customer WHERE c_acctbal >= 0) AS target_rows
      FROM ({_rows("customer", [
          ("not_null", "c_custkey", _cnt(rel, "c_custkey IS NULL")),
          ("non_negative", "c_acctbal", _cnt(rel, "c_acctbal < 0")),
          ("unique", "c_custkey", f"SELECT COUNT(*) FROM (SELECT 1 FROM {rel} GROUP BY c_custkey "
                                  "HAVING COUNT(*) > 1)")])})"""


ORACLE = {
    "load_checked": _loaded(1, "(SELECT * FROM customer WHERE c_acctbal >= 0)") + " UNION ALL "
        + _loaded(2, "customer"),
    "quarantine_accepted": tb.with_ctes(
        f"SELECT * EXCLUDE (failed_checks) FROM (SELECT *, {_FAILED} AS failed_checks FROM R) "
        "WHERE failed_checks = ''", "R"),
    "quarantine_rejected": tb.with_ctes(
        f"SELECT * FROM (SELECT *, {_FAILED} AS failed_checks FROM R) WHERE failed_checks <> ''", "R"),
    "check_not_null": tb.with_ctes(_rows("ingestion.trips", [
        ("not_null", c, _cnt(_R, f"{c} IS NULL")) for c in
        ["taxi_type", "pickup_datetime", "dropoff_datetime", "vendor_id"]]), "R"),
    "check_unique": tb.with_ctes(
        _rows("dim_zones", [("unique", "location_id",
                             "SELECT COUNT(*) FROM (SELECT location_id FROM Z GROUP BY 1 "
                             "HAVING COUNT(*) > 1)")])
        + " UNION ALL " +
        _rows("lineitem", [("unique", "l_orderkey,l_linenumber",
                            "SELECT COUNT(*) FROM (SELECT l_orderkey, l_linenumber FROM lineitem "
                            "GROUP BY 1, 2 HAVING COUNT(*) > 1)")]), "Z"),
    "check_non_negative": _rows("customer", [
        ("non_negative", "c_acctbal", _cnt("customer", "c_acctbal < 0")),
        ("positive", "c_acctbal", _cnt("customer", "c_acctbal <= 0")),
        ("positive", "c_custkey", _cnt("customer", "c_custkey <= 0"))]),
    "check_accepted_values": tb.with_ctes(_rows("ingestion.trips", [
        ("accepted_values", "taxi_type",
         _cnt(_R, "taxi_type IS NOT NULL AND taxi_type NOT IN ('yellow', 'green')")),
        ("accepted_values", "payment_type",
         _cnt(_R, "payment_type IS NOT NULL AND payment_type NOT IN (1, 2)"))]), "R"),
    "check_custom_sql": sb.with_fct(_rows("fct_trips", [
        ("dropoff_after_pickup", "",
         f"CASE WHEN ({_cnt('FCT', 'dropoff_datetime < pickup_datetime')}) = 0 "
         f"THEN 0 ELSE 1 END")])),
    "check_schema_contract": tb.with_ctes("", "R", "P").rstrip() + ",\n" + _STG_CTE + "\n"
        + " UNION ALL ".join(
            f"SELECT '{f.name}' AS column_name, '{f.dataType.simpleString()}' AS expected_type, "
            f"'{f.dataType.simpleString()}' AS actual_type, true AS matches, "
            + (f"(SELECT COUNT(*) FROM STG WHERE {f.name} IS NULL)" if not f.nullable
               else "CAST(NULL AS BIGINT)") + " AS null_rows"
            for f in STAGING_CONTRACT.fields),
    "check_suite": tb.with_ctes("", "R", "P").rstrip() + ",\n" + _STG_CTE + "\n" + _rows(
        "staging.trips",
        [("not_null", c, _cnt("STG", f"{c} IS NULL"))
         for c in ["taxi_type", "pickup_datetime", "dropoff_datetime"]]
        + [("non_negative", c, _cnt("STG", f"{c} < 0"))
           for c in ["trip_distance", "fare_amount", "total_amount", "tip_amount"]]
        + [("accepted_values", "taxi_type",
            _cnt("STG", "taxi_type IS NOT NULL AND taxi_type NOT IN ('yellow', 'green')")),
           ("unique", ",".join(STAGING_KEY),
            f"SELECT COUNT(*) FROM (SELECT 1 FROM STG GROUP BY {', '.join(STAGING_KEY)} "
            f"HAVING COUNT(*) > 1)"),
           ("dropoff_after_pickup", "",
            f"CASE WHEN ({_cnt('STG', 'dropoff_datetime < pickup_datetime')}) = 0 "
            f"THEN 0 ELSE 1 END")]),
}
