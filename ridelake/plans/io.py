"""Registered source, sink and layout queries.

A query whose operator writes does so below the session's scratch folder
(``spark.checkpoint.dir``) in a fresh sub-folder, and returns the table it
wrote as read back, so the oracle states the final content.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import functions as F

from ridelake.operators import load
from ridelake.operators.diagnostics import describe
from ridelake.plans import landing, models
from ridelake.plans import sqlbits as sb
from ridelake.plans import tables as tb
from ridelake.plans.adhoc import RANGE_HI, RANGE_LO
from ridelake.session import scratch_path
from ridelake.sources import files, paged

LINE_COLS = ["l_orderkey", "l_extendedprice", "l_shipdate"]
# Fixed window of the file-plan questions: wider than the data on both
# ends, starting mid-month.
PLAN_START, PLAN_END = "1994-11-15", "2002-03-01"
PLAN_TYPES = ["yellow", "green", "fhv"]
GAP_KEY = 10_000_000_000  # far beyond the last page
PAGE_SIZE = 500
# Spark's types of the line item columns, in file order.
LINEITEM_SPARK_TYPES = [
    ("l_orderkey", "bigint"), ("l_partkey", "bigint"), ("l_suppkey", "bigint"),
    ("l_linenumber", "int"), ("l_quantity", "double"), ("l_extendedprice", "double"),
    ("l_discount", "double"), ("l_tax", "double"), ("l_returnflag", "string"),
    ("l_linestatus", "string"), ("l_shipdate", "timestamp_ntz")]


def q_scan_parquet(spark, sf):
    return files.read_parquet(spark, f"{sf}/lineitem.parquet", columns=LINE_COLS)


def q_scan_csv(spark, sf):
    li = tb.table(spark, sf, "lineitem")
    path = scratch_path(spark, "csv")
    li.write.option("header", True).csv(path)
    return files.read_csv(spark, path, schema=li.schema)


def q_scan_csv_gz(spark, sf):
    orders = tb.table(spark, sf, "orders")
    path = scratch_path(spark, "csvgz")
    orders.write.option("header", True).option("compression", "gzip").csv(path)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return files.read_csv(spark, path, schema=orders.schema, repartition=n)


def q_scan_union_by_name(spark, sf):
    """Two file sets: open lines with an integral quantity, closed lines with
    a double quantity and one extra column."""
    li = tb.table(spark, sf, "lineitem")
    root = scratch_path(spark, "ubn")
    (li.filter(F.col("l_linestatus") == "O")
       .withColumn("l_quantity", F.col("l_quantity").cast("bigint"))
       .write.parquet(f"{root}/a"))
    (li.filter(F.col("l_linestatus") == "F")
       .withColumn("l_extra", F.col("l_linenumber") * 10)
       .write.parquet(f"{root}/b"))
    return files.read_union_by_name(spark, [f"{root}/a", f"{root}/b"])


def q_external_table(spark, sf):
    li = tb.table(spark, sf, "lineitem")
    path = scratch_path(spark, "ext")
    li.write.parquet(path)
    return files.external_table(spark, "ext_lineitem", path)


def q_paged_json_source(spark, sf):
    """Customers served as pages of 500 records; read until an empty page.  A
    page of customers that lies beyond the first missing one is not read."""
    cust = tb.table(spark, sf, "customer")
    root = scratch_path(spark, "pages")
    stray = cust.where("c_custkey < 9").withColumn("c_custkey", F.col("c_custkey") + GAP_KEY)
    (cust.unionByName(stray)
         .withColumn("page", (F.col("c_custkey") / PAGE_SIZE).cast("long") + 1)
         .hint("rebalance", "page").write.partitionBy("page").json(root))
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in cust.schema.fields)
    return paged.read_pages(spark, root + "/page={page}", ddl)


def q_seed_lookup(spark, sf):
    nation = tb.table(spark, sf, "nation")
    path = scratch_path(spark, "seed")
    nation.write.option("header", True).csv(path)
    return files.read_seed(spark, path, "n_nationkey int, n_name string, n_regionkey int")


def q_file_inventory(spark, sf):
    orders = tb.table(spark, sf, "orders")
    path = scratch_path(spark, "inventory")
    (orders.withColumn("o_year", F.year("o_orderdate")).hint("rebalance", "o_year")
           .write.partitionBy("o_year").option("header", True).csv(path))
    inv = files.file_inventory(spark, path)
    # how many files a year has is the writer's choice; what they hold is not
    return (inv.withColumn("o_year", F.regexp_extract("file_path", r"o_year=(\d+)", 1).cast("int"))
            .groupBy("o_year").agg(F.sum("rows").alias("rows"),
                                   F.every(F.col("file_size") == F.col("text_bytes")).alias("sizes_agree")))


def q_csv_to_parquet(spark, sf):
    orders = tb.table(spark, sf, "orders")
    src = scratch_path(spark, "csvsrc")
    out = scratch_path(spark, "csvout")
    (orders.withColumn("o_year", F.year("o_orderdate")).hint("rebalance", "o_year")
           .write.partitionBy("o_year").option("header", True)
           .option("compression", "gzip").csv(src))
    load.csv_to_parquet(spark, src, out, orders.schema)
    load.csv_to_parquet(spark, src, out, orders.schema)  # re-run: nothing pending
    return spark.read.parquet(out).drop("source")


def q_replace_table(spark, sf):
    li = tb.table(spark, sf, "lineitem")
    loc = scratch_path(spark, "replace")
    load.replace_table(li, "replaced_lineitem", loc)
    return load.replace_table(li, "replaced_lineitem", loc)


def q_partitioned_clustered(spark, sf):
    """Yellow trips partitioned by dropoff month, clustered by vendor; the
    range question then reads only the partitions of its window."""
    y = tb.yellow_raw(tb.trips(spark, sf))
    path = scratch_path(spark, "partclust")
    part = load.write_partitioned(y, path, "tpep_dropoff_datetime", ["VendorID"], "month")
    t = spark.read.parquet(path)
    lo = F.lit(RANGE_LO).cast("timestamp_ntz")
    hi = F.lit(RANGE_HI).cast("timestamp_ntz")
    return (t.filter(F.col("tpep_dropoff_datetime").between(lo, hi)
                     & (F.col(part) >= F.trunc(lo.cast("date"), "month"))
                     & (F.col(part) <= hi.cast("date")))
            .select(F.col("VendorID").alias("vendor_id")).distinct())


def q_repartition_write(spark, sf):
    stats = load.repartition_write(tb.table(spark, sf, "lineitem"),
                                   scratch_path(spark, "repart"), 4)
    return stats.select("num_files", "total_rows", (F.col("avg_file_mb") > 0).alias("has_size"))


def q_metadata_count(spark, sf):
    """Row count of the line items from parquet footers (no column data read)."""
    return files.metadata_count(spark, f"{sf}/lineitem.parquet")


def q_scan_two_columns(spark, sf):
    """Two of sixteen columns: the scan reads only these (``ReadSchema``)."""
    li = tb.table(spark, sf, "lineitem")
    return li.groupBy("l_suppkey").agg(F.countDistinct("l_partkey").alias("parts"))


def q_describe_columns(spark, sf):
    return describe(tb.table(spark, sf, "lineitem"))


def q_standardize_trips(spark, sf):
    return tb.canonical(tb.trips(spark, sf), tb.T0)


def _ingestion_table(spark, sf, runs: int = 1) -> str:
    root = landing.build(spark, sf)
    target = scratch_path(spark, "ingestion")
    for _ in range(runs):
        batch = landing.ingest(spark, root, PLAN_START, PLAN_END, ["yellow", "green"], tb.T0)
        load.append(batch, target, partition_by=["taxi_type"], clustered=True)  # a file has one type
    return target


def _read_ingestion(spark, target):
    from ridelake.operators.staging import CANONICAL_COLUMNS
    return spark.read.parquet(target).select(*CANONICAL_COLUMNS)


def q_ingest_trips(spark, sf):
    return _read_ingestion(spark, _ingestion_table(spark, sf))


def q_rerun_idempotent(spark, sf):
    """Ingest the same window twice (append), then stage: same as one load."""
    raw = _read_ingestion(spark, _ingestion_table(spark, sf, runs=2))
    return models.staging_of(spark, sf, raw)


def q_load_append(spark, sf):
    # both appends read the trip join: keep it for their duration, then release
    t = tb.trips(spark, sf).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        target = scratch_path(spark, "append")
        load.append(tb.canonical_rows(t, tb.T0), target, ["taxi_type"])
        load.append(tb.canonical_rows(tb.reextracted(t), tb.T1), target, ["taxi_type"])
    finally:
        t.unpersist()
    return _read_ingestion(spark, target)


def q_month_file_plan(spark, sf):
    root = landing.build_markers(spark, sf)
    plan = files.month_plan(spark, PLAN_START, PLAN_END, PLAN_TYPES, landing.pattern(root))
    return plan.select("taxi_type", "month", "exists")


def q_skip_missing_files(spark, sf):
    root = landing.build_markers(spark, sf)
    plan = files.month_plan(spark, PLAN_START, PLAN_END, PLAN_TYPES, landing.pattern(root))
    return plan.filter("exists").select("taxi_type", "month")


def q_backfill_counts(spark, sf):
    root = landing.build(spark, sf)
    return landing.read_counts(spark, root, PLAN_START, PLAN_END, ["yellow", "green"])


QUERIES = {
    "scan_parquet": q_scan_parquet,
    "scan_csv": q_scan_csv,
    "scan_csv_gz": q_scan_csv_gz,
    "scan_union_by_name": q_scan_union_by_name,
    "external_table": q_external_table,
    "paged_json_source": q_paged_json_source,
    "seed_lookup": q_seed_lookup,
    "file_inventory": q_file_inventory,
    "csv_to_parquet": q_csv_to_parquet,
    "replace_table": q_replace_table,
    "partitioned_clustered": q_partitioned_clustered,
    "repartition_write": q_repartition_write,
    "scan_two_columns": q_scan_two_columns,
    "metadata_count": q_metadata_count,
    "describe_columns": q_describe_columns,
    "standardize_trips": q_standardize_trips,
    "ingest_trips": q_ingest_trips,
    "rerun_idempotent": q_rerun_idempotent,
    "load_append": q_load_append,
    "month_file_plan": q_month_file_plan,
    "skip_missing_files": q_skip_missing_files,
    "backfill_counts": q_backfill_counts,
}

_MONTHS = f"""
  SELECT CAST(m AS DATE) AS month
  FROM generate_series(TIMESTAMP '{PLAN_START[:8]}01', TIMESTAMP '{PLAN_END}' - INTERVAL 1 DAY,
                       INTERVAL 1 MONTH) g(m)"""

_HAVE = """
  SELECT DISTINCT taxi_type, CAST(date_trunc('month', pickup_datetime) AS DATE) AS month FROM T"""

ORACLE = {
    "scan_parquet": f"SELECT {', '.join(LINE_COLS)} FROM lineitem",
    "metadata_count": "SELECT COUNT(*) AS row_count FROM lineitem",
    "describe_columns": " UNION ALL ".join(
        f"SELECT {i + 1} AS ordinal, '{c}' AS column_name, '{t}' AS data_type, "
        f"true AS nullable, COUNT({c}) AS non_null_rows FROM lineitem"
        for i, (c, t) in enumerate(LINEITEM_SPARK_TYPES)),
    "scan_csv": "SELECT * FROM lineitem",
    "scan_csv_gz": "SELECT * FROM orders",
    "scan_union_by_name": """
        SELECT * REPLACE (CAST(l_quantity AS DOUBLE) AS l_quantity),
               CASE WHEN l_linestatus = 'F' THEN l_linenumber * 10 END AS l_extra
        FROM lineitem""",
    "external_table": "SELECT * FROM lineitem",
    "paged_json_source": "SELECT * FROM customer",
    "seed_lookup": "SELECT * FROM nation",
    "file_inventory": """
        SELECT CAST(year(o_orderdate) AS INT) AS o_year, COUNT(*) AS rows, true AS sizes_agree
        FROM orders GROUP BY 1""",
    "repartition_write": "SELECT 4 AS num_files, COUNT(*) AS total_rows, true AS has_size FROM lineitem",
    "csv_to_parquet": "SELECT * FROM orders",
    "scan_two_columns": "SELECT l_suppkey, COUNT(DISTINCT l_partkey) AS parts FROM lineitem GROUP BY 1",
    "replace_table": "SELECT * FROM lineitem",
    "partitioned_clustered": tb.with_ctes(f"""
        SELECT DISTINCT vendor_id FROM T WHERE taxi_type = 'yellow'
          AND dropoff_datetime BETWEEN TIMESTAMP '{RANGE_LO}' AND TIMESTAMP '{RANGE_HI}'""", "T"),
    "standardize_trips": tb.with_ctes(tb.sql_canonical("T", tb.T0), "T"),
    "ingest_trips": tb.with_ctes(f"""
        SELECT * REPLACE (CASE WHEN taxi_type = 'yellow' AND year(pickup_datetime) = {landing.NO_FEE_YEAR}
                                    AND day(pickup_datetime) < {landing.NO_FEE_BEFORE_DAY} THEN NULL ELSE airport_fee END AS airport_fee)
        FROM ({tb.sql_canonical("T", tb.T0)})""", "T"),
    "rerun_idempotent": tb.with_ctes("", "T", "P").rstrip()
        + f",\nR1 AS ({tb.sql_canonical('T', tb.T0)})\n"
        + sb.sql_staging("R1", models.RUN_START, models.RUN_END),
    "load_append": tb.with_ctes("SELECT * FROM R", "R"),
    "month_file_plan": tb.with_ctes(f"""
        SELECT ty.taxi_type, mo.month,
               EXISTS (SELECT 1 FROM H2 h WHERE h.taxi_type = ty.taxi_type
                                            AND h.month = mo.month) AS exists
        FROM ({_MONTHS}) mo, (VALUES {', '.join(f"('{t}')" for t in PLAN_TYPES)}) ty(taxi_type)
        """.replace("H2", f"({_HAVE})"), "T"),
    "skip_missing_files": tb.with_ctes(f"""
        SELECT h.taxi_type, h.month FROM ({_HAVE}) h
        WHERE h.month >= DATE '{PLAN_START[:8]}01' AND h.month < DATE '{PLAN_END}'""", "T"),
    "backfill_counts": tb.with_ctes("""
        SELECT taxi_type, strftime(pickup_datetime, '%Y-%m') AS month, COUNT(*) AS rows
        FROM T GROUP BY 1, 2""", "T"),
}
