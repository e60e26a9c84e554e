"""Physical-plan assertions: the plans we want, not only the rows."""

from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from ridelake.operators import load
from ridelake.plans import adhoc, io, landing, models
from ridelake.session import scratch_path


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_fact_table_broadcasts_the_zone_dimension(spark, sf_dir):
    plan = _plan(models.q_fct_trips(spark, sf_dir))
    assert "BroadcastHashJoin LeftOuter" in plan or "BroadcastHashJoin" in plan
    assert plan.count("WindowGroupLimit") >= 2


def test_mart_aggregates_partially_before_the_shuffle(spark, sf_dir):
    plan = _plan(models.q_monthly_zone_revenue(spark, sf_dir))
    assert "partial_sum" in plan and "partial_count" in plan


def test_staging_joins_payment_seed_by_broadcast(spark, sf_dir):
    plan = _plan(models.q_staging_trips(spark, sf_dir))
    assert "SortMergeJoin LeftOuter" not in plan
    assert plan.count("Scan parquet") <= 4   # the trip join is read once


def test_projection_reaches_the_scan(spark, sf_dir):
    df = io.q_scan_parquet(spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_orderkey:bigint,l_extendedprice:double,l_shipdate:timestamp_ntz>" in plan \
        or "struct<l_orderkey:bigint,l_extendedprice:double,l_shipdate:timestamp_ntz>" in plan


def test_partitioned_layout_prunes_partitions(spark, sf_dir):
    plan = _plan(io.q_partitioned_clustered(spark, sf_dir))
    assert "PartitionFilters: [isnotnull(tpep_dropoff_datetime_month" in plan


def test_top1_is_a_take_ordered(spark, sf_dir):
    plan = _plan(adhoc.q_longest_trip_day(spark, sf_dir))
    assert "TakeOrderedAndProject" in plan


def test_least_frequent_zone_aggregates_before_the_lookup(spark, sf_dir):
    plan = _plan(adhoc.q_least_frequent_zone(spark, sf_dir))
    assert "BroadcastHashJoin" in plan and plan.count("HashAggregate") >= 4


def test_metadata_count_reads_footers_only(spark, sf_dir):
    plan = _plan(io.q_metadata_count(spark, sf_dir))
    assert "PushedAggregation: [COUNT(*)]" in plan


def test_replace_table_records_statistics(spark, sf_dir):
    df = io.q_replace_table(spark, sf_dir)
    stats = spark.sql("DESCRIBE TABLE EXTENDED replaced_lineitem").filter("col_name = 'Statistics'")
    assert "rows" in stats.first()["data_type"]
    assert df.count() > 0


def test_trip_join_without_broadcasts_shuffles_line_items_once(spark, sf_dir):
    """The shape at scale, when no dimension fits a broadcast: customers join
    orders first, line items are shuffled once by order key, no extra spread."""
    from ridelake.plans import tables as tb
    old = {k: spark.conf.get(k, None) for k in
           ("spark.sql.autoBroadcastJoinThreshold", "ridelake.broadcast.maxBytes")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("ridelake.broadcast.maxBytes", "0")
    try:
        plan = _plan(tb.trips(spark, sf_dir))
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    assert "RoundRobinPartitioning" not in plan
    assert plan.count("hashpartitioning(l_orderkey") == 1
    assert plan.count("hashpartitioning(o_custkey") == 1


def test_line_items_are_never_the_broadcast_side(spark, sf_dir):
    """Without statistics Catalyst estimates orders x customer as a product of
    sizes; the explicit, size-checked hint keeps the line items streaming."""
    from ridelake.plans import tables as tb
    plan = _plan(tb.trips(spark, sf_dir))
    assert "BuildLeft" not in plan


def test_bucketed_tables_join_without_a_shuffle(spark, sf_dir):
    from ridelake.operators.load import write_bucketed
    from ridelake.session import scratch_path
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    a = write_bucketed(li, "b_lineitem", scratch_path(spark, "bl"), 8, ["l_orderkey"])
    b = write_bucketed(orders, "b_orders", scratch_path(spark, "bo"), 8, ["o_orderkey"])
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(a.join(b, a["l_orderkey"] == b["o_orderkey"]))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "SortMergeJoin" in plan and "Exchange hashpartitioning" not in plan


def _written(spark, action):
    """Physical plans that ``action`` planned for writes."""
    seen = []
    real = DataFrameWriter.parquet

    def parquet(self, path, *args, **kwargs):
        seen.append(self._df._jdf.queryExecution().executedPlan().toString())
        return real(self, path, *args, **kwargs)

    DataFrameWriter.parquet = parquet
    try:
        action()
    finally:
        DataFrameWriter.parquet = real
    return seen


def test_shuffles_start_finely_and_merge_up_to_a_bounded_size(spark, sf_dir):
    """The tasks of a large shuffle stay small whatever the session's number
    of shuffle partitions (here 8); those of a small one are merged."""
    assert int(spark.conf.get("spark.sql.shuffle.partitions")) == 8
    rows = spark.range(4_000_000).select((F.col("id") % 1_000_003).alias("k"), F.xxhash64("id").alias("v"))
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        large = rows.repartition("k").rdd.getNumPartitions()
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    assert large > 16
    assert spark.range(10).repartition("id").rdd.getNumPartitions() == 1
    assert before == "32m"


def test_an_external_table_is_written_without_a_shuffle(spark, sf_dir):
    path = _written(spark, lambda: io.q_external_table(spark, sf_dir))
    assert path and not any("Exchange" in p for p in path)


def test_a_few_large_files_are_written_without_shuffled_rows(spark, sf_dir):
    """Stored files that split finely are joined to n files as they are."""
    rows = spark.range(0, 1000, numPartitions=8).withColumn("v", F.col("id") * 2)
    target = scratch_path(spark, "few")
    plans = _written(spark, lambda: load.repartition_write(rows, target, 4))
    assert len(plans) == 2 and not any("Exchange" in p for p in plans)
    got = load.file_stats(spark, target).first()
    assert (got.num_files, got.total_rows) == (4, 1000)
    assert sorted(map(tuple, spark.read.parquet(target).collect())) == [(i, 2 * i) for i in range(1000)]


def test_rows_in_one_file_are_still_dealt_to_all_files(spark):
    target = scratch_path(spark, "dealt")
    got = load.repartition_write(spark.range(0, 1000, numPartitions=1), target, 4).first()
    assert (got.num_files, got.total_rows) == (4, 1000)


def test_monthly_files_join_the_trips_once(spark, sf_dir):
    plans = _written(spark, lambda: landing.build(spark, sf_dir))
    assert len(plans) == 5 and sum("Join" in p for p in plans) == 1


def test_files_of_one_type_are_appended_without_a_shuffle(spark, sf_dir):
    root = landing.build(spark, sf_dir)
    target = scratch_path(spark, "one-type")
    batch = landing.ingest(spark, root, io.PLAN_START, io.PLAN_END, ["yellow", "green"], "2002-01-01 00:00:00")
    plans = _written(spark, lambda: load.append(batch, target, ["taxi_type"], clustered=True))
    assert len(plans) == 1 and "Exchange" not in plans[0]
    assert spark.read.parquet(target).count() == batch.count()
