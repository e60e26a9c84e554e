"""Streams whose state is bounded by a watermark and that still lose no row.

Spark drops a row that is older than the watermark, because the state it would
meet is gone.  Here such rows leave the stream before the stateful operator
and are settled against tables instead:

* ``daily_report_state``: the state store holds the counts of the open days;
  each micro-batch upserts only the (day, group) rows it changed.  Rows of
  closed days are counted in a table of their own.
* ``dedup_state``: the state store holds the keys of the last ``delay``; older
  rows are compared with the keys of the sink.

A run processes all files that are new as one micro-batch, under the watermark
that the last batch left in the checkpoint's commit log.  A batch that is
repeated after a failure finds the same watermark, so it splits its rows in
the same way, and it replaces what it wrote before.
"""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from ridelake.operators import load
from ridelake.sources import fs
from ridelake.streaming.ingest import _event_time, _run, _source

_WM = "_event_time"
EPOCH = dt.datetime(1970, 1, 1)


def watermark(spark: SparkSession, checkpoint: str) -> dt.datetime:
    """The watermark under which the next batch of a checkpoint runs; the epoch
    before the first."""
    done = [int(n) for n in fs.list_names(spark, f"{checkpoint}/commits") if n.isdigit()]
    if not done:
        return EPOCH
    lines = spark.read.text(f"{checkpoint}/commits/{max(done)}").collect()  # two lines
    entry = next(json.loads(r[0]) for r in lines if r[0].startswith("{"))
    return EPOCH + dt.timedelta(milliseconds=entry["nextBatchWatermarkMs"])


def _ntz(value: dt.datetime):
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


# ------------------------------------------------------------------- daily report

REPORT = ("n_events", "value_sum")


def daily_report_state(spark: SparkSession, source_dir: str, target: str, late_target: str,
                       checkpoint: str, schema: StructType, ts_col: str, group_col: str,
                       value_col: str, delay: str) -> StreamingQuery:
    """One run of the report.  ``target`` gets (day, group, n_events, value_sum)
    of days that were open when their rows came; ``late_target`` the same of
    rows whose day was closed, or that have no time, with ``found_on``, the
    first day open at the time.  A day's whole figures are the sums over both
    (``whole_report``)."""
    closed = watermark(spark, checkpoint)
    open_from = dt.datetime(closed.year, closed.month, closed.day)
    day = F.to_date(ts_col)
    on_time = day >= F.lit(open_from.date())
    # a row of a closed day counts in the oldest open window, under its own day
    effective = F.when(on_time, F.col(ts_col).cast("timestamp_ntz")).otherwise(_ntz(open_from))
    rows = _source(spark, source_dir, schema).select(
        F.to_timestamp(effective).alias(_WM), day.alias("day"), F.col(group_col),
        F.col(value_col).alias("_value"), F.coalesce(~on_time, F.lit(True)).alias("_late"))
    counted = (rows.withWatermark(_WM, delay)
               .groupBy(F.window(_WM, "1 day").alias("_w"), "day", group_col, "_late")
               .agg(F.count(F.lit(1)).alias("n_events"), F.sum("_value").alias("value_sum")))

    def upsert(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()  # a row a changed (day, group)
        try:
            fresh = batch.where("NOT _late").select("day", group_col, *REPORT)
            load.upsert_partitions(fresh, target, ["day", group_col], "day")
            late = batch.where("_late").select(F.to_date("_w.start").alias("found_on"), "day", group_col, *REPORT)
            load.upsert_partitions(late, late_target, ["found_on", "day", group_col], "found_on")
        finally:
            batch.unpersist()

    return _run(counted.writeStream.outputMode("update").foreachBatch(upsert), checkpoint)


def whole_report(spark: SparkSession, target: str, late_target: str, group_col: str) -> DataFrame:
    """The report of every day: on-time figures plus those of late rows."""
    parts = [spark.read.parquet(p).select(F.col("day").cast("date").alias("day"), group_col, *REPORT)
             for p in (target, late_target) if fs.has_data_files(spark, p)]
    both = parts[0].unionByName(parts[1]) if len(parts) > 1 else parts[0]
    return both.groupBy("day", group_col).agg(
        F.sum("n_events").alias("n_events"), F.round(F.sum("value_sum"), 4).alias("value_sum"))


# ------------------------------------------------------------------- first copies

def _same(left: DataFrame, right: DataFrame, keys: list[str]):
    """Equal keys, NULL among them (as ``dropDuplicates`` has it)."""
    condition = F.lit(True)
    for k in keys:
        condition = condition & left[k].eqNullSafe(right[k])
    return condition


def dedup_state(spark: SparkSession, source_dir: str, target: str, checkpoint: str,
                schema: StructType, keys: list[str], ts_col: str, delay: str) -> StreamingQuery:
    """One run that adds to ``target`` one row of each key not yet there.

    Rows younger than the watermark are compared with the keys in the state
    store, which forgets a key once the watermark passes its time by ``delay``.
    Older rows, and rows without a time, are compared with each other and with
    the sink.  Copies of a record share its time; a copy that claims a later
    time than ``delay`` after the first is a record of its own.

    ``target`` is partitioned by ``kind`` (on_time, late) and ``batch``; a
    repeated batch replaces its own partitions."""
    mark = _ntz(watermark(spark, checkpoint))
    source = _source(spark, source_dir, schema)
    late = F.col(ts_col).isNull() | (F.col(ts_col).cast("timestamp_ntz") <= mark)
    fresh = (_event_time(source.where(~late), ts_col).withWatermark(_WM, delay)
             .dropDuplicatesWithinWatermark(keys).drop(_WM).withColumn("_late", F.lit(False)))
    stream = fresh.unionByName(source.where(late).withColumn("_late", F.lit(True)))
    columns = [f.name for f in schema.fields]

    def settle(batch: DataFrame, batch_id: int) -> None:
        def write(rows: DataFrame, kind: str) -> None:
            rows.write.mode("overwrite").parquet(f"{target}/kind={kind}/batch={batch_id}")

        batch = batch.persist()
        try:
            write(batch.where("NOT _late").select(*columns), "on_time")
            old = batch.where("_late").select(*columns).dropDuplicates(keys)
            sink = (spark.read.schema(_with_partitions(schema)).parquet(target)
                    .where(~((F.col("kind") == "late") & (F.col("batch") == str(batch_id)))).select(*keys))
            wanted = old.select(*keys)
            seen = sink.join(wanted, _same(sink, wanted, keys), "left_semi").distinct()
            write(old.join(seen, _same(old, seen, keys), "left_anti"), "late")
        finally:
            batch.unpersist()

    return _run(stream.writeStream.foreachBatch(settle), checkpoint)


def _with_partitions(schema: StructType) -> StructType:
    return StructType([*schema.fields, StructField("kind", StringType()), StructField("batch", StringType())])


def read_deduplicated(spark: SparkSession, target: str, schema: StructType) -> DataFrame:
    return spark.read.schema(_with_partitions(schema)).parquet(target).drop("kind", "batch")
