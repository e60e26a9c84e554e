"""Registered streaming queries over the events table.

The events are delivered to a landing folder in two batches split by event
time; the stream runs after each delivery and the sink is returned.  Dedup and
report get the later half first, so that the second delivery is older than
any watermark.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ridelake.plans import tables as tb
from ridelake.session import scratch_path
from ridelake.streaming import convert
from ridelake.streaming import ingest as st
from ridelake.streaming import pages
from ridelake.streaming import state as sst

SPLIT_TS = "2024-01-16 00:00:00"
REDELIVERED_TYPE = "error"
EARLY_TS, LATE_TS = "2024-01-11 00:00:00", "2024-01-21 00:00:00"
CSV_SPLIT = "1998-01-01 00:00:00"
STATE_DELAY = "2 days"
PAGE_SIZE = 500


def _deliver(df, folder: str) -> None:
    df.write.mode("append").parquet(folder)


def _batches(spark, sf):
    ev = tb.table(spark, sf, "events")
    split = F.lit(SPLIT_TS).cast("timestamp_ntz")
    return ev, ev.filter(F.col("ts") < split), ev.filter(F.col("ts") >= split)


def q_stream_ingest(spark, sf):
    ev, first, second = _batches(spark, sf)
    src, out, ckpt = (scratch_path(spark, n) for n in ("evsrc", "evout", "evckpt"))
    _deliver(first, src)
    st.ingest_files(spark, src, out, ckpt, ev.schema)
    _deliver(second, src)
    st.ingest_files(spark, src, out, ckpt, ev.schema)
    st.ingest_files(spark, src, out, ckpt, ev.schema)  # nothing new: no change
    return spark.read.parquet(out)


def q_stream_dedup(spark, sf):
    """The later half, then the earlier half with all error events again."""
    ev, first, second = _batches(spark, sf)
    src, out, ckpt = (scratch_path(spark, n) for n in ("dupsrc", "dupout", "dupckpt"))
    _deliver(second, src)
    st.dedup_stream(spark, src, out, ckpt, ev.schema, ["event_id"], "ts")
    _deliver(first.unionByName(ev.filter(F.col("event_type") == REDELIVERED_TYPE)), src)
    st.dedup_stream(spark, src, out, ckpt, ev.schema, ["event_id"], "ts")
    return spark.read.parquet(out)


def q_stream_daily_report(spark, sf):
    ev, first, second = _batches(spark, sf)
    src, out, ckpt = (scratch_path(spark, n) for n in ("repsrc", "repout", "repckpt"))
    for batch in (second, first):
        _deliver(batch, src)
        st.daily_report_stream(spark, src, out, ckpt, ev.schema, "ts", "event_type", "value")
    return (spark.read.parquet(out)
            .select(F.col("day").cast("date").alias("day"), "event_type", "n_events", "value_sum"))


def _thirds(ev):
    """The events in three parts by time: early, middle, late."""
    lo, hi = (F.lit(t).cast("timestamp_ntz") for t in (EARLY_TS, LATE_TS))
    ts = F.col("ts")
    return [ev.where(ts < lo), ev.where((ts >= lo) & (ts < hi)), ev.where(ts >= hi)]


def q_stream_report_state(spark, sf):
    """The report by windowed state.  The middle third comes first, then the
    last one, then the first, whose days are closed by then."""
    ev = tb.table(spark, sf, "events")
    early, middle, late = _thirds(ev)
    src, out, later, ckpt = (scratch_path(spark, n) for n in ("wsrc", "wout", "wlate", "wckpt"))
    for batch in (middle, late, early):
        _deliver(batch, src)
        sst.daily_report_state(spark, src, out, later, ckpt, ev.schema, "ts", "event_type", "value", STATE_DELAY)
    return sst.whole_report(spark, out, later, "event_type")


def q_stream_dedup_state(spark, sf):
    """First copies under a bounded state: middle, last and first third, each
    after the middle one with all error events again."""
    ev = tb.table(spark, sf, "events")
    early, middle, late = _thirds(ev)
    again = ev.where(F.col("event_type") == REDELIVERED_TYPE)
    src, out, ckpt = (scratch_path(spark, n) for n in ("bsrc", "bout", "bckpt"))
    for batch in (middle, late.unionByName(again), early.unionByName(again)):
        _deliver(batch, src)
        sst.dedup_state(spark, src, out, ckpt, ev.schema, ["event_id"], "ts", STATE_DELAY)
    return sst.read_deduplicated(spark, out, ev.schema)


def q_csv_stream_to_parquet(spark, sf):
    """Gzip CSV files of orders in two deliveries; a run after each, and one
    with nothing new.  Finished files are archived."""
    orders = tb.table(spark, sf, "orders")
    src, out, ckpt, done = (scratch_path(spark, n) for n in ("cssrc", "csout", "csckpt", "csdone"))
    split = F.lit(CSV_SPLIT).cast("timestamp_ntz")
    for rows in (orders.where(F.col("o_orderdate") < split), orders.where(F.col("o_orderdate") >= split), None):
        if rows is not None:
            (rows.withColumn("o_year", F.year("o_orderdate")).hint("rebalance", "o_year").write.mode("append")
                 .partitionBy("o_year").option("header", True).option("compression", "gzip").csv(src))
        convert.csv_stream_to_parquet(spark, src, out, ckpt, orders.schema, archive_dir=done)
    return spark.read.parquet(out).drop("source")


def q_paged_json_stream(spark, sf):
    """Customers served as pages of 500 records, the later half of the pages
    after the first run; a run after each delivery, and one with nothing new."""
    cust = (tb.table(spark, sf, "customer")
            .withColumn("page", (F.col("c_custkey") / PAGE_SIZE).cast("long") + 1))
    half = (cust.agg(F.max("page")).first()[0] or 0) // 2
    src, out, ckpt = (scratch_path(spark, n) for n in ("pgsrc", "pgout", "pgckpt"))
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in cust.schema.fields if f.name != "page")
    for rows in (cust.where(F.col("page") <= half), cust.where(F.col("page") > half), None):
        if rows is not None:
            rows.hint("rebalance", "page").write.mode("append").partitionBy("page").json(src)
        pages.read_new_pages(spark, src + "/page={page}", ddl, out, ckpt)
    return spark.read.schema(ddl).parquet(out)


QUERIES = {
    "paged_json_stream": q_paged_json_stream,
    "csv_stream_to_parquet": q_csv_stream_to_parquet,
    "stream_report_state": q_stream_report_state,
    "stream_dedup_state": q_stream_dedup_state,
    "stream_ingest": q_stream_ingest,
    "stream_dedup": q_stream_dedup,
    "stream_daily_report": q_stream_daily_report,
}

_REPORT = """
        SELECT CAST(ts AS DATE) AS day, event_type, COUNT(*) AS n_events,
               ROUND(SUM(value), 4) AS value_sum
        FROM events GROUP BY 1, 2"""

ORACLE = {
    "paged_json_stream": "SELECT * FROM customer",
    "csv_stream_to_parquet": "SELECT * FROM orders",
    "stream_report_state": _REPORT,
    "stream_dedup_state": "SELECT * FROM events",
    "stream_ingest": "SELECT * FROM events",
    "stream_dedup": "SELECT * FROM events",
    "stream_daily_report": _REPORT,
}
