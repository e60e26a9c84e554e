"""Incremental ingest with Structured Streaming.

* ``ingest_files``: pick up only files not seen before (the checkpoint holds
  the file log), append them to a parquet sink with exactly-once commits.
* ``dedup_stream``: the same, dropping re-delivered records whose key was
  already seen.
* ``daily_report_stream``: per-day aggregates kept current in a table; the
  days that a micro-batch touches are recomputed from the source, so events
  may arrive as late as they like.

All runs use ``trigger(availableNow=True)``: process what is there, then
stop, so a scheduler can start the same job again and it resumes from its
checkpoint.  Checkpoints live in the shared scratch folder.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ridelake.operators import load

_WM = "_event_time"


def _source(spark: SparkSession, source_dir: str, schema: StructType,
            max_files: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(source_dir)


def _run(writer, checkpoint: str, target: str | None = None):
    w = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    q = w.start(target) if target else w.start()
    q.awaitTermination()
    if q.exception():
        raise RuntimeError(str(q.exception()))
    return q


def ingest_files(spark: SparkSession, source_dir: str, target: str, checkpoint: str,
                 schema: StructType) -> None:
    stream = _source(spark, source_dir, schema)
    _run(stream.writeStream.format("parquet").outputMode("append"), checkpoint, target)


def _event_time(df: DataFrame, ts_col: str) -> DataFrame:
    # watermarks need a zone-aware timestamp; the session zone is UTC
    return df.withColumn(_WM, F.col(ts_col).cast("timestamp"))


def dedup_stream(spark: SparkSession, source_dir: str, target: str, checkpoint: str,
                 schema: StructType, keys: list[str], ts_col: str,
                 delay: str | None = None) -> None:
    """First copy of each key wins, however late it arrives: the state keeps
    every key seen.  With ``delay`` the state of a key is dropped once the
    watermark passes its event time plus ``delay``; records older than the
    watermark are then discarded, first copies among them."""
    source = _source(spark, source_dir, schema)
    if delay is None:
        stream = source.dropDuplicates(keys)
    else:
        stream = (_event_time(source, ts_col).withWatermark(_WM, delay)
                  .dropDuplicatesWithinWatermark(keys).drop(_WM))
    _run(stream.writeStream.format("parquet").outputMode("append"), checkpoint, target)


def daily_report(events: DataFrame, ts_col: str, group_col: str, value_col: str) -> DataFrame:
    """Count and sum per day and group."""
    return (events.groupBy(F.to_date(ts_col).alias("day"), group_col)
            .agg(F.count(F.lit(1)).alias("n_events"), F.round(F.sum(value_col), 4).alias("value_sum")))


def daily_report_stream(spark: SparkSession, source_dir: str, target: str, checkpoint: str,
                        schema: StructType, ts_col: str, group_col: str, value_col: str) -> None:
    """The report of every day, in a table partitioned by day.  Each
    micro-batch names the days it touches; those days are recomputed from all
    files delivered so far and replaced, so no event is too late and a repeated
    batch changes nothing."""
    def refresh(batch: DataFrame, batch_id: int) -> None:
        # one value a day
        days = [r[0] for r in batch.select(F.to_date(ts_col)).distinct().collect()]
        if not days:
            return
        events = spark.read.schema(schema).parquet(source_dir)
        known = [d for d in days if d is not None]
        touched = F.to_date(ts_col).isin(known)
        if None in days:
            touched = touched | F.col(ts_col).isNull()
        if known:  # a range that reaches the scan; days between are not recomputed
            span = (F.col(ts_col) >= F.lit(min(known))) & (
                F.col(ts_col) < F.lit(max(known) + dt.timedelta(days=1)))
            events = events.where(span | F.col(ts_col).isNull())
        load.replace_partitions(daily_report(events.where(touched), ts_col, group_col, value_col),
                                target, "day", days)

    _run(_source(spark, source_dir, schema).writeStream.foreachBatch(refresh), checkpoint)
