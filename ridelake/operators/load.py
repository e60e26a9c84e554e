"""Load strategies for parquet tables (a folder, optionally partitioned).

Plain parquet has no DELETE or MERGE, so the row-level strategies write the
new content of the partitions they touch, once, to a fresh folder in their
final layout, and then put those partition folders in place of the old ones
by renaming; the old ones are deleted last.  A failure before the renames
leaves the target as it was; a re-run with the same inputs gives the same
table.  Keys compare as in SQL: a NULL key equals nothing.
"""

from __future__ import annotations

import datetime as dt
import re
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ridelake.functions.time import in_window
from ridelake.sources import fs
from ridelake.sources.files import list_files, month_starts


def _writer(df: DataFrame, mode: str, partition_by: list[str] | None, dynamic: bool = False):
    if partition_by:
        # rows of one partition value go to few tasks (few files per folder);
        # AQE splits a skewed value over several tasks and merges small ones
        df = df.hint("rebalance", *partition_by)
    w = df.write.mode(mode)
    if mode == "overwrite":
        w = w.option("partitionOverwriteMode", "dynamic" if dynamic else "static")
    if partition_by:
        w = w.partitionBy(*partition_by)
    return w


def append(df: DataFrame, target: str, partition_by: list[str] | None = None,
           clustered: bool = False) -> None:
    """Add rows.  ``clustered``: each task of ``df`` holds few partition values
    already (files read from folders of one value), so no row is exchanged."""
    if clustered and partition_by:
        df.write.mode("append").partitionBy(*partition_by).parquet(target)
    else:
        _writer(df, "append", partition_by).parquet(target)


def _replace_folder(spark: SparkSession, new: str, path: str, backup: str) -> None:
    """Put ``new`` in the place of ``path``; if that fails, ``path`` is put back."""
    had = fs.exists(spark, path)
    if had and not fs.rename(spark, path, backup):
        raise OSError(f"cannot move {path} aside")
    if not fs.rename(spark, new, path):
        if had:
            fs.rename(spark, backup, path)
        raise OSError(f"cannot move {new} to {path}")


def full_refresh(df: DataFrame, target: str, partition_by: list[str] | None = None) -> None:
    """Replace the whole table (truncate+insert / create+replace).  The new
    content is written once, beside the target, so ``df`` may itself read the
    target, and a failed write leaves it untouched."""
    spark = df.sparkSession
    stage, backup = _beside(target, "new"), _beside(target, "old")
    _writer(df, "overwrite", partition_by).parquet(stage)
    _replace_folder(spark, stage, target, backup)
    fs.delete(spark, backup)


def _beside(target: str, what: str) -> str:
    """A fresh hidden folder on the target's file system."""
    parent, _, name = target.rstrip("/").rpartition("/")
    return f"{parent}/_{name}-{what}-{uuid.uuid4().hex[:12]}"


#: Characters that are written as %XX in partition folder names: fixed values.
_ESCAPED = set("\"#%'*/:=?\\{[]^\x7f") | {chr(c) for c in range(1, 32)}
_NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


def partition_folder(column: str, value) -> str:
    """Folder name of a partition value; NULL and '' share one folder."""
    text = "" if value is None else str(value)
    if not text:
        return f"{column}={_NULL_FOLDER}"
    return f"{column}=" + "".join(f"%{ord(c):02X}" if c in _ESCAPED else c for c in text)


def read_target(spark: SparkSession, target: str, like: DataFrame,
                partition_col: str | None = None) -> DataFrame:
    """The table at ``target``, its partition column in the type that ``like``
    declares (folder names alone would be guessed: '007' as 7)."""
    schema = spark.read.parquet(target).schema
    if partition_col:
        declared = like.schema[partition_col].dataType
        schema = StructType([StructField(f.name, declared, True) if f.name == partition_col else f
                             for f in schema.fields])
    return spark.read.schema(schema).parquet(target)


def _in_partitions(partition_col: str, values: list) -> Column:
    """Rows of the partitions ``values``, NULL among them."""
    some = F.col(partition_col).isin([v for v in values if v is not None])
    return some | F.col(partition_col).isNull() if None in values else some


def _swap_partitions(spark: SparkSession, content: DataFrame, target: str, partition_col: str,
                     affected: list) -> None:
    """Write ``content`` once, then replace the ``affected`` partitions of
    ``target`` with its partitions; those that end up empty are removed."""
    stage, backup = _beside(target, "new"), _beside(target, "old")
    _writer(content, "overwrite", [partition_col]).parquet(stage)
    fs.mkdirs(spark, backup)
    present = {n for n in fs.list_dirs(spark, stage) if n.startswith(f"{partition_col}=")}
    for name in sorted(present | {partition_folder(partition_col, v) for v in affected}):
        if name in present:
            _replace_folder(spark, f"{stage}/{name}", f"{target}/{name}", f"{backup}/{name}")
        elif fs.exists(spark, f"{target}/{name}"):
            fs.rename(spark, f"{target}/{name}", f"{backup}/{name}")
    fs.delete(spark, backup)
    fs.delete(spark, stage)
    spark.catalog.refreshByPath(target)


def replace_partitions(new: DataFrame, target: str, partition_col: str, values: list) -> None:
    """Replace the partitions ``values`` by the rows of ``new``, all of which
    lie in them."""
    spark = new.sparkSession
    if not fs.has_data_files(spark, target):
        _writer(new, "append", [partition_col]).parquet(target)
        return
    _swap_partitions(spark, new, target, partition_col, values)


def upsert_partitions(new: DataFrame, target: str, keys: list[str], partition_col: str) -> None:
    """Replace the rows whose ``keys`` (which include the partition column)
    occur in ``new`` by those of ``new``.  NULL matches NULL.  Only partitions
    that ``new`` has rows in are read and rewritten."""
    spark = new.sparkSession
    if not fs.has_data_files(spark, target):
        if not new.isEmpty():
            _writer(new, "append", [partition_col]).parquet(target)
        return
    # one value a touched partition
    values = [r[0] for r in new.select(partition_col).distinct().collect()]
    if not values:
        return
    old = read_target(spark, target, new, partition_col).filter(_in_partitions(partition_col, values))
    match = reduce(lambda x, y: x & y, [old[k].eqNullSafe(new[k]) for k in keys])
    kept = old.join(new.select(*keys), match, "left_anti")
    _swap_partitions(spark, kept.unionByName(new.select(*old.columns)), target, partition_col, values)


def _key_window(key: str, start, end, granularity: str) -> Column:
    if granularity == "timestamp":
        return in_window(key, start, end)
    if granularity == "date":
        s, e = _as_dt(start), _as_dt(end)
        if s.time() != dt.time(0) or e.time() != dt.time(0):
            raise ValueError("a date-granular window must start and end at midnight")
        return (F.col(key) >= F.lit(s.date())) & (F.col(key) < F.lit(e.date()))
    raise ValueError(f"unknown granularity {granularity}")


def _as_dt(v) -> dt.datetime:
    if isinstance(v, dt.datetime):
        return v
    if isinstance(v, dt.date):
        return dt.datetime(v.year, v.month, v.day)
    return dt.datetime.fromisoformat(str(v))


def window_months(start, end) -> list[dt.date]:
    """Month partitions a half-open window [start, end) touches."""
    e = _as_dt(end)
    last = (e - dt.timedelta(microseconds=1)).date()
    return [m for m in month_starts(_as_dt(start).date(), last + dt.timedelta(days=1))]


def time_interval(new: DataFrame, target: str, key: str, start, end,
                  partition_col: str, granularity: str = "timestamp") -> None:
    """Delete target rows whose ``key`` is in [start, end) and insert the rows
    of ``new`` in that window.  ``partition_col`` holds the first day of the
    month of ``key``; only the months the window touches are read and
    rewritten.  Rows with a NULL key are never in a window."""
    spark = new.sparkSession
    in_win = _key_window(key, start, end, granularity)
    months = window_months(start, end)
    incoming = new.filter(in_win)
    if not fs.has_data_files(spark, target):
        _writer(incoming, "append", [partition_col]).parquet(target)
        return
    old = read_target(spark, target, new, partition_col).filter(
        _in_partitions(partition_col, months))
    kept = old.filter(~in_win | F.col(key).isNull())
    staged = kept.unionByName(incoming.select(*old.columns))
    _swap_partitions(spark, staged, target, partition_col, months)


def _affected_values(new: DataFrame, old: DataFrame, keys: list[str], partition_col: str) -> list:
    """Partitions that hold new rows, or old rows whose key is among the new
    ones (a key may have moved): one value a partition, bounded by their number."""
    stale = old.select(*dict.fromkeys([*keys, partition_col])).join(
        new.select(*keys).distinct(), keys, "left_semi").select(partition_col)
    touched = new.select(partition_col).unionByName(stale).distinct()
    return list(dict.fromkeys(None if r[0] == "" else r[0] for r in touched.collect()))


def _upsert(new: DataFrame, target: str, keys: list[str], partition_col: str | None, combine) -> None:
    """Replace what ``combine(old, new)`` may change of the target by its result."""
    spark = new.sparkSession
    if not fs.has_data_files(spark, target):
        _writer(new, "append", [partition_col] if partition_col else None).parquet(target)
        return
    old = read_target(spark, target, new, partition_col)
    if not partition_col:
        full_refresh(combine(old, new.select(*old.columns)), target)
        return
    affected = _affected_values(new, old, keys, partition_col)
    held = old.filter(_in_partitions(partition_col, affected))
    _swap_partitions(spark, combine(held, new.select(*old.columns)), target, partition_col, affected)


def delete_insert(new: DataFrame, target: str, keys: list[str],
                  partition_col: str | None = None) -> None:
    """Remove every target row whose key values occur in ``new``, whatever its
    partition, then insert ``new``.  A NULL key occurs nowhere.  With
    ``partition_col`` only the partitions that hold such rows, or get new ones,
    are rewritten."""
    _upsert(new, target, keys, partition_col, lambda old, rows: old.join(
        rows.select(*keys).distinct(), keys, "left_anti").unionByName(rows))


def merge(new: DataFrame, target: str, keys: list[str], partition_col: str | None = None,
          update_columns: list[str] | None = None, check_keys: bool = True) -> None:
    """Upsert on a primary key: matched rows are updated (all columns, or only
    ``update_columns``), unmatched source rows are inserted, and target rows
    without a match (a NULL key has none) stay as they are.  An update may move
    a row to another partition.  The source key must be unique, as for a SQL
    MERGE; ``check_keys=False`` skips that check for sources unique by
    construction (e.g. grouped on the key)."""
    if check_keys:
        dup = new.dropna(subset=keys).groupBy(*keys).count().filter(F.col("count") > 1)
        if not dup.isEmpty():
            raise ValueError(f"merge source has repeated keys {keys}")

    def combine(old: DataFrame, rows: DataFrame) -> DataFrame:
        if update_columns is None:
            return old.join(rows.select(*keys), keys, "left_anti").unionByName(rows)
        o = old.withColumn("_old", F.lit(True)).alias("o")
        n = rows.withColumn("_new", F.lit(True)).alias("n")
        joined = o.join(n, [F.col(f"o.{k}") == F.col(f"n.{k}") for k in keys], "full_outer")

        def value(c: str) -> Column:
            # an update takes the new value, an insert all of them, the rest is old
            takes = F.col("n._new") if c in update_columns else F.col("o._old").isNull()
            return F.when(takes, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c)

        return joined.select(*[value(c) for c in old.columns])

    _upsert(new, target, keys, partition_col, combine)


def as_view(df: DataFrame, name: str) -> DataFrame:
    """View materialisation: a name for the plan, recomputed on each use."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def replace_table(df: DataFrame, name: str, location: str, analyze: bool = True) -> DataFrame:
    """``CREATE OR REPLACE TABLE name AS SELECT``, stored at ``location``.
    With ``analyze`` the table's size and row count are recorded for the
    cost-based optimizer (a materialised table has statistics, files alone
    only have sizes)."""
    spark = df.sparkSession
    df.write.mode("overwrite").option("path", location).saveAsTable(name)
    if analyze:
        spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS")
    return spark.table(name)


def write_partitioned(df: DataFrame, target: str, ts_col: str, cluster_cols: list[str],
                      granularity: str = "day", files: int | None = None) -> str:
    """Partition by the day (or month) of ``ts_col`` and cluster by
    ``cluster_cols`` inside each file.

    A rebalance on the partition column keeps each day in few files (AQE
    splits a skewed day over several tasks), and sorting inside each task by
    the cluster columns gives row groups whose min/max statistics let
    filters on those columns skip data.  ``files`` forces a file count per
    write instead.  Returns the name of the partition column.
    """
    part = f"{ts_col}_{granularity}"
    expr = F.to_date(ts_col) if granularity == "day" else F.trunc(ts_col, "month")
    out = df.withColumn(part, expr)
    out = out.repartition(files, part) if files else out.hint("rebalance", part)
    out = out.sortWithinPartitions(part, *cluster_cols)
    out.write.mode("overwrite").option("partitionOverwriteMode", "static") \
        .partitionBy(part).parquet(target)
    return part


def file_stats(spark: SparkSession, path: str) -> DataFrame:
    """Files, rows and mean file size (MiB) of a parquet folder."""
    files = (spark.read.parquet(path)
             .select(F.col("_metadata.file_path").alias("f"),
                     F.col("_metadata.file_size").alias("size"))
             .groupBy("f").agg(F.count(F.lit(1)).alias("rows"), F.max("size").alias("size")))
    return files.agg(F.count(F.lit(1)).alias("num_files"),
                     F.sum("rows").cast("bigint").alias("total_rows"),
                     F.round(F.avg("size") / (1024 * 1024), 4).alias("avg_file_mb"))


def repartition_write(df: DataFrame, target: str, n: int) -> DataFrame:
    """Write ``df`` as ``n`` files (fewer only if it has fewer rows).

    The rows are stored first, by as many tasks as compute them, and the stored
    files are then joined in ``n`` tasks: these read a share of the compressed
    columns, not of shuffled rows, which are several times larger.  Rows whose
    files do not split into ``n`` parts with rows are dealt out by a shuffle."""
    spark = df.sparkSession
    stage = _beside(target, "new")
    df.write.parquet(stage)
    stored = spark.read.schema(df.schema).parquet(stage)
    if stored.rdd.getNumPartitions() >= n:
        stored.coalesce(n).write.mode("overwrite").parquet(target)
        if file_stats(spark, target).first()["num_files"] == n:
            fs.delete(spark, stage)
            return file_stats(spark, target)
    stored.repartition(n).write.mode("overwrite").parquet(target)
    fs.delete(spark, stage)
    return file_stats(spark, target)


_STEM = re.compile(r"\.csv(\.gz)?$")


def csv_to_parquet(spark: SparkSession, inputs: str, out_dir: str, schema,
                   remove_source: bool = False) -> list[str]:
    """Convert every CSV(.gz) under ``inputs`` that has no output yet into
    parquet under ``out_dir/source=<path below inputs, without the ending>``;
    all pending files are read by one scan.  What is done is read from the
    output's data, so file names may hold any character.  Returns the converted
    sources."""
    files = list_files(spark, inputs, suffix=".csv.gz") + list_files(spark, inputs, suffix=".csv")
    root = fs.plain_path(spark, inputs).rstrip("/") + "/"
    source = {f: _STEM.sub("", fs.plain_path(spark, f).removeprefix(root)) for f in files}
    done = set()
    if fs.has_data_files(spark, out_dir):
        fields = spark.createDataFrame([], schema).schema.fields
        out_schema = StructType([*fields, StructField("source", StringType())])
        # one value a converted file
        done = {r[0] for r in spark.read.schema(out_schema).parquet(out_dir)
                .select("source").distinct().collect()}
    pending = [f for f in files if source[f] not in done]
    if not pending:
        return []
    path = F.url_decode(F.replace("_metadata.file_path", F.lit("+"), F.lit("%2B")))
    below = F.substring_index(path, root, -1)  # file paths come percent-encoded
    df = (spark.read.option("header", True).schema(schema).csv([glob_escaped(f) for f in pending])
          .withColumn("source", F.regexp_replace(below, r"\.csv(\.gz)?$", "")))
    df.write.mode("append").partitionBy("source").parquet(out_dir)
    if remove_source:
        for f in pending:
            fs.delete(spark, f)
    return [source[f] for f in pending]


def glob_escaped(path: str) -> str:
    """A path in which no character is read as a pattern."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


def write_bucketed(df: DataFrame, name: str, location: str, buckets: int,
                   key_cols: list[str], sort_cols: list[str] | None = None,
                   partition_by: list[str] | None = None) -> DataFrame:
    """A catalog table bucketed (and sorted) on ``key_cols``: later joins and
    aggregations of two tables bucketed the same way on the same key read
    co-located buckets without a shuffle.  ``partition_by`` adds folders, each
    with its own buckets; rows are dealt by bucket key first, so a task writes
    one file a folder and bucket."""
    out = df.repartition(buckets, *key_cols) if partition_by else df
    w = out.write.mode("overwrite").option("path", location)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.bucketBy(buckets, *key_cols).sortBy(*(sort_cols or key_cols)).saveAsTable(name)
    return df.sparkSession.table(name)
