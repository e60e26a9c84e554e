"""File readers and file plans.

Readers return lazy DataFrames.  Driver-side work is limited to metadata:
listing paths, reading one footer schema per file group, and checking
which planned files exist; rows are only ever read by executors.
"""

from __future__ import annotations

import datetime as dt
import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ByteType,
    DataType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    ShortType,
    StructType,
)

from ridelake.functions.time import parse_day
from ridelake.sources import fs

log = logging.getLogger(__name__)


def read_parquet(spark: SparkSession, *paths: str, columns: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(*paths)
    return df.select(*columns) if columns else df


def read_parquet_v2(spark: SparkSession, *paths: str) -> DataFrame:
    """Parquet through the DataSource V2 scan, which can answer aggregates
    from footers (``spark.sql.parquet.aggregatePushdown``)."""
    key = "spark.sql.sources.useV1SourceList"
    old = spark.conf.get(key)
    spark.conf.set(key, ",".join(x for x in old.split(",") if x.strip() != "parquet"))
    try:
        return spark.read.parquet(*paths)
    finally:
        spark.conf.set(key, old)


def metadata_count(spark: SparkSession, *paths: str) -> DataFrame:
    """``count(*)`` answered from parquet footers: the scan plans as
    ``PushedAggregation: [COUNT(*)]`` and reads no column data."""
    spark.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return read_parquet_v2(spark, *paths).selectExpr("count(*) AS row_count")


_SCHEMAS: dict[str, StructType] = {}


def read_input(spark: SparkSession, path: str) -> DataFrame:
    """Read an immutable input table.  Its footer schema is looked up once per
    process and then passed explicitly, so later reads start no schema
    inference job."""
    schema = _SCHEMAS.get(path)
    if schema is None:
        schema = spark.read.parquet(path).schema
        _SCHEMAS[path] = schema
    return spark.read.schema(schema).parquet(path)


def read_csv(spark: SparkSession, *paths: str, schema: StructType | str | None = None,
             header: bool = True, infer: bool = False, repartition: int | None = None,
             **options) -> DataFrame:
    """CSV with a header.  A declared schema is the production path; ``infer``
    is for exploration only (it costs an extra pass over the data).

    Compressed files (``.gz``) are read whole by one task each because gzip
    is not splittable; ``repartition`` spreads their rows afterwards.
    """
    reader = spark.read.option("header", header)
    if schema is not None:
        reader = reader.schema(schema)
    elif infer:
        reader = reader.option("inferSchema", True)
    for k, v in options.items():
        reader = reader.option(k, v)
    df = reader.csv(list(paths))
    return df.repartition(repartition) if repartition else df


# --- union by name ---------------------------------------------------------

_INTEGRAL_RANK = {ByteType: 1, ShortType: 2, IntegerType: 3, LongType: 4}


def widest(a: DataType, b: DataType) -> DataType:
    """Common type of two column types: integral widths widen, an integral
    meets a float as double, a decimal meets a float as double; text and
    numbers do not mix."""
    if a == b:
        return a
    ta, tb = type(a), type(b)
    if ta in _INTEGRAL_RANK and tb in _INTEGRAL_RANK:
        return a if _INTEGRAL_RANK[ta] >= _INTEGRAL_RANK[tb] else b
    numeric = (*_INTEGRAL_RANK, FloatType, DoubleType, DecimalType)
    if ta in numeric and tb in numeric:
        if DecimalType in (ta, tb) and not ({ta, tb} & {FloatType, DoubleType}):
            dec = a if ta is DecimalType else b
            return DecimalType(38, dec.scale)
        return DoubleType()
    raise TypeError(f"cannot union columns of types {a.simpleString()} and {b.simpleString()}")


def list_files(spark: SparkSession, path: str, suffix: str = ".parquet") -> list[str]:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fsys = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fsys.isFile(hpath):
        return [path]
    out = []
    it = fsys.listFiles(hpath, True)
    while it.hasNext():
        p = it.next().getPath()
        name = p.getName()
        if name.endswith(suffix) and not name.startswith(("_", ".")):
            out.append(p.toString())
    return sorted(out)


def read_union_by_name(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Read files whose schemas differ and stack them by column name.

    Footers are read by executors (one job for all files); files are grouped
    by schema, each group is one scan with that schema, every column
    is cast to the widest type seen, and columns a group lacks are NULL.
    Column names match case-insensitively (the first spelling seen wins).
    """
    from ridelake.sources.footers import schema_groups

    groups = schema_groups(spark, paths)
    if not groups:
        raise FileNotFoundError(f"no parquet files under {paths}")
    target: dict[str, DataType] = {}
    spelling: dict[str, str] = {}
    for schema, _ in groups:
        for field in schema.fields:
            k = field.name.lower()
            spelling.setdefault(k, field.name)
            target[k] = widest(target[k], field.dataType) if k in target else field.dataType
    frames = []
    for schema, own in groups:
        df = spark.read.schema(schema).parquet(*own)
        have = {c.lower(): c for c in df.columns}
        frames.append(df.select(*[
            (F.col(have[k]).cast(t) if k in have else F.lit(None).cast(t)).alias(spelling[k])
            for k, t in target.items()]))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def external_table(spark: SparkSession, name: str, location: str, fmt: str = "parquet",
                   glob: str | None = "*.parquet") -> DataFrame:
    """A catalog table that points at files in place (no copy)."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    opts = {"pathGlobFilter": glob} if glob else {}
    spark.catalog.createTable(name, path=location, source=fmt, **opts)
    return spark.table(name)


# --- period file plans -----------------------------------------------------

def month_starts(start, end) -> list[dt.date]:
    """First day of every month that has a day in [first of ``start``'s month, ``end``)."""
    first, last = parse_day(start), parse_day(end) - dt.timedelta(days=1)
    months = range(first.year * 12 + first.month - 1, last.year * 12 + last.month)
    return [dt.date(m // 12, m % 12 + 1, 1) for m in months]


def month_paths(start, end, types: list[str], pattern: str) -> list[tuple[str, dt.date, str]]:
    """(type, month, path) for every month of the window and every type.

    ``pattern`` uses ``{type}``, ``{year}`` and ``{month}`` (zero padded).
    """
    return [(t, m, pattern.format(type=t, year=m.year, month=f"{m.month:02d}"))
            for m in month_starts(start, end) for t in types]


def present(spark: SparkSession, paths: list[str]) -> set[str]:
    """The subset of ``paths`` that exist, from one listing per parent
    folder (one call per folder instead of one per planned path)."""
    by_parent: dict[str, list[str]] = {}
    for p in paths:
        parent, _, name = p.rstrip("/").rpartition("/")
        by_parent.setdefault(parent, []).append(p)
    found = set()
    for parent, children in by_parent.items():
        names = set(fs.list_names(spark, parent))
        found.update(c for c in children if c.rstrip("/").rpartition("/")[2] in names)
    return found


def listed_folders(spark: SparkSession, root: str, suffix: str = ".parquet") -> DataFrame:
    """(folder) of every data file below ``root``; Spark's file index lists
    them, and an absent root has none."""
    if not fs.exists(spark, root):
        return spark.createDataFrame([], "folder string")
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True)
             .option("pathGlobFilter", f"*{suffix}").load(root))
    return files.select(F.regexp_replace("path", "/[^/]*$", "").alias("folder")).distinct()


def month_plan(spark: SparkSession, start, end, types: list[str], pattern: str) -> DataFrame:
    """The file plan as a DataFrame with an ``exists`` flag per path: months
    made by Spark from the window, joined to one listing of the folder above
    the first placeholder.

    Only the window's ends and the types come from the driver."""
    root = pattern.partition("{")[0].rpartition("/")[0]
    first, last = parse_day(start).replace(day=1), parse_day(end) - dt.timedelta(days=1)
    months = spark.range(1).select(F.explode(F.when(
        F.lit(first) <= F.lit(last), F.sequence(F.lit(first), F.lit(last), F.expr("INTERVAL 1 MONTH")))).alias("month"))
    planned = months.select(F.explode(F.array(*map(F.lit, types))).alias("taxi_type"), "month")
    path = F.lit(pattern)
    for name, value in (("type", F.col("taxi_type")), ("year", F.date_format("month", "yyyy")),
                        ("month", F.date_format("month", "MM"))):
        path = F.replace(path, F.lit(f"{{{name}}}"), value)
    planned = planned.withColumn("path", path)
    # a listed folder is qualified with its file system: compare what lies below the root
    below = F.substring_index("folder", fs.plain_path(spark, root), -1)
    have = listed_folders(spark, root).select(F.concat(F.lit(root), below).alias("path"), F.lit(True).alias("_there"))
    return (planned.join(have, "path", "left")
            .select("taxi_type", "month", "path", F.coalesce("_there", F.lit(False)).alias("exists")))


def existing(spark: SparkSession, paths: list[str]) -> list[str]:
    """Only the paths that exist; absent ones are reported and skipped."""
    have = present(spark, paths)
    for p in paths:
        if p not in have:
            log.info("skipping missing file: %s", p)
    return [p for p in paths if p in have]


def read_seed(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """A small CSV lookup with declared columns."""
    return spark.read.option("header", True).schema(schema).csv(path)


def file_inventory(spark: SparkSession, path: str) -> DataFrame:
    """Per text file: size on disk, physical lines and data rows (lines - 1).

    Counted by executors from the file's own lines, grouped by file.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_size").alias("file_size"),
        (F.octet_length("value") + 1).alias("line_bytes"))
    return (lines.groupBy("file_path")
            .agg(F.max("file_size").alias("file_size"),
                 F.count(F.lit(1)).alias("lines"),
                 (F.count(F.lit(1)) - 1).alias("rows"),
                 F.sum("line_bytes").alias("text_bytes")))
