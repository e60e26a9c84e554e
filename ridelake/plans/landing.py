"""Landing area of monthly raw files, written by Spark from the test tables.

Layout: ``{root}/taxi_type={type}/month={YYYY}-{MM}/part-*.parquet``, one
folder per (type, month) as a monthly source would deliver them; yellow
and green keep their own column names.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ridelake.operators.staging import empty_canonical, standardize
from ridelake.plans import tables as tb
from ridelake.session import scratch_path
from ridelake.sources import fs
from ridelake.sources.files import existing, month_paths
from ridelake.sources.footers import schema_groups

PATTERN = "{root}/taxi_type={type}/month={year}-{month}"
PICKUP = {"yellow": "tpep_pickup_datetime", "green": "lpep_pickup_datetime"}


#: Fixed drift of the yellow source: in one year the files of the first half
#: of each month lack the fee column, in another passenger counts are whole.
NO_FEE_YEAR, NO_FEE_BEFORE_DAY, WHOLE_COUNT_YEAR = 1996, 15, 1998


def build(spark: SparkSession, sf: str) -> str:
    """Write the monthly files of both types.  The yellow source changes its
    columns and types over the years, and within months, as files do."""
    root = scratch_path(spark, "landing")
    # all writes read the trip join: store it once, so none of them runs it again
    joined = scratch_path(spark, "landing-trips")
    t = tb.trips(spark, sf)
    t.write.parquet(joined)
    t = spark.read.schema(t.schema).parquet(joined)

    def write(raw: DataFrame, typ: str) -> None:
        (raw.withColumn("month", F.date_format(PICKUP[typ], "yyyy-MM"))
            .hint("rebalance", "month")
            .write.mode("append").partitionBy("month").parquet(f"{root}/taxi_type={typ}"))

    yellow, at = tb.yellow_raw(t), F.col(PICKUP["yellow"])
    kind = (F.when((F.year(at) == NO_FEE_YEAR) & (F.day(at) < NO_FEE_BEFORE_DAY), "no fee")
            .when(F.year(at) == WHOLE_COUNT_YEAR, "whole counts").otherwise("plain"))
    write(yellow.where(kind == "plain"), "yellow")
    write(yellow.where(kind == "no fee").drop("Airport_fee"), "yellow")
    write(yellow.where(kind == "whole counts")
          .withColumn("passenger_count", F.col("passenger_count").cast("long")), "yellow")
    write(tb.green_raw(t), "green")
    fs.delete(spark, joined)
    return root


def build_markers(spark: SparkSession, sf: str) -> str:
    """The landing folders with a marker file each, for questions about which
    files exist."""
    root = scratch_path(spark, "markers")
    t = tb.trips(spark, sf)
    (t.select("taxi_type", F.date_format("pickup_datetime", "yyyy-MM").alias("month")).distinct()
      .withColumn("marker", F.lit(1)).write.partitionBy("taxi_type", "month").parquet(root))
    return root


def pattern(root: str) -> str:
    return PATTERN.replace("{root}", root)


def _planned_months(spark: SparkSession, root: str, typ: str, start, end) -> list[str]:
    """Months of the window whose file exists for ``typ`` (missing ones are
    skipped), as the partition values of the landing folder."""
    planned = month_paths(start, end, [typ], pattern(root))
    have = set(existing(spark, [p for _, _, p in planned]))
    return [f"{m.year}-{m.month:02d}" for _, m, p in planned if p in have]


def _folder(root: str, typ: str, month: str) -> str:
    return f"{root}/taxi_type={typ}/month={month}"


def _by_schema(spark: SparkSession, root: str, typ: str,
               months: list[str]) -> list[tuple[StructType, list[str]]]:
    """The files of the months by their schema, one footer a file."""
    return schema_groups(spark, [_folder(root, typ, m) for m in months]) if months else []


def _read_files(spark: SparkSession, root: str, typ: str, schema: StructType, paths: list[str]) -> DataFrame:
    """Files of one schema, with the month of their folder."""
    full = StructType([*schema.fields, StructField("month", StringType())])
    return spark.read.schema(full).option("basePath", f"{root}/taxi_type={typ}").parquet(*paths)


def _read_months(spark: SparkSession, root: str, typ: str, months: list[str]) -> DataFrame:
    """One scan of the type's folder, pruned to ``months``; only the folder
    names are read."""
    return (spark.read.schema(StructType([StructField("month", StringType())]))
            .parquet(f"{root}/taxi_type={typ}").filter(F.col("month").isin(months)))


def ingest(spark: SparkSession, root: str, start, end, types: list[str],
           extracted_at: str) -> DataFrame:
    """Months of the window x types -> existing files -> one scan per type and
    schema of the files, each standardised by its own columns -> one stacked frame (empty
    but typed when no file)."""
    frames = []
    for typ in types:
        months = _planned_months(spark, root, typ, start, end)
        for schema, paths in _by_schema(spark, root, typ, months):
            frames.append(standardize(_read_files(spark, root, typ, schema, paths), typ, extracted_at))
    return reduce(DataFrame.unionByName, frames) if frames else empty_canonical(spark)


def read_counts(spark: SparkSession, root: str, start, end, types: list[str]) -> DataFrame:
    """Rows per (type, month) of all existing files in the window: one scan
    per type, the month taken from the folder name."""
    frames = [spark.createDataFrame([], "taxi_type string, month string")]
    for typ in types:
        months = _planned_months(spark, root, typ, start, end)
        if months:
            frames.append(_read_months(spark, root, typ, months).select(
                F.lit(typ).alias("taxi_type"), "month"))
    return (reduce(DataFrame.unionByName, frames)
            .groupBy("taxi_type", "month").agg(F.count(F.lit(1)).alias("rows")))
