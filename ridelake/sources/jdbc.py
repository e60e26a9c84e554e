"""Database tables as sources and sinks over Spark's JDBC data source.

Reads are split into ``num_partitions`` range queries on a numeric, date or
timestamp column, so executors read in parallel instead of one task pulling
the whole table.  Writes go out in parallel batches from every task.

No query is registered for these: exercising them needs a database server
(or an embedded database that only the driver process could see), and this
repository starts neither.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, url: str, table_or_query: str,
               partition_column: str | None = None, lower_bound=None, upper_bound=None,
               num_partitions: int | None = None, fetch_size: int = 10_000,
               properties: dict[str, str] | None = None) -> DataFrame:
    """``table_or_query`` is a table name or a parenthesised subquery with an
    alias, e.g. ``"(select * from trips where ...) t"``."""
    reader = (spark.read.format("jdbc").option("url", url)
              .option("dbtable", table_or_query).option("fetchsize", fetch_size))
    if partition_column is not None:
        if None in (lower_bound, upper_bound, num_partitions):
            raise ValueError("a partitioned read needs lower_bound, upper_bound, num_partitions")
        reader = (reader.option("partitionColumn", partition_column)
                  .option("lowerBound", str(lower_bound)).option("upperBound", str(upper_bound))
                  .option("numPartitions", num_partitions))
    for k, v in (properties or {}).items():
        reader = reader.option(k, v)
    return reader.load()


def write_table(df: DataFrame, url: str, table: str, mode: str = "append",
                batch_size: int = 10_000, num_partitions: int | None = None,
                properties: dict[str, str] | None = None) -> None:
    """``mode``: ``append``, or ``overwrite`` to replace the table (with
    ``truncate`` in ``properties`` to keep its definition)."""
    writer = (df.write.format("jdbc").mode(mode).option("url", url)
              .option("dbtable", table).option("batchsize", batch_size))
    if num_partitions is not None:
        writer = writer.option("numPartitions", num_partitions)
    for k, v in (properties or {}).items():
        writer = writer.option(k, v)
    writer.save()
