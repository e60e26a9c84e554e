"""Checks that act: loads that take effect only if their checks pass, and a
split of a table into accepted and rejected rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ridelake.operators import checks as ck
from ridelake.operators import load
from ridelake.operators.joins import broadcast_limit, estimated_bytes
from ridelake.session import scratch_path
from ridelake.sources import fs


def checked_refresh(df: DataFrame, target: str, checks: list[ck.Check], table_name: str = "",
                    partition_by: list[str] | None = None) -> DataFrame:
    """Replace the table at ``target`` by ``df`` if all ``checks`` pass, else
    leave it as it was.  Returns one row a check, as ``run_checks``.

    Row-level checks are counted while the rows are written: ``df`` is computed
    once and nothing is read again for them.  They are counted in the tasks
    that write, so a lost executor's repeated work is not counted twice.
    ``unique`` and custom checks read what was written, before it takes
    effect."""
    spark = df.sparkSession
    stage, backup = load._beside(target, "new"), load._beside(target, "old")
    counted = [c for c in checks if c.name in ck.ROW_LEVEL]
    others = [c for c in checks if c.name not in ck.ROW_LEVEL]
    seen = Observation()
    out = df.hint("rebalance", *partition_by) if partition_by else df
    out = out.observe(seen, F.count(F.lit(1)).alias("rows"), *[
        F.expr(f"count_if({ck._failing_sql(c)})").alias(f"f{i}") for i, c in enumerate(counted)])
    writer = out.write.partitionBy(*partition_by) if partition_by else out.write
    writer.parquet(stage)
    found = seen.get
    results = [(table_name, c.name, ",".join(c.columns), found[f"f{i}"], found[f"f{i}"] == 0)
               for i, c in enumerate(counted)]
    if others:
        written = spark.read.schema(df.schema).parquet(stage)
        results += [tuple(r) for r in ck.run_checks(written, others, table_name).collect()]  # a row a check
    if all(r[-1] for r in results):
        load._replace_folder(spark, stage, target, backup)
        fs.delete(spark, backup)
        spark.catalog.refreshByPath(target)
    else:
        fs.delete(spark, stage)
    return spark.createDataFrame(results, ck.RESULT_SCHEMA)


def check_label(check: ck.Check) -> str:
    return f"{check.name}({','.join(check.columns)})"


def _stored(df: DataFrame, name: str) -> tuple[DataFrame, bool]:
    """``df`` written to the scratch area and read back, and whether it may be
    broadcast: its rows are counted, not estimated, and taken at their size in
    memory, since files of few different values are far smaller."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    stored = df.sparkSession.read.schema(df.schema).parquet(path)
    in_memory = stored.count() * (8 + stored._jdf.schema().defaultSize())
    return stored, max(in_memory, estimated_bytes(stored)) <= broadcast_limit(df.sparkSession)


def repeated_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """The keys that more than one row has (NULL equals NULL).

    Rows are counted by a 64-bit hash of the key first, before any shuffle as
    far as a task sees them.  The hashes that more than one row has are stored;
    if they are few, they go to the rows, and only the keys they leave are
    exchanged, else all keys are (counted before the shuffle, too)."""
    hashed = df.select(*keys, F.xxhash64(*keys).alias("_hash"))
    suspects, few = _stored(hashed.groupBy("_hash").count().where("count > 1").select("_hash"), "suspects")
    rows = hashed.join(F.broadcast(suspects), "_hash", "left_semi") if few else hashed
    return rows.groupBy(*keys).count().where("count > 1").select(*keys)


def mark_failures(df: DataFrame, checks: list[ck.Check], column: str = "failed_checks") -> DataFrame:
    """``df`` with the labels of the checks that each row breaks, in the order
    of ``checks`` (none: an empty array).  Every row of a repeated key breaks
    ``unique``: its repeated keys are stored first, and only if they are too
    many to broadcast are the rows shuffled to them.  ``df`` is read twice more
    a unique check, so it should be a stored table or derived from one row by
    row."""
    if column in df.columns:
        raise ValueError(f"the table has a column {column}")
    labels, out = [], df
    for i, check in enumerate(checks):
        if check.name in ck.ROW_LEVEL:
            broken = F.expr(ck._failing_sql(check))
        elif check.name == "unique":
            names = [f"_key{i}_{j}" for j in range(len(check.columns))]
            again, few = _stored(repeated_keys(df, list(check.columns)).toDF(*names), "repeated")
            again = again.withColumn(f"_again{i}", F.lit(True)).hint("broadcast" if few else "merge")
            match = reduce(lambda x, y: x & y, [
                F.col(ck.ident(c)).eqNullSafe(F.col(k)) for c, k in zip(check.columns, names)])
            out = out.join(again, match, "left")
            broken = F.col(f"_again{i}")
        else:
            raise ValueError(f"check {check.name} does not judge rows")
        labels.append(F.when(broken, F.lit(check_label(check))))
    marked = F.array_compact(F.array(*labels)) if labels else F.array().cast("array<string>")
    return out.select(*[F.col(ck.ident(c)) for c in df.columns], marked.alias(column))


def quarantine(df: DataFrame, checks: list[ck.Check], target: str,
               column: str = "failed_checks",
               compression: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Split ``df`` by its checks into two tables, written in one pass below
    ``target``: accepted rows as they are, rejected rows with the labels of
    what they break in ``column``.  Each row goes to exactly one of them.
    ``compression`` names the files' codec (default: the session's)."""
    spark = df.sparkSession
    if "accepted" in df.columns:
        raise ValueError("the table has a column accepted")
    marked = mark_failures(df, checks, column)
    # both folders' files are open at once, so a task need not sort its rows
    writers = "spark.sql.maxConcurrentOutputFileWriters"
    old = spark.conf.get(writers)
    spark.conf.set(writers, "2")
    try:
        marked.withColumn("accepted", F.size(column) == 0).write.parquet(
            target, partitionBy="accepted", compression=compression)
    finally:
        spark.conf.set(writers, old)
    whole = spark.read.schema(f"{_ddl(marked)}, accepted boolean").parquet(target)
    return (whole.where("accepted").drop("accepted", column), whole.where("NOT accepted").drop("accepted"))


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"{ck.ident(f.name)} {f.dataType.simpleString()}" for f in df.schema.fields)
