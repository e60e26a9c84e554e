"""Duplicate, NULL, period and storage diagnostics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridelake.functions.keys import surrogate_key


def duplicate_summary(df: DataFrame, keys: list[str]) -> DataFrame:
    """Total rows, distinct keys and their difference, from one shuffle.

    Grouping on the key columns (not on a hash of them) keeps the count
    exact, and partial aggregation bounds what a hot key ships.
    """
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.sum("n").cast("bigint").alias("total_rows"),
        F.count(F.lit(1)).alias("distinct_keys"),
        (F.sum("n") - F.count(F.lit(1))).cast("bigint").alias("duplicate_count"),
    )


def duplicate_rows(df: DataFrame, keys: list[str], key_name: str = "row_key") -> DataFrame:
    """Every row whose key occurs more than once, with its surrogate key.

    The repeated keys are found by an aggregation and joined back with a
    semi-join; no row limit is applied (callers order and sample if they
    want a sample).
    """
    dups = df.groupBy(*keys).count().filter(F.col("count") > 1).drop("count")
    rows = df.join(dups, on=[df[k].eqNullSafe(dups[k]) for k in keys], how="left_semi")
    return rows.withColumn(key_name, surrogate_key(df, keys))


def sample_duplicate_rows(df: DataFrame, keys: list[str], n: int = 10) -> DataFrame:
    """A deterministic sample of ``n`` duplicated rows (ordered by key)."""
    rows = duplicate_rows(df, keys)
    return rows.orderBy(*[F.col(k).asc_nulls_last() for k in keys + ["row_key"]]).limit(n)


def null_profile(df: DataFrame, a: str, b: str) -> DataFrame:
    """Total rows and NULL counts of two columns, separately and together."""
    return df.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col(a).isNull()).alias("null_a"),
        F.count_if(F.col(b).isNull()).alias("null_b"),
        F.count_if(F.col(a).isNull() & F.col(b).isNull()).alias("null_both"),
    )


def hash_collisions(df: DataFrame, cols: list[str], key_name: str = "row_key") -> DataFrame:
    """Surrogate keys shared by distinct business rows (NULL and '' hash alike)."""
    keyed = df.select(surrogate_key(df, cols).alias(key_name),
                      F.struct(*[F.col(c) for c in cols]).alias("_row"))
    return (keyed.groupBy(key_name)
            .agg(F.countDistinct("_row").alias("distinct_rows"),
                 F.count(F.lit(1)).alias("rows"))
            .filter(F.col("distinct_rows") > 1))


def out_of_period(df: DataFrame, ts_col: str, period_col: str,
                  group_cols: list[str] | None = None) -> DataFrame:
    """Rows whose ``ts_col`` lies outside the month starting at ``period_col``,
    counted by year of ``ts_col``."""
    start = F.col(period_col).cast("timestamp_ntz")
    end = F.add_months(F.col(period_col), 1).cast("timestamp_ntz")
    outside = (F.col(ts_col) < start) | (F.col(ts_col) >= end)
    return (df.filter(outside)
            .groupBy(*(group_cols or []), F.year(ts_col).alias("ts_year"))
            .agg(F.count(F.lit(1)).alias("rows_outside")))


def describe(df: DataFrame) -> DataFrame:
    """Column names and types as rows, with each column's non-NULL count from
    one aggregation pass over the data."""
    from ridelake.functions.sqltext import ident, literal, sql

    fields = df.schema.fields
    counts = ", ".join(f"count({ident(f.name)}) AS c{i}" for i, f in enumerate(fields))
    stacked = ", ".join(f"{i + 1}, {literal(f.name)}, {literal(f.dataType.simpleString())}, "
                        f"{literal(f.nullable)}, c{i}" for i, f in enumerate(fields))
    return sql(df, f"SELECT stack({len(fields)}, {stacked}) AS "
                   f"(ordinal, column_name, data_type, nullable, non_null_rows) "
                   f"FROM (SELECT {counts} FROM {{src}})", src=df)


def sample_rows(df: DataFrame, n: int, order_cols: list[str]) -> DataFrame:
    """``n`` rows in a stated order (a top-n, so it is planned as one)."""
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in order_cols]).limit(n)


def distinct_count(df: DataFrame, col: str, exact: bool = True,
                   relative_error: float = 0.01) -> DataFrame:
    """``count(distinct col)``; with ``exact=False`` a HyperLogLog++ sketch
    (``approx_count_distinct``) whose per-task state is a few KB, so no
    shuffle of the distinct values is needed at any scale."""
    agg = (F.countDistinct(col) if exact
           else F.approx_count_distinct(col, rsd=relative_error))
    return df.agg(agg.alias(f"distinct_{col}"))
