"""Data-quality checks that return their results as a DataFrame.

All row-level checks of one table (not_null, non_negative, positive,
accepted_values) are fused into a single aggregation pass over the data;
each ``unique`` check costs one extra shuffle on its key; a custom SQL check
runs its own statement.  Results are one row per check:
``(table_name, check_name, column_name, failures, passed)``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from ridelake.functions.sqltext import ident, literal, sql
from pyspark.sql.types import StructType

RESULT_SCHEMA = ("table_name string, check_name string, column_name string, "
                 "failures bigint, passed boolean")


@dataclass(frozen=True)
class Check:
    name: str
    columns: tuple[str, ...] = ()
    values: tuple = ()
    query: str | None = None
    expected: object = None
    extra: dict = field(default_factory=dict)


def not_null(col: str) -> Check:
    return Check("not_null", (col,))


def unique(*cols: str) -> Check:
    return Check("unique", tuple(cols))


def non_negative(col: str) -> Check:
    return Check("non_negative", (col,))


def positive(col: str) -> Check:
    return Check("positive", (col,))


def accepted_values(col: str, values) -> Check:
    return Check("accepted_values", (col,), tuple(values))


def sql_equals(name: str, query: str, value) -> Check:
    """Custom check: the scalar result of ``query`` must equal ``value``."""
    return Check(name, (), query=query, expected=value)


def _failing_sql(check: Check) -> str:
    """Predicate text marking a failing row; NULL never fails (except not_null)."""
    c = ident(check.columns[0])
    if check.name == "not_null":
        return f"{c} IS NULL"
    if check.name == "non_negative":
        return f"{c} < 0"
    if check.name == "positive":
        return f"{c} <= 0"
    if check.name == "accepted_values":
        values = ", ".join(_text(v) for v in check.values)
        return f"{c} IS NOT NULL AND {c} NOT IN ({values})"
    raise ValueError(f"not a row-level check: {check.name}")


ROW_LEVEL = {"not_null", "non_negative", "positive", "accepted_values"}


def run_checks(df: DataFrame, checks: list[Check], table_name: str = "",
               fail_on_error: bool = False) -> DataFrame:
    parts: list[str] = []
    row_checks = [c for c in checks if c.name in ROW_LEVEL]
    if row_checks:
        # one pass over the data; its single result row is then unpivoted
        counts = ", ".join(f"count_if({_failing_sql(c)}) AS f{i}"
                           for i, c in enumerate(row_checks))
        stacked = ", ".join(f"{literal(c.name)}, {literal(','.join(c.columns))}, f{i}"
                            for i, c in enumerate(row_checks))
        parts.append(f"SELECT stack({len(row_checks)}, {stacked}) AS "
                     f"(check_name, column_name, failures) FROM (SELECT {counts} FROM {{src}})")
    for c in checks:
        if c.name == "unique":
            keys = ", ".join(ident(k) for k in c.columns)
            parts.append(f"SELECT 'unique', {literal(','.join(c.columns))}, COUNT(1) FROM "
                         f"(SELECT 1 FROM {{src}} GROUP BY {keys} HAVING COUNT(1) > 1)")
        elif c.query is not None:
            # braces of the user's text are not placeholders, but for {src}
            query = c.query.replace("{", "{{").replace("}", "}}").replace("{{src}}", "{src}")
            parts.append(f"SELECT {_text(c.name)}, '', CASE WHEN ({query}) = "
                         f"{_text(c.expected)} THEN 0 ELSE 1 END")
        elif c.name not in ROW_LEVEL:
            raise ValueError(f"unknown check {c.name}")
    if not parts:
        return df.sparkSession.createDataFrame([], RESULT_SCHEMA)
    out = sql(df, _wrap(table_name, parts), src=df)
    if fail_on_error:
        # the result has one row per check, so collecting it is bounded
        failed = [r for r in out.collect() if not r["passed"]]
        if failed:
            raise AssertionError(f"{len(failed)} check(s) failed on {table_name}: {failed}")
    return out


def _text(value) -> str:
    """A literal inside a statement with placeholders."""
    return literal(value).replace("{", "{{").replace("}", "}}")


def _wrap(table_name: str, parts: list[str]) -> str:
    named = [f"SELECT * FROM ({p}) AS q{i}(check_name, column_name, failures)"
             for i, p in enumerate(parts)]
    return (f"SELECT {_text(table_name)} AS table_name, CAST(check_name AS STRING) AS "
            f"check_name, CAST(column_name AS STRING) AS column_name, "
            f"CAST(failures AS BIGINT) AS failures, failures = 0 AS passed "
            f"FROM ({' UNION ALL '.join(named)})")


def check_schema(df: DataFrame, contract: StructType) -> DataFrame:
    """Declared columns, types and nullability against the frame.

    One row per column: expected and actual type, whether they match, and
    for columns the contract declares non-nullable the number of NULL rows.
    Columns the frame has but the contract lacks are reported too.  One
    aggregation pass counts everything; its single row is then stacked.
    """
    actual = {f.name.lower(): f for f in df.schema.fields}
    declared = {f.name.lower() for f in contract.fields}
    pairs = [(f, actual.get(f.name.lower())) for f in contract.fields]
    pairs += [(None, f) for key, f in actual.items() if key not in declared]
    counts, rows = ["COUNT(1) AS n"], []
    for i, (want, got) in enumerate(pairs):
        expected = want.dataType.simpleString() if want else None
        found = got.dataType.simpleString() if got else None
        nulls = "CAST(NULL AS BIGINT)"
        if want and got and not want.nullable:
            counts.append(f"count_if({ident(got.name)} IS NULL) AS c{i}")
            nulls = f"c{i}"
        rows.append(f"{literal((want or got).name)}, CAST({literal(expected)} AS STRING), "
                    f"CAST({literal(found)} AS STRING), {literal(expected == found)}, {nulls}")
    return sql(df, f"SELECT stack({len(rows)}, {', '.join(rows)}) AS (column_name, expected_type, "
                   f"actual_type, matches, null_rows) FROM (SELECT {', '.join(counts)} FROM {{src}})",
               src=df)
