"""Deterministic deduplication.

Both forms are ``row_number() over (partition by keys order by ...) = 1``.
Catalyst turns that into a ``WindowGroupLimit`` that runs once before the
shuffle (each map task keeps only its best row per key) and once after, so a
key that holds a third of all rows still ships only one row per map task.

Every column not already in the order is appended as a tie-breaker, so the
survivor does not depend on input order or partitioning.  Ascending order
puts NULLs last, as the warehouse SQL does; descending order puts them last
too.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ridelake.functions.sqltext import ident, sql


def order_sql(columns: list[str], keys, order_by) -> str:
    """ORDER BY text: ``order_by`` items, then every other column ascending."""
    used = {k.lower() for k in keys}
    parts = []
    for item in order_by:
        name, direction = item if isinstance(item, tuple) else (item, "asc")
        used.add(name.lower())
        parts.append(f"{ident(name)} {'DESC' if direction == 'desc' else 'ASC'} NULLS LAST")
    parts += [f"{ident(c)} ASC NULLS LAST" for c in columns if c.lower() not in used]
    return ", ".join(parts)


def row_number_sql(columns: list[str], keys, order_by) -> str:
    part = ", ".join(ident(k) for k in keys)
    return f"ROW_NUMBER() OVER (PARTITION BY {part} ORDER BY {order_sql(columns, keys, order_by)})"


def keep_first(df: DataFrame, keys, order_by) -> DataFrame:
    """``DISTINCT ON (keys) ... ORDER BY keys, order_by`` (first wins)."""
    rownum = row_number_sql(df.columns, keys, order_by)
    return sql(df, f"SELECT * EXCEPT (_rn) FROM (SELECT *, {rownum} AS _rn FROM {{src}}) "
                   f"WHERE _rn = 1", src=df)


def keep_latest(df: DataFrame, keys, ts_col: str) -> DataFrame:
    """Latest ``ts_col`` wins per key."""
    return keep_first(df, keys, [(ts_col, "desc")])
