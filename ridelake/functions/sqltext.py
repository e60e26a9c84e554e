"""Helpers for operators written as Spark SQL over DataFrame parameters.

``spark.sql("SELECT ... FROM {df}", df=df)`` is planned by Catalyst exactly
like the equivalent DataFrame calls, but the driver builds it with a few
gateway calls instead of several per column expression, which matters for
wide projections.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame

from ridelake.operators.joins import broadcast_limit, estimated_bytes


def ident(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def literal(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "TRUE" if value else "FALSE"
    if isinstance(value, (int, float)):
        return repr(value)
    if isinstance(value, dt.datetime):
        return f"TIMESTAMP_NTZ '{value.strftime('%Y-%m-%d %H:%M:%S.%f')}'"
    if isinstance(value, dt.date):
        return f"DATE '{value.isoformat()}'"
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def ts_literal(value) -> str:
    """A zone-less timestamp literal from a string, date or datetime."""
    if isinstance(value, dt.datetime):
        return literal(value)
    if isinstance(value, dt.date):
        return f"TIMESTAMP_NTZ '{value.isoformat()} 00:00:00'"
    return f"TIMESTAMP_NTZ '{value}'"


def window_sql(col: str, start, end) -> str:
    """Half-open ``start <= col < end`` as SQL text."""
    return f"{col} >= {ts_literal(start)} AND {col} < {ts_literal(end)}"


def sql(df: DataFrame, text: str, **frames: DataFrame) -> DataFrame:
    """Run ``text`` with ``{name}`` placeholders bound to ``frames``."""
    return df.sparkSession.sql(text, **frames)


def broadcast_hint(frames: dict[str, DataFrame], limit: int | None = None) -> str:
    """``/*+ BROADCAST(alias) */`` for every aliased frame whose estimated
    size is within ``limit`` (default: the session's broadcast bound); larger
    ones are left to the planner."""
    small = [alias for alias, df in frames.items()
             if estimated_bytes(df) <= (broadcast_limit(df.sparkSession) if limit is None
                                        else limit)]
    return f"/*+ {', '.join(f'BROADCAST({a})' for a in small)} */" if small else ""
