"""Time predicates written so that Catalyst pushes them to the scan."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def parse_day(value) -> dt.date:
    """The day of a run parameter (a date, a datetime or an ISO text)."""
    if not value:
        raise ValueError("a run needs its date")
    return dt.date.fromisoformat(str(value)[:10])


def _ts_lit(value) -> Column:
    if isinstance(value, dt.datetime):
        text = value.strftime("%Y-%m-%d %H:%M:%S.%f")
    elif isinstance(value, dt.date):
        text = value.strftime("%Y-%m-%d 00:00:00")
    else:
        text = str(value)
    return F.lit(text).cast("timestamp_ntz")


def in_window(col, start, end, partition_col: str | None = None,
              partition_granularity: str = "month") -> Column:
    """Half-open ``start <= col < end``.

    With ``partition_col`` the matching predicate on the derived partition
    column is added too, because a predicate on the raw timestamp alone does
    not prune partitions.
    """
    cond = (_c(col) >= _ts_lit(start)) & (_c(col) < _ts_lit(end))
    if partition_col is not None:
        lo = F.trunc(_ts_lit(start).cast("date"), partition_granularity) \
            if partition_granularity == "month" else _ts_lit(start).cast("date")
        hi = _ts_lit(end).cast("date")
        cond = cond & (F.col(partition_col) >= lo) & (F.col(partition_col) <= hi)
    return cond


def on_day(col, day) -> Column:
    """``to_date(col) = day`` rewritten as a range so it reaches the scan."""
    d = parse_day(day)
    return in_window(col, d, d + dt.timedelta(days=1))


def month_start(col) -> Column:
    """``date_trunc('month', ts)`` kept zone-less."""
    return F.date_trunc("month", _c(col)).cast("timestamp_ntz")


def hours_between(start_col, end_col) -> Column:
    """Whole-second difference in hours as a double."""
    secs = F.unix_timestamp(_c(end_col)) - F.unix_timestamp(_c(start_col))
    return secs.cast("double") / F.lit(3600.0)
