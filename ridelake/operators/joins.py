"""Joins against dimensions, with a checked broadcast.

A side is broadcast only when the optimizer's size estimate of it is below
a bound; past the bound the join is left to the sort-merge path (and AQE,
which may still switch to a broadcast at runtime from real shuffle sizes).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_BROADCAST_LIMIT = 64 * 1024 * 1024
LIMIT_CONF = "ridelake.broadcast.maxBytes"


def broadcast_limit(spark) -> int:
    """The size bound for explicit broadcasts (session setting
    ``ridelake.broadcast.maxBytes``, default 64 MiB)."""
    return int(spark.conf.get(LIMIT_CONF, str(DEFAULT_BROADCAST_LIMIT)))


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of ``df`` (an upper-bound style statistic)."""
    stats = df._jdf.queryExecution().optimizedPlan().stats()
    return int(str(stats.sizeInBytes()))


def maybe_broadcast(df: DataFrame, limit: int | None = None) -> DataFrame:
    limit = broadcast_limit(df.sparkSession) if limit is None else limit
    return F.broadcast(df) if estimated_bytes(df) <= limit else df


def join_dim(fact: DataFrame, dim: DataFrame, on, how: str = "left",
             limit: int | None = None) -> DataFrame:
    """``fact ⨝ dim`` with the dimension broadcast only below ``limit``."""
    return fact.join(maybe_broadcast(dim, limit), on, how)


def with_zone(df: DataFrame, zones: DataFrame, id_col: str, prefix: str,
              how: str = "left", limit: int | None = None) -> DataFrame:
    """Adds ``{prefix}_borough`` and ``{prefix}_zone`` looked up by ``id_col``.

    The dimension key must be unique (``check_unique``), otherwise the join
    would fan rows out.
    """
    z = zones.select(
        F.col("location_id").alias(f"_{prefix}_loc"),
        F.col("borough").alias(f"{prefix}_borough"),
        F.col("zone").alias(f"{prefix}_zone"),
    )
    z = maybe_broadcast(z, limit)
    return df.join(z, F.col(id_col) == F.col(f"_{prefix}_loc"), how).drop(f"_{prefix}_loc")
