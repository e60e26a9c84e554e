"""Sharding by jump consistent hashing (Lamping and Veach, 2014).

A stable 64-bit key decides the shard with no ring table: the hash jumps
forward through shard counts, and the last jump below ``n`` is the shard.
Appending shard ``n`` moves a key only if its next jump lands on ``n``, so
exactly the necessary share moves, all of it into the new shard.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import prepare, staged, table


def jump_hash(keys: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each unsigned 64-bit key."""
    if shards < 1:
        raise ValueError("at least one shard is needed")
    key = keys.astype(np.uint64).copy()
    shard = np.zeros(len(key), np.int64)
    jump = np.zeros(len(key), np.int64)
    live = np.arange(len(key))
    while len(live):
        shard[live] = jump[live]
        k = key[live] * np.uint64(2862933555777941757) + np.uint64(1)
        key[live] = k
        scale = float(1 << 31) / ((k >> np.uint64(33)).astype(np.float64) + 1.0)
        jump[live] = ((shard[live] + 1) * scale).astype(np.int64)
        live = live[jump[live] < shards]
    return shard


def jump_shard(key: Column, shards: int) -> Column:
    """Column form over a bigint key; vectorised, nothing is kept between rows."""
    def assign(k: pd.Series) -> pd.Series:
        return pd.Series(jump_hash(k.to_numpy(np.int64).view(np.uint64), shards), dtype="int32")

    return F.pandas_udf(assign, "int")(key)


def shard_documents(docs: DataFrame, shards: int = 16, sub_buckets: int = 1024) -> DataFrame:
    """Shard, slot and grown shard of every row.

    ``shard`` depends on ``doc_id`` and ``shards`` alone.  A null id is a key
    like any other; rows with one id share a shard (rows with equal texts and
    different ids need not: the id decides); a null text counts as
    empty; an empty table gives no rows; other columns are not read.

    Slots are numbered from 0 without gaps in each shard.  A shard is never
    one window, nor is an id: rows are numbered inside (shard, sub-bucket), the
    sub-bucket by id and text, and moved up by the counts of the sub-buckets
    before, a table of ``shards * sub_buckets`` rows at most, which is what the
    broadcast is bounded by.
    """
    key = F.xxhash64("doc_id")
    size = (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long")
    crc = F.crc32(F.coalesce("text", F.lit("")).cast("binary"))
    sub = F.pmod(F.shiftrightunsigned(F.xxhash64("doc_id", size, crc), 7), F.lit(sub_buckets))
    # texts are read once; counts and numbers are taken from the narrow rows
    rows = staged(docs.select(
        "doc_id", size.alias("size"), crc.alias("text_crc32"),
        jump_shard(key, shards).alias("shard"),
        jump_shard(key, shards + 1).alias("grown_shard"),
        sub.cast("int").alias("_sub")), "shards")
    counts = rows.groupBy("shard", "_sub").count()
    before = (Window.partitionBy("shard").orderBy("_sub")
              .rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("shard", "_sub", F.coalesce(F.sum("count").over(before), F.lit(0))
                            .alias("_before"))
    w = Window.partitionBy("shard", "_sub").orderBy("doc_id", "size", "text_crc32")
    return (rows.withColumn("_r", F.row_number().over(w))
            .join(F.broadcast(offsets), ["shard", "_sub"])
            .select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
                    (F.col("_before") + F.col("_r") - 1).cast("long").alias("slot"),
                    "grown_shard"))


def op9_shard_documents(spark, sf_dir):
    """All documents in shards 0 to 15 under the law ``key``."""
    return shard_documents(table(prepare(spark), sf_dir, "documents"))
