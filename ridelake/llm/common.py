"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ridelake.session import scratch_path, scratch_root, ship_package

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SPACE_WORDS = r"[^\x20\x09-\x0D]+"


def prepare(spark: SparkSession) -> SparkSession:
    """Make the package importable on executors and the shared folder known.
    Cluster settings (partition counts, AQE sizes) stay as the cluster has them."""
    scratch_root(spark)
    ship_package(spark)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the session's shared folder and read it back: cuts
    lineage and keeps it readable when an executor is lost."""
    path = scratch_path(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ascii_lower(col):
    """Lower-case A-Z only."""
    return F.translate(col, UPPER, UPPER.lower())


#: Ranges (a power of two) in which the rows of one id are numbered.
NUMBER_RANGES = 1024


def numbered(docs: DataFrame, extra: Iterable[str] = ("text",)) -> DataFrame:
    """(doc_id, _n, *extra): the rows of a document table with ``_n`` numbering
    the rows of one ``doc_id`` from 0 in the order of their texts.

    Rows that repeat an id are separate documents, ordered by 128 bits of their
    text's hash; rows alike in id and text follow in any order.  Ids normally do
    not repeat, which one pass over the id column alone establishes; only the
    rows of repeated ids are numbered.  An id of any number of rows is numbered
    in ``NUMBER_RANGES`` ranges of the hash, each moved up by the counts of
    those before."""
    base = docs.select("doc_id", *[F.col(c) for c in extra])
    again = (base.groupBy("doc_id").count().where("count > 1")
             .select(F.col("doc_id").alias("_again")))
    if again.isEmpty():
        return base.withColumn("_n", F.lit(0))
    hit = base["doc_id"].eqNullSafe(F.col("_again"))
    once = base.join(again, hit, "left_anti").withColumn("_n", F.lit(0))
    order = F.xxhash64("text")
    more = base.join(again, hit, "left_semi").withColumns(
        {"_order": order, "_range": F.shiftright(order, 64 - NUMBER_RANGES.bit_length() + 1)})
    counts = more.groupBy("doc_id", "_range").agg(F.count("*").alias("_rows"))
    earlier = Window.partitionBy("doc_id").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    base_of = counts.select(F.col("doc_id").alias("_id"), F.col("_range").alias("_of"),
                            F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_base"))
    own = Window.partitionBy("doc_id", "_range").orderBy("_order", F.xxhash64(F.lit(1), "text"))
    placed = more.withColumn("_own", F.row_number().over(own) - 1).join(
        base_of, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_range") == F.col("_of")))
    return once.unionByName(placed.select(*base.columns, (F.col("_base") + F.col("_own")).cast("int").alias("_n")))


def with_fields(schema: T.StructType, *fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType(list(schema.fields) + [T.StructField(n, t) for n, t in fields])


def text_slices(batch: pa.RecordBatch, name: str = "text",
                max_bytes: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Cut a batch into slices of about ``max_bytes`` of text (one row at least),
    so that work arrays stay small whatever the batch holds."""
    col = batch.column(batch.schema.get_field_index(name))
    sizes = utf8_sizes(col)
    start, held = 0, 0
    for i, n in enumerate(sizes.tolist()):
        if held and held + n > max_bytes:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n
    if start < batch.num_rows:
        yield batch.slice(start)


def utf8_sizes(col: pa.Array) -> np.ndarray:
    import pyarrow.compute as pc

    return pc.fill_null(pc.binary_length(col), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def utf8_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts of a column as one byte array, and the offsets of the rows in
    it (nulls are empty)."""
    sizes = utf8_sizes(col)
    offsets = np.zeros(len(sizes) + 1, np.int64)
    np.cumsum(sizes, out=offsets[1:])
    if col.null_count:
        raw = b"".join(x.as_buffer().to_pybytes() if x.is_valid else b""
                       for x in col.cast(pa.large_binary()))
        return np.frombuffer(raw, np.uint8), offsets
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    marks = np.frombuffer(col.buffers()[1], np.int64 if wide else np.int32)
    first = int(marks[col.offset])
    data = col.buffers()[2]
    if data is None:
        return np.zeros(0, np.uint8), offsets
    return np.frombuffer(data, np.uint8)[first:first + int(offsets[-1])], offsets


IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True

#: What separates words of letters, digits and characters beyond ASCII.
IS_MARK = np.zeros(256, bool)
IS_MARK[[*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = True
IS_NEWLINE = np.zeros(256, bool)
IS_NEWLINE[0x0A] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

_ODD = np.uint64(0x9E3779B97F4A7C15)


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (murmur3's constants) over an unsigned array."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def split_words(data: np.ndarray, offsets: np.ndarray, between: np.ndarray = IS_SPACE):
    """Words (runs without bytes of the table ``between``) of concatenated
    texts: byte starts, byte ends, the row each belongs to.  Words never cross
    rows."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, none
    space = between[data]
    word = ~space
    first = word.copy()
    first[1:] &= space[:-1]
    last = word.copy()
    last[:-1] &= space[1:]
    inner = offsets[1:-1]
    inner = inner[(inner > 0) & (inner < len(data))]
    first[inner] = word[inner]
    last[inner - 1] = word[inner - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    rows = np.searchsorted(offsets, starts, side="right") - 1
    return starts, ends, rows


_TABLE = mix64(np.arange(1, 257, dtype=np.uint64) * _ODD)
_LONG = 1 << 16
with np.errstate(over="ignore"):
    _POWERS = np.cumprod(np.full(_LONG, np.uint64(0xD6E8FEB86659FD93)), dtype=np.uint64)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of non-overlapping byte spans, in order: random byte values
    times powers by place, summed per span and finalised with the length.  Very
    long spans are hashed one at a time."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    lens = ends - starts
    if lens.max() > _LONG:
        out = np.zeros(len(lens), np.uint64)
        few = lens > _LONG
        out[~few] = span_hashes(data, starts[~few], ends[~few])
        out[few] = [int.from_bytes(hashlib.blake2b(data[s:e].tobytes(), digest_size=8).digest(), "big")
                    for s, e in zip(starts[few].tolist(), ends[few].tolist())]
        return out
    first = np.cumsum(lens) - lens
    place = np.arange(int(lens.sum()))
    at = place + np.repeat(starts - first, lens)
    place -= np.repeat(first, lens)
    sums = np.add.reduceat(_TABLE[data[at]] * _POWERS[place], first)
    return mix64(sums + lens.astype(np.uint64) * _ODD)
