"""Corpus pipeline: the stages from raw documents to packed sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next one's docs.  All but the last return the
columns of documents.  Judged against brute-force versions in tests/llm: SQL
cannot state the classifier, so ``ORACLE_SQL`` is None.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridelake.llm import decontam, packing, quality_classifier, simhash, suffix_dedup
from ridelake.llm.common import prepare, staged, table
from ridelake.llm.tokens import public_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def row_key():
    """The id (none goes last) and 128 bits of the text's hash.  Rows alike in
    both hold the same text, so one verdict holds for all of them."""
    return F.struct(F.isnull("doc_id").alias("no_id"), F.col("doc_id").alias("id"),
                    F.xxhash64("text").alias("h"), F.xxhash64(F.lit(1), "text").alias("h1"))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier finds neither of low quality nor toxic."""
    prepare(spark)
    judged = quality_classifier.classify(docs, table(spark, sf_dir, "labels"), keep=COLUMNS)
    return judged.where("kept").select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the smallest id, then text
    hash; a document without an id only where no other has one.

    Rows that share an id, or have none, are documents of their own."""
    prepare(spark)
    groups = simhash.near_duplicates(docs.select(row_key().alias("doc_id"), "text"))
    first = staged(groups.where("doc_id = component_id").groupBy(F.col("doc_id").alias("_key"))
                   .agg(F.count("*").alias("_rows")), "representatives")
    keyed = docs.select(*COLUMNS, row_key().alias("_key"))
    kept = keyed.join(first.where("_rows = 1"), "_key", "left_semi").select(*COLUMNS)
    again = first.where("_rows > 1")  # rows alike in id and text
    if again.isEmpty():
        return kept
    one = (keyed.join(again, "_key", "left_semi").groupBy("_key")
           .agg(F.min(F.struct("lang", "source", "n_chars", "doc_id", "text")).alias("r")))
    return kept.unionByName(one.select("r.*").select(*COLUMNS))


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the bytes of repeated 100-byte strings; a document of
    which nothing is left goes, one that was empty before stays."""
    prepare(spark)
    cut = suffix_dedup.remove_repeats(docs, keep=COLUMNS)
    return (cut.where("n_bytes = 0 OR n_removed < n_bytes")
            .withColumn("n_chars", F.length("text").cast("long"))
            .select(*COLUMNS))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap no benchmark item; rows that share an id, or have
    none, are judged each."""
    prepare(spark)
    hits = decontam.overlaps(docs.select(row_key().alias("doc_id"), "text"), table(spark, sf_dir, "benchmark"))
    bad = staged(hits.select(F.col("doc_id").alias("_key")).distinct(), "contaminated")
    return docs.select(*COLUMNS, row_key().alias("_key")).join(bad, "_key", "left_anti").select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 2048 tokens."""
    prepare(spark)
    return packing.pack_documents(docs, public_path("byte_bpe_50k.json"))


STAGES = [
    ("quality_classifier", quality),
    ("simhash_near_dedup", near_dedup),
    ("suffix_array_dedup", substring_dedup),
    ("benchmark_decontamination", decontaminate),
    ("packing", pack),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each on all that its predecessor kept."""
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
