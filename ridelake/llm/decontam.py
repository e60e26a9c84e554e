"""Benchmark decontamination by spaced seeds.

A seed hashes some of the words in a short span and ignores the others, so it
still hits when an ignored word was substituted.  The two masks together hit
every run of 13 words (and every longer run) of which a fifth is substituted,
and every item of 8 to 12 words of which one is.  Items of fewer than six
words, where the benchmark has any, are hashed whole.  Test and training seeds meet in one hash join; around each hit the whole item
is laid over the document without gaps, and a hit counts only where at least
``share`` of the words of a window of ``window`` words agree.

All DataFrame/SQL.  Documents are not shuffled: their seeds stream past the
seeds of the benchmark, which are broadcast only after they have been counted.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import UPPER, prepare, table

#: Offsets of the words that each mask reads.
MASKS = ((0, 2, 3, 4, 5), (0, 1, 2, 4, 6))
SPAN = 6
#: Items from so many words on may differ in one word (the masks hit them all).
ONE_OFF = 8
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: Benchmark seeds are broadcast up to this number of rows (24 bytes each).
BROADCAST_SEEDS = 4_000_000


def word_hashes(text: str) -> str:
    """SQL for the 64-bit hashes of a text's words: A-Z lower-cased; runs of
    letters, digits and characters beyond ASCII."""
    lower = f"translate({text}, '{UPPER}', '{UPPER.lower()}')"
    return (f"transform(array_remove(split({lower}, r'{NOT_WORD}'), ''), w -> xxhash64(w))")


def _seeds(rows: DataFrame, keep: list[str]) -> DataFrame:
    """One row a seed: ``keep``, the first word's place ``at``, the ``key``."""
    # _outer: no filter on the array is inferred, which would tokenise twice
    placed = rows.selectExpr(
        *keep, f"""explode_outer(CASE WHEN size(h) >= {SPAN} THEN sequence(0, size(h) - {SPAN})
                   END) AS at""")
    keys = ", ".join(
        f"xxhash64({m}, " + ", ".join(f"get(h, at + {o})" for o in mask) + ")"
        for m, mask in enumerate(MASKS))
    return placed.selectExpr(*keep, "at", f"array({keys}) AS keys").selectExpr(
        *keep, "at", "explode_outer(keys) AS key").where("at IS NOT NULL")


def _whole_seeds(rows: DataFrame, keep: list[str], sizes: list[int]) -> DataFrame:
    """Seeds that read every word of runs of these sizes."""
    parts = []
    for n in sizes:
        words = ", ".join(f"get(h, at + {o})" for o in range(n))
        parts.append(rows.selectExpr(
            *keep, f"explode_outer(CASE WHEN size(h) >= {n} THEN sequence(0, size(h) - {n}) END) AS at")
            .selectExpr(*keep, "at", f"xxhash64({-n}, {words}) AS key").where("at IS NOT NULL"))
    return reduce(DataFrame.unionByName, parts)


def overlaps(docs: DataFrame, benchmark: DataFrame, window: int = 13, share: float = 0.8,
             shortest: int = 3, broadcast_seeds: int = BROADCAST_SEEDS) -> DataFrame:
    """One row for each document and benchmark item that overlap.

    doc_id, item_id, doc_start and doc_end (words from 0, half-open),
    item_start and item_end, n_equal and n_overlap (words), item_words.  Of
    several overlaps of a document and an item the one with most equal words
    is returned (then the first).  Items shorter than ``window`` must agree as
    a whole: in all words but one from eight words on, in every word below.
    Items of fewer than ``shortest`` words are no evidence and are not
    searched.  Null and empty texts have no words.  Rows that repeat a
    document or item id are searched each and reported once; null ids are
    reported as such.  Empty tables give no rows; other columns are not read.
    """
    items = benchmark.selectExpr("item_id", f"{word_hashes('text')} AS ih").where(f"size(ih) >= {shortest}")
    # the item's words go along, so the bound is on words, not on rows; sizes
    # below the span are few
    found = items.selectExpr("sum(size(ih) * size(ih)) AS n",
                             f"sort_array(collect_set(IF(size(ih) < {SPAN}, size(ih), NULL))) AS sizes").first()
    texts = docs.selectExpr("doc_id", f"{word_hashes('text')} AS h")
    test_words = items.selectExpr("item_id", "ih", "ih AS h")
    tests, seeds = _seeds(test_words, ["item_id", "ih", "h"]), _seeds(texts, ["doc_id", "h"])
    if found["sizes"]:
        # a whole seed of a longer item would hit too, but only repeat its hits
        whole = _whole_seeds(test_words.where(f"size(h) < {SPAN}"), ["item_id", "ih", "h"], found["sizes"])
        tests = tests.unionByName(whole)
        seeds = seeds.unionByName(_whole_seeds(texts, ["doc_id", "h"], found["sizes"]))
    tests = tests.selectExpr("key", "item_id", "ih", "at AS item_at")
    if (found["n"] or 0) * len(MASKS) <= broadcast_seeds:
        tests = F.broadcast(tests)
    need = (f"CASE WHEN size(ih) >= {window} THEN CAST(ceil({share} * {window}) AS INT) "
            f"WHEN size(ih) >= {ONE_OFF} THEN size(ih) - 1 ELSE size(ih) END")
    # the row number keeps what follows out of the join's condition: the join
    # stays in generated code, which copies a document's hashes for hits only
    hits = (seeds.join(tests, "key")
            .selectExpr("doc_id", "h", "ih", "at", "item_id", "item_at",
                        "monotonically_increasing_id() AS hit")
            .selectExpr("hit", "doc_id", "item_id", "size(ih) AS item_words", "at - item_at AS shift",
                        f"least({window}, size(ih)) AS wide", f"{need} AS need",
                        """transform(sequence(0, size(ih) - 1), q -> CASE WHEN
                             at - item_at + q >= 0 AND get(h, at - item_at + q) = get(ih, q)
                             THEN 1 ELSE 0 END) AS eq""")
            .selectExpr("*", """filter(sequence(0, item_words - wide), s ->
                aggregate(slice(eq, s + 1, wide), 0, (a, x) -> a + x) >= need) AS good""")
            .where("size(good) > 0")
            .where("hit >= 0")
            .selectExpr("doc_id", "item_id", "item_words", "shift", "good[0] AS item_start",
                        "good[size(good) - 1] + wide AS item_end", "eq")
            .selectExpr("*", """aggregate(slice(eq, item_start + 1, item_end - item_start), 0,
                                (a, x) -> a + x) AS n_equal"""))
    best = hits.groupBy("doc_id", "item_id").agg(
        F.min(F.struct((-F.col("n_equal")).alias("less"), "shift", "item_start", "item_end",
                       "item_words")).alias("b"))
    return best.selectExpr(
        "doc_id", "item_id", "b.shift + b.item_start AS doc_start", "b.shift + b.item_end AS doc_end",
        "b.item_start", "b.item_end", "-b.less AS n_equal",
        "b.item_end - b.item_start AS n_overlap", "b.item_words")


def op3_spaced_seed_decontam(spark, sf_dir):
    """All documents against all benchmark items."""
    prepare(spark)
    return overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
