"""Small documents with every odd case, and brute-force versions."""

import hashlib
import random
import re

from pyspark.sql import functions as F

SPACE = re.compile(r"[^\x20\x09-\x0D]+")
MARK = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
#: column names that operators use inside
CLASHES = ["fp", "_n", "bin", "gram", "key", "h", "start", "_row", "ranges", "component_id", "shard"]


def low(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def prose(rng, words, vocabulary=None):
    pool = vocabulary or [f"{a}{b}" for a in ("tor", "mel", "an", "quis", "ße", "ver") for b in ("da", "lo", "é", "n", "tum")]
    return " ".join(rng.choice(pool) for _ in range(words))


def edge_rows():
    rng = random.Random(11)
    a, b = prose(rng, 120), prose(rng, 90)
    rows = [(0, None), (1, ""), (2, " \n\t \r "), (3, "word"), (4, prose(rng, 30_000)),
            (5, a), (6, a), (7, a + " Extra words"), (8, b), (8, b), (8, prose(rng, 40)),
            (None, prose(rng, 60)), (None, a), (9, "x" * 99), (10, "x" * 100), (11, "x" * 400),
            (12, "ab" * 300 + b[:150]), (13, b[20:200] + " " + a[100:300]), (14, "Two words"),
            (15, "日本語 テキスト é ü " * 30), (16, "日本語 テキスト é ü " * 11 + a[:200]),
            (-5, "SHOUT!! " * 60), (17, b), (18, "same line\nsame line\n\nsame line\n" * 8)]
    return rows


def frame(spark, rows, clash=True):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    df = df.withColumns({"lang": F.lit("en"), "source": F.lit("s"), "n_chars": F.length("text").cast("long")})
    return df.withColumns({c: F.lit(1) for c in CLASHES}) if clash else df


def empty(spark):
    return frame(spark, edge_rows()).where("1 = 0")


def brute_substrings(rows, length=100):
    """Rows in corpus order -> (doc_id, n_bytes, n_removed, n_spans, sha256)."""
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    seen, out = set(), []
    for doc, text in ordered:
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for p in range(len(raw) - length + 1):
            w = raw[p:p + length]
            if w in seen:
                gone[p:p + length] = b"\1" * length
            seen.add(w)
        kept = bytes(c for c, g in zip(raw, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (not i or not gone[i - 1]))
        out.append((doc, len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def by_text(rows):
    """Multiset of result rows, nulls first."""
    return sorted(map(tuple, rows), key=lambda r: [(x is not None, x if x is not None else 0) for x in r])
