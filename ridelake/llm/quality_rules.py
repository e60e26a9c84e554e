"""Quality rules by compression bands.

The zstandard ratio (compressed over plain bytes) of a whole document, and of
its fixed-size chunks, tells repetitive text (low) and noise (high) from
prose.  Short texts compress worse, so the band depends on the length.  Plain
word and line rules go first.  No shuffle; whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from .common import (IS_NEWLINE, IS_SPACE, mix64, prepare, span_hashes, split_words, table,
                     text_slices, utf8_bytes)

#: (bytes at least, ratio at least, ratio at most), by growing length.  The
#: upper limits lie above the largest ratio of any sf0.1 document or chunk of
#: that length (0.857, 0.745, 0.698, 0.638, 0.592, 0.543, 0.521, 0.484) and
#: below random letter/digit words; from 1,000 bytes also below random
#: lower-case words (0.629 to 0.587).
BANDS = ((0, 0.0, 2.0), (200, 0.10, 0.88), (300, 0.10, 0.78), (500, 0.10, 0.72), (700, 0.10, 0.67),
         (1000, 0.13, 0.605), (1500, 0.13, 0.58), (2000, 0.13, 0.56), (4000, 0.13, 0.55))
CHUNK = 4096
#: A shorter last chunk says nothing alone; it is judged with the one before.
LEAST_CHUNK = 200
WINDOW = 8

_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True


def text_counts(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of each
    of the concatenated texts."""
    rows = len(offsets) - 1

    def per_row(mask):
        total = np.concatenate(([0], np.cumsum(mask)))
        return total[offsets[1:]] - total[offsets[:-1]]

    starts, ends, row = split_words(data, offsets)
    n = np.bincount(row, minlength=rows)
    ls, le, lr = split_words(data, offsets, IS_NEWLINE)
    inked = np.concatenate(([0], np.cumsum(~IS_SPACE[data])))
    full = inked[le] > inked[ls]  # lines with a word
    ls, le, lr = ls[full], le[full], lr[full]
    line = mix64(span_hashes(data, ls, le) ^ mix64(lr.astype(np.uint64)))
    _, once = np.unique(line, return_index=True)
    lines = np.bincount(lr, minlength=rows) - np.bincount(lr[once], minlength=rows)
    return {"n_words": n, "word_chars": per_row(~IS_SPACE[data] & ((data & 0xC0) != 0x80)),
            "n_symbols": per_row(_SYMBOL[data]), "n_dup_lines": lines,
            "n_repeat_words": _repeated(span_hashes(data, starts, ends), row, rows)}


def _repeated(h: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    """Words of each row in windows that the row holds twice or more."""
    m = len(h) - WINDOW + 1
    if m < 1:
        return np.zeros(rows, np.int64)
    x, have = h, 1
    while have < WINDOW:  # windows of 2, 4, 8 words
        x = mix64(x[:-have] * np.uint64(0x9E3779B97F4A7C15) + x[have:])
        have *= 2
    at = np.flatnonzero(row[:m] == row[WINDOW - 1:])
    key = mix64(x[at] ^ mix64(row[at].astype(np.uint64)))
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    twin = np.zeros(len(order), bool)
    twin[1:] = same
    twin[:-1] |= same
    start = at[order[twin]]
    cover = np.cumsum(np.bincount(start, minlength=len(h) + 1)
                      - np.bincount(start + WINDOW, minlength=len(h) + 1)[:len(h) + 1])
    return np.bincount(row[cover[:len(h)] > 0], minlength=rows)


def in_band(size: int, ratio: float, bands=BANDS) -> bool:
    least, most = next((lo, hi) for n, lo, hi in reversed(bands) if size >= n)
    return least <= ratio <= most


def chunk_edges(size: int, chunk: int = CHUNK) -> list[int]:
    """Edges of the chunks; together they hold the whole text."""
    edges = [*range(0, size, chunk), size]
    if len(edges) > 2 and edges[-1] - edges[-2] < LEAST_CHUNK:
        del edges[-2]
    return edges


def compression_verdict(text: bytes, compressor, bands=BANDS, chunk: int = CHUNK,
                        most_odd: float = 0.05) -> tuple[float, float, bool]:
    """(ratio of the whole, share of chunks outside the band of their length, kept)."""
    if not text:
        return 0.0, 0.0, True
    ratio = len(compressor.compress(text)) / len(text)
    whole = in_band(len(text), ratio, bands)
    edges = chunk_edges(len(text), chunk)
    if len(edges) == 2:
        return ratio, float(not whole), whole
    odd = sum(not in_band(e - s, len(compressor.compress(text[s:e])) / (e - s), bands)
              for s, e in zip(edges, edges[1:])) / (len(edges) - 1)
    return ratio, odd, whole and odd <= most_odd


def apply_rules(docs: DataFrame, min_words: int = 20, max_repeat_percent: int = 30,
                level: int = 3) -> DataFrame:
    """One row a document: counts, ``base_failed``, ``kept``, ratios.

    A null text has no words; texts of fewer than ``min_words`` words fail.
    Repeated rows are judged each; an empty table gives no rows; other columns
    are not read.
    """
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    names = ["doc_id", *counts, "base_failed", "kept", "ratio", "odd_chunks"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressor = zstandard.ZstdCompressor(level=level)
        for b in batches:
            for part in text_slices(b):
                data, offsets = utf8_bytes(part.column(1))
                c = text_counts(data, offsets)
                failed = (c["n_words"] < min_words) | (
                    100 * c["n_repeat_words"] > max_repeat_percent * c["n_words"])
                raw = data.tobytes()
                ratio, odd, kept = zip(*(compression_verdict(raw[s:e], compressor) for s, e in
                                         zip(offsets[:-1].tolist(), offsets[1:].tolist())))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0)] + [pa.array(c[k].astype(np.int64)) for k in counts]
                    + [pa.array(failed), pa.array(np.array(kept) & ~failed), pa.array(ratio), pa.array(odd)],
                    names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, " + ", ".join(f"{c} long" for c in counts)
        + ", base_failed boolean, kept boolean, ratio double, odd_chunks double")


def op6_compression_bands(spark, sf_dir):
    """All documents under the contract's rules and the compression bands."""
    return apply_rules(table(prepare(spark), sf_dir, "documents"))
