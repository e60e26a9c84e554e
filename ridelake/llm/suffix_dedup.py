"""Exact substring dedup by prefix-free parsing, for highly repetitive text.

Every byte covered by a ``length``-byte string that also starts earlier (in a
smaller document, or earlier in the same one) is removed.

1. Parsing.  A rolling hash of ``GRAM`` bytes triggers a phrase at the least
   hash of every window of ``length - GRAM + 1`` grams, so each string of
   ``length`` bytes holds a trigger, chosen by its content alone.  A phrase is
   the text around its trigger that any such string can reach.
2. Dictionary and parse.  Equal phrases collapse: the first one (in corpus
   order) stands in the dictionary, all others are parse entries whose whole
   phrase is a repeat.  Map tasks collapse what they hold before the shuffle,
   so a group of copies sends a row a task, not a row a copy.
3. Suffix order.  Only dictionary phrases that share a trigger with another
   one can still hold a common string.  Their suffixes, cut at ``length``
   bytes, are sorted by content and then by their place in the corpus; all but
   the first of a run of equals are repeats.

Work follows the distinct text, not the repeats.  Corpus order is (doc_id,
row of that id, byte).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mix64, numbered, prepare, staged, table

GRAM = 32
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


# ------------------------------------------------------------------- parsing

def _words_at_every_byte(raw: bytes) -> np.ndarray:
    """Eight bytes from each position, as one unsigned number each."""
    n = len(raw) - 7
    out = np.empty(n, np.uint64)
    for o in range(min(8, n)):
        out[o::8] = np.frombuffer(raw, "<u8", offset=o, count=(n - o + 7) // 8)
    return out


def _least_in_windows(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` values."""
    m, have = x, 1
    while 2 * have <= width:
        m = np.minimum(m[:-have], m[have:])
        have *= 2
    return np.minimum(m[:len(m) - (width - have)], m[width - have:]) if have < width else m


class Segments:
    """Byte ranges of texts laid out in one buffer with zeros between them."""

    def __init__(self, length: int):
        self.length, self.reach = length, length - GRAM
        self.gap = length + self.reach
        self.parts: list[bytes] = [bytes(self.gap)]
        self.size = self.gap
        self.rows: list[tuple[int, int, int, int, int]] = []  # row, offset, lo, first, last window

    def add(self, row: int, text: bytes, first: int, last: int) -> None:
        lo, hi = max(0, first - self.reach), min(len(text), last + self.gap)
        self.rows.append((row, self.size - lo, first, last, len(text)))
        self.parts += [text[lo:hi], bytes(self.gap)]
        self.size += hi - lo + self.gap

    def triggers(self):
        """(row, place, phrase end, gram hash, phrase hash) of the triggers, in order."""
        raw = b"".join(self.parts) + bytes(8)
        eight = _words_at_every_byte(raw)
        sixteen = eight[:-8] * _A + eight[8:]
        gram = mix64(sixteen[:-16] * _B + sixteen[16:])
        bits = np.uint64(max(1, int(len(gram)).bit_length()))
        placed = (gram >> bits << bits) | np.arange(len(gram), dtype=np.uint64)
        least = _least_in_windows(placed, self.length - GRAM + 1)
        row, shift, first, last, size = (np.array(c, np.int64) for c in zip(*self.rows))
        n = last - first
        own = np.repeat(np.arange(len(n)), n)
        at = np.arange(int(n.sum())) + np.repeat(first + shift - (np.cumsum(n) - n), n)
        hit = (least[at] & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
        new = np.ones(len(hit), bool)
        new[1:] = (hit[1:] != hit[:-1]) | (own[1:] != own[:-1])
        hit, own = hit[new], own[new]
        place = hit - shift[own]
        left = np.minimum(place, self.reach)
        right = np.minimum(size[own] - place, self.length)
        phrase = mix64((left * 1024 + right).astype(np.uint64))
        for o in range(-self.reach, self.length, 8):
            # bytes beyond a text are zeros here; the lengths above tell them from real ones
            phrase = mix64((phrase ^ eight[hit + min(o, self.length - 8)]) * _A)
        return row[own], place, place + right, gram[hit], phrase


def _collapse(doc, n, place, end, gram, phrase):
    """Of equal phrases the first stays; the others are repeats: masks."""
    order = np.lexsort((place, n, doc))
    order = order[np.argsort((gram ^ (phrase * _A))[order], kind="stable")]
    same = np.zeros(len(order), bool)
    same[1:] = (gram[order][1:] == gram[order][:-1]) & (phrase[order][1:] == phrase[order][:-1])
    again = np.zeros(len(order), bool)
    again[order] = same
    return again


def _merged(doc, n, start, end):
    """Overlapping or touching ranges of one text as one range."""
    order = np.lexsort((start, n, doc))
    doc, n, start, end = doc[order], n[order], start[order], end[order]
    new = np.ones(len(doc), bool)
    if len(doc) > 1:
        fresh = (doc[1:] != doc[:-1]) | (n[1:] != n[:-1])
        group = np.cumsum(np.concatenate(([True], fresh)))
        # the furthest end so far within the text: texts are lifted above one another
        lift = group * (int(end.max()) + 2)
        far = np.maximum.accumulate(end + lift)
        new[1:] = fresh | (start[1:] + lift[1:] > far[:-1])
        first = np.flatnonzero(new)
        end = np.append(far[first[1:] - 1], far[-1]) - lift[first]
        doc, n, start = doc[first], n[first], start[first]
    return doc, n, start, end


_NAMES = ["gram", "phrase", "doc", "_n", "start", "end"]
_ROWS = "gram long, phrase long, doc long, _n int, start long, end long"


def _rows(gram, phrase, doc, n, start, end) -> pa.RecordBatch:
    def longs(x):
        return pa.nulls(len(doc), pa.int64()) if x is None else pa.array(x.view(np.int64))
    return pa.RecordBatch.from_arrays(
        [longs(gram), longs(phrase), pa.array(doc), pa.array(n.astype(np.int32)),
         pa.array(start), pa.array(end)], _NAMES)


def _parse(length: int, segment: int = 1 << 17, buffer: int = 1 << 18, hold: int = 1_500_000):
    """(doc, _n, text) -> phrases (gram and phrase set; start is the trigger)
    and repeats (both null), collapsed over ``hold`` phrases at a time."""
    reach = length - GRAM

    def emit(held):
        doc, n, place, end, gram, phrase = (np.concatenate(c) for c in zip(*held))
        again = _collapse(doc, n, place, end, gram, phrase)
        one = ~again
        if again.any():
            yield _rows(None, None, *_merged(doc[again], n[again],
                                             np.maximum(place[again] - reach, 0), end[again]))
        yield _rows(gram[one], phrase[one], doc[one], n[one], place[one], end[one])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0

        def flush(segs, docs, ns, last):
            row, place, end, gram, phrase = segs.triggers()
            # a trigger on the seam of two segments of one text comes twice
            keep = np.ones(len(row), bool)
            keep[1:] = (row[1:] != row[:-1]) | (place[1:] != place[:-1])
            if len(row) and last == (row[0], place[0]):
                keep[0] = False
            back = (int(row[-1]), int(place[-1])) if len(row) else last
            row = row[keep]
            held.append((docs[row], ns[row], place[keep], end[keep], gram[keep], phrase[keep]))
            return back, len(row)

        for b in batches:
            docs = b.column(0).to_numpy(zero_copy_only=False)
            ns = b.column(1).to_numpy(zero_copy_only=False)
            segs, last = Segments(length), None
            for r, t in enumerate(b.column(2)):
                text = t.as_buffer().to_pybytes() if t.is_valid else b""
                for first in range(0, len(text) - length + 1, segment):
                    segs.add(r, text, first, min(first + segment, len(text) - length + 1))
                    if segs.size >= buffer:
                        last, k = flush(segs, docs, ns, last)
                        segs, count = Segments(length), count + k
                if count >= hold:
                    yield from emit(held)
                    held, count = [], 0
            if segs.rows:
                count += flush(segs, docs, ns, last)[1]
        if held:
            yield from emit(held)

    return run


# ------------------------------------------------- dictionary, parse, suffixes

def _dictionary(length: int):
    """Rows sorted by (gram, phrase, corpus order) -> repeats, and the
    dictionary phrases whose gram has another phrase (gram set)."""
    reach = length - GRAM

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = held = None  # last row's (gram, phrase); the last first-of-its-kind, undecided
        alone = True
        for b in batches:
            own = b.column(0).is_valid().to_numpy(zero_copy_only=False)
            if not own.all():
                yield b.filter(pa.array(~own))
                b = b.filter(pa.array(own))
            if not b.num_rows:
                continue
            gram, phrase, doc, n, start, end = (c.to_numpy(zero_copy_only=False) for c in b.columns)
            new_gram, new = np.ones(len(gram), bool), np.ones(len(gram), bool)
            new_gram[1:] = gram[1:] != gram[:-1]
            new[1:] = new_gram[1:] | (phrase[1:] != phrase[:-1])
            if seen is not None:
                new_gram[0] = gram[0] != seen[0]
                new[0] = new_gram[0] or phrase[0] != seen[1]
            seen = (gram[-1], phrase[-1])
            again = ~new
            if again.any():
                yield _rows(None, None, *_merged(doc[again], n[again],
                                                 np.maximum(start[again] - reach, 0), end[again]))
            cols = [c[new] for c in (gram, phrase, doc, n, start, end)]
            first = new_gram[new]
            if held is not None:
                cols = [np.concatenate((h, c)) for h, c in zip(held, cols)]
                first = np.concatenate(([alone], first))
            if not len(first):
                continue
            # shared: the one before, or the one after, has the same gram
            shared = ~first
            shared[:-1] |= ~first[1:]
            held, alone = [c[-1:] for c in cols], bool(first[-1])
            shared[-1] = False
            if shared.any():
                yield _rows(*[c[shared] for c in cols])
        if held is not None and not alone:
            yield _rows(*held)

    return run


def _contexts(length: int):
    """(doc, _n, text, [(gram, start, end)]) -> rows with the phrase's bytes."""
    reach = length - GRAM
    names = ["gram", "doc", "_n", "start", "end", "bytes"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in range(b.num_rows):
                text = b.column(2)[r].as_buffer().to_pybytes()
                marks = b.column(3).slice(r, 1).flatten()
                gram, start, end = (marks.field(i) for i in range(3))
                cut = [text[max(0, s - reach):e] for s, e in zip(start.to_pylist(), end.to_pylist())]
                same = pa.array(np.zeros(len(cut), np.int64))
                yield pa.RecordBatch.from_arrays(
                    [gram, b.column(0).slice(r, 1).take(same), b.column(1).slice(r, 1).take(same),
                     start, end, pa.array(cut, pa.binary())], names)

    return run


_CONTEXT = "gram long, doc long, _n int, start long, end long, bytes binary"


def _windows(length: int, gram, doc, n, start, end, texts):
    """All strings of ``length`` bytes around the triggers: (row, place, hash)."""
    reach, wide = length - GRAM, 2 * length - GRAM + 8
    pads = [bytes(max(0, reach - s)) + t for s, t in zip(start.tolist(), texts)]
    raw = b"".join(p.ljust(wide, b"\0") for p in pads) + bytes(8)
    h, have = _words_at_every_byte(raw)[:len(pads) * wide], 8
    while 2 * have <= length:
        h = mix64(h * _A + np.append(h[have:], np.zeros(have, np.uint64)))
        have *= 2
    h = mix64(h * _A + np.append(h[length - have:], np.zeros(length - have, np.uint64)) * _B)
    h = h.reshape(-1, wide)[:, :reach + 1]
    h = mix64(h ^ (gram.view(np.uint64) * _B)[:, None])
    place = (start - reach)[:, None] + np.arange(reach + 1)[None, :]
    ok = (place >= 0) & (place + length <= end[:, None])
    row = np.broadcast_to(np.arange(len(pads))[:, None], ok.shape)
    return row[ok], place[ok], h[ok]


def _ordered_suffixes(length: int, max_group: int | None, chunk: int = 16_384):
    """Phrases sorted by (gram, corpus order) -> repeats; the phrases of a gram
    with more than ``max_group`` of them pass through (gram set)."""
    def repeats(cols):
        gram, doc, n, start, end, texts = cols
        row, place, h = _windows(length, gram, doc, n, start, end, texts)
        order = np.argsort(h, kind="stable")
        same = h[order][1:] == h[order][:-1]
        twin = np.zeros(len(order), bool)
        twin[1:] = same
        twin[:-1] |= same
        order = order[twin]
        if not len(order):
            return
        row, place, h = row[order], place[order], h[order]
        order = np.lexsort((place, n[row], doc[row], h))
        row, place, h = row[order], place[order], h[order]
        head = np.concatenate(([True], h[1:] != h[:-1]))
        first = np.flatnonzero(head)[np.cumsum(head) - 1]
        again = ((doc[row] != doc[row[first]]) | (n[row] != n[row[first]]) | (place != place[first]))
        row, place = row[again], place[again]
        if len(row):
            doc, n, start, end = _merged(doc[row], n[row], place, place + length)
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(len(doc), pa.int64()), pa.array(doc), pa.array(n.astype(np.int32)),
                 pa.array(start), pa.array(end), pa.nulls(len(doc), pa.binary())],
                ["gram", "doc", "_n", "start", "end", "bytes"])

    def columns(b):
        return [c.to_numpy(zero_copy_only=False) for c in b.columns[:5]] + [b.column(5).to_pylist()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, passing = [], 0, None  # whole groups, then the open one

        def settle(final):
            nonlocal held, size, passing
            t = pa.Table.from_batches(held).combine_chunks()
            gram = t["gram"].to_numpy()
            cut = t.num_rows if final else int(np.flatnonzero(gram != gram[-1])[-1]) + 1 \
                if (gram != gram[-1]).any() else 0
            edges = np.flatnonzero(np.concatenate(([True], gram[:cut][1:] != gram[:cut][:-1], [True]))) \
                if cut else np.zeros(1, int)
            lo = 0
            for a, z in zip(edges[:-1], edges[1:]):  # groups together up to a chunk of rows
                if max_group is not None and z - a > max_group:
                    if a > lo:
                        yield from repeats(columns(t.slice(lo, a - lo).combine_chunks().to_batches()[0]))
                    yield from t.slice(a, z - a).to_batches()
                    lo = z
                elif z - lo >= chunk:
                    yield from repeats(columns(t.slice(lo, z - lo).combine_chunks().to_batches()[0]))
                    lo = z
            if cut > lo:
                yield from repeats(columns(t.slice(lo, cut - lo).combine_chunks().to_batches()[0]))
            rest = t.slice(cut)
            if max_group is not None and rest.num_rows > max_group:
                passing = int(gram[-1])
                yield from rest.to_batches()
                rest = rest.slice(0, 0)
            held, size = rest.to_batches(), rest.num_rows

        for b in batches:
            if passing is not None:
                more = b.column(0).to_numpy(zero_copy_only=False) == passing
                k = int(more.sum())
                if k:
                    yield b.slice(0, k)
                b = b.slice(k)
                if not b.num_rows:
                    continue
                passing = None
            held.append(b)
            size += b.num_rows
            if size >= chunk:
                yield from settle(False)
        if size:
            yield from settle(True)

    return run


def _all_windows(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 4096):
                p = b.slice(lo, 4096)
                gram, doc, n, start, end = (c.to_numpy(zero_copy_only=False) for c in p.columns[:5])
                row, place, h = _windows(length, gram, doc, n, start, end, p.column(5).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h.view(np.int64)), pa.array(doc[row]), pa.array(n[row]), pa.array(place)],
                    ["h", "doc", "_n", "start"])

    return run


def _keyed(docs: DataFrame) -> DataFrame:
    return numbered(docs).select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("doc"), "_n", "text", "doc_id")


def repeated_ranges(docs: DataFrame, length: int = 100, max_group: int = 100_000) -> DataFrame:
    """(doc, _n, start, end): byte ranges that together hold every byte covered
    by a repeated string; they may overlap."""
    if length < 2 * GRAM:
        raise ValueError(f"length must be {2 * GRAM} or more")
    keyed = _keyed(docs)
    phrases = keyed.select("doc", "_n", "text").mapInArrow(_parse(length), _ROWS)
    # repeats found already have no gram: they are dealt out by their place
    dealt = phrases.repartition(F.coalesce("gram", F.xxhash64("doc", "_n", "start")))
    found = staged(dealt.sortWithinPartitions("gram", "phrase", "doc", "_n", "start")
                   .mapInArrow(_dictionary(length), _ROWS), "phrases")
    ranges = ["doc", "_n", "start", "end"]
    marks = (found.where("gram IS NOT NULL").groupBy("doc", "_n")
             .agg(F.collect_list(F.struct("gram", "start", "end")).alias("marks")))
    bodies = (keyed.select("doc", "_n", "text").join(marks, ["doc", "_n"])
              .mapInArrow(_contexts(length), _CONTEXT))
    late = staged(bodies.repartition("gram").sortWithinPartitions("gram", "doc", "_n", "start")
                  .mapInArrow(_ordered_suffixes(length, max_group), _CONTEXT), "suffixes")
    out = found.where("gram IS NULL").select(ranges).unionByName(
        late.where("gram IS NULL").select(ranges))
    hot = late.where("gram IS NOT NULL")
    if not hot.isEmpty():
        # one trigger with very many contexts: each string is its own key here
        every = hot.mapInArrow(_all_windows(length), "h long, doc long, _n int, start long")
        first = (every.groupBy("h").agg(F.min(F.struct("doc", "_n", "start")).alias("first"),
                                        F.count("*").alias("c")).where("c > 1"))
        more = (every.join(first, "h").where(F.struct("doc", "_n", "start") != F.col("first"))
                .select("doc", "_n", "start", (F.col("start") + length).alias("end")))
        out = out.unionByName(more)
    return out


def _removed(with_text: bool):
    """(doc_id, text, ranges) -> what is left of each text."""
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["_row", "text"] * with_text

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols = [[] for _ in range(4)]
            texts = []
            for t, marks in zip(b.column(1), b.column(2)):
                text = t.as_buffer().to_pybytes() if t.is_valid else b""
                kept, at, spans, gone = [], 0, 0, 0
                if marks.is_valid:
                    s, e = (marks.values.field(i).to_numpy(zero_copy_only=False) for i in range(2))
                    z = np.zeros(len(s), np.int64)
                    for lo, hi in zip(*(x.tolist() for x in _merged(z, z, s, e)[2:])):
                        kept.append(text[at:lo])
                        at, spans, gone = hi, spans + 1, gone + hi - lo
                kept.append(text[at:])
                left = b"".join(kept)
                for c, v in zip(cols, (len(text), gone, spans, hashlib.sha256(left).hexdigest())):
                    c.append(v)
                # a range may end inside a character: what is left of it goes too
                texts.append(left.decode("utf-8", "ignore") if t.is_valid else None)
            out = [b.column(0)] + [pa.array(c) for c in cols]
            yield pa.RecordBatch.from_arrays(out + ([b.column(3), pa.array(texts, pa.string())]
                                                    if with_text else []), names)

    return run


def remove_repeats(docs: DataFrame, length: int = 100, max_group: int = 100_000,
                   keep: tuple[str, ...] | None = None) -> DataFrame:
    """One row a document: its size, what is removed of it, and the SHA-256 of
    what is left; with ``keep`` (column names of ``docs``) also those columns,
    the text among them as it is left (a cut character is dropped).

    Texts are UTF-8 bytes; a null text is empty (and stays null in ``keep``).
    ``doc_id`` is an integer; rows that repeat an id follow one another in the
    order of their texts, and a null id comes before all others.  Texts shorter
    than ``length`` are never touched.  An empty table gives no rows; columns
    that are not kept are not read.
    """
    ranges = (repeated_ranges(docs, length, max_group).groupBy("doc", "_n")
              .agg(F.collect_list(F.struct("start", "end")).alias("ranges"))
              .withColumnRenamed("doc", "_doc").withColumnRenamed("_n", "_m"))
    rest = [c for c in keep or () if c not in ("text", "doc_id")]
    source = docs.select("doc_id", "text", F.struct(*[F.col(c) for c in rest]).alias("_row")) \
        if rest else docs.select("doc_id", "text", F.struct(F.lit(0).alias("_")).alias("_row"))
    rows = numbered(source, ("text", "_row")).withColumn(
        "_k", F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))))
    joined = rows.join(ranges, (rows["_k"] == ranges["_doc"]) & (rows["_n"] == ranges["_m"]), "left")
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    if keep is None:
        return joined.select("doc_id", "text", "ranges").mapInArrow(_removed(False), schema)
    row = source.schema["_row"].dataType.simpleString()
    out = joined.select("doc_id", "text", "ranges", "_row").mapInArrow(
        _removed(True), f"{schema}, _row {row}, text string")
    return out.select(*[F.col(c) if c in ("doc_id", "text") else F.col(f"_row.{c}") for c in keep],
                      "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op4_suffix_dedup(spark, sf_dir):
    """All documents without the bytes of repeated 100-byte strings."""
    return remove_repeats(table(prepare(spark), sf_dir, "documents"))
