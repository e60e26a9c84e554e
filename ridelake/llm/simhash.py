"""Near-duplicate detection over SimHash fingerprints by segment popcounts.

A 64-bit fingerprint is embedded as the bit counts of its 32 two-bit
segments (packed two bits a segment, so the embedding is one long).  The
Manhattan distance of two embeddings never exceeds the Hamming distance of
the fingerprints.  The grid groups the segments into ``blocks``; fingerprints
within ``max_bits`` agree on the counts of all but ``max_bits`` blocks, so the
range join is one equality join for each choice of the agreeing blocks.
Pairs that meet in a cell pass the Manhattan bound over all segments and then
the exact bit distance.

Copies collapse first: the join works on distinct fingerprints.  A cell never
emits all its pairs, only a spanning forest of its links, and a cell beyond
``max_cell`` is dealt out again in pairs of hashed chunks, so no task holds
more than two chunks.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prepare, staged, table
from .components import components

SEED = 42
_LOW = 0x5555555555555555
_COLUMN = (np.arange(8) * 256).astype(np.int64)
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)


# ---------------------------------------------------------------- fingerprints

def simhash(text: str | None, shingle: int = 4) -> int:
    """Fingerprint of one text: majority bits of the XXH64 of its word shingles."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(b" ".join(words), SEED)]
    else:
        joined = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[s:e], SEED) for s, e in
                  zip(starts[:len(words) - shingle + 1].tolist(), ends[shingle - 1:].tolist())]
    counts = np.zeros((8, 8), np.int64)
    for i in range(0, len(hashes), 1 << 15):
        h = np.array(hashes[i:i + (1 << 15)], ">u8").view(np.uint8).reshape(-1, 8)
        at = h + _COLUMN  # how often each byte value stands in each of the 8 bytes
        counts += np.bincount(at.ravel(), minlength=2048).reshape(8, 256) @ _BITS
    return int.from_bytes(np.packbits(2 * counts.ravel() > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = 4) -> DataFrame:
    """(doc_id, fp bigint) of every row; a null text counts as empty."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = [simhash(t.as_py(), shingle) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(np.array(fp, np.uint64).view(np.int64))], ["doc_id", "fp"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, fp long")


# ------------------------------------------------------------------- grid join

def embedding(fp):
    """Bit counts of the 32 two-bit segments, packed in a long (column form)."""
    low, high = fp.bitwiseAND(F.lit(_LOW)), F.shiftrightunsigned(fp, 1).bitwiseAND(F.lit(_LOW))
    return F.shiftleft(low.bitwiseAND(high), 1).bitwiseOR(low.bitwiseXOR(high))


def block_masks(blocks: int, max_bits: int) -> list[int]:
    """Signed masks of the segments to agree on, one a choice of blocks."""
    if not max_bits < blocks <= 32:
        raise ValueError("more blocks than bits, and at most 32, are needed")
    edges = [32 * i // blocks for i in range(blocks + 1)]
    parts = [sum(3 << (2 * s) for s in range(a, b)) for a, b in zip(edges, edges[1:])]
    masks = (sum(c) for c in combinations(parts, blocks - max_bits))
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def _embed(x: np.ndarray) -> np.ndarray:
    low, high = x & np.uint64(_LOW), (x >> np.uint64(1)) & np.uint64(_LOW)
    return ((low & high) << np.uint64(1)) | (low ^ high)


def near(a: np.ndarray, b: np.ndarray, max_bits: int) -> np.ndarray:
    """Pairwise: within ``max_bits``?  The Manhattan distance of the embeddings
    bounds it from below; what passes is verified on the bits."""
    d = _embed(a) ^ _embed(b)
    two = (d >> np.uint64(1)) & ~d & np.uint64(_LOW)  # counts 0 and 2
    bound = np.bitwise_count(d & np.uint64(_LOW)) + 2 * np.bitwise_count(two)
    ok = bound <= max_bits
    ok[ok] = np.bitwise_count((a ^ b)[ok] if len(a) == len(b) else (a ^ b[ok])) <= max_bits
    return ok


def forest(fps: np.ndarray, max_bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links that span each component of one cell."""
    out, rest = [], np.unique(fps)
    while len(rest) > 1:
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            p = np.array([queue.pop()], np.uint64)
            hit = near(p, rest, max_bits)
            if hit.any():
                new = rest[hit]
                out.append((np.repeat(p, len(new)), new))
                queue.extend(new.tolist())
                rest = rest[~hit]
    return out


def _cell_links(max_bits: int, max_cell: int | None, small: int = 12):
    """Rows (cell, fp) sorted by cell -> links (a, b), or (fp, null, cell) for
    the members of a cell beyond ``max_cell``."""
    names = ["a", "b", "cell"]

    def links(a, b):
        return pa.RecordBatch.from_arrays(
            [pa.array(a.view(np.int64)), pa.array(b.view(np.int64)), pa.nulls(len(a), pa.int64())], names)

    def hot(cell, fp):
        return pa.RecordBatch.from_arrays(
            [pa.array(fp.view(np.int64)), pa.nulls(len(fp), pa.int64()),
             pa.array(np.full(len(fp), cell, np.int64))], names)

    def whole(cells, fps):
        starts = np.flatnonzero(np.concatenate(([True], cells[1:] != cells[:-1])))
        sizes = np.diff(np.append(starts, len(cells)))
        few = np.repeat(sizes <= small, sizes)
        found = []
        for d in range(1, small):  # all pairs of the small cells, by distance in the order
            at = np.flatnonzero((cells[:-d] == cells[d:]) & few[:-d])
            if not len(at):
                break
            ok = near(fps[at], fps[at + d], max_bits)
            found.append((fps[at][ok], fps[at + d][ok]))
        for s, n in zip(starts[sizes > small].tolist(), sizes[sizes > small].tolist()):
            found += forest(fps[s:s + n], max_bits)
        found = [x for x in found if len(x[0])]
        if found:
            a, b = (np.concatenate(x) for x in zip(*found))
            yield links(a, b)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, fps, passing = np.zeros(0, np.int64), np.zeros(0, np.uint64), None
        for batch in batches:
            c = batch.column(0).to_numpy(zero_copy_only=False)
            f = batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
            if passing is not None:  # the rest of a cell that is already being dealt out
                n = int(np.searchsorted(c, passing, side="right")) if c[0] == passing else 0
                if n:
                    yield hot(passing, f[:n])
                c, f = c[n:], f[n:]
                if not len(c):
                    continue
                passing = None
            cells, fps = np.concatenate((cells, c)), np.concatenate((fps, f))
            last = int(np.searchsorted(cells, cells[-1], side="left"))
            yield from split(cells[:last], fps[:last])
            cells, fps = cells[last:], fps[last:]
            if max_cell is not None and len(cells) > max_cell:
                passing = int(cells[0])
                yield hot(passing, fps)
                cells, fps = cells[:0], fps[:0]
        yield from split(cells, fps)

    def split(cells, fps):
        if max_cell is not None and len(cells):
            starts = np.flatnonzero(np.concatenate(([True], cells[1:] != cells[:-1])))
            sizes = np.diff(np.append(starts, len(cells)))
            for s, n in zip(starts[sizes > max_cell].tolist(), sizes[sizes > max_cell].tolist()):
                yield hot(int(cells[s]), fps[s:s + n])
            keep = np.repeat(sizes <= max_cell, sizes)
            cells, fps = cells[keep], fps[keep]
        if len(cells) > 1:
            yield from whole(cells, fps)

    return run


def linked_fingerprints(fps: DataFrame, max_bits: int = 4, blocks: int = 8,
                        max_cell: int = 4096) -> DataFrame:
    """(a, b): links between the distinct fingerprints ``fp`` that join every
    pair within ``max_bits`` into one component."""
    schema = "a long, b long, cell long"
    e = embedding(F.col("fp"))
    cells = F.array(*[F.xxhash64(F.lit(i), e.bitwiseAND(F.lit(m)))
                      for i, m in enumerate(block_masks(blocks, max_bits))])
    dealt = fps.select(F.explode(cells).alias("cell"), "fp").repartition("cell")
    first = staged(dealt.sortWithinPartitions("cell")
                   .mapInArrow(_cell_links(max_bits, max_cell), schema), "cell-links")
    links, hot = first.where("cell IS NULL"), first.where("cell IS NOT NULL")
    if not hot.isEmpty():
        chunks = hot.groupBy("cell").agg(F.ceil(F.count("*") / F.lit(max_cell // 2)).alias("k"))
        own = F.pmod(F.xxhash64("a", F.lit(7)), F.col("k"))
        pairs = (hot.join(chunks, "cell").select("cell", "a", own.alias("c"), "k")
                 .select("cell", "a", "c", F.explode(F.sequence(F.lit(0).cast("long"), F.col("k") - 1)).alias("j"))
                 .select(F.xxhash64("cell", F.least("c", "j"), F.greatest("c", "j")).alias("cell"),
                         F.col("a").alias("fp")))
        links = links.unionByName(pairs.repartition("cell").sortWithinPartitions("cell")
                                  .mapInArrow(_cell_links(max_bits, None), schema))
    return links.select("a", "b")


def near_duplicates(docs: DataFrame, shingle: int = 4, max_bits: int = 4, blocks: int = 8,
                    max_cell: int = 4096) -> DataFrame:
    """Fingerprint and component of every row.

    ``component_id`` is the smallest ``doc_id`` reachable over links of at
    most ``max_bits`` bits.  Texts without words (null, empty, white space)
    have fingerprint zero and link like any other.  Rows that repeat an id are
    separate rows of one result; a null id is never a component's name unless
    all its ids are null.  An empty table gives no rows; other columns are not
    read.
    """
    marked = staged(fingerprints(docs, shingle), "fingerprints")
    fps = marked.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = components(linked_fingerprints(fps.select("fp"), max_bits, blocks, max_cell))
    named = (fps.join(roots, fps["fp"] == roots["node"], "left")
             .select("fp", "least", F.coalesce("root", "fp").alias("root")))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    of = named.select("fp", "root").join(least, "root").select("fp", "component_id")
    return marked.join(of, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op2_simhash_near_dedup(spark, sf_dir):
    """All documents: 4-word shingles, links at 4 or fewer bits."""
    return near_duplicates(table(prepare(spark), sf_dir, "documents"))
