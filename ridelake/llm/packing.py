"""Packing examples into training sequences: vector bin packing.

An example has three demands: tokens, segments (one a piece) and loss-bearing
tokens.  A sequence is filled by the dot-product heuristic: of the pieces
that fit under all limits, take the one whose demand vector has the largest
dot product with what the sequence has left.  When nothing fits whole, a
piece is cut to fill the sequence, and the rest of it goes back to the pool.

Examples are cut into pieces and tokenised where they are read.  Pieces are
dealt by a hash of (document, piece) into bins of bounded expected size, so a
very long document is spread over many, and each bin is packed by itself.  A
sequence that is not full (the last of a bin, or one closed by another limit)
is split at powers of two, which need no padding.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import numbered, prepare, table
from .tokens import encoder, public_path

END_ID = 1


def cut_example(tokens: int, loss_from: int, max_tokens: int, max_loss: int) -> list[tuple[int, int]]:
    """(start, length) of pieces that each fit a sequence: full ones first, the
    rest last."""
    out, at = [], 0
    while at < tokens:
        n = min(tokens - at, max_tokens, max(loss_from - at, 0) + max_loss)
        out.append((at, n))
        at += n
    return out


def fill_sequences(lengths: np.ndarray, loss_from: np.ndarray, max_tokens: int,
                   max_segments: int, max_loss: int) -> list[list[tuple[int, int, int]]]:
    """Sequences as lists of (item, start, length); items are given by their
    length and the place in them from which tokens bear loss.

    Items of equal demands are one class, so a step costs no more than the
    number of different demands."""
    pool: dict[tuple[int, int], list[tuple[int, int]]] = {}
    for i in range(len(lengths) - 1, -1, -1):
        n, quiet = int(lengths[i]), int(min(max(loss_from[i], 0), lengths[i]))
        pool.setdefault((n, quiet), []).append((i, 0))
    keys = sorted(pool)
    # demands of the classes by column; a cut adds at most one class a sequence
    size, quiet = (np.array([k[i] for k in keys], np.int64) for i in (0, 1))
    loss, alive = size - quiet, np.ones(len(keys), bool)
    where = {k: j for j, k in enumerate(keys)}
    out, left = [], len(lengths)

    def take(j):
        item = pool[keys[j]].pop()
        alive[j] = bool(pool[keys[j]])
        return item

    def give_back(n, still, item):
        nonlocal size, quiet, loss, alive
        k = (n, still)
        if k not in where:
            where[k] = len(keys)
            keys.append(k)
            pool[k] = []
            size, quiet, loss = np.append(size, n), np.append(quiet, still), np.append(loss, n - still)
            alive = np.append(alive, False)
        pool[k].append(item)
        alive[where[k]] = True

    while left:
        tokens, segments, bearing, seq = max_tokens, max_segments, max_loss, []
        while left and tokens > 0 and segments > 0:
            # dot product of demand and room, each as a share of its limit (a
            # segment is the same demand for all)
            score = size * (tokens / max_tokens ** 2) + loss * (bearing / max_loss ** 2)
            score[~(alive & (size <= tokens) & (loss <= bearing))] = -1
            j = int(np.argmax(score))
            if score[j] >= 0:
                i, at = take(j)
                n, still = keys[j]
                left -= 1
            else:  # nothing fits whole: cut the longest that can fill the rest
                fill = np.minimum(tokens, quiet + bearing) * alive
                j = int(np.argmax(fill * (1 << 40) + size))
                n = int(fill[j])
                if n < 1:
                    break
                i, at = take(j)
                whole, still = keys[j]
                give_back(whole - n, max(still - n, 0), (i, at + n))
            tokens, segments, bearing = tokens - n, segments - 1, bearing - max(n - still, 0)
            seq.append((i, at, n))
        out.append(seq)
    return out


def split_at_powers(seq: list[tuple[int, int, int]]) -> list[list[tuple[int, int, int]]]:
    """A part-full sequence as sequences of power-of-two lengths, largest first."""
    total, out, rest = sum(n for _, _, n in seq), [], list(seq)
    for bit in range(total.bit_length() - 1, -1, -1):
        want, part = total & (1 << bit), []
        while want:
            i, at, n = rest.pop(0)
            m = min(n, want)
            part.append((i, at, m))
            if m < n:
                rest.insert(0, (i, at + m, n - m))
            want -= m
        if part:
            out.append(part)
    return out


def _pieces(tokenizer: str, end_id: int, max_tokens: int, max_loss: int, names: list[str],
            with_ids: bool):
    """(doc_id, _n, text, _loss_from) -> one row a piece; ids go along only
    where the piece may still be cut."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        end = np.array([end_id], enc.dtype).tobytes()
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                part = b.slice(lo, 256)
                rows, cols = [], [[] for _ in range(6)]
                for r, (text, quiet) in enumerate(zip(part.column(2), part.column(3).to_pylist())):
                    ids = np.frombuffer(enc.encode(text.as_py() or "") + end, enc.dtype)
                    for at, n in cut_example(len(ids), quiet, max_tokens, max_loss):
                        own = ids[at:at + n]
                        whole = n == max_tokens
                        rows.append(r)
                        for c, v in zip(cols, (at, n, max(quiet - at, 0), len(ids),
                                               zlib.crc32(own.astype("<u4")),
                                               None if whole and not with_ids else own.tobytes())):
                            c.append(v)
                at = pa.array(rows, pa.int64())
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(at), part.column(1).take(at)]
                    + [pa.array(c, k) for c, k in zip(cols, kinds)], names)

    return run


def _pack_bin(max_tokens: int, max_segments: int, max_loss: int, with_ids: bool):
    def run(key, t):
        t = t.sort_by([(c, "ascending") for c in ("doc_id", "_n", "start", "doc_tokens", "crc")])
        first = int(key[0].as_py()) << 32
        start, length = (t[c].to_numpy() for c in ("start", "length"))
        quiet, crc, ids = t["quiet"].to_numpy(), t["crc"].to_numpy(), t["ids"].combine_chunks()
        held = [x.as_py() for x in ids]
        whole = length == max_tokens
        pick = np.flatnonzero(~whole)
        packed = fill_sequences(length[pick], quiet[pick], max_tokens, max_segments, max_loss)
        seqs = [[(int(i), 0, max_tokens)] for i in np.flatnonzero(whole)]
        for s in packed:
            s = [(int(pick[i]), at, n) for i, at, n in s]
            seqs += [s] if sum(n for _, _, n in s) == max_tokens else split_at_powers(s)
        rows, out = [], {c: [] for c in ("start", "length", "crc", "sequence_id", "offset", "ids")}
        for k, s in enumerate(seqs):
            offset = 0
            for i, at, n in s:
                own = None
                if held[i] is not None and (with_ids or n < length[i]):
                    width = len(held[i]) // int(length[i])  # bytes an id
                    own = np.frombuffer(held[i], f"<u{width}")[at:at + n].astype("<u4")
                rows.append(i)
                for c, v in zip(out, (int(start[i]) + at, n,
                                      int(crc[i]) if n == length[i] else zlib.crc32(own),
                                      first + k, offset, own.tobytes() if with_ids and own is not None else None)):
                    out[c].append(v)
                offset += n
        t = t.take(pa.array(rows, pa.int64()))
        cols = {"doc_id": t["doc_id"], "start": out["start"], "length": out["length"],
                "ids_crc32": out["crc"], "doc_tokens": t["doc_tokens"],
                "sequence_id": out["sequence_id"], "offset": out["offset"]}
        if with_ids:
            cols["ids"] = pa.array(out["ids"], pa.binary())
        return pa.table(cols)

    return run


def pack_documents(docs: DataFrame, tokenizer: str, max_tokens: int = 2048, max_segments: int = 256,
                   max_loss: int | None = None, end_id: int = END_ID, bin_pieces: int = 16384,
                   loss_from=None, with_ids: bool = False) -> DataFrame:
    """Pieces of all documents in sequences under limits on tokens, segments
    and loss-bearing tokens (``max_loss``, by default ``max_tokens``).

    ``loss_from`` (a column; by default 0) is the token of a document from
    which tokens bear loss, as after the prompt of instruction data.  A null
    or empty text has the end id alone.  Rows that repeat an id are documents
    of their own; a null id is kept.  An empty table gives no rows; other
    columns are not read.  ``with_ids`` adds the ids themselves (unsigned
    32-bit, little-endian).  Each id of a document lies in exactly one piece;
    ``offset`` is gapless from 0 in each sequence.  Every sequence holds
    ``max_tokens`` or a power of two of them, whatever closed it, so none needs
    padding.
    """
    limit = max_tokens if max_loss is None else max_loss
    if min(max_tokens, max_segments, limit) < 1:
        raise ValueError("limits must be positive")
    source = docs.withColumn("_quiet", (F.lit(0) if loss_from is None else loss_from).cast("long"))
    rows = numbered(source, ("text", "_quiet")).select("doc_id", "_n", "text", F.coalesce("_quiet", F.lit(0)))
    # an id stands for one byte at least: a bound on the pieces, from one light pass
    least = min(max_tokens, limit)
    pieces = docs.agg(F.sum(F.floor(F.coalesce(F.octet_length("text"), F.lit(0)) / least) + 2)).first()[0]
    bins = max(1, -(-(pieces or 0) // bin_pieces))
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "_n", "start", "length", "quiet", "doc_tokens", "crc", "ids"]
    cut = rows.mapInArrow(
        _pieces(tokenizer, end_id, max_tokens, limit, names, with_ids),
        f"doc_id {kind}, _n int, start long, length long, quiet long, doc_tokens long, crc long, ids binary")
    dealt = cut.withColumn("bin", F.pmod(F.xxhash64("doc_id", "_n", "start"), F.lit(bins)))
    return dealt.groupBy("bin").applyInArrow(
        _pack_bin(max_tokens, max_segments, limit, with_ids),
        f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
        + (", ids binary" if with_ids else ""))


def op1_vector_packing(spark, sf_dir):
    """All documents in sequences of at most 2048 tokens."""
    docs = table(prepare(spark), sf_dir, "documents")
    return pack_documents(docs, public_path("byte_bpe_50k.json"))
