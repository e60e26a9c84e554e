"""Byte-level BPE ids of whole texts with the tiktoken library, and back.

The library reads a rank file by path and a pattern; each match of the pattern
is merged by itself.  Its pattern matcher keeps one stack entry a character of
a run of white space and gives up on very long runs, so long texts are cut
first, only where a cut changes no match:

* before a white-space character that follows another character (a match
  holds white space at its front or is all white space), and between a letter
  or digit and a punctuation mark that follows it;
* a run of more than ``LONG_RUN`` white-space characters is one match but for
  its last character, which the next match may begin with; at the end of the
  text it is one match whole.  Such a match goes to the merges directly.

Ids are kept as little-endian unsigned 32-bit bytes; decoding gives raw bytes,
since an id need not end at a character's end.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from .common import prepare, table, text_slices
from .tokens import public_path

#: What the pattern's \s matches.
WHITE = "\t-\r \u0085\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
LONG_RUN = 4096
#: Texts beyond so many characters are cut near multiples of it.
SEGMENT = 1 << 16
#: Ids that are decoded at once.
DECODE = 1 << 18

_LONG = re.compile(f"[{WHITE}]{{{LONG_RUN + 1},}}")
_SAFE = re.compile(r"(?<=\S)(?=[ \t\n\r])"
                   r"|(?<=[0-9A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff\u3041-\u3096\u30a1-\u30fa\u4e00-\u9fa5\uac00-\ud7a3])"
                   r"(?=[!-/:-@\[-`{-~\u3001\u3002\uff01\uff0c\uff1a\uff1b\uff1f])")
_LOADED: dict = {}


def segments(text: str, size: int = SEGMENT) -> Iterator[tuple[str, bool]]:
    """Parts of a text whose ids, one after the other, are the text's; the flag
    marks a part that is a single match."""
    if len(text) <= min(size, LONG_RUN):
        yield text, False
        return
    at = 0
    for run in _LONG.finditer(text):
        start, end = run.span()
        yield from _cuts(text, at, start, size)
        at = end if end == len(text) else end - 1
        yield text[start:at], True
    yield from _cuts(text, at, len(text), size)


def _cuts(text: str, at: int, end: int, size: int) -> Iterator[tuple[str, bool]]:
    while end - at > size:
        cut = _SAFE.search(text, at + size, end)
        if cut is None:
            break
        yield text[at:cut.start()], False
        at = cut.start()
    if at < end:
        yield text[at:end], False


class ByteBPE:
    """The worker's encoder and decoder of a rank file."""

    def __init__(self, ranks_path: str, pattern: str):
        import tiktoken

        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, f)}
        self.by_match = tiktoken.Encoding("matches", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.as_match = tiktoken.Encoding("whole", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> bytes:
        """The ids of a text, four bytes each."""
        return b"".join(
            np.array((self.as_match if single else self.by_match).encode_ordinary(part), "<u4").tobytes()
            for part, single in segments(text))

    def decode(self, ids: bytes) -> bytes:
        """The bytes that ids stand for; an id without a rank is an error."""
        held = np.frombuffer(ids, "<u4")
        return b"".join(self.by_match.decode_bytes(held[i:i + DECODE].tolist())
                        for i in range(0, len(held), DECODE))


def byte_bpe(ranks_path: str, pattern: str) -> ByteBPE:
    key = ranks_path, pattern
    if key not in _LOADED:
        _LOADED[key] = ByteBPE(*key)
    return _LOADED[key]


def _mapped(df: DataFrame, read: str, write: str, keep: tuple[str, ...], convert) -> DataFrame:
    """``keep`` and a binary column ``write`` made of column ``read``."""
    if write in keep:
        raise ValueError(f"column {write} is made here and cannot be kept")
    # plain names inside: a kept column may have any name
    held = [F.col(f"`{c}`").alias(f"_{i}") for i, c in enumerate(keep)]
    source = df.select(F.col(read).alias("_in"), *held)
    schema = StructType([*source.schema.fields[1:], StructField("_out", BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in text_slices(b, "_in"):
                made = pa.array([convert(x.as_py()) for x in part.column(0)], pa.binary())
                yield pa.RecordBatch.from_arrays([*part.columns[1:], made], schema.names)

    return source.mapInArrow(run, schema).toDF(*keep, write)


def encode(docs: DataFrame, ranks_path: str, pattern: str, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` and ``ids``: the ids of every row's ``text``, little-endian
    unsigned 32-bit, without special tokens (their strings are ordinary text).

    A null text is empty and has no ids.  Each row is encoded by itself, so
    repeated rows give repeated results, ids may be null, and an empty table
    gives no rows.  Columns that are not kept are not read.  A text of any
    length is encoded whole; work arrays hold one segment of it."""
    return _mapped(docs, "text", "ids", keep,
                   lambda text: byte_bpe(ranks_path, pattern).encode(text or ""))


def decode(encoded: DataFrame, ranks_path: str, pattern: str, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` and ``decoded``: the bytes of every row's ``ids``.  Null ids
    give no bytes; bytes need not be UTF-8 unless the ids are a whole text's."""
    return _mapped(encoded, "ids", "decoded", keep,
                   lambda ids: byte_bpe(ranks_path, pattern).decode(ids or b""))


def op11_byte_bpe(spark, sf_dir):
    """Ids of all documents, digested, and the digest of what they decode to."""
    import public_tokenizers

    how = public_path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    docs = table(prepare(spark), sf_dir, "documents")
    back = decode(encode(docs, *how), *how, keep=("doc_id", "ids"))
    return back.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                       F.sha2("ids", 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))
