"""Fill-in-the-middle examples: a text is cut in three at ranks of its units.

Units (lines, by default) are the nodes of an indexable skip list.  An edge of
a lane carries how many units and how many code points it passes over; a lane
above takes about a quarter of the nodes below, by a hash of their number, and
its widths are sums of those below.  A rank is reached from the top lane by
moving on while the units passed stay within it, then going down; the code
points passed on the way are the place in the text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import mix64, prepare, table, text_slices

LINES = r"[^\n]*\n|[^\n]+"
MARKS = ("<P>", "<S>", "<M>")


class SkipList:
    """Units by their lengths in code points."""

    def __init__(self, lengths: np.ndarray):
        chars = np.asarray(lengths, np.int64)
        units = np.ones(len(chars), np.int64)
        coin = mix64(np.arange(1, len(chars) + 1, dtype=np.uint64))
        #: lane -> (units, code points) of the edge from each node to the next
        self.lanes = [(units, chars)]
        #: lane -> number in the lane below of each node; node 0 stands before all units
        self.below = [np.zeros(0, np.int64)]
        while True:
            up = np.flatnonzero(coin & np.uint64(3) == 0)  # edges that end in a promoted node
            if not len(up):
                break
            first = np.append(0, up[:-1] + 1)
            units, chars = (np.add.reduceat(w[:up[-1] + 1], first) for w in (units, chars))
            self.lanes.append((units, chars))
            self.below.append(np.append(0, up + 1))
            coin = coin[up] >> np.uint64(2)
            if len(up) == 1:
                break

    def seek(self, rank: int) -> int:
        """Code points before the unit of this rank (all of them for the rank
        past the last unit)."""
        node = passed = place = 0
        for lane in range(len(self.lanes) - 1, -1, -1):
            units, chars = self.lanes[lane]
            while node < len(units) and passed + units[node] <= rank:
                passed += int(units[node])
                place += int(chars[node])
                node += 1
            if lane:
                node = int(self.below[lane][node])
        if passed != rank:
            raise IndexError(rank)
        return place


def draws(key: Column, seed: int) -> list[Column]:
    """Four numbers below 2^32 from the sha256 of ``seed:key``; a null key is
    an empty one."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    digest = F.sha2(name.cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def _split(unit: str, marks: tuple[str, str, str], rate: int, spm_rate: int, names: list[str]):
    """(key, text, h1..h4) -> key, n, form, prefix, middle and suffix lengths, output."""
    finder, (p, s, m) = re.compile(unit), marks

    def example(text: str, h1: int, h2: int, h3: int, h4: int):
        lengths = np.fromiter(map(len, finder.findall(text)), np.int64)
        if lengths.sum() != len(text):
            raise ValueError(f"units by {unit!r} do not cover the text")
        n = len(lengths)
        if not text or h3 % 100 >= rate or any(mark in text for mark in marks):
            return n, "plain", None, None, None, text
        units = SkipList(lengths)
        a, b = (units.seek(r) for r in sorted((h1 % (n + 1), h2 % (n + 1))))
        prefix, middle, suffix = text[:a], text[a:b], text[b:]
        if h4 % 100 < spm_rate:
            return n, "spm", a, b - a, len(text) - b, f"{s}{suffix}{p}{prefix}{m}{middle}"
        return n, "psm", a, b - a, len(text) - b, f"{p}{prefix}{s}{suffix}{m}{middle}"

    kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in text_slices(b):
                h = [c.to_pylist() for c in part.columns[2:]]
                rows = [example(t.as_py() or "", *hs) for t, *hs in zip(part.column(1), *h)]
                made = zip(*rows) if rows else [[]] * len(kinds)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *[pa.array(c, k) for c, k in zip(made, kinds)]], names)

    return run


def fill_in_middle(docs: DataFrame, seed: int, unit: str = LINES, marks: tuple[str, str, str] = MARKS,
                   rate: int = 100, spm_rate: int = 50) -> DataFrame:
    """Examples of all documents: ``doc_id``, ``n`` units, ``form``, code points
    of the three parts, ``output``.

    ``unit`` is a pattern whose matches cover the text.  The two cuts, whether
    to cut (``rate`` per cent) and the form (``spm_rate`` per cent suffix
    first) follow from ``seed`` and ``doc_id`` alone, so a re-run cuts alike
    and rows that share an id share their draws.  A null id counts as an empty
    key, a null text as an empty one.  Texts that are empty or hold a mark stay
    plain; their part lengths are null.  An empty table gives no rows; other
    columns are not read.  A very long text is one row of one task."""
    if not all(marks) or len(set(marks)) < 3:
        raise ValueError("three different marks are needed")
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "suffix_chars", "output"]
    drawn = docs.select("doc_id", "text", *[h.alias(f"h{i}") for i, h in enumerate(draws(F.col("doc_id"), seed), 1)])
    return drawn.mapInArrow(
        _split(unit, marks, rate, spm_rate, names),
        f"doc_id {kind}, n long, form string, prefix_chars long, middle_chars long, suffix_chars long, output string")


def restored(output: Column, form: Column, marks: tuple[str, str, str] = MARKS) -> Column:
    """The text of an example, from its output and form alone: a cut text holds
    no mark, so each mark stands once."""
    parts = F.split(output, "|".join(f"\\Q{m}\\E" for m in marks), -1)
    return (F.when(form == "psm", F.concat(parts[1], parts[3], parts[2]))
            .when(form == "spm", F.concat(parts[2], parts[3], parts[1]))
            .otherwise(output))


def op12_fill_in_middle(spark, sf_dir):
    """All documents cut at lines drawn under seed 7."""
    made = fill_in_middle(table(prepare(spark), sf_dir, "documents"), seed=7)
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")).cast("binary"), 256).alias("restored_sha256"))
