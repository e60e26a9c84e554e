"""Licence scans with a generalised suffix automaton over licence words.

The automaton accepts every substring of every template (and base phrase).
Streaming a document through it gives matching statistics: at each word, the
length of the longest template substring that ends there.  Maximal long
matches are chained, in template order and over small gaps, into spans; a
span that covers enough of its template labels the document.

Only runs of words whose neighbours are neighbours in some template can hold
a match of two or more words, so runs are found over whole batches of words
at once and the automaton sees nothing else.  No shuffle.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import (IS_MARK, LOWER, prepare, span_hashes, split_words, table, text_slices,
                     utf8_bytes)

#: (label, phrase): fixed values of the contract.
PHRASES = (("mit", "the mit license"), ("apache-2", "apache license version 2"),
           ("cc-by-nc", "cc by nc"))

#: Creative Commons clauses: (label, title, clause), fixed values.
CREATIVE_COMMONS = (
    ("cc-by", "Attribution", "BY"),
    ("cc-by-nc", "Attribution-NonCommercial", "BY-NC"),
    ("cc-by-nc-nd", "Attribution-NonCommercial-NoDerivatives", "BY-NC-ND"),
    ("cc-by-nc-nd", "Attribution-NonCommercial-NoDerivs", "BY-NC-ND"),
    ("cc-by-nc-sa", "Attribution-NonCommercial-ShareAlike", "BY-NC-SA"),
    ("cc-by-nd", "Attribution-NoDerivatives", "BY-ND"),
    ("cc-by-nd", "Attribution-NoDerivs", "BY-ND"),
    ("cc-by-sa", "Attribution-ShareAlike", "BY-SA"),
)

#: (label, text): openings, usual notices and short whole texts of public
#: licences, fixed values.  The words in braces tell a licence from its kin.
TEMPLATES = (
    ("agpl-3", "licensed under the {GNU Affero General Public License, version 3}"),
    ("apache-1.1", "Licensed under the {Apache License, Version 1.1}"),
    ("apache-2", "Licensed under the {Apache License, Version 2}.0"),
    ("apache-2", "Licensed under the {Apache License 2}.0"),
    ("apache-2", 'Licensed under the {Apache License, Version 2}.0 (the "License"); you may not use this'
                 " file except in compliance with the License. You may obtain a copy of the License at"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are"
            " permitted provided that the following conditions are met"),
    ("bsl-1", "Distributed under the {Boost Software License, Version 1}.0"),
    ("cc0-1", "licensed under {CC0 1}.0 Universal"),
    ("epl-1", "made available under the terms of the {Eclipse Public License v1}.0"),
    ("epl-2", "made available under the terms of the {Eclipse Public License 2}.0"),
    ("epl-2", "made available under the terms of the {Eclipse Public License v. 2}.0"),
    ("gpl-1", "licensed under the {GNU General Public License, version 1}"),
    ("gpl-2", "licensed under the {GNU General Public License, version 2}"),
    ("gpl-3", "licensed under the {GNU General Public License, version 3}"),
    ("gpl-2", "This program is free software; you can redistribute it and/or modify it under the"
              " terms of the {GNU General Public License as published by the Free Software Foundation;"
              " either version 2} of the License, or (at your option) any later version"),
    ("gpl-3", "This program is free software: you can redistribute it and/or modify it under the"
              " terms of the {GNU General Public License as published by the Free Software Foundation,"
              " either version 3} of the License, or (at your option) any later version"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or"
            " without fee is hereby granted"),
    ("lgpl-2", "licensed under the {GNU Library General Public License, version 2}"),
    ("lgpl-2.1", "licensed under the {GNU Lesser General Public License, version 2.1}"),
    ("lgpl-3", "licensed under the {GNU Lesser General Public License, version 3}"),
    ("mit", "Released under the {MIT License}"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this"
            ' software and associated documentation files (the "Software"), to deal in the Software'
            " without restriction"),
    ("mpl-1.1", "subject to the {Mozilla Public License Version 1.1}"),
    ("mpl-2", "This Source Code Form is subject to the terms of the {Mozilla Public License, v. 2}.0"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
    ("zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will"
             " the authors be held liable for any damages arising from the use of this software"),
    *((label, f"This work is licensed under a Creative Commons {{{title} {version[0]}}}{version[1:]} License")
      for label, title, _ in CREATIVE_COMMONS for version in ("3.0 Unported", "4.0 International")),
    *((label, f"Licensed under {{CC {clause} {version[0]}}}{version[1:]}")
      for label, clause in sorted({(label, clause) for label, _, clause in CREATIVE_COMMONS})
      for version in ("3.0", "4.0")),
)


def words_of(text: str) -> list[bytes]:
    low = LOWER[np.frombuffer(text.encode(), np.uint8)]
    starts, ends, _ = split_words(low, np.array([0, len(low)]), IS_MARK)
    raw = low.tobytes()
    return [raw[s:e] for s, e in zip(starts.tolist(), ends.tolist())]


def marked_words(text: str) -> tuple[list[bytes], tuple[int, int] | None]:
    """Words of a template, and the places (first, end) of those in braces."""
    before, _, rest = text.partition("{")
    inside, _, after = rest.partition("}")
    head, decisive = words_of(before), words_of(inside)
    return head + decisive + words_of(after), (len(head), len(head) + len(decisive)) if decisive else None


class SuffixAutomaton:
    """Generalised: one automaton over several sequences of integers.  Each
    state knows where (sequence, last place) its strings occur."""

    def __init__(self, sequences: list[list[int]]):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.ends: list[set[tuple[int, int]]] = [set()]
        for k, sequence in enumerate(sequences):
            last = 0
            for at, c in enumerate(sequence):
                last = self._extend(last, c)
                state = last
                while state > 0:  # all suffixes that end here; sequences are short
                    self.ends[state].add((k, at))
                    state = self.link[state]

    def _state(self, length, link, moves, ends) -> int:
        self.next.append(moves)
        self.link.append(link)
        self.length.append(length)
        self.ends.append(ends)
        return len(self.next) - 1

    def _split(self, p, c, q) -> int:
        """The copy of ``q`` that holds its strings up to one longer than ``p``'s."""
        clone = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]), set(self.ends[q]))
        self.link[q] = clone
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = clone
            p = self.link[p]
        return clone

    def _extend(self, last, c) -> int:
        q = self.next[last].get(c)
        if q is not None:
            return q if self.length[q] == self.length[last] + 1 else self._split(last, c, q)
        new, p = self._state(self.length[last] + 1, 0, {}, set()), last
        while p >= 0 and c not in self.next[p]:
            self.next[p][c] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][c]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, c, q)
        return new

    def statistics(self, run: list[int]) -> list[tuple[int, int]]:
        """(length, state) of the longest match that ends at each item."""
        out, state, n = [], 0, 0
        for c in run:
            while state and c not in self.next[state]:
                state = self.link[state]
                n = self.length[state]
            if c in self.next[state]:
                state, n = self.next[state][c], n + 1
            out.append((n, state))
        return out


class Scanner:
    def __init__(self, phrases, templates, min_match: int, min_cover: float, max_gap: int):
        marked = [(label, marked_words(t)) for label, t in (*phrases, *templates)]
        named = [(label, words) for label, (words, _) in marked]
        self.decisive = [place for _, (_, place) in marked]
        if any(len(w) < 2 for _, w in named):
            raise ValueError("phrases and templates need two words or more")
        self.labels = [label for label, _ in named]
        self.n_phrases, self.min_cover, self.max_gap = len(phrases), min_cover, max_gap
        self.min_match = min_match
        vocabulary = sorted({w for _, words in named for w in words})
        raw = np.frombuffer(b"".join(vocabulary), np.uint8)
        ends = np.cumsum([len(w) for w in vocabulary])
        hashes = span_hashes(raw, ends - [len(w) for w in vocabulary], ends)
        order = np.argsort(hashes)
        self.hashes, self.ids = hashes[order], order
        number = {w: i for i, w in enumerate(vocabulary)}
        self.sequences = [[number[w] for w in words] for _, words in named]
        self.automaton = SuffixAutomaton(self.sequences)
        self.pairs = np.zeros((len(vocabulary), len(vocabulary)), bool)
        for s in self.sequences:
            self.pairs[s[:-1], s[1:]] = True

    def runs(self, data: np.ndarray, offsets: np.ndarray):
        """Words of each row, and (row, first word, ids) of the runs."""
        low = LOWER[data]
        starts, ends, row = split_words(low, offsets, IS_MARK)
        n = np.bincount(row, minlength=len(offsets) - 1)
        h = span_hashes(low, starts, ends)
        at = np.searchsorted(self.hashes, h)
        at[at == len(self.hashes)] = 0
        known = self.hashes[at] == h
        ids = np.where(known, self.ids[at], 0)
        near = known[:-1] & known[1:] & (row[:-1] == row[1:]) & self.pairs[ids[:-1], ids[1:]]
        edge = np.diff(np.concatenate(([0], near.astype(np.int8), [0])))
        first = np.cumsum(n) - n
        out = [(int(row[a]), int(a - first[row[a]]), ids[a:z + 1].tolist())
               for a, z in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1))]
        return n, out

    def matches(self, run: list[int]):
        """(sequence, place in the run, place in the sequence, words): what each
        sequence has in common with the run and neither side can extend."""
        automaton = self.automaton
        least = min(self.min_match, min(map(len, self.sequences)))
        for i, (n, state) in enumerate(automaton.statistics(run)):
            seen = set()
            while n >= least:  # shorter suffixes occur in further sequences
                for k, end in automaton.ends[state]:
                    s = self.sequences[k]
                    if (k, end) in seen or n < min(self.min_match, len(s)):
                        continue
                    seen.add((k, end))
                    if end + 1 == len(s) or i + 1 == len(run) or s[end + 1] != run[i + 1]:
                        yield k, i + 1 - n, end + 1 - n, n
                state = automaton.link[state]
                n = automaton.length[state]

    def scan(self, runs: list[tuple[int, list[int]]]):
        """Base places, and spans (template, first word, end word, cover), of one document."""
        base, found_by = [], {}
        for first, run in runs:
            for k, at, t, n in self.matches(run):
                found_by.setdefault(k, []).append((first + at, t, n))
                if k < self.n_phrases and n == len(self.sequences[k]):
                    base.append((first + at, k))
        spans = []
        for k, found in found_by.items():
            spans += self.chain(k, sorted(found))
        return base, self.best_spans(spans)

    def chain(self, k: int, found):
        """Best chain ending in each match that has the decisive words in one
        match; the best of them, repeated on what lies beyond it."""
        # (words covered, first word) of the best chain that ends with the match:
        # of all chains, and of those with the decisive words
        free, bound = [], []
        whole, lo = len(self.sequences[k]), 0
        d = self.decisive[k]
        for j, (at, t, n) in enumerate(found):
            has = d is None or (t <= d[0] and d[1] <= t + n)
            any_chain, own = (n, at), (n, at) if has else None
            while found[lo][0] < at - self.max_gap - whole:
                lo += 1  # no match that starts so early reaches this one
            for i in range(lo, j):
                at2, t2, n2 = found[i]
                if at2 + n2 <= at <= at2 + n2 + self.max_gap and t2 + n2 <= t:
                    cover, start = free[i]
                    if cover + n > any_chain[0]:
                        any_chain = cover + n, start
                    before = free[i] if has else bound[i]
                    if before is not None and (own is None or before[0] + n > own[0]):
                        own = before[0] + n, before[1]
            free.append(any_chain)
            bound.append(own)
        out = {}
        for (at, t, n), chained in zip(found, bound):
            if chained is None:
                continue
            cover, start = chained
            share = min(1.0, cover / whole)
            if share >= self.min_cover and share > out.get(start, (0, 0.0))[1]:
                out[start] = (at + n, share)
        return [(k, s, e, c) for s, (e, c) in out.items()]

    def best_spans(self, spans):
        """Words that templates of several labels claim go to the one that
        covers most words there, then the larger share, then the earlier."""
        kept, starts, ends, labels = [], [], [], []  # regions of kept spans of one label, disjoint, by place
        for k, s, e, c in sorted(spans, key=lambda x: (-x[3] * len(self.sequences[x[0]]), -x[3], x[0], x[1])):
            lo, hi = bisect_right(ends, s), bisect_left(starts, e)
            label = self.labels[k]
            if any(x != label for x in labels[lo:hi]):
                continue
            kept.append((k, s, e, c))
            if lo < hi:
                s, e = min(s, starts[lo]), max(e, ends[hi - 1])
            starts[lo:hi], ends[lo:hi], labels[lo:hi] = [s], [e], [label]
        return kept


def scan_licenses(docs: DataFrame, phrases=PHRASES, templates=TEMPLATES, min_match: int = 4,
                  min_cover: float = 0.6, max_gap: int = 6) -> DataFrame:
    """One row a document: words, base places, labels, spans and score.

    A base place is where a phrase's words stand consecutively (overlaps
    count).  A template labels a document when a chain of matches of at least
    ``min_match`` words, at most ``max_gap`` words apart, covers ``min_cover``
    of it and one of the matches holds all words in braces (version, clauses),
    if the template marks some.  Of overlapping spans with different labels
    the longest counts.  ``score`` is the best cover, 1 where there is a base
    place.
    ``spans`` are (label, first word, end word, cover).  A null text is empty;
    without a match labels are '', score 0, places null.  Repeated rows are
    scanned each; an empty table gives no rows; other columns are not read.
    """
    scanner = Scanner(phrases, templates, min_match, min_cover, max_gap)
    names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels",
             "score", "spans"]
    span = pa.list_(pa.struct([("label", pa.string()), ("first_word", pa.int64()),
                               ("end_word", pa.int64()), ("cover", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in text_slices(b):
                n, runs = scanner.runs(*utf8_bytes(part.column(1)))
                own: dict[int, list] = {}
                for row, first, ids in runs:
                    own.setdefault(row, []).append((first, ids))
                cols = [[0] * len(n), [None] * len(n), [None] * len(n), [""] * len(n),
                        [""] * len(n), [0.0] * len(n), [[] for _ in n]]
                for row, found in own.items():
                    base, spans = scanner.scan(found)
                    labels = {scanner.labels[k] for _, k in base}
                    cols[0][row] = len(base)
                    if base:
                        cols[1][row] = min(p for p, _ in base)
                        cols[2][row] = max(p for p, _ in base)
                    cols[3][row] = ",".join(sorted(labels))
                    cols[4][row] = ",".join(sorted(labels | {scanner.labels[k] for k, *_ in spans}))
                    cols[5][row] = 1.0 if base else max((c for *_, c in spans), default=0.0)
                    cols[6][row] = [{"label": scanner.labels[k], "first_word": s, "end_word": e, "cover": c}
                                    for k, s, e, c in sorted(spans, key=lambda x: (x[1], x[2], x[0]))]
                kinds = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.float64(), span]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(n)] + [pa.array(c, k) for c, k in zip(cols, kinds)], names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n_words long, n_base long, first_word long, last_word long,"
             " base_labels string, labels string, score double,"
             " spans array<struct<label string, first_word long, end_word long, cover double>>")


def op5_license_scan(spark, sf_dir):
    """All documents under the contract's phrases and the library's templates."""
    return scan_licenses(table(prepare(spark), sf_dir, "documents")).drop("spans")
