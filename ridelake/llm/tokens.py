"""Token ids of whole texts by a byte-level BPE tokenizer file.

A single space between two non-space characters always begins a new
pre-token of this tokenizer family, so a text can be cut there and each part
encoded by itself.  Parts repeat heavily across a corpus: their ids are kept
per worker in a bounded cache of two generations (a part in use moves to the
younger one), and only unseen parts reach the library.
"""

from __future__ import annotations

import os
import re

import numpy as np

#: White space other than plain spaces and line breaks.
_OTHER_SPACE = re.compile("[\t\x0b-\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
_PLAIN_SPACE = re.compile(r"(?<=\S) (?=\S)")
#: Latin letters and closing marks, and perhaps the same on the next line:
#: each of these runs is always a pre-token of its own, the line break too.
_LETTERS = "[A-Za-zÀ-ÖØ-öø-ÿ]+"
_MARKS = "[!-&(-/:-@\\[-`{-~]*"  # no apostrophe: it may begin a pre-token with letters
_WORD = re.compile(f"({_LETTERS})({_MARKS})(?:(\n{_LETTERS})({_MARKS}))?")
_LOADED: dict = {}


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in byte-level BPE vocabularies:
    printable Latin-1 characters for themselves, the rest from U+0100 up."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(0x100 + i) for i, b in enumerate(rest)}


class Encoder(dict):
    """Ids of texts as little-endian unsigned 16- or 32-bit bytes (``dtype``).
    As a dict: the ids of parts that follow a space."""

    #: entries of a generation, and the longest part that is kept (characters)
    MAX_PARTS, MAX_PART = 500_000, 48

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings are ordinary text
        self.model = self.tokenizer.model
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.older: dict[str, bytes] = {}
        self.letters = str.maketrans({chr(b): c for b, c in _byte_letters().items()})
        self.space = self.letters[ord(" ")]
        self.packed = [i.to_bytes(self.dtype.itemsize, "little") for i in range(self.tokenizer.get_vocab_size())]
        self.marks: dict[str, bytes] = {"": b""}
        self.line = self.bare("\n")

    def bare(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return b"".join(map(self.packed.__getitem__, ids))

    def word(self, word: str) -> bytes:
        """Ids of letters alone, or after a space: one pre-token."""
        if word.isascii():
            spelt = word.replace(" ", self.space)
        else:
            spelt = word.encode().decode("latin-1").translate(self.letters)
        packed = self.packed
        return b"".join([packed[t.id] for t in self.model.tokenize(spelt)])

    def closing(self, marks: str) -> bytes:
        ids = self.marks.get(marks)
        if ids is None:
            ids = self.bare(marks)
            if len(self.marks) < self.MAX_PARTS:
                self.marks[marks] = ids
        return ids

    def __missing__(self, part: str) -> bytes:
        """A part that follows a space; or one that starts with a line break,
        which no such part does, then letters."""
        ids = self.older.get(part)
        if ids is not None:
            self[part] = ids
            return ids
        if len(part) > self.MAX_PART:
            return self.bare(" " + part)
        word = _WORD.fullmatch(part)
        if part[0] == "\n":
            ids = self.line + self.word(part[1:])
        elif word is None:
            ids = self.bare(" " + part)
        elif word[3]:  # seldom the same again: only its parts are kept
            return self[word[1]] + self.closing(word[2]) + self[word[3]] + self.closing(word[4])
        elif word[2]:
            ids = self[word[1]] + self.closing(word[2])
        else:
            ids = self.word(" " + part)
        self[part] = ids
        return ids

    def encode(self, text: str) -> bytes:
        if (text[:1] != " " and text[-1:] != " " and "  " not in text and " \n" not in text
                and "\n " not in text and not _OTHER_SPACE.search(text)):
            parts = text.split(" ")
        else:
            parts = _PLAIN_SPACE.split(text)
        first = parts[0]
        parts[0] = ""
        plain = len(first) <= self.MAX_PART and _WORD.fullmatch(first)
        self[""] = self.word(first) if plain and plain[1] == first else self.bare(first)
        ids = b"".join(map(self.__getitem__, parts))
        if len(self) > self.MAX_PARTS:
            self.older = dict(self)
            self.clear()
        return ids


def encoder(path: str) -> Encoder:
    """The worker's encoder of a tokenizer file."""
    if path not in _LOADED:
        _LOADED[path] = Encoder(path)
    return _LOADED[path]


def public_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)
