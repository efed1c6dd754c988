"""Token ids of whole texts by a tokenizer file, with a cache of words.

The file's tokenizer normalises to NFC, lower-cases, and splits into letter runs, single digits
and runs of other signs before it merges. White space parts all of these, so a text's ids are
those of its words one after the other, and a word's ids those of its pre-tokens. Each worker
remembers the ids of words and pre-tokens of ordinary length. Texts for which that is not certain
(special-token marks, text not in NFC, capitals with odd lower case) are encoded in one piece.
"""

from __future__ import annotations

import os
import re
import struct
import unicodedata

import regex

MAX_CACHED = 1_000_000
MAX_LETTERS = 48           # longer words and pre-tokens are not remembered
# the pre-token rule of the file, on lower-case text
ASCII = re.compile(r"[a-z]+|[0-9]|'(?:s|t|re|ve|m|ll|d)|[^\sa-z0-9]+")
UNICODE = regex.compile(r"\p{L}+|\p{N}|'(?:s|t|re|ve|m|ll|d)|[^\s\p{L}\p{N}]+")
CONTROL = re.compile("[\x1c-\x1f]")        # white space to one library and signs to the other
PLACED = re.compile("[\u03a3\u0130]")      # capitals whose lower case is not one letter for one, whatever the place

_ENCODERS: dict[str, "Encoder"] = {}


def encoder(path: str) -> "Encoder":
    """The encoder of a file, one for each Python worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


class Memory(dict):
    """Ids by word and pre-token; what is not known yet is merged when it is asked for."""

    def __init__(self, merge):
        self.merge, self.old = merge, {}

    def forget(self):
        """What is not asked for again is forgotten in time."""
        if len(self) > MAX_CACHED:
            self.old = dict(self)
            self.clear()

    def __missing__(self, word: str) -> bytes:
        ids = self.old.get(word)
        if ids is None:
            parts = [word] if word.isalpha() else (ASCII if word.isascii() else UNICODE).findall(word)
            ids = self.merge(word) if parts == [word] else b"".join([self[p] for p in parts])
        if len(word) <= MAX_LETTERS:
            self[word] = ids
        return ids


class Encoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.signs = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.memory = Memory(self.merged)

    def merged(self, piece: str) -> bytes:
        """The ids of one pre-token, which is normalised and split already."""
        if not (piece.isascii() and piece.isprintable()):   # other bytes have signs of their own in the vocabulary
            piece = self.signs.pre_tokenize_str(piece)[0][0]
        ids = [t.id for t in self.model.tokenize(piece)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def direct(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, text: str | None) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        if "<|" in text or CONTROL.search(text) or not (
                text.isascii() or not PLACED.search(text) and unicodedata.is_normalized("NFC", text)):
            return self.direct(text)
        self.memory.forget()
        return b"".join(map(self.memory.__getitem__, text.lower().split()))
