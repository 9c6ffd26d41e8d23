"""Token ids of the public BPE vocabularies, a word at a time.

Both vocabularies split a text into words before any merge, so a word's ids do not depend on its
neighbours. A worker keeps the ids of the space-separated chunks it has met as little-endian bytes; a
text's ids are then one join of bytes. Texts with a character outside RANGE go to the tokenizers library
whole, because the classes below are spelled out for that range only.
"""

from __future__ import annotations

import re
from array import array

import public_tokenizers
from tokenizers import Tokenizer

# The letters, numbers and white space of RANGE, which NFC leaves alone.
RANGE = "\x00-\x1b\x20-įı-ɏ‐-‧‰-⁞€"
LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ɏ"
NUMBERS = "0-9²³¹¼-¾"
SPACES = "\t-\r \u0085 "
OUTSIDE = re.compile(f"[^{RANGE}]")
TWO_SPACES = re.compile(f"[{SPACES}][{SPACES}]")

BYTE_SPLIT = re.compile(f" ?[{LETTERS}]+|'s|'t|'re|'ve|'m|'ll|'d| ?[{NUMBERS}]+| ?[^{SPACES}{LETTERS}{NUMBERS}]+|[{SPACES}]+(?![^{SPACES}])|[{SPACES}]+")
WORD_SPLIT = re.compile(f"[{LETTERS}]+|'s|'t|'re|'ve|'m|'ll|'d|[{NUMBERS}]|[^{SPACES}{LETTERS}{NUMBERS}]+")

_shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
#: Byte-level vocabularies write bytes that do not print as the characters from U+0100 on.
BYTE_TO_CHAR = {b: b for b in _shown} | {b: 0x100 + i for i, b in enumerate(b for b in range(256) if b not in set(_shown))}

_open: dict[tuple[str, int], "Words"] = {}


class Words:
    """Encodes texts with one vocabulary file. `most` bounds the chunks that are remembered."""

    def __init__(self, name: str, most: int = 900_000):
        self.tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.model = self.tokenizer.model
        self.byte_level = name == "byte_bpe_50k.json"
        if not self.byte_level and name != "word_bpe_49k.json":
            raise ValueError(f"no splitting rule is known for {name}")
        self.known = _Known(self._chunk, most)
        self.counts = _Known(lambda chunk: len(self._chunk(chunk)) // 4, most)

    def _pieces(self, pieces: list[str]) -> bytes:
        ids: list[int] = []
        for p in pieces:
            ids += [t.id for t in self.model.tokenize(p.encode().decode("latin-1").translate(BYTE_TO_CHAR))]
        return array("I", ids).tobytes()

    def _chunk(self, chunk: str) -> bytes:
        if not self.byte_level:
            return self._pieces(WORD_SPLIT.findall(chunk))
        return self._pieces(BYTE_SPLIT.findall(chunk if chunk[:1] == "\n" else " " + chunk))

    def encode(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        if OUTSIDE.search(text):
            return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        if not self.byte_level:  # white space only separates
            return b"".join(map(self.known.__getitem__, text.lower().split()))
        if TWO_SPACES.search(text):  # runs of white space depend on what follows
            return self._pieces(BYTE_SPLIT.findall(text))
        first, *rest = text.replace("\n", " \n").split(" ")
        return self._pieces(BYTE_SPLIT.findall(first)) + b"".join(map(self.known.__getitem__, rest))


    def count(self, text: str) -> int:
        """How many ids a text has; what is remembered of a chunk is a number."""
        if OUTSIDE.search(text) or self.byte_level and TWO_SPACES.search(text):
            return len(self.encode(text)) // 4
        if not self.byte_level:
            return sum(map(self.counts.__getitem__, text.lower().split()))
        first, *rest = text.replace("\n", " \n").split(" ")
        return len(self._pieces(BYTE_SPLIT.findall(first))) // 4 + sum(map(self.counts.__getitem__, rest))


class _Known(dict):
    def __init__(self, make, most):
        super().__init__()
        self.make, self.most = make, most

    def __missing__(self, chunk: str) -> bytes | int:
        ids = self.make(chunk)
        if len(self) < self.most and len(chunk) <= 64:
            self[chunk] = ids
        return ids


def words(name: str, most: int = 900_000) -> Words:
    """The worker's encoder for a vocabulary; kept while the worker lives."""
    if (name, most) not in _open:
        _open[name, most] = Words(name, most)
    return _open[name, most]
