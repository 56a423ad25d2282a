"""Ids of a public tokenizer for whole texts, each frequent piece of text encoded once per worker.

A text is cut only where white space follows something else. Both public vocabularies cut there
as well (their patterns let nothing but white space stand before or inside a run of white space),
so the ids of the pieces, joined, are the ids of the text.
"""

from __future__ import annotations

import functools
import os
import re
import string
from array import array

import numpy as np

# fixed values: the code points with the Unicode property White_Space
_SPACES = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
_WS = "".join(map(chr, _SPACES))

#: White space stays with what follows it.
KEEP_SPACE = re.compile(f"[{_WS}]*[^{_WS}]+|[{_WS}]+")
#: White space is dropped.
DROP_SPACE = re.compile(f"[^{_WS}]+")

# byte-level vocabularies write a printable byte as itself and the others from U+0100 on, in order
_PRINTABLE = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
_BYTE_SIGNS = {b: 0x100 + i for i, b in enumerate(b for b in range(256) if b not in _PRINTABLE)}
_SPACE_SIGN = chr(_BYTE_SIGNS[0x20])

#: Distinct pieces an encoder holds, and one that a worker keeps; bounds of memory only (some 120
#: bytes a piece), ids do not depend on them.
CACHED_PIECES, KEPT_PIECES = 400_000, 1_000_000


class PieceEncoder(dict):
    """Encodes texts with the ``tokenizers`` file at ``path``; maps a piece to its ids as bytes.

    A piece that is one run of Latin-1 letters (which no normalisation but lower case changes) goes
    straight to the library's model; ASCII punctuation that ends it is a run of its own. Every other
    new piece goes through the whole library. When half of ``cached`` pieces are held they become the
    older half, from which those met again are taken back.
    """

    def __init__(self, path: str, pieces: re.Pattern, cached: int = CACHED_PIECES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task on every core
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self._model = self._tokenizer.model.tokenize
        self._split, self._cached = pieces.findall, cached
        self._spaced = pieces == KEEP_SPACE
        self._lower = self._tokenizer.normalizer is not None
        self._older: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        ids = self._older.get(piece)
        if ids is None:
            ids = self._encoded(piece)
        self[piece] = ids
        return ids

    def _encoded(self, piece: str) -> bytes:
        word = piece.rstrip(string.punctuation)
        bare = word[1:] if self._spaced and word[:1] == " " else word
        if not (bare.isalpha() and (bare.isascii() or max(bare) <= "\xff")):
            return array("i", self._tokenizer.encode(piece, add_special_tokens=False).ids).tobytes()
        if len(word) < len(piece):
            return self[word] + self[piece[len(word) :]]
        if self._lower:
            bare = bare.lower()
        if not bare.isascii():
            bare = bare.encode().decode("latin-1").translate(_BYTE_SIGNS)
        if self._spaced and word[0] == " ":
            bare = _SPACE_SIGN + bare
        return array("i", [token.id for token in self._model(bare)]).tobytes()

    def encode(self, text: str | None) -> np.ndarray:
        """The ids of one text; none for null."""
        if len(self) > self._cached // 2:
            self._older = self.copy()
            self.clear()
        text = text or ""
        # str.split knows the same white space and four separators more
        fast = not self._spaced and not any(c in text for c in "\x1c\x1d\x1e\x1f")
        pieces = text.split() if fast else self._split(text)
        return np.frombuffer(b"".join(map(self.__getitem__, pieces)), np.int32)


@functools.lru_cache(maxsize=2)
def worker_encoder(path: str, pieces: re.Pattern) -> PieceEncoder:
    """The encoder of this Python worker, which keeps its pieces from one task to the next."""
    return PieceEncoder(path, pieces, KEPT_PIECES)
