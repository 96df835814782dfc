"""Whole texts to token ids, as packed little-endian uint32 bytes.

Both vocabularies split a text into pieces first and merge inside a piece
only, so the ids of a text are the ids of its pieces in a row. Pieces
repeat, so each task encodes a piece once and joins the packed ids. The
fast split is used for texts of the characters checked by ``_SAFE`` alone,
where Python's classes and the tokenizer's agree; any other text goes to
the tokenizer whole.
"""

from __future__ import annotations

import os
import re
import unicodedata
from array import array
from functools import lru_cache
from itertools import islice

import public_tokenizers
from tokenizers import Tokenizer

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core

BYTE_BPE = "byte_bpe_50k.json"
WORD_BPE = "word_bpe_49k.json"

_LAST = 0x24F
_SAFE = re.compile("[\t\n\r\x20-\x7e¡-įı-ɏ]*")
LONG_TEXT = 2_000_000
BLOCK = 200_000


def _byte_letters() -> dict[int, str]:
    """Letter of each byte in byte-level vocabularies: printable ones stand for themselves, the others for 256, 257, ..."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = [b for b in range(256) if b not in own]
    return {b: chr(256 + rest.index(b)) if b not in own else chr(b) for b in range(256)}


_BYTES = _byte_letters()


def _char_class(kind: str) -> str:
    chars = [c for c in map(chr, range(_LAST + 1)) if unicodedata.category(c)[0] == kind]
    return "".join(map(re.escape, chars))


_L, _N = _char_class("L"), _char_class("N")
_SUFFIX = "'s|'t|'re|'ve|'m|'ll|'d"
#: fixed values: the split patterns of the two vocabulary files, for the characters of _SAFE
_SPLIT = {
    BYTE_BPE: re.compile(rf"{_SUFFIX}| ?[{_L}]+| ?[{_N}]+| ?[^\s{_L}{_N}]+|\s+(?!\S)|\s+"),
    WORD_BPE: re.compile(rf"{_SUFFIX}|[{_L}]+|[{_N}]|[^\s{_L}{_N}]+"),
}


@lru_cache(maxsize=2)
def encoder(vocabulary: str) -> PieceEncoder:
    """The encoder of this Python worker: what it has learnt serves all its tasks."""
    return PieceEncoder(vocabulary)


class PieceEncoder:
    """Packed ids of texts. ``limit``: pieces kept at most."""

    def __init__(self, vocabulary: str, limit: int = 800_000):
        self.tokenizer = Tokenizer.from_file(public_tokenizers.path(vocabulary))
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.split, self.lower, self.limit = _SPLIT[vocabulary], vocabulary == WORD_BPE, limit
        self.cache: dict[str, bytes] = {}

    def _whole(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array("I", e.ids).tobytes() for e in found]

    def _learn(self, pieces: list[str]) -> None:
        """Merge the pieces that are not known yet; their bytes are written in the vocabulary's letters."""
        if len(self.cache) > self.limit:
            self.cache = {}
        cache, merge = self.cache, self.tokenizer.model.tokenize
        for p in set(pieces):
            if p not in cache:
                found = merge(p.encode().decode("latin-1").translate(_BYTES))
                cache[p] = array("I", [t.id for t in found]).tobytes()

    def _join(self, pieces: list[str]) -> bytes:
        try:
            return b"".join([self.cache[p] for p in pieces])
        except KeyError:
            self._learn(pieces)
            return b"".join([self.cache[p] for p in pieces])

    def packed(self, texts: list) -> list[bytes]:
        """The ids of each whole text; empty for NULL."""
        return [self._one(t) for t in texts]

    def _one(self, text: str | None) -> bytes:
        if not text:
            return b""
        if not _SAFE.fullmatch(text):
            return self._whole([text])[0]
        if self.lower:
            text = text.lower()
        if len(text) <= LONG_TEXT:
            return self._join(self.split.findall(text))
        found, parts = self.split.finditer(text), []
        while block := [m.group() for m in islice(found, BLOCK)]:
            parts.append(self._join(block))
        return b"".join(parts)
