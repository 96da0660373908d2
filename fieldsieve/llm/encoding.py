"""Token ids of whole texts, as little-endian unsigned 32-bit numbers in one binary value.

The byte-level vocabulary never lets a token cross the border in front of a blank that follows a
character that is not white space. Texts are therefore cut at these borders, and the tokenizers
library encodes each distinct piece once per worker while it stays in a bounded cache. Plain words,
marks and line ends fall apart in a way that holds in any Unicode version, and each part goes
straight to the library's merge model; any other piece goes through the whole tokenizer. The ids
are those of encoding the whole text at once.
"""

from __future__ import annotations

import os
import re
import struct
from collections.abc import Callable

#: Pieces a worker remembers, and the longest piece worth remembering. They bound memory only:
#: a forgotten or long piece is encoded again.
CACHED_PIECES = 600_000
CACHED_LENGTH = 48

_BORDER = re.compile(r"(?<=\S)(?= )")

# Letters that every Unicode version has as letters, and ASCII marks without the apostrophe.
_LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
_MARKS = r"!-&(-/:-@\[-`{-~"
_PART = re.compile(f" ?[{_LETTERS}]+| ?[0-9]+| ?[{_MARKS}]+|\n(?!\\s)")


def _parts(text: str) -> list[str] | None:
    """The parts of a plain text, or None if something in it is not plain."""
    parts = _PART.findall(text)
    return parts if sum(map(len, parts)) == len(text) else None


def byte_alphabet() -> dict[int, str]:
    """The printable character that stands for each byte: itself, or the next one from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


def public_vocabulary(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class _Pieces(dict):
    """Id bytes by piece, encoded when first asked for."""

    def __init__(self, tokenizer):
        self._tokenizer = tokenizer
        self._tokenizer.encode_special_tokens = True  # the added tokens are cut out before
        self._merge = self._tokenizer.model.tokenize
        self._alphabet = byte_alphabet()

    def __missing__(self, piece: str) -> bytes:
        if _PART.fullmatch(piece):
            shown = piece.encode().decode("latin-1").translate(self._alphabet)
            ids = [t.id for t in self._merge(shown)]
        else:
            ids = self._tokenizer.encode(piece, add_special_tokens=False).ids
        found = struct.pack(f"<{len(ids)}I", *ids)
        if len(piece) <= CACHED_LENGTH:
            if len(self) >= CACHED_PIECES:
                self.clear()
            self[piece] = found
        return found


class TextEncoder:
    """Encodes texts to id bytes with one vocabulary file of the tokenizers library.

    None is an empty text. The strings of added tokens give their ids, as in the library, or with
    ``plain`` are ordinary text. Added tokens that take in the white space or words about them are
    not provided for.
    """

    def __init__(self, vocabulary: str, plain: bool = False):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(vocabulary)
        added = tokenizer.get_added_tokens_decoder()
        if any(t.lstrip or t.rstrip or t.single_word for t in added.values()):
            raise ValueError("added tokens must stand for their own string only")
        self._added = {} if plain else {t.content: struct.pack("<I", i) for i, t in added.items()}
        longest_first = sorted(self._added, key=len, reverse=True)
        self._cut = re.compile(f"({'|'.join(map(re.escape, longest_first))})") if self._added else None
        self._pieces = _Pieces(tokenizer)

    def __call__(self, text: str | None) -> bytes:
        if not text:
            return b""
        if self._cut is None or not self._cut.search(text):
            return self._ordinary(text)
        return b"".join(self._added.get(t) or self._ordinary(t) for t in self._cut.split(text) if t)

    def _ordinary(self, text: str) -> bytes:
        parts = _parts(text)
        if parts is None:
            parts = []
            for piece in _BORDER.split(text):
                parts += _parts(piece) or [piece]
        return b"".join(map(self._pieces.__getitem__, parts))


_ENCODERS: dict[tuple[str, bool], TextEncoder] = {}


def encoder(vocabulary: str, plain: bool = False) -> Callable[[str | None], bytes]:
    """The worker's encoder for a vocabulary file; it lives as long as the worker."""
    key = vocabulary, plain
    if key not in _ENCODERS:
        _ENCODERS[key] = TextEncoder(*key)
    return _ENCODERS[key]
