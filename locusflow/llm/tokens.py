"""Exact token ids and counts by a two-tier lookup in front of a tokenizer file.

A text is cut at white space into chunks. The first tier maps whole chunks to their value, the second maps the
pre-tokens inside a chunk. Only a pre-token found in neither tier is encoded by the tokenizer's model. A text
for which cutting could change the result (special strings, unusual white space, characters outside the checked
ranges) is encoded whole by the library, so the result is always the library's own.
"""

from __future__ import annotations

import os
import re
import struct
import unicodedata

import regex

# The splitting patterns stated in the two tokenizer files.
BYTE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

# Characters whose letter, number and space classes are the same for both pattern libraries.
_UNCHECKED = re.compile("[^\t\n\r\x20-\x7e\xa0-ɏΑ-ΡΣ-ϿА-я‐-‧"
                        "‰-⁞€ぁ-ゖァ-ヺ一-龥가-힣]")


class Whole(Exception):
    """The text must be encoded as a whole."""


def byte_alphabet() -> dict[int, str]:
    """The printable stand-in of every byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table, spare = {b: chr(b) for b in plain}, 256
    for b in range(256):
        if b not in table:
            table[b] = chr(spare)
            spare += 1
    return table


class Tier(dict):
    """A bounded lookup of two generations: a missing key is looked for among the older ones, else computed.

    When the younger generation is full it becomes the older one, so that what is in use stays and no more than twice
    ``limit`` entries are held; ``base`` is always there.
    """

    def __init__(self, compute, base: dict | None = None, limit: int = 200_000, longest: int = 64):
        super().__init__(base or {})
        self.compute, self.base, self.limit, self.longest, self.older = compute, base or {}, limit, longest, {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.compute(key)
        if len(key) <= self.longest:
            if len(self) >= self.limit + len(self.base):
                self.older = dict(self)
                self.clear()
                self.update(self.base)
            self[key] = value
        return value


class TwoTier:
    """Token values of whole texts. ``as_ids``: little-endian 32-bit ids as bytes; else token counts.

    ``kind`` is ``"byte"`` (byte-level pieces that keep white space) or ``"word"`` (lower case, white space dropped).
    """

    def __init__(self, path: str, kind: str, as_ids: bool, frequent: dict | None = None):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.kind, self.as_ids = kind, as_ids
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.pattern = regex.compile(BYTE_PATTERN if kind == "byte" else WORD_PATTERN)
        self.alphabet = byte_alphabet()
        self.fold = b"".join if as_ids else sum
        self.tokenize, self.findall, self.blank = self.library.model.tokenize, self.pattern.findall, self.alphabet[32]
        self.chunks = Tier(self._chunk, frequent)
        # a word piece is a chunk too; byte-level pieces hold the space before them
        self.pieces = self.chunks if kind == "word" else Tier(self._piece)

    def _value(self, ids):
        return struct.pack(f"<{len(ids)}I", *ids) if self.as_ids else len(ids)

    def _piece(self, piece: str):
        if piece.isascii() and piece.isprintable():  # these stand for themselves, but for the space
            shown = piece.replace(" ", self.blank)
        else:
            shown = piece.encode().decode("latin-1").translate(self.alphabet)
        found = self.tokenize(shown)
        return self._value([t.id for t in found]) if self.as_ids else len(found)

    def _chunk(self, chunk: str):
        """``chunk`` follows a space that it doesn't hold; byte-level chunks after a line break hold the break."""
        if not (chunk.isascii() and chunk.isprintable()) and _UNCHECKED.search(chunk):
            raise Whole
        if self.kind == "byte":
            inner = chunk[1:] if chunk[:1] == "\n" else chunk
            if not inner or inner[0].isspace() or inner[-1].isspace():
                raise Whole
            if chunk[0] != "\n":
                chunk = " " + chunk
        if self.kind == "word" and chunk.isalpha():  # letters, perhaps with one mark behind them, need no pattern
            return self._piece(chunk)
        if self.kind == "word" and chunk[-1] in ".,;:!?" and chunk[:-1].isalpha():
            found = [chunk[:-1], chunk[-1]]
        else:
            found = self.findall(chunk)
        return self._piece(found[0]) if len(found) == 1 else self.fold(map(self.pieces.__getitem__, found))

    def _cut(self, text: str) -> list[str]:
        if self.kind == "byte":
            return text.replace("\n", " \n").split(" ")
        if not text.isascii():
            if not unicodedata.is_normalized("NFC", text):
                text = unicodedata.normalize("NFC", text)
            text = text.replace("Σ", "σ")  # the library lowers each character on its own
        return text.lower().split()

    def __call__(self, text: str):
        if not text:
            return self._value([])
        if not any(s in text for s in self.special) and not (self.kind == "word" and _ODD_SPACE.search(text)):
            try:
                chunks = self._cut(text)
                if self.kind == "word":
                    return self.fold(map(self.chunks.__getitem__, chunks))
                head, rest = chunks[0], chunks[1:]
                if not head or _UNCHECKED.search(head) or head[0].isspace() or head[-1].isspace():
                    raise Whole
                first = self.fold(map(self.pieces.__getitem__, self.findall(head)))
                return first + self.fold(map(self.chunks.__getitem__, rest))
            except Whole:
                pass
        return self._value(self.library.encode(text, add_special_tokens=False).ids)


# Characters that str.split() takes for white space and the tokenizer doesn't, or that normalising may move.
_ODD_SPACE = re.compile("[\x1c-\x1f\x85]")

_LOADED: dict = {}


def worker_lookup(path: str, kind: str, as_ids: bool, frequent: dict | None = None) -> TwoTier:
    """The lookup of this worker process, kept from task to task."""
    key = (path, kind, as_ids, len(frequent or {}))
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = TwoTier(path, kind, as_ids, frequent)
    return _LOADED[key]
