"""Ids of a word-level BPE vocabulary file, one chunk between white space at a time.

White space always ends a token of this kind of vocabulary, so a text's ids are its chunks' ids
in a row. Chunks repeat, so each worker keeps the ids of those it has met (at most ``limit``).
"""

from __future__ import annotations

import re
import sys
from array import array

import pyarrow as pa

PLAIN = re.compile("([a-zß-öø-ÿ]+)([.,]*)")
SPECIAL = b"<|"
assert sys.byteorder == "little" and array("I").itemsize == 4  # ids are little-endian 32-bit numbers


def byte_letters() -> dict[int, str]:
    """The letter that byte-level BPE writes for each byte value."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}


class WordIds(dict):
    """Maps a chunk (UTF-8, ASCII letters in lower case) to its ids as little-endian bytes.

    It holds the chunks met since it was last full and, in ``older``, those of the filling before; a chunk found there
    moves back. So what texts use again and again stays, and what occurs once goes, at ``2 * limit`` chunks at most.
    """

    def __init__(self, path: str, limit: int = 250_000):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.letters = str.maketrans({chr(b): c for b, c in byte_letters().items()})
        self.limit = limit
        self.older: dict[bytes, bytes] = {}
        self.parts: dict[str, bytes] = {}

    def part(self, letters: str) -> bytes:
        """Ids of one run of letters or punctuation marks, which the vocabulary splits no further."""
        found = self.parts.get(letters)
        if found is None:
            # printable ASCII is written as it is
            written = letters if letters.isascii() else letters.encode().decode("latin-1").translate(self.letters)
            found = self.parts[letters] = array("I", [t.id for t in self.model.tokenize(written)]).tobytes()
        return found

    def __missing__(self, chunk: bytes) -> bytes:
        ids = self.older.get(chunk)
        if ids is None:
            text = chunk.decode()
            plain = PLAIN.fullmatch(text)
            if plain:
                ids = self.part(plain[1]) + (self.part(plain[2]) if plain[2] else b"")
            else:
                ids = array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        self[chunk] = ids
        return ids

    def make_room(self) -> None:
        """Start a new filling if this one is full."""
        if len(self) > self.limit:
            self.older = dict(self)
            self.clear()
            self.parts.clear()

    def encode(self, text: bytes) -> bytes:
        """Ids of a whole text; upper case is kept where it tells a special token's name apart."""
        return self.joined((text if SPECIAL in text else text.lower()).split())

    def joined(self, chunks: list[bytes]) -> bytes:
        """Ids of a text cut into its chunks."""
        self.make_room()
        return b"".join(map(self.__getitem__, chunks))


_READY: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    """The worker's own encoder for a vocabulary file."""
    if path not in _READY:
        _READY[path] = WordIds(path)
    return _READY[path]


def release() -> None:
    """Let go of the worker's encoders and of free memory that Arrow holds, where all texts are encoded."""
    if _READY:
        _READY.clear()
        pa.default_memory_pool().release_unused()
