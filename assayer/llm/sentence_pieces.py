"""SentencePiece encoding by a forward pass shared between words with common prefixes, and decoding.

A text is cut into marked words, which no piece crosses. The distinct words of a slice, sorted, are a trie
read depth first: the forward state of a common prefix is kept and only the rest of a word is worked out.

The forward state of a prefix is the last piece of its best segmentation. In a vocabulary of merged
pairs the best segmentation is the one that merging yields; its neighbours ``a, b`` are exactly those for
which ``a + b`` merges to ``[a, b]``. So a piece scores 0 after a state it may follow and minus
infinity otherwise, and just one piece that ends at a place scores 0. The ids equal the library's.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
LIMIT = 400_000
SLICE = 1000
_RUNS = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")


class Pieces:
    """A vocabulary of merged pairs, read from a model file, with the words met so far."""

    def __init__(self, path: str, limit: int = LIMIT):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        special = [model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i) for i in range(size)]
        names = [model.id_to_piece(i) for i in range(size)]
        self.ids = {name: i for i, name in enumerate(names) if not special[i]}
        self.scores = {name: model.get_score(i) for name, i in self.ids.items()}
        self.bytes = {int(n[3:5], 16): i for i, n in enumerate(names) if model.is_byte(i)}
        self.unknown = model.unk_id()
        lengths: dict[str, set[int]] = {}
        for name in self.ids:
            lengths.setdefault(name[-2:], set()).add(len(name))
        self.lengths = {tail: sorted(found, reverse=True) for tail, found in lengths.items()}
        values = {i: bytes([b]) for b, i in self.bytes.items()}
        spoken = {i: n.replace(MARK, " ").encode() for n, i in self.ids.items()}
        other = {i: b"" for i in range(size) if model.is_control(i)} | {self.unknown: " ⁇ ".encode()}
        readings = values | spoken | other
        self.spoken = [readings.get(i, b"") for i in range(size)]
        self.fits: dict[tuple[str, str], bool] = {}
        self.words: dict[str, bytes] = {}
        self.limit = limit
        self.breaks_lines = "\n" not in self.ids

    def merged(self, text: str) -> list[str]:
        """Merge the neighbours whose join scores best, the leftmost of equals, until none is a piece."""
        parts = list(text)
        while True:
            best, at = None, -1
            for i, (a, b) in enumerate(pairwise(parts)):
                score = self.scores.get(a + b)
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if best is None:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def follows(self, last: str, piece: str) -> bool:
        """Whether ``piece`` may come after ``last``; an empty ``last`` is the word's start."""
        key = last, piece
        found = self.fits.get(key)
        if found is None:
            found = self.fits[key] = self.merged(last + piece) == ([last, piece] if last else [piece])
        return found

    def learn(self, words: list[str]) -> None:
        """Segment sorted distinct words depth first and remember their ids."""
        ids, follows, lengths = self.ids, self.follows, self.lengths
        before, last = "", [""]  # last[i]: last piece of the best segmentation of the first i letters
        for word in words:
            shared, top = 0, min(len(word), len(before))
            while shared < top and word[shared] == before[shared]:
                shared += 1
            del last[shared + 1 :]
            for end in range(shared + 1, len(word) + 1):
                for size in lengths.get(word[max(0, end - 2) : end], ()):
                    piece = word[end - size : end] if size <= end else ""
                    if piece in ids and follows(last[end - size], piece):
                        break
                else:
                    piece = word[end - 1]  # a piece of one letter, or a letter the vocabulary lacks
                last.append(piece)
            before, end, found = word, len(word), []
            while end:
                piece = last[end]
                found += self.numbers(piece)
                end -= len(piece)
            self.words[word] = struct.pack(f"<{len(found)}I", *reversed(found))

    def numbers(self, piece: str) -> list[int]:
        """Id of a piece, or of the bytes of a letter that is none, last first."""
        if piece in self.ids:
            return [self.ids[piece]]
        if self.bytes:
            return [self.bytes[b] for b in reversed(piece.encode())]
        return [self.unknown]

    def cut(self, text: str) -> list[str]:
        """The marked words of a text; line breaks are words of their own, as no piece holds one."""
        if not text:
            return []
        lines = text.split("\n") if self.breaks_lines else [text]
        out: list[str] = []
        for i, line in enumerate(lines):
            if i:
                out.append("\n")
            if MARK in line or "  " in line or line[:1] == " ":
                out += _RUNS.findall((MARK if i == 0 else "") + line.replace(" ", MARK))
            elif line or i == 0:
                words = line.split(" ")
                head = [MARK + words[0]] if i == 0 else [words[0]] if words[0] else []
                out += head
                out += [MARK + w for w in words[1:]]
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit numbers."""
        if len(self.words) > self.limit:
            self.words.clear()
        if len(self.fits) > 2 * self.limit:
            self.fits.clear()
        cuts = [self.cut(t) for t in texts]
        self.learn(sorted({w for words in cuts for w in words} - self.words.keys()))
        ids = self.words.__getitem__
        return [b"".join(map(ids, words)) for words in cuts]

    def decode(self, ids: bytes) -> str:
        """Text of ids; the mark before the first word goes."""
        numbers = np.frombuffer(ids, "<u4").tolist()
        text = b"".join(map(self.spoken.__getitem__, numbers)).decode("utf-8", "replace")
        return text[1:] if text[:1] == " " else text


_READY: dict[str, Pieces] = {}


def pieces_of(path: str) -> Pieces:
    """The worker's own vocabulary."""
    if path not in _READY:
        _READY[path] = Pieces(path)
    return _READY[path]


def encode(documents: DataFrame, model: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, ids`` per row, ids as little-endian unsigned 32-bit numbers; null and empty texts have none.

    Rows are neither joined nor shuffled; other columns are ignored.
    """
    source = documents.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pieces_of(model)
        for batch in batches:
            for part in (batch.slice(i, SLICE) for i in range(0, batch.num_rows, SLICE)):
                ids = pieces.encode([t or "" for t in part.column(1).to_pylist()])
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.binary())], ["doc_id", "ids"])

    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {kind}, ids binary")


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """Replace ``ids`` by the ``text`` they stand for; null ids give an empty text. Other columns stay.

    Inverse of ``encode`` but for texts that hold the mark itself, which reads as a space.
    """
    kept = [c for c in encoded.columns if c not in ("ids", "text")]
    source = encoded.select(*kept, "ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pieces_of(model)
        for batch in batches:
            texts = [pieces.decode(i or b"") for i in batch.column(len(kept)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string())], [*kept, "text"])

    schema = source.drop("ids").withColumn("text", F.lit("")).schema
    return source.mapInArrow(run, schema)
