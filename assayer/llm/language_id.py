"""Language identification by cross-parsing: the language that needs fewest phrases wins.

For each language a suffix automaton of sampled labelled text knows all substrings of it. A text is
parsed from left to right into the longest phrases the automaton knows. The number of phrases,
times the logarithm of the sample's length and divided by the text's length, is the language's
cross-entropy in bits per byte; the least wins, ties go to the name that sorts first.

Samples are blocks of training text chosen by hash, ``TRAINING_BYTES`` in all, shared equally by the
languages, so the automata have a fixed size whatever the corpus. Whole texts are parsed in blocks of
``BLOCK_BYTES``; all blocks of a batch and all languages advance together.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TRAINING_BYTES = 160 * 1024
SAMPLE_CHARS = 512
BLOCK_BYTES = 1024
LANES = 2048
UNDETERMINED = "und"


def normalise(text: str) -> bytes:
    """Lower-case UTF-8; every run of ASCII other than letters becomes one space."""
    return b" ".join(text.lower().encode().translate(_LETTERS).split())


_LETTERS = bytes(b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def suffix_automaton(text: bytes) -> list[dict[int, int]]:
    """Transitions of the smallest automaton that reads every substring; state 0 is the start."""
    moves, link, length, last = [{}], [-1], [0], 0
    for byte in text:
        state = len(moves)
        moves.append({})
        length.append(length[last] + 1)
        link.append(0)
        at = last
        while at >= 0 and byte not in moves[at]:
            moves[at][byte] = state
            at = link[at]
        if at >= 0:
            target = moves[at][byte]
            if length[target] == length[at] + 1:
                link[state] = target
            else:
                copy = len(moves)
                moves.append(dict(moves[target]))
                length.append(length[at] + 1)
                link.append(link[target])
                while at >= 0 and moves[at].get(byte) == target:
                    moves[at][byte] = copy
                    at = link[at]
                link[target] = link[state] = copy
        last = state
    return moves


class Parser:
    """All languages' automata in one table.

    Row ``r`` and column ``c`` hold ``2 * (next row * width) + begins``: ``begins`` is 1 where the known
    substring ends and byte ``c`` begins a phrase. Column 0 stands for bytes in no sample. Each
    language's last row has read nothing, so every byte begins a phrase there.
    """

    def __init__(self, samples: dict[str, bytes]):
        self.languages = sorted(samples)
        used = sorted(set(b"".join(samples.values())))
        self.column = np.zeros(256, np.uint8)
        self.column[used[:255]] = np.arange(1, len(used[:255]) + 1)
        self.width = width = int(self.column.max()) + 1
        parts, fresh, base = [], [], 0
        for name in self.languages:
            moves = suffix_automaton(samples[name])
            lost = base + len(moves)
            state = np.repeat(np.arange(len(moves)), [len(m) for m in moves])
            byte = np.array([b for m in moves for b in m], np.int64)
            target = np.array([t for m in moves for t in m.values()], np.int64) + base
            begin = np.full(width, lost)
            begin[self.column[byte[state == 0]]] = target[state == 0]
            part = np.tile((2 * width * begin + 1).astype(np.int32), (len(moves) + 1, 1))
            part[state, self.column[byte]] = 2 * width * target
            parts.append(part)
            fresh.append(lost * width)
            base = lost + 1
        self.table = np.concatenate(parts).ravel() if parts else np.zeros(0, np.int32)
        self.fresh = np.array(fresh, np.int32)
        self.bits = np.array([np.log2(max(2, len(samples[n]))) for n in self.languages])

    def entropies(self, texts: list[bytes]) -> np.ndarray:
        """Bits per byte of each text (row) under each language (column); 0 for an empty text."""
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        blocks = -(-sizes // BLOCK_BYTES)
        owner = np.repeat(np.arange(len(texts)), blocks)
        begin = np.arange(len(owner)) - np.repeat(blocks.cumsum() - blocks, blocks)
        begin = begin * BLOCK_BYTES
        length = np.minimum(BLOCK_BYTES, sizes[owner] - begin)
        begin += (sizes.cumsum() - sizes)[owner]
        symbols = self.column[np.frombuffer(b"".join(texts), np.uint8)]
        phrases = np.zeros((len(texts), len(self.languages)))
        order = np.argsort(-length, kind="stable")
        for lanes in (order[i : i + LANES] for i in range(0, len(order), LANES)):
            counts = self._parse(symbols, begin[lanes], length[lanes])
            np.add.at(phrases, owner[lanes], counts)
        return phrases * self.bits / np.maximum(sizes, 1)[:, None]

    def _parse(self, symbols: np.ndarray, begin: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Phrases of each block under each language; blocks come longest first."""
        steps = int(length[0]) if len(length) else 0
        place = np.arange(steps, dtype=np.int32)[:, None] + begin[None, :].astype(np.int32)
        table = symbols.take(np.minimum(place, len(symbols) - 1, out=place))
        active = np.searchsorted(-length, -np.arange(steps), "left")
        state = np.repeat(self.fresh[:, None], len(begin), axis=1)
        counts = np.zeros(state.shape, np.int32)
        for step in range(steps):
            n = active[step]
            value = self.table.take(state[:, :n] + table[step, :n])
            counts[:, :n] += value & 1
            state[:, :n] = value >> 1
        return counts.T


_READY: dict[int, Parser] = {}


def parser_of(samples: dict[str, bytes]) -> Parser:
    """The worker's own parser for these samples; only the latest is kept."""
    key = hash(tuple(sorted(samples.items())))
    if key not in _READY:
        _READY.clear()
        _READY[key] = Parser(samples)
    return _READY[key]


def learn(
    labelled: DataFrame, lang_column: str = "lang", text_column: str = "text", budget: int = TRAINING_BYTES
) -> dict[str, bytes]:
    """Sample of each language; rows with a null label or text teach nothing.

    One pass counts the blocks per language, a second keeps the blocks whose hash falls under the
    language's rate; what goes over the budget is cut off.
    """
    rows = labelled.select(F.col(lang_column).alias("lang"), F.col(text_column).alias("text")).dropna()
    rows = rows.where(F.rlike("text", F.lit(r"\p{L}"))).withColumn(
        "blocks", F.ceil(F.length("text") / SAMPLE_CHARS).cast("int")
    )
    totals = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.sum("blocks").alias("n")).collect()}
    if not totals:
        return {}
    share = budget // len(totals)
    rates = F.create_map(
        *[F.lit(x) for name, n in totals.items() for x in (name, 1.25 * share / SAMPLE_CHARS / n)]
    )
    keep = "filter(sequence(0, blocks - 1), p -> xxhash64(spot, p) / 18446744073709551616D + 0.5 < rate)"
    cut = f"transform({keep}, p -> substring(text, p * {SAMPLE_CHARS} + 1, {SAMPLE_CHARS}))"
    chosen = (
        rows.withColumn("spot", F.xxhash64("text"))
        .withColumn("rate", rates[F.col("lang")])
        .select("lang", F.explode(F.expr(cut)).alias("part"))
        .distinct()
    )
    samples: dict[str, list[str]] = {}
    for row in sorted(chosen.collect()):
        samples.setdefault(row["lang"], []).append(row["part"])
    return {name: b" ".join(map(normalise, parts))[:share] for name, parts in samples.items()}


def identify(
    documents: DataFrame, samples: dict[str, bytes], keep: tuple[str, ...] = ("doc_id",), text_column: str = "text"
) -> DataFrame:
    """The columns ``keep`` and ``lang_pred, score, bits`` per row; nothing but the text decides.

    ``lang_pred`` is ``und`` with score 0 where the text is null or has no letter, or where nothing was
    learnt. ``score`` is the winner's share of inverse fourth powers of the entropies; ``bits`` is
    its entropy per byte. Rows are neither joined nor shuffled. Columns named like a result must
    not be in ``keep``; other columns are ignored.
    """
    kept = [F.col(name) for name in keep]
    readable = F.when(F.rlike(text_column, F.lit(r"\p{L}")), F.col(text_column)).alias("readable text")
    source = documents.select(*kept, readable)
    found = [T.StructField("lang_pred", T.StringType())]
    found += [T.StructField(name, T.DoubleType()) for name in ("score", "bits")]
    schema = T.StructType([*source.drop("readable text").schema, *found])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser = parser_of(samples)
        names = pa.array([*parser.languages, UNDETERMINED])
        for batch in batches:
            for part in (batch.slice(i, 2000) for i in range(0, batch.num_rows, 2000)):
                texts = [normalise(t) if t else b"" for t in part.column(len(keep)).to_pylist()]
                known = np.array([bool(t) for t in texts]) & bool(parser.languages)
                best, score = np.full(len(texts), len(parser.languages)), np.zeros(len(texts))
                bits = np.zeros(len(texts))
                if known.any():
                    rates = parser.entropies([t for t in texts if t])
                    own = rates.argmin(axis=1)
                    weight = (rates.min(axis=1, keepdims=True) / rates) ** 4
                    best[known], score[known] = own, weight.max(axis=1) / weight.sum(axis=1)
                    bits[known] = rates.min(axis=1)
                results = [names.take(pa.array(best)), pa.array(score), pa.array(bits)]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *results], schema.names)

    return source.mapInArrow(run, schema)


def remainder(column: str, divisor: int) -> Column:
    """CRC-32 of the number as text, modulo ``divisor``; a null id leaves -1."""
    return F.coalesce(F.crc32(F.col(column).cast("string")) % divisor, F.lit(-1))
