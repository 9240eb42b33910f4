"""Periodic runs of words, by longest common extensions on suffix trees.

A run is a stretch with a smallest period ``q`` that no neighbouring word extends. Every run of two periods at least has a
Lyndon root with regard to the order of words or to its reverse: the longest Lyndon word that starts at some place of it.
So the longest Lyndon word of every place, in both orders, is a candidate for a root. Suffix trees of the words and of
their reversal tell how far the candidate's period goes on to the right and to the left.

Trees are built only where a run can be: the first two thirds of a run of ``LEAST_LENGTH`` words or more, 16 words at least, occur
again one period later, so each of its words is in a sequence of 16 words that the text holds twice. Stretches of
such words are cut out whole; a run lies in one of them and ends inside it as in the text.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from fractions import Fraction
from functools import partial
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayer.llm.shingles import grams, word_numbers
from assayer.llm.suffix_trees import Extensions, SuffixTree, ranks

LEAST_LENGTH = 24
LEAST_PERIODS = 3
SLICE = 500

Run = tuple[int, int, int]  # start, length, period
Edit = Callable[[object, list[bytes]], list[bytes]]


def repeated_stretches(numbers: np.ndarray, sizes: np.ndarray, least: int, periods: int) -> list[tuple[int, int, int]]:
    """``text, start, end`` of the stretches of words in sequences that their text holds twice.

    ``numbers`` are the words of several texts of ``sizes`` words, one after the other.
    """
    width = least - least // periods  # what a run repeats one period later, at least
    owner = np.repeat(np.arange(len(sizes)), sizes)
    if len(owner) < width:
        return []
    inside = owner[: len(owner) - width + 1] == owner[width - 1 :]
    at = np.flatnonzero(inside)
    # numbers of sequences; the text's own number keeps texts apart
    gram = grams(numbers, width)[at] ^ (owner[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(gram, kind="stable")
    gram = gram[order]
    same = gram[1:] == gram[:-1]
    twice = at[order[np.concatenate([same, [False]]) | np.concatenate([[False], same])]]
    marks = np.zeros(len(owner) + 1, np.int64)
    np.add.at(marks, twice, 1)
    np.subtract.at(marks, twice + width, 1)
    covered = np.cumsum(marks[:-1]) > 0
    first = np.cumsum(sizes) - sizes
    step = np.ones(len(owner), bool)
    step[1:] = (covered[1:] != covered[:-1]) | (owner[1:] != owner[:-1])
    starts = np.flatnonzero(step)
    ends = np.append(starts[1:], len(owner))
    good = covered[starts] & (ends - starts >= least)
    text = owner[starts[good]]
    return list(zip(text.tolist(), (starts[good] - first[text]).tolist(), (ends[good] - first[text]).tolist()))


def lyndon_lengths(rank: list[int]) -> np.ndarray:
    """Length of the longest Lyndon word at each place: up to the next smaller suffix."""
    size = len(rank)
    out, stack = [0] * size, [size - 1]
    for i in range(size - 2, -1, -1):
        value = rank[i]
        while rank[stack[-1]] > value:
            stack.pop()
        out[i] = stack[-1] - i
        stack.append(i)
    return np.array(out[:-1], np.int64)


def runs_of(words: list, least: int = LEAST_LENGTH, periods: int = LEAST_PERIODS) -> list[Run]:
    """All runs of a sequence that are ``least`` words and ``periods`` periods long, by start, then period.

    ``periods`` is 2 at least. The end mark of the suffix order has number 0, below all words in both orders.
    """
    size = len(words)
    if size < least:
        return []
    names = {}
    text = [names.setdefault(w, len(names) + 1) for w in words]
    tree = SuffixTree(text)
    suffixes, shared = tree.tour()
    right = Extensions(suffixes, shared)
    left = Extensions(*SuffixTree(text[::-1]).tour())
    found = []
    for rank in (right.rank, ranks(tree.tour(reverse=True)[0])):
        period = lyndon_lengths(rank.tolist())
        start = np.flatnonzero((period * periods <= size) & (np.arange(size) + period < size))
        period = period[start]
        more = right.of(start, start + period)
        # the word before the root against the one before its repetition, counted from the text's end
        before = np.zeros(len(start), np.int64)
        inner = start > 0
        before[inner] = left.of(size - start[inner], size - start[inner] - period[inner])
        found.append(np.stack([start - before, before + period + more, period], axis=1))
    runs = np.concatenate(found)
    runs = runs[(runs[:, 1] >= least) & (runs[:, 1] >= periods * runs[:, 2])]
    return [tuple(r) for r in np.unique(runs[:, [0, 2, 1]], axis=0)[:, [0, 2, 1]].tolist()]


def strongest(runs: list[Run]) -> Run | None:
    """The run with the greatest exact number of periods; of equal ones the first, then the one of least period."""
    return min(runs, key=lambda r: (Fraction(-r[1], r[2]), r[0], r[2]), default=None)


def collapsed(words: list[bytes], runs: list[Run]) -> list[bytes]:
    """Words outside all runs and those in a run's first period only."""
    if not runs:
        return words
    drop = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        drop[start + period] += 1
        drop[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(drop[:-1]) == 0).tolist()]


def with_repeated_tail(doc_id: object, words: list[bytes]) -> list[bytes]:
    """The words of one in ten documents with a tail that repeats; which one follows from the id's CRC-32.

    A null id counts as empty.
    """
    h = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    if h % 10 or not words:
        return words
    n, g = len(words), h // 10
    start = g % n
    period = 1 + (n - start) // (3 + g % 8)
    unit = words[start : start + period]
    return words[:start] + (unit * (-(-(n - start) // period)))[: n - start]


def find_runs(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    least: int = LEAST_LENGTH,
    periods: int = LEAST_PERIODS,
    edit: Edit | None = None,
) -> DataFrame:
    """``doc_id, n_words, runs, strongest, collapsed`` per row.

    Words are runs of anything but ASCII white space. ``runs`` are structs ``start, length, period`` by start, then period;
    ``strongest`` is the one of most periods, null without runs; ``collapsed`` are the words kept when each run
    shrinks to its first period, joined by a space. A null text counts as empty. ``edit`` changes a document's words first.
    Rows are worked on where they are read, each by itself, so repeated rows get equal results; other columns are
    ignored.
    """
    source = documents.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    work = partial(_run_batches, least=least, periods=periods, edit=edit)
    run = "struct<start: bigint, length: bigint, period: bigint>"
    return source.mapInArrow(
        work, f"doc_id {kind}, n_words bigint, runs array<{run}>, strongest {run}, collapsed string"
    )


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _run_batches(
    batches: Iterator[pa.RecordBatch], least: int, periods: int, edit: Edit | None
) -> Iterator[pa.RecordBatch]:
    as_struct = lambda r: dict(zip(("start", "length", "period"), r)) if r else None
    numbered = word_numbers()
    for batch in batches:
        for part in (batch.slice(i, SLICE) for i in range(0, batch.num_rows, SLICE)):
            words = [(t or b"").split() for t in part.column(1).cast(pa.binary()).to_pylist()]
            if edit:
                words = [edit(i, w) for i, w in zip(part.column(0).to_pylist(), words)]
            sizes = np.fromiter(map(len, words), np.int64, len(words))
            numbers = numbered.of([w for one in words for w in one])
            runs: list[list[Run]] = [[] for _ in words]
            for text, start, end in repeated_stretches(numbers, sizes, least, periods):
                found = runs_of(words[text][start:end], least, periods)
                runs[text] += [(start + s, length, period) for s, length, period in found]
            kept = [b" ".join(collapsed(w, r)) for w, r in zip(words, runs)]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    pa.array(sizes),
                    pa.array([[as_struct(r) for r in one] for one in runs], pa.list_(_RUN)),
                    pa.array([as_struct(strongest(one)) for one in runs], _RUN),
                    pa.array(kept, pa.binary()).cast(pa.string()),
                ],
                ["doc_id", "n_words", "runs", "strongest", "collapsed"],
            )
