"""Removal of word passages that occur more than once, by matching statistics on suffix automata.

A passage is repeated if a window of ``length`` consecutive words starts at two places. All windows
with the same words choose the same *anchor*, the least of their ``ANCHOR``-word n-grams (leftmost of
equals). So consecutive windows with one anchor form a *run*, and a run can share windows only
with runs of the same anchor; that splits the reference into shards no repeated window crosses.

1. Runs whose anchor occurs once are done. Runs that are equal as a whole are repeated throughout.
2. What is left (the edges of shared passages) is fetched as word numbers, with one example of each
   run that is repeated as a whole. They are dealt by anchor into reference shards of about
   ``SHARD_RUNS`` runs. Each shard's suffix automaton counts the occurrences of every substring, and its
   runs stream through it: a window is repeated if the state that holds it occurs twice.
3. An anchor with more than ``SHARD_RUNS`` open runs would make a shard too large; its windows are counted
   one by one in a distributed aggregation instead, with the same result.

The automata stay where their shard's runs are, as the reference grows with the corpus and
must not be broadcast. Words are compared by 64-bit numbers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayer.llm.counted_join import join_counted
from assayer.llm.shingles import grams, mixed, word_numbers
from assayer.session import discard, settle

LENGTH = 35
ANCHOR = 8
SHARD_RUNS = 3000
BROADCAST_BYTES = 64 * 1024 * 1024
BASE = np.uint64(0x9E3779B97F4A7C15)
SLICE = 2000
KEY = ["doc_id", "mark"]


class Powers:
    """Powers of ``BASE`` and of its inverse, for numbers of word sequences of any length."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def until(self, count: int) -> None:
        if len(self.up) <= count:
            size = 2 * count
            inverse = pow(int(BASE), -1, 1 << 64)
            for name, base in (("up", BASE), ("down", np.uint64(inverse))):
                factors = np.full(size, base, np.uint64)
                factors[0] = 1
                setattr(self, name, np.multiply.accumulate(factors))

    def of(self, numbers: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """A number for each span ``[begin, end)`` that depends on its words and length alone."""
        self.until(len(numbers) + 1)
        sums = np.zeros(len(numbers) + 1, np.uint64)
        np.cumsum(mixed(numbers) * self.up[: len(numbers)], out=sums[1:])
        span = (sums[end] - sums[begin]) * self.down[begin]
        return mixed(span + (end - begin).astype(np.uint64))


_POWERS = Powers()


def least_places(values: np.ndarray, width: int) -> np.ndarray:
    """Place of the least of each ``width`` consecutive values, the leftmost of equals."""
    place, reach = np.arange(len(values)), 1
    while reach < width:
        step = min(reach, width - reach)
        left, right = place[: len(place) - step], place[step:]
        place = np.where(values[right] < values[left], right, left)
        reach += step
    return place


def runs_of(numbers: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """``anchor, run, start, windows`` of each run of windows that choose one anchor."""
    values = grams(numbers, ANCHOR)
    place = least_places(values, length - ANCHOR + 1)
    start = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
    windows = np.diff(np.r_[start, len(place)])
    whole = _POWERS.of(numbers, start, start + windows + length - 1)
    shift = (place[start] - start).astype(np.uint64)
    return values[place[start]], mixed(whole + shift), start, windows


class CountingAutomaton:
    """Suffix automaton of several sequences; counts how often each substring occurs."""

    def __init__(self, sequences: list[list[int]], weights: list[int]):
        self.moves, self.link, self.length, self.count = [{}], [-1], [0], [0]
        for sequence, weight in zip(sequences, weights):
            last = 0
            for symbol in sequence:
                last = self._extend(last, symbol)
                self.count[last] += weight
        for state in sorted(range(1, len(self.link)), key=self.length.__getitem__, reverse=True):
            self.count[self.link[state]] += self.count[state]

    def _copy(self, at: int, symbol: int, target: int) -> int:
        copy = len(self.moves)
        self.moves.append(dict(self.moves[target]))
        self.length.append(self.length[at] + 1)
        self.link.append(self.link[target])
        self.count.append(0)
        while at >= 0 and self.moves[at].get(symbol) == target:
            self.moves[at][symbol] = copy
            at = self.link[at]
        self.link[target] = copy
        return copy

    def _extend(self, last: int, symbol: int) -> int:
        target = self.moves[last].get(symbol)
        if target is not None:  # an earlier sequence went the same way
            return target if self.length[target] == self.length[last] + 1 else self._copy(last, symbol, target)
        state = len(self.moves)
        self.moves.append({})
        self.length.append(self.length[last] + 1)
        self.link.append(0)
        self.count.append(0)
        at = last
        while at >= 0 and symbol not in self.moves[at]:
            self.moves[at][symbol] = state
            at = self.link[at]
        if at >= 0:
            target = self.moves[at][symbol]
            same = self.length[target] == self.length[at] + 1
            self.link[state] = target if same else self._copy(at, symbol, target)
        return state

    def repeated(self, sequence: list[int], length: int) -> list[int]:
        """Starts of the windows of ``length`` symbols that occur at least twice."""
        state, matched, out = 0, 0, []
        for end, symbol in enumerate(sequence, 1):
            while state and symbol not in self.moves[state]:
                state = self.link[state]
                matched = self.length[state]
            if symbol in self.moves[state]:
                state, matched = self.moves[state][symbol], matched + 1
            while self.length[self.link[state]] >= length:
                state = self.link[state]
                matched = self.length[state]
            if matched >= length and self.count[state] >= 2:
                out.append(end - length)
        return out


def intervals(starts: list[int]) -> list[tuple[int, int]]:
    """Sorted numbers as maximal half-open intervals."""
    out: list[list[int]] = []
    for s in starts:
        if out and out[-1][1] == s:
            out[-1][1] = s + 1
        else:
            out.append([s, s + 1])
    return [tuple(x) for x in out]


def merge_spans(lists: DataFrame) -> DataFrame:
    """Join touching and overlapping intervals in each document's ``list``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))
        for batch in batches:
            spans = batch.column("list")
            begin, end = (spans.flatten().field(n).to_numpy() for n in ("a", "b"))
            edges = np.r_[0, np.cumsum(spans.value_lengths().to_numpy())]
            out = []
            for lo, hi in zip(edges[:-1], edges[1:]):
                order = np.argsort(begin[lo:hi], kind="stable")
                a, b = begin[lo:hi][order], np.maximum.accumulate(end[lo:hi][order])
                first = np.flatnonzero(np.r_[True, a[1:] > b[:-1]])
                last = np.r_[first[1:] - 1, len(a) - 1]
                out.append([{"a": x, "b": y} for x, y in zip(a[first].tolist(), b[last].tolist())])
            yield batch.set_column(2, "list", pa.array(out, kind))

    return lists.mapInArrow(run, lists.schema)


def find_runs(source: DataFrame, length: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = word_numbers()
        for batch in batches:
            for part in (batch.slice(i, SLICE) for i in range(0, batch.num_rows, SLICE)):
                owner, found = [], []
                for row, text in enumerate(part.column("text").cast(pa.binary()).to_pylist()):
                    words = text.split() if text else []
                    if len(words) >= length:
                        found.append(runs_of(numbers.of(words), length))
                        owner.append(np.full(len(found[-1][0]), row))
                if found:
                    anchor, whole, start, windows = map(np.concatenate, zip(*found))
                    rows = pa.array(np.concatenate(owner))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(anchor.view(np.int64)),
                            pa.array(whole.view(np.int64)),
                            part.column("doc_id").take(rows),
                            part.column("mark").take(rows),
                            pa.array(start.astype(np.int32)),
                            pa.array(windows.astype(np.int32)),
                        ],
                        ["anchor", "run", "doc_id", "mark", "start", "windows"],
                    )

    kind = source.schema["doc_id"].dataType.simpleString()
    schema = f"anchor bigint, run bigint, doc_id {kind}, mark bigint, start int, windows int"
    return source.mapInArrow(run, schema)


def with_lists(source: DataFrame, lists: DataFrame, how: str) -> DataFrame:
    """Join texts with per-document lists; the lists are broadcast if measured to be small."""
    lists = settle(lists, "lists")
    size = lists.agg(F.coalesce(F.sum(F.size("list") * 24 + 128), F.lit(0))).first()[0]
    held = lists.select(F.col("doc_id").alias("of_doc"), F.col("mark").alias("of_mark"), "list")
    if size <= BROADCAST_BYTES:
        held = F.broadcast(held)
    same = F.col("doc_id").eqNullSafe(F.col("of_doc")) & (F.col("mark") == F.col("of_mark"))
    return source.join(held, same, how).drop("of_doc", "of_mark")


def fetch(source: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """Word numbers of the wanted runs: ``anchor, weight, doc_id, mark, start, words``."""
    item = F.struct("start", "windows", "weight", "anchor")
    lists = wanted.groupBy(*KEY).agg(F.collect_list(item).alias("list"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = word_numbers()
        for batch in batches:
            rows: list[tuple] = []
            for row, (text, items) in enumerate(
                zip(batch.column("text").cast(pa.binary()).to_pylist(), batch.column("list").to_pylist())
            ):
                words = numbers.of(text.split())
                for item in items:
                    span = words[item["start"] : item["start"] + item["windows"] + length - 1]
                    rows.append((item["anchor"], item["weight"], row, item["start"], span.tobytes()))
            if rows:
                anchor, weight, row, start, span = zip(*rows)
                row = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(anchor, pa.int64()),
                        pa.array(weight, pa.int32()),
                        batch.column("doc_id").take(row),
                        batch.column("mark").take(row),
                        pa.array(start, pa.int32()),
                        pa.array(span, pa.binary()),
                    ],
                    ["anchor", "weight", "doc_id", "mark", "start", "words"],
                )

    kind = source.schema["doc_id"].dataType.simpleString()
    schema = f"anchor bigint, weight int, doc_id {kind}, mark bigint, start int, words binary"
    return with_lists(source, lists, "inner").mapInArrow(run, schema)


def match_shards(runs: DataFrame, shards: int, length: int) -> DataFrame:
    """Intervals of repeated window starts, by one counting automaton per shard."""

    def match(group: pd.DataFrame) -> pd.DataFrame:
        sequences = [np.frombuffer(w, np.uint64).tolist() for w in group["words"]]
        automaton = CountingAutomaton(sequences, group["weight"].tolist())
        own = {}
        for i in np.flatnonzero(group["weight"].to_numpy() == 1).tolist():
            if found := intervals(automaton.repeated(sequences[i], length)):
                own[i] = found
        place = [i for i, found in own.items() for _ in found]
        spans = np.array([s for found in own.values() for s in found], np.int64).reshape(-1, 2)
        picked = group.iloc[place]
        begin = picked["start"].to_numpy(np.int64)
        return pd.DataFrame(
            {"doc_id": picked["doc_id"], "mark": picked["mark"], "a": begin + spans[:, 0], "b": begin + spans[:, 1]}
        )

    kind = runs.schema["doc_id"].dataType.simpleString()
    dealt = runs.withColumn("shard", F.pmod("anchor", F.lit(shards)))
    return dealt.groupBy("shard").applyInPandas(match, f"doc_id {kind}, mark bigint, a bigint, b bigint")


def match_windows(runs: DataFrame, length: int) -> DataFrame:
    """The same intervals for runs of hot anchors: each window is a row, counted by its number."""

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(i, SLICE) for i in range(0, batch.num_rows, SLICE)):
                spans = [np.frombuffer(w, np.uint64) for w in part.column("words").to_pylist()]
                counts = np.array([len(s) - length + 1 for s in spans], np.int64)
                begin = [np.arange(c) for c in counts]
                window = [_POWERS.of(s, b, b + length) for s, b in zip(spans, begin)]
                row = pa.array(np.repeat(np.arange(len(spans)), counts))
                start = np.repeat(part.column("start").to_numpy().astype(np.int64), counts)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate(window).view(np.int64)),
                        part.column("weight").take(row),
                        part.column("doc_id").take(row),
                        part.column("mark").take(row),
                        pa.array(start + np.concatenate(begin)),
                    ],
                    ["window", "weight", "doc_id", "mark", "a"],
                )

    kind = runs.schema["doc_id"].dataType.simpleString()
    rows = runs.mapInArrow(windows, f"window bigint, weight int, doc_id {kind}, mark bigint, a bigint")
    rows = settle(rows, "windows")
    single = F.sum(F.when(F.col("weight") == 1, 1).otherwise(0)).alias("times")
    twice = settle(rows.groupBy("window").agg(F.sum("weight").alias("n"), single).where("n >= 2"), "twice")
    found = join_counted(rows.where("weight = 1"), twice.select("window", "times"), ["window"], "times", rows.count())
    return found.select(*KEY, "a", (F.col("a") + 1).alias("b"))


def repeated_spans(source: DataFrame, length: int, shard_runs: int) -> DataFrame:
    """``doc_id, mark, a, b``: windows that start in ``[a, b)`` are repeated."""
    found = settle(find_runs(source, length), "runs")
    often = settle(found.groupBy("anchor").agg(F.count("*").alias("times")).where("times > 1"), "often")
    runs = settle(join_counted(found, often, ["anchor"], "times", found.count()).drop("times"), "runs")
    for done in (found, often):  # read no more; half of the runs are not wanted
        discard(done)
    first = F.min(F.struct(*KEY, "start", "windows")).alias("first")
    counts = settle(runs.groupBy("anchor", "run").agg(F.count("*").alias("times"), first), "counts")
    copied = counts.where("times > 1").select("anchor", "run", "times")
    whole = join_counted(runs, copied, ["anchor", "run"], "times", runs.count())
    whole = whole.select(*KEY, F.col("start").cast("long").alias("a"), (F.col("start") + F.col("windows")).cast("long").alias("b"))

    single = F.sum(F.when(F.col("times") == 1, 1).otherwise(0)).alias("single")
    sizes = counts.groupBy("anchor").agg(F.count("*").alias("kinds"), single)
    sizes = settle(sizes.where("kinds > 1 AND single > 0"), "sizes")
    weight = F.least("times", F.lit(2)).cast("int").alias("weight")
    wanted = counts.join(sizes.select("anchor"), "anchor").select("anchor", weight, "first.*")
    fetched = settle(fetch(source, wanted, length), "fetched")
    hot = sizes.where(F.col("kinds") > shard_runs).select("anchor")
    cold = sizes.where(F.col("kinds") <= shard_runs)
    total = cold.agg(F.coalesce(F.sum("kinds"), F.lit(0))).first()[0]
    shards = max(1, -(-total // shard_runs))
    found = match_shards(fetched.join(cold.select("anchor"), "anchor"), shards, length)
    if not hot.isEmpty():
        found = found.unionByName(match_windows(fetched.join(hot, "anchor"), length))
    return whole.unionByName(found)


def remove_repeats(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    length: int = LENGTH,
    shard_runs: int = SHARD_RUNS,
) -> DataFrame:
    """``doc_id, n_words, n_removed, kept`` per row; ``kept`` is the kept words joined by one space.

    Words are runs of anything but ASCII white space. A word goes if a window of ``length`` words that
    covers it starts at another place too, in the same or another row, as judged on the input. A null
    text has no words. Repeated rows repeat each other's windows. Other columns are ignored.
    ``length`` must exceed ``ANCHOR``.
    """
    text = F.coalesce(F.col(text_column), F.lit(""))
    source = documents.select(F.col(id_column).alias("doc_id"), F.xxhash64(text).alias("mark"), text.alias("text"))
    spans = repeated_spans(source, length, shard_runs)
    lists = merge_spans(spans.groupBy(*KEY).agg(F.collect_list(F.struct("a", "b")).alias("list")))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total, removed, kept = [], [], []
            for text, items in zip(
                batch.column("text").cast(pa.binary()).to_pylist(), batch.column("list").to_pylist()
            ):
                words = text.split()
                total.append(len(words))
                if items:
                    edge = np.zeros(len(words) + 1, np.int32)
                    np.add.at(edge, [s["a"] for s in items], 1)
                    np.add.at(edge, [s["b"] + length - 1 for s in items], -1)
                    stays = np.flatnonzero(edge.cumsum()[:-1] == 0).tolist()
                    words = [words[i] for i in stays]
                removed.append(total[-1] - len(words))
                kept.append(b" ".join(words))
            columns = [pa.array(total, pa.int64()), pa.array(removed, pa.int64())]
            texts = pa.array(kept, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *columns, texts], ["doc_id", "n_words", "n_removed", "kept"]
            )

    kind = source.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_words bigint, n_removed bigint, kept string"
    return with_lists(source, lists, "left").mapInArrow(cut, schema)
