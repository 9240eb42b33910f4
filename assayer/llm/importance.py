"""Importance resampling towards a target collection.

Texts are bags of hashed word runs. A first pass counts the buckets of the raw and of the target texts, one
array a task; the gains of all buckets are an array of fixed size, from which a second pass adds up each
document's weight. The best scores are drawn without sorting the table: a quantile sketch proposes a bracket
around the cutoff, exact counts of the rows above it and in it prove the bracket or widen it, and only the rows
in it are sorted to find the cutoff.
"""

from __future__ import annotations

import math
import zlib
from array import array
from collections.abc import Iterator
from fractions import Fraction
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from assayer.session import settle

BUCKETS = 10_000
LONGEST_RUN = 3
LEAST_WORDS = 20
SHARE = Fraction(5, 100)
SEED = 42
SLICE = 500
SKETCH_ERROR = 0.001
ROWS_PER_TASK = 500_000
LONGEST_STEP = 64
WORD_LETTERS = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def _shift_tables() -> np.ndarray:
    """``[n][k][v]``: what a CRC-32 state with byte ``k`` equal to ``v`` becomes after ``n`` zero bytes."""
    byte = np.arange(256, dtype=np.uint32)
    step = byte.copy()
    for _ in range(8):
        step = np.where(step & 1, np.uint32(0xEDB88320) ^ (step >> np.uint32(1)), step >> np.uint32(1))
    tables = np.zeros((LONGEST_STEP + 1, 4, 256), np.uint32)
    for k in range(4):
        tables[0, k] = byte << np.uint32(8 * k)
    for n in range(LONGEST_STEP):
        tables[n + 1] = step[tables[n] & np.uint32(255)] ^ (tables[n] >> np.uint32(8))
    return tables


_SHIFT = _shift_tables().ravel()


def appended(head: np.ndarray, tail: np.ndarray, length: np.ndarray) -> np.ndarray:
    """CRC-32 of joined byte strings from those of the parts; ``length`` is the second part's."""
    left, crc = length, head
    while True:
        step = np.minimum(left, LONGEST_STEP)
        base, moved = step * 1024, np.zeros(len(crc), np.uint32)
        for k, byte in enumerate(np.ascontiguousarray(crc, "<u4").view(np.uint8).reshape(-1, 4).T):
            moved ^= _SHIFT.take(base + byte + 256 * k)
        crc, left = moved, left - step
        if not left.any():
            return crc ^ tail


class WordSums(dict):
    """Numbers words in the order it meets them and keeps each one's sums; forgets all after ``limit`` words.

    ``single`` is the CRC-32 of a word, ``spaced`` that of a space and the word, ``length`` counts both.
    """

    def __init__(self, limit: int = 200_000):
        super().__init__()
        self.limit = limit
        self.forget()

    def forget(self) -> None:
        self.clear()
        self.single, self.spaced, self.length = array("I"), array("I"), array("q")

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self.single)
        self.single.append(zlib.crc32(word))
        self.spaced.append(zlib.crc32(b" " + word))
        self.length.append(len(word) + 1)
        return number

    def of(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if len(self) > self.limit:
            self.forget()
        numbers = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        kept = (np.array(self.single, np.uint32), np.array(self.spaced, np.uint32), np.array(self.length, np.int64))
        return tuple(values[numbers] for values in kept)


_READY = WordSums()


def features(texts: list[bytes | None], buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words per text, and owner and bucket of every run of 1 to ``LONGEST_RUN`` words."""
    words = [(t or b"").lower().translate(WORD_LETTERS).split() for t in texts]
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    run, spaced, length = _READY.of(list(chain.from_iterable(words)))
    owner = np.repeat(np.arange(len(texts)), sizes)
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(owner))  # words from here to the text's end
    sums, owners, at = [run], [owner], np.arange(len(owner))
    for more in range(1, LONGEST_RUN):
        inside = left[at] > more
        at, run = at[inside], run[inside]
        run = appended(run, spaced[at + more], length[at + more])
        sums.append(run)
        owners.append(owner[at])
    return sizes, np.concatenate(owners), (np.concatenate(sums) % np.uint32(buckets)).astype(np.int64)


def _texts(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[tuple[pa.RecordBatch, list[bytes | None]]]:
    for batch in batches:
        for part in (batch.slice(i, SLICE) for i in range(0, batch.num_rows, SLICE)):
            yield part, part[column].cast(pa.binary()).to_pylist()


def bucket_counts(texts: DataFrame, column: str = "text", buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts fall in each bucket; each task sends its own counts, ``buckets`` rows at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for _, bodies in _texts(batches, "text"):
            total += np.bincount(features(bodies, buckets)[2], minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["bucket", "times"])

    counted = texts.select(F.col(column).alias("text")).mapInArrow(run, "bucket bigint, times bigint")
    out = np.zeros(buckets, np.int64)
    for bucket, times in counted.groupBy("bucket").agg(F.sum("times")).collect():  # at most ``buckets`` rows
        out[bucket] = times
    return out


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Gain of each bucket in thousandths, from the smoothed shares of target and raw features, rounded down."""
    n, all_raw, all_target = len(raw), float(raw.sum()), float(target.sum())
    ratio = [((t + 1.0) * (all_raw + n)) / ((s + 1.0) * (all_target + n)) for s, t in zip(raw.tolist(), target.tolist())]
    return np.array([math.floor(1000 * math.log(r)) for r in ratio], np.int64)


def weigh(documents: DataFrame, gain: np.ndarray, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, n_words, n_features, weight``: the sum of the gains of a text's features; without any 0."""
    source = documents.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    shared = source.sparkSession.sparkContext.broadcast(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values = shared.value
        for part, bodies in _texts(batches, "text"):
            sizes, owner, bucket = features(bodies, len(values))
            count = np.bincount(owner, minlength=len(bodies)).astype(np.int64)
            # sums stay below 2**53, so adding in doubles is exact
            weight = np.bincount(owner, values[bucket], minlength=len(bodies)).astype(np.int64)
            columns = [part.column(0), pa.array(sizes), pa.array(count), pa.array(weight)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "n_features", "weight"])

    return source.mapInArrow(run, f"doc_id {kind}, n_words bigint, n_features bigint, weight bigint")


def with_scores(weighed: DataFrame, seed: int = SEED) -> DataFrame:
    """Add ``score``: the weight and Gumbel noise that follows from seed and id; a null id is written as empty."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("bigint")
    return weighed.withColumn("score", F.col("weight") + noise)


def order() -> list[F.Column]:
    """Best first; ties to smaller ids, and rows that agree in both in a fixed order."""
    return [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("n_features"), F.asc("weight")]


def ranked(rows: DataFrame, total: int) -> DataFrame:
    """Add ``rank`` from 1 in ``order()``; rows are dealt by range, so a task sorts some ``ROWS_PER_TASK``.

    The written slices follow one another, so a row's rank is its place in its slice behind the rows of
    earlier slices.
    """
    tasks = max(1, -(-total // ROWS_PER_TASK))
    sliced = rows.repartitionByRange(tasks, *order()).withColumn("slice", F.spark_partition_id())
    sliced = settle(sliced, "slices")
    sizes = sorted(sliced.groupBy("slice").count().collect())  # one row a task
    before = np.cumsum([0] + [n for _, n in sizes]).tolist()
    starts = rows.sparkSession.createDataFrame(
        [(s, b) for (s, _), b in zip(sizes, before)], "slice int, before bigint"
    )
    place = F.row_number().over(Window.partitionBy("slice").orderBy(*order()))
    numbered = sliced.withColumn("rank", place).join(F.broadcast(starts), "slice")
    return numbered.withColumn("rank", F.col("rank") + F.col("before")).drop("slice", "before")


def bracket(scores: DataFrame, total: int, wanted: int, error: float = SKETCH_ERROR) -> tuple[int, int, int]:
    """``low, high, above``: the ``wanted``-th best score is in ``low..high``; ``above`` scores are higher.

    The sketch of all scores proposes; exact counts outside the bracket decide. While they refute it, it is
    widened by doubling the error.
    """
    while True:
        at = 1 - wanted / total
        low, high = scores.approxQuantile("score", [max(0.0, at - 2 * error), min(1.0, at + 2 * error)], error)
        over, inside = F.col("score") > high, F.col("score").between(low, high)
        above, within = scores.agg(F.count_if(over), F.count_if(inside)).first()
        if above < wanted <= above + within:
            return int(low), int(high), above
        error *= 2
        if error >= 1:
            low, high = scores.agg(F.min("score"), F.max("score")).first()
            return low, high, 0


def cutoff(pool: DataFrame, total: int, wanted: int, error: float = SKETCH_ERROR) -> tuple[int, object]:
    """Score and id of the ``wanted``-th row of ``order()``; only rows of the bracket are sorted."""
    low, high, above = bracket(pool.select("score"), total, wanted, error)
    inside = pool.where(F.col("score").between(low, high))
    last = ranked(inside, inside.count()).where(F.col("rank") == wanted - above).first()
    return last["score"], last["doc_id"]


def draw(
    scored: DataFrame, share: Fraction = SHARE, least_words: int = LEAST_WORDS, error: float = SKETCH_ERROR
) -> DataFrame:
    """Add ``rank``, 1 for the best; null for rows that are not drawn.

    Of the rows with at least ``least_words`` words the best ``share`` is drawn, rounded down. Where one id and score
    occurs in several rows at the cutoff, as many of them are drawn as belong to the share.
    """
    scored = settle(scored, "scored")
    able = F.col("n_words") >= least_words
    total = scored.where(able).count()
    wanted = math.floor(share * total)
    if not wanted:
        return scored.withColumn("rank", F.lit(None).cast("bigint"))
    score, doc_id = cutoff(scored.where(able), total, wanted, error)
    same = F.lit(score) == F.col("score")
    first = F.lit(True) if doc_id is None else F.coalesce(F.col("doc_id") <= F.lit(doc_id), F.lit(False))
    chosen = able & ((F.col("score") > score) | (same & first))
    drawn = ranked(scored.where(chosen), wanted)
    drawn = drawn.withColumn("rank", F.when(F.col("rank") <= wanted, F.col("rank")).cast("bigint"))
    return scored.where(~chosen).withColumn("rank", F.lit(None).cast("bigint")).unionByName(drawn)


def resample(
    documents: DataFrame,
    target: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    buckets: int = BUCKETS,
    share: Fraction = SHARE,
    least_words: int = LEAST_WORDS,
    seed: int = SEED,
) -> DataFrame:
    """``doc_id, n_words, n_features, weight, score, rank`` per row of ``documents``; ``rank`` is null if not drawn.

    Words are runs of ASCII letters and digits and of all characters beyond ASCII, A-Z in lower case. A null text has
    none. Equal rows each count and are ranked one by one; a null id ranks behind all others. Columns besides id and text
    are ignored. Without target texts all gains come from the raw ones; an empty table gives an empty result.
    """
    gain = gains(bucket_counts(documents, text_column, buckets), bucket_counts(target, "text", buckets))
    return draw(with_scores(weigh(documents, gain, id_column, text_column), seed), share, least_words)
