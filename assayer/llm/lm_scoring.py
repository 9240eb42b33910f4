"""Log probabilities of texts under a word unigram and under a self-attention model of subword ids.

Words are counted over all training texts: each task counts its own first, so what is shuffled follows the number
of distinct words. The ``HEAD_WORDS`` most frequent words go to every task in a broadcast of that bound; a
text's other words are joined with the counts, and no such word is frequent enough to fill a task.
Each text is cut into words and encoded once; its subword ids are stored, counted, dealt in windows and scored from there.
The ids' counts over all training texts give the model its classes. The attention weights are fitted to all windows of all training texts, laid end to end, so that each id is learnt from. Windows are dealt by
hash into shards and turns; in each of ``ROUNDS`` rounds every shard takes the same number of steps over its windows of
that turn, from the common weights in a task of its own, and the weights are averaged by place. All texts are scored whole, in overlapping windows that count each id once.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayer.llm.attention import BATCH, OWN, ROUNDS, SEED, STEPS, WINDOW, Attention, id_ranks, windows
from assayer.llm.word_ids import release, word_ids
from assayer.session import new_folder, settle

HEAD_WORDS = 1 << 18
LEAST_WINDOWS = 40_000
WINDOW_SHARE = 1  # every window; a caller may lower it for trials, to ``LEAST_WINDOWS`` at least
SHARD_WINDOWS = 320_000  # as many as a shard's steps visit, each once
STATE_ROW = 4096  # numbers of a shard's weights in a row
TEXT_BYTES = 60  # a text has a window for some so many bytes, from which the number of shards follows
ROWS_OUT = 200_000  # windows dealt at a time
FLUSH = 300_000
SLICE = 500
CHUNK = 4096  # windows whose ids are weighed at once
PART = 256  # and of which the block is applied at once, to stay in a core's cache
END = b""  # the end of a text, counted as a token; no word is empty
END_ID = 0
MARKS = 2  # of a window's places: no id before the text's first (-1), nothing after its last (-2)


def slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    return (batch.slice(i, SLICE) for i in range(0, batch.num_rows, SLICE))


def texts_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    for batch in batches:
        for part in slices(batch):
            yield part, [(t or b"").lower() for t in part.column("text").cast(pa.binary()).to_pylist()]


def count_words(training: DataFrame) -> DataFrame:
    """``word, times`` over all training texts; the empty word is the end of a text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def flush() -> pa.RecordBatch:
            out = [pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())]
            counts.clear()
            return pa.RecordBatch.from_arrays(out, ["word", "times"])

        for _, texts in texts_of(batches):
            for text in texts:
                counts.update(text.split())
            counts[END] += len(texts)
            if len(counts) > FLUSH:
                yield flush()
        yield flush()

    rows = training.mapInArrow(run, "word binary, times bigint")
    return settle(rows.groupBy("word").agg(F.sum("times").alias("times")), "words")


def head_words(words: DataFrame, most: int) -> dict[bytes, int]:
    """Counts of the ``most`` most frequent words and of the end of a text.

    They are picked and written by tasks, so the driver receives the chosen rows alone, as Arrow columns.
    """
    ranked = words.where(F.col("word") != F.lit(END)).orderBy(F.desc("times"), "word").limit(most)
    rows = settle(ranked, "head-words").unionByName(words.where(F.col("word") == F.lit(END))).toArrow()
    return dict(zip(rows.column("word").to_pylist(), rows.column("times").to_pylist()))


def id_kind(size: int) -> str:
    """The numbers in which ids of a vocabulary of this size, and the marks of windows, are stored."""
    return "<u2" if size + MARKS <= 1 << 16 else "<u4"


def id_totals(totals: DataFrame, size: int) -> np.ndarray:
    """Occurrences of each id by ``id, times`` of the tasks."""
    counts = np.zeros(size)
    for row in totals.groupBy("id").agg(F.sum("times").alias("times")).collect():  # one row per id of the vocabulary at most
        counts[row["id"]] = row["times"]
    return counts


def id_rows(total: np.ndarray) -> pa.RecordBatch:
    seen = np.flatnonzero(total)
    return pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen].astype(np.int64))], ["id", "times"])


def count_ids(words: DataFrame, vocabulary: str, size: int) -> np.ndarray:
    """Occurrences of each subword id in the texts of these ``word, times``, where the texts' own ids are not stored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, total = word_ids(vocabulary), np.zeros(size)
        for batch in batches:
            times = batch.column(1).to_numpy()
            ids = [encoder[w] if w else END_ID.to_bytes(4, "little") for w in batch.column(0).to_pylist()]
            encoder.make_room()
            lengths = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
            flat = np.frombuffer(b"".join(ids), "<u4")
            total += np.bincount(flat, np.repeat(times, lengths), size)
        yield id_rows(total)

    return id_totals(words.mapInArrow(run, "id bigint, times bigint"), size)


def count_stored_ids(texts: DataFrame, size: int) -> np.ndarray:
    """Occurrences of each subword id in the stored ``ids`` of all texts."""
    kind = id_kind(size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for ids, _ in (laid_end_to_end(part.column("ids"), kind) for batch in batches for part in slices(batch)):
            total += np.bincount(ids, minlength=size)
        yield id_rows(total)

    return id_totals(texts.select("ids").mapInArrow(run, "id bigint, times bigint"), size)


def laid_end_to_end(column: pa.Array, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts of a column, laid end to end, and the texts' lengths."""
    cells = column.to_pylist()
    lengths = np.fromiter(map(len, cells), np.int64, len(cells)) // np.dtype(kind).itemsize
    return np.frombuffer(b"".join(cells), kind).astype(np.int32), lengths


def encoded(texts: list[bytes], encoder) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts laid end to end, each with its end, and their lengths."""
    end = END_ID.to_bytes(4, "little")
    ids = [encoder.encode(t) + end for t in texts]
    return np.frombuffer(b"".join(ids), "<u4"), np.fromiter(map(len, ids), np.int64, len(ids)) // 4


def laid_out(ids: np.ndarray, lengths: np.ndarray, rank: np.ndarray):
    """Input numbers (rank and 1, or 0 at a text's start) and target places of the windows, owners, counted positions."""
    start, owner, fresh = windows(lengths)
    stop = np.cumsum(lengths)
    inputs = np.empty(len(ids), np.int32)
    inputs[1:] = 1 + np.minimum(rank[ids[:-1]], OWN)
    inputs[(stop - lengths)[lengths > 0]] = 0
    along = np.arange(WINDOW, dtype=np.int32)
    place = start.astype(np.int32)[:, None] + along
    counted = (place < stop.astype(np.int32)[owner][:, None]) & (along >= fresh.astype(np.int32)[:, None])
    np.minimum(place, len(ids) - 1, out=place)
    return inputs[place], place, owner, counted


def drawn_windows(ids: np.ndarray, starts: np.ndarray, first=0, stop=None) -> np.ndarray:
    """A window at each start, with the id before it, or -1 at the text's start; -2 fills up.

    ``first`` and ``stop`` are the bounds of each window's text among the ids, by default of all. A start may lie up to
    ``WINDOW - 1`` places before the text's first.
    """
    begin, end = np.maximum(starts, first), np.minimum(starts + WINDOW, len(ids) if stop is None else stop)
    place = begin[:, None] + np.arange(-1, WINDOW)
    rows = ids.astype(np.int32)[np.clip(place, 0, len(ids) - 1)]
    rows[place >= end[:, None]] = -2
    rows[begin == first, 0] = -1
    return rows


def mixed(marks: np.ndarray, nth: np.ndarray) -> np.ndarray:
    """A number below 2^62 by text mark and window, spread evenly (splitmix64)."""
    x = marks + (nth.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(2)).astype(np.int64)


def turns_of(shards: int) -> int:
    """Turns into which a shard's windows are dealt; few windows all take part in every round."""
    return 1 if shards == 1 else min(ROUNDS, max(1, SHARD_WINDOWS // (BATCH * (STEPS // ROUNDS))))


def cells(rows: np.ndarray, edges: np.ndarray) -> pa.Array:
    """Binary values, of which each is the bytes of the rows from one edge to the next."""
    width = rows.nbytes // max(1, len(rows))
    return pa.Array.from_buffers(pa.binary(), len(edges) - 1, [None, pa.py_buffer((edges * width).astype(np.int32)), pa.py_buffer(rows)])


def deal_windows(texts: DataFrame, size: int) -> tuple[DataFrame, int]:
    """``turn, shard, keys, ids``: all windows of the stored texts, those of a task for a turn and shard side by side; number of shards.

    Each of ``ids`` has one place more than a window; the first is the id before it, or -1 at a text's start, all stored
    with ``MARKS`` added. Windows follow one another without overlap, so each id, the end's too, is in one. The key follows
    from the row's mark and the window's number, and deals it whatever the partitions. With a ``WINDOW_SHARE`` under 1 only
    that share of the keys is kept.
    """
    total = texts.agg(F.coalesce(F.sum(F.greatest(F.lit(1), F.expr(f"octets div {TEXT_BYTES}"))), F.lit(0))).first()[0]
    share = min(1.0, max(WINDOW_SHARE, LEAST_WINDOWS / max(1, total)))
    shards = max(1, round(share * total / SHARD_WINDOWS))
    kind, turns = id_kind(size), turns_of(shards)

    def dealt(keys: np.ndarray, rows: np.ndarray) -> pa.RecordBatch:
        place = keys // shards % turns * shards + keys % shards
        order = np.argsort(place, kind="stable")
        place = place[order]
        edges = np.flatnonzero(np.r_[True, place[1:] != place[:-1], True])
        turn, shard = np.divmod(place[edges[:-1]], shards)
        columns = [pa.array(shard, pa.int32()), cells(keys[order], edges), cells(rows[order], edges), pa.array(turn, pa.int32())]
        return pa.RecordBatch.from_arrays(columns, ["shard", "keys", "ids", "turn"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for part in (part for batch in batches for part in slices(batch)):
            marks = part.column("mark").to_numpy().view(np.uint64)
            ids, lengths = laid_end_to_end(part.column("ids"), kind)
            stop, counts = np.cumsum(lengths), -(-lengths // WINDOW)
            owner = np.repeat(np.arange(len(lengths)), counts)
            nth = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
            keys = mixed(marks[owner], nth)
            if share < 1:
                chosen = keys < share * 2.0**62
                owner, nth, keys = owner[chosen], nth[chosen], keys[chosen]
            first = (stop - lengths)[owner]
            for some in (slice(i, i + ROWS_OUT) for i in range(0, len(keys), ROWS_OUT)):
                rows = drawn_windows(ids, (first + nth * WINDOW)[some], first[some], stop[owner][some])
                held.append((keys[some], (rows + MARKS).astype(kind)))
                if sum(len(k) for k, _ in held) >= ROWS_OUT:
                    yield dealt(*map(np.concatenate, zip(*held)))
                    held.clear()
        if held:
            yield dealt(*map(np.concatenate, zip(*held)))

    schema = "shard int, keys binary, ids binary, turn int"
    rows, path = texts.select("mark", "ids").mapInArrow(run, schema), new_folder(texts.sparkSession, "windows")
    rows.write.partitionBy("turn").parquet(path)
    return texts.sparkSession.read.schema(rows.schema).parquet(path), shards


def windows_of(keys: list[bytes], ids: list[bytes], kind: str) -> tuple[np.ndarray, np.ndarray]:
    """Keys and ids, with their marks, of the windows that were dealt together."""
    rows = np.frombuffer(b"".join(ids), kind).reshape(-1, WINDOW + 1).astype(np.int32)
    return np.frombuffer(b"".join(keys), np.int64), rows - MARKS


def sample_windows(training: DataFrame, vocabulary: str) -> tuple[DataFrame, int]:
    """``shard, key, ids, turn`` for each window that the training texts are dealt as, to look at; number of shards."""
    size = vocabulary_size(vocabulary)
    kind, none = id_kind(size), training.sparkSession.sparkContext.broadcast({})
    source = training.select(F.lit(0).alias("doc_id"), "text", F.lit(True).alias("learn"), F.xxhash64(*training.columns).alias("mark"))
    sample, shards = deal_windows(read_texts(source, vocabulary, kind, none), size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (row for batch in batches for row in batch.to_pylist()):
            keys, ids = windows_of([row["keys"]], [row["ids"]], kind)
            columns = [pa.array([row["shard"]] * len(keys), pa.int32()), pa.array(keys), cells(ids, np.arange(len(keys) + 1))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array([row["turn"]] * len(keys), pa.int32())], ["shard", "key", "ids", "turn"])

    return sample.mapInArrow(run, "shard int, key bigint, ids binary, turn int"), shards


def mean_state(table: pa.Table) -> pa.Table:
    """The shards' rows of one stretch of weights, averaged by place."""
    rows = table.sort_by("shard").column("state").to_pylist()
    mean = np.mean([np.frombuffer(row, np.float32) for row in rows], axis=0, dtype=np.float64)
    return pa.table({"start": table.column("start")[:1], "state": pa.array([mean.astype(np.float32).tobytes()], pa.binary())})


def fitted(model: Attention, sample: DataFrame, rank: np.ndarray, turns: int = 1) -> Attention:
    """``model`` after ``ROUNDS`` rounds of steps on every shard; the driver holds one set of weights.

    A round reads the windows of its turn; those of a shard are one task's, some tens of thousands.
    """
    context, steps, kind = sample.sparkSession.sparkContext, STEPS // ROUNDS, id_kind(len(rank))
    ranks = context.broadcast(rank.astype(np.int32))
    over = STEPS if turns == 1 else steps * (ROUNDS // turns)  # steps in which a shard's windows of a turn are all seen
    for done in range(0, STEPS, steps):
        common = context.broadcast(model.state())

        def run(table: pa.Table) -> pa.Table:
            release()
            keys, rows = windows_of(table.column("keys").to_pylist(), table.column("ids").to_pylist(), kind)
            rank, rows = ranks.value, rows[np.argsort(keys, kind="stable")]  # of one key are only the windows of equal texts
            before, target = rows[:, :-1], rows[:, 1:]
            known = np.where(before >= 0, 1 + np.minimum(rank[np.maximum(before, 0)], OWN), 0)
            shard = table.column("shard")[0].as_py()
            own = Attention().load(common.value)
            own.fit(known, rank[np.maximum(target, 0)], target >= 0, done, steps, SEED + shard, over)
            state = own.state().astype(np.float32)
            starts = range(0, len(state), STATE_ROW)
            rows = pa.array([state[i : i + STATE_ROW].tobytes() for i in starts], pa.binary())
            return pa.table({"start": pa.array(starts, pa.int32()), "shard": pa.array([shard] * len(starts), pa.int32()), "state": rows})

        turn = sample.where(F.col("turn") == done // steps % turns).select("shard", "keys", "ids")
        parts = turn.groupBy("shard").applyInArrow(run, "start int, shard int, state binary")
        mean = parts.groupBy("start").applyInArrow(mean_state, "start int, state binary").toArrow().sort_by("start")
        if mean.num_rows:  # none where a turn has no windows
            model.load(np.frombuffer(b"".join(mean.column("state").to_pylist()), np.float32))
        common.destroy()
    return model


def vocabulary_size(vocabulary: str) -> int:
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary).get_vocab_size()


def train(texts: DataFrame, size: int):
    """Model fitted to the stored texts, with the ids' ranks and the rare ids' log shares."""
    counts = count_stored_ids(texts, size)
    rank, shares = id_ranks(counts)
    model = Attention().begin(np.sort(counts)[::-1])
    sample, shards = deal_windows(texts, size)
    return fitted(model, sample, rank, turns_of(shards)), rank, shares


def log_probabilities(ids: np.ndarray, lengths: np.ndarray, learnt) -> np.ndarray:
    """Log10 probability under the model of each text, whose ids are laid end to end."""
    model, rank, shares = learnt
    before, place, owner, counted = laid_out(ids, lengths, rank)
    ranks, rare = rank[ids], shares[ids]
    out = np.zeros(len(lengths))
    for at in range(0, len(owner), CHUNK):
        pick = counted[at : at + CHUNK]
        wanted = place[at : at + CHUNK][pick]
        split = range(at, min(at + CHUNK, len(owner)), PART)
        top = np.concatenate([model.hidden(before[i : i + PART])["top"][counted[i : i + PART].ravel()] for i in split])
        logs = model.log_shares(top, ranks[wanted]) + rare[wanted]
        out += np.bincount(np.repeat(owner[at : at + CHUNK], pick.sum(axis=1)), logs, len(lengths))
    return out / math.log(10)


def read_texts(source: DataFrame, vocabulary: str, kind: str, common: Broadcast) -> DataFrame:
    """Each text of ``doc_id, text, learn, mark`` read once and stored: its ids, its length, its words and what they weigh.

    ``common`` has the log10 weights of the words that are known everywhere; ``rare`` are the other ones.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, logs, row = word_ids(vocabulary), common.value, TaskContext.get().partitionId() << 32
        unseen, end = 0.0 if END in logs else math.log10(0.5), END_ID.to_bytes(4, "little")
        for part, texts in texts_of(batches):
            n_tokens, n_known, base, rare, ids = [], [], [], [], []
            for text in texts:
                found = text.split()
                ids.append(np.frombuffer(encoder.joined(found) + end, "<u4").astype(kind).tobytes())
                found.append(END)
                values = list(map(logs.get, found))
                missing = values.count(None)
                rare.append([w for w, v in zip(found, values) if v is None and w] if missing else [])
                n_tokens.append(len(found))
                n_known.append(len(found) - missing)
                base.append(math.fsum(filter(None, values)) + unseen)  # no logarithm of a half and a whole number is 0
            columns = {
                "row": pa.array(np.arange(row, row + len(texts))),
                **{name: part.column(name) for name in ("doc_id", "learn", "mark")},
                "octets": pa.array([len(t) for t in texts], pa.int64()),
                "n_tokens": pa.array(n_tokens, pa.int64()),
                "n_known": pa.array(n_known, pa.int64()),
                "base": pa.array(base, pa.float64()),
                "rare": pa.array(rare, pa.list_(pa.binary())),
                "ids": pa.array(ids, pa.binary()),
            }
            row += len(texts)
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    schema = (
        f"row bigint, doc_id {source.schema['doc_id'].dataType.simpleString()}, learn boolean, mark bigint, octets bigint, "
        "n_tokens bigint, n_known bigint, base double, rare array<binary>, ids binary"
    )
    return settle(source.mapInArrow(run, schema), "texts")


def score(
    documents: DataFrame,
    is_training: Column,
    vocabulary: str,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``doc_id, n_tokens, n_known, train_tokens, base_score, score`` per row.

    A text is lower-cased (A-Z) and is its words, runs of anything but ASCII white space, and one end. ``base_score`` is its
    log10 probability under the training counts ``c``, each token ``(c + 0.5) / (N + 0.5 * (V + 1))``. ``score`` is that of its
    subword ids and end under the model. Rows where ``is_training`` is true are learnt from; a null text counts as empty.
    Repeated rows count each; with nothing to learn from, all counts are 0 and the model stays as it began.
    """
    source = documents.select(
        F.col(id_column).alias("doc_id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"), is_training.alias("learn")
    )
    training = source.where("learn").drop("learn")
    words = count_words(training.select("text")).where("times > 0")
    tokens, kinds = words.agg(F.coalesce(F.sum("times"), F.lit(0)), F.count("*")).first()
    context = documents.sparkSession.sparkContext
    head = head_words(words, HEAD_WORDS)
    common = context.broadcast({w: math.log10(n + 0.5) for w, n in head.items()})
    least = min(n for w, n in head.items() if w) if len(head) > HEAD_WORDS else 0
    del head
    size = vocabulary_size(vocabulary)
    kind = id_kind(size)
    texts = read_texts(source.withColumn("mark", F.xxhash64("doc_id", "text")), vocabulary, kind, common)
    learnt = context.broadcast(train(texts.where("learn"), size))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for part in (part for batch in batches for part in slices(batch)):
            scores = log_probabilities(*laid_end_to_end(part.column("ids"), kind), learnt.value)
            yield part.drop_columns("ids").append_column("score", pa.array(scores))

    read = texts.select("row", "doc_id", "n_tokens", "n_known", "base", "ids")
    scored = settle(read.mapInArrow(run, read.drop("ids").withColumn("score", F.lit(0.0)).schema), "scored")
    counts = words.where(F.col("times") <= least) if least else words.where("false")
    value = F.log10(F.coalesce("times", F.lit(0)) + 0.5)
    rare = (
        texts.select("row", F.explode("rare").alias("word"))
        .join(counts, "word", "left")
        .groupBy("row")
        .agg(F.sum(value).alias("rare_base"), F.count("times").alias("rare_known"))
    )
    width = math.log10(tokens + 0.5 * (kinds + 1))
    return scored.join(rare, "row", "left").select(
        "doc_id",
        "n_tokens",
        (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("rare_base", F.lit(0.0)) - F.col("n_tokens") * width).alias("base_score"),
        "score",
    )
