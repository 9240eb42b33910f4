"""SimHash near-duplicates by anchor points of a covering code.

Two fingerprints of 64 bits that differ in at most three have a half in which they differ in at most
one. On the 32 bits of a half the anchors are the words of a covering code: a perfect Hamming code on
31 bits beside one free bit, so every half is within one bit of its home anchor (covering radius 1). Each
distinct fingerprint is a resident of its two homes and a guest of every anchor within two bits (radius plus
the half's threshold), 17 at most a half. Of two fingerprints that link, each is a guest where the other is a
resident, so residents are compared with guests, anchor by anchor, on all 64 bits.

Links matter only as far as they connect. A task keeps a spanning forest of each anchor's links, never the
links themselves. An anchor with more members than ``CROWD`` is first dealt into parts by hash, each linked in itself;
what has become one component there is not compared again. Then members outside their anchor's
largest component meet all others in blocks of residents and guests, so that no task holds an anchor as a whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayer.llm.components import connected
from assayer.llm.counted_join import join_counted
from assayer.operators.lookup import join_terms
from assayer.session import settle

SHINGLE = 3
SEED = 42
SLICE = 500
FREE = np.uint32(1 << 31)  # the bit of a half that the Hamming code leaves out
THRESHOLD = 3
CROWD = 4096  # members of an anchor that one task compares at once
FEW = 16  # up to so many members an anchor's links are written as they are
MEMBERS_AT_ONCE = 1 << 16
_LANES = np.uint64(0x0101010101010101)


def bit_majorities(hashes: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Fingerprint of each stretch of ``hashes``; ``ends`` is where each stretch ends, none is empty.

    Eight bits of a hash are counted at once in the bytes of one number, in runs of at most 255 hashes.
    """
    starts = np.concatenate([[0], ends[:-1]])
    sizes = ends - starts
    runs = -(-sizes // 255)
    owner = np.repeat(np.arange(len(ends)), runs)
    turn = np.arange(len(owner)) - np.repeat(np.cumsum(runs) - runs, runs)
    cuts = starts[owner] + 255 * turn
    first = np.cumsum(runs) - runs
    out = np.zeros(len(ends), np.uint64)
    for bit in range(8):
        lanes = np.add.reduceat((hashes >> np.uint64(bit)) & _LANES, cuts)
        counts = np.add.reduceat(lanes.view(np.uint8).reshape(-1, 8).astype(np.int64), first, axis=0)
        over = (2 * counts > sizes[:, None]).astype(np.uint64)
        out |= (over << (np.uint64(8) * np.arange(8, dtype=np.uint64) + np.uint64(bit))).sum(axis=1, dtype=np.uint64)
    return out


def text_hashes(text: bytes, width: int = SHINGLE) -> list[int]:
    """XXH64 of each run of ``width`` words, repeats included; of the whole sequence if it is shorter."""
    words = text.lower().split()
    if not words:
        return []
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = (ends - ends[0] if len(words) == 1 else np.concatenate([[0], ends[:-1]])).tolist()
    stops = (ends - 1)[min(width, len(words)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    return [digest(joined[a:b], SEED) for a, b in zip(starts, stops)]


def fingerprints(texts: list[bytes | None], width: int = SHINGLE) -> np.ndarray:
    """Fingerprints of texts; of one without words 0."""
    hashes = [text_hashes(t or b"", width) for t in texts]
    sizes = np.array([len(h) for h in hashes], np.int64)
    out = np.zeros(len(texts), np.uint64)
    some = sizes > 0
    if some.any():
        flat = np.array([h for one in hashes for h in one], np.uint64)
        out[some] = bit_majorities(flat, np.cumsum(sizes[some]))
    return out


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Check sums of the bytes of a half, and for each sum the 15 pairs of bits that undo it."""
    check = np.zeros((4, 256), np.uint8)
    for byte in range(4):
        for bit in range(8):
            place = 8 * byte + bit + 1
            if place < 32:
                check[byte, (np.arange(256) >> bit & 1) == 1] ^= place
    pairs = np.zeros((32, 15), np.uint32)
    for total in range(1, 32):
        both = [(i, i ^ total) for i in range(1, 32) if i < i ^ total]
        pairs[total] = [(1 << i - 1) | (1 << j - 1) for i, j in both]
    return check, pairs


_CHECK, _PAIRS = _tables()


def anchors(half: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``owner, anchor, resident``: every anchor within two bits of each half; the first is its home."""
    parts = np.ascontiguousarray(half, "<u4").view(np.uint8).reshape(-1, 4)
    total = np.bitwise_xor.reduce(_CHECK[np.arange(4), parts], axis=1).astype(np.int64)
    off = total > 0
    home = half ^ np.where(off, np.uint32(1) << (total - 1).clip(0).astype(np.uint32), np.uint32(0))
    owner = np.arange(len(half))
    around = half[off][:, None] ^ _PAIRS[total[off]]
    return (
        np.concatenate([owner, owner, np.repeat(owner[off], 15)]),
        np.concatenate([home, home ^ FREE, around.ravel()]),
        np.arange(2 * len(half) + around.size) < len(half),
    )


def members(marks: DataFrame) -> DataFrame:
    """``anchor, mark, resident`` for both halves of each fingerprint; bit 32 of ``anchor`` tells the half."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 10_000):
                mark = batch.column(0).slice(start, 10_000).to_numpy().view(np.uint64)
                for side in range(2):
                    owner, anchor, resident = anchors((mark >> np.uint64(32 * side)).astype(np.uint32))
                    key = anchor.astype(np.int64) | (side << 32)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(key), pa.array(mark[owner].view(np.int64)), pa.array(resident)],
                        ["anchor", "mark", "resident"],
                    )

    return marks.select("mark").mapInArrow(run, "anchor bigint, mark bigint, resident boolean")


def forest(mark: np.ndarray, left: np.ndarray, threshold: int) -> list[tuple[int, int]]:
    """Links that span what the links between ``mark[left]`` and ``mark`` connect."""
    label, edges = np.arange(len(mark)), []
    for i in np.flatnonzero(left):
        near = np.flatnonzero(np.bitwise_count(mark ^ mark[i]) <= threshold)
        others, first = np.unique(label[near], return_index=True)
        apart = others != label[i]
        if apart.any():
            edges += [(i, j) for j in near[first[apart]]]
            label[np.isin(label, others)] = label[i]
    return edges


def link_groups(key: np.ndarray, mark: np.ndarray, left: np.ndarray, threshold: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of whole groups; equal ``key`` values stand together."""
    starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    sizes = np.diff(np.append(starts, len(key)))
    small = np.repeat(sizes <= FEW, sizes)
    first, size = np.repeat(starts, sizes), np.repeat(sizes, sizes)
    lead = np.flatnonzero(left & small)
    a = np.repeat(lead, size[lead])
    b = np.repeat(first[lead], size[lead]) + np.arange(len(a)) - np.repeat(np.cumsum(size[lead]) - size[lead], size[lead])
    near = (a != b) & (np.bitwise_count(mark[a] ^ mark[b]) <= threshold)
    found = [np.stack([a[near], b[near]], axis=1)]
    for start, n in zip(starts[sizes > FEW], sizes[sizes > FEW]):
        edges = forest(mark[start : start + n], left[start : start + n], threshold)
        found.append(np.array(edges, np.int64).reshape(-1, 2) + start)
    x, y = mark[np.concatenate(found)].view(np.int64).T
    return np.minimum(x, y), np.maximum(x, y)


def compare(rows: DataFrame, threshold: int) -> DataFrame:
    """Links ``a, b`` found by comparing, in each ``(anchor, cell)``, the marks flagged ``left`` with all."""
    rows = rows.select("anchor", "cell", "mark", "left").repartition("anchor", "cell")
    rows = rows.sortWithinPartitions("anchor", "cell")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def linked(table: pa.Table) -> pa.RecordBatch:
            anchor, cell, mark, left = (c.to_numpy() for c in table.columns)
            group = np.concatenate([[0], np.cumsum((np.diff(anchor) != 0) | (np.diff(cell) != 0))])
            a, b = link_groups(group, mark.view(np.uint64), left, threshold)
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            if sum(b.num_rows for b in held) < MEMBERS_AT_ONCE:
                continue
            table = pa.Table.from_batches(held).combine_chunks()
            anchor, cell = table["anchor"].to_numpy(), table["cell"].to_numpy()
            last = np.flatnonzero((anchor != anchor[-1]) | (cell != cell[-1]))
            whole = int(last[-1]) + 1 if len(last) else 0  # the last group may go on
            if whole:
                yield linked(table.slice(0, whole))
            held = table.slice(whole).to_batches()
        if held:
            yield linked(pa.Table.from_batches(held))

    return rows.mapInArrow(run, "a bigint, b bigint")


def spread(name: str, parts) -> F.Column:
    """A part from 0 for the value of a column, by hash."""
    return F.pmod(F.xxhash64(name), parts).cast("bigint")


def crowd_links(rows: DataFrame, found: DataFrame, threshold: int, crowd: int) -> DataFrame:
    """Links of crowded anchors between what is not yet connected by ``found``.

    Members outside the anchor's largest component are compared with all members, block by block.
    """
    labels = connected(found).withColumnRenamed("node", "mark")
    marked = rows.join(labels, "mark", "left").withColumn("label", F.coalesce("label", "mark"))
    marked = settle(marked.select("anchor", "mark", "n", "label"), "crowded")
    sizes = marked.groupBy("anchor", "label").agg(F.count("*").alias("size"), F.max("n").alias("n"))
    main = F.max(F.struct("size", "label"))
    plans = sizes.groupBy("anchor").agg(main.alias("main"), F.max("n").alias("n")).where("main.size < n")
    blocks = F.expr(f"(n - main.size + {crowd} - 1) div {crowd}").alias("blocks")
    plans = settle(plans.select("anchor", "n", F.col("main.label").alias("main"), blocks), "plans")
    total = plans.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    marked = join_counted(marked.drop("n"), plans, ["anchor"], "n", total)
    parts = F.expr(f"(n + {crowd} - 1) div {crowd}").alias("parts")
    here = marked.select("anchor", "mark", "label", "main", "blocks", parts)
    right = here.select(
        "*", spread("mark", F.col("parts")).alias("part"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")
    )
    left = here.where("label <> main").select(
        "*", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), spread("mark", F.col("blocks")).alias("block")
    )
    both = right.withColumn("left", F.lit(False)).unionByName(left.withColumn("left", F.lit(True)))
    return compare(both.withColumn("cell", F.expr("part * blocks + block")), threshold)


def near_groups(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    width: int = SHINGLE,
    crowd: int = CROWD,
) -> DataFrame:
    """``doc_id, fingerprint, component_id`` per row: rows whose fingerprints differ in at most three bits link.

    Words are runs of anything but ASCII white space, A-Z in lower case. A bit of the fingerprint is set if it is set in
    more than half of the hashes of a text's runs of ``width`` words, repeats included; a shorter text is one run. A
    null text and one without words have fingerprint 0 and link like any other. ``component_id`` is the least non-null
    id that links reach. Repeated rows and equal texts are linked; other columns are ignored; an empty table
    gives an empty result.
    """
    source = documents.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(i, SLICE) for i in range(0, batch.num_rows, SLICE)):
                found = fingerprints(part.column(1).cast(pa.binary()).to_pylist(), width)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found.view(np.int64))], ["doc_id", "mark"])

    described = settle(source.mapInArrow(run, f"doc_id {kind}, mark bigint"), "fingerprints")
    classes = described.groupBy("mark").agg(F.min("doc_id").alias("least"), F.count("*").alias("rows"))
    classes = settle(classes, "classes")
    links = near_links(classes, crowd)
    named = settle(components(classes, connected(links).withColumnRenamed("node", "mark")), "components")
    joined = join_terms(described, named, "mark", "rows", "doc_id", limit=8 * 1024 * 1024)
    return joined.select("doc_id", F.lpad(F.lower(F.hex("mark")), 16, "0").alias("fingerprint"), "component_id")


def near_links(classes: DataFrame, crowd: int = CROWD, threshold: int = THRESHOLD) -> DataFrame:
    """Links ``a, b`` between distinct ``mark`` values that connect all that differ in at most ``threshold`` bits."""
    if threshold > THRESHOLD:
        raise ValueError(f"two halves differ in one bit at most for thresholds up to {THRESHOLD}")
    rows = members(classes)
    held = rows.groupBy("anchor").agg(F.count("*").alias("n"), F.max("resident").alias("met"))
    held = settle(held.where("n > 1 AND met").select("anchor", "n"), "anchors")
    total = held.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    held_rows = join_counted(rows, held, ["anchor"], "n", total)
    parts = F.expr(f"(n + {crowd} - 1) div {crowd}")
    dealt = held_rows.withColumn("cell", spread("mark", parts)).withColumnRenamed("resident", "left")
    # in a part of a crowded anchor all are compared, so that most of it becomes one component
    dealt = dealt.withColumn("left", F.col("left") | (F.col("n") > crowd))
    links = settle(compare(dealt, threshold).distinct(), "links")
    if held.where(F.col("n") > crowd).isEmpty():
        return links
    crowded = held_rows.where(F.col("n") > crowd)
    return settle(links.unionByName(crowd_links(crowded, links, threshold, crowd)), "all-links")


def components(classes: DataFrame, labels: DataFrame) -> DataFrame:
    """``mark, rows, component_id``: the least id among the marks of one label, for a mark without label its own."""
    joined = settle(classes.join(labels, "mark", "left"), "labelled")
    linked = joined.where("label IS NOT NULL")
    least = settle(linked.groupBy("label").agg(F.min("least").alias("component_id"), F.count("*").alias("times")), "least")
    found = join_counted(linked, least, ["label"], "times", linked.count())
    alone = joined.where("label IS NULL").withColumn("component_id", F.col("least"))
    columns = ["mark", "rows", "component_id"]
    return found.select(columns).unionByName(alone.select(columns))
