"""Jaccard self-join of documents on word n-grams with adaptive multi-match prefixes.

Each document is a set of 64-bit n-gram numbers in one global order: rare n-grams by number, then the
frequent ones by estimated count. Sets of similarity ``t`` share at least ``l`` of their first
``n - ceil(t * n) + l`` n-grams, for every ``l``. A document picks its own ``l`` by the
estimated cost of its candidates, and two documents are compared only if they share as many prefix
n-grams as the smaller of their two ``l`` asks.

Equal sets are one class throughout. Links are wanted only as far as they connect, so candidates
that are connected already are never paired: first each class is compared with the leader it shares
most prefix n-grams with, a set of few n-grams of its own; then the components found are contracted,
and all remaining candidate pairs between different components are compared. No pair of a group that has
become one component is ever formed, and none between components is left out. The places of
the matches in the two orders and the prefix n-grams that no other prefix holds bound the overlap, so most unequal pairs go before their texts are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from assayer.llm.components import connected
from assayer.llm.shingles import shingle_set
from assayer.operators.lookup import join_terms
from assayer.session import settle

WIDTH = 4
PERCENT = 85
MOST_MATCHES = 8
VERIFY_COST = 1000.0  # bringing two sets together against the reading of one posting
FREQUENT_LEAST = 32
FREQUENT_MOST = 1 << 22  # bound on the frequent n-grams, which are broadcast
BROADCAST_IDS = 2_000_000
SLICE = 2000


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list[bytes | None]]]:
    for batch in batches:
        for part in (batch.slice(i, SLICE) for i in range(0, batch.num_rows, SLICE)):
            yield part.column(0), part.column(1).cast(pa.binary()).to_pylist()


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def signature(shingles: np.ndarray) -> int:
    """Number of a whole set, as a signed 64-bit value."""
    return int(np.uint64(xxhash.xxh3_64_intdigest(shingles.tobytes())).astype(np.int64))


def describe(source: DataFrame, width: int) -> DataFrame:
    """Per row ``doc_id, n, signature``, and per slice of a batch rows ``gram, times`` of its repeated n-grams."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in _batches(batches):
            sets = [shingle_set(t or b"", width) for t in texts]
            sizes = np.array([len(s) for s in sets], np.int64)
            marks = pa.array([signature(s) if len(s) else None for s in sets], pa.int64())
            gram, times = np.unique(np.concatenate([*sets, np.zeros(0, np.uint64)]), return_counts=True)
            often = times >= 3
            gap, n = pa.nulls(int(often.sum()), pa.int64()), len(sets)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.concat_arrays([ids, pa.nulls(len(gap), ids.type)]),
                    pa.concat_arrays([pa.array(sizes), gap]),
                    pa.concat_arrays([marks, gap]),
                    pa.concat_arrays([pa.nulls(n, pa.int64()), _signed(gram[often])]),
                    pa.concat_arrays([pa.nulls(n, pa.int64()), pa.array(times[often].astype(np.int64))]),
                ],
                ["doc_id", "n", "signature", "gram", "times"],
            )

    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {kind}, n bigint, signature bigint, gram bigint, times bigint")


def frequent_grams(described: DataFrame) -> np.ndarray:
    """Frequent n-grams, least frequent first; at most ``FREQUENT_MOST`` by their definition."""
    total = described.agg(F.sum("n")).first()[0] or 0
    least = max(FREQUENT_LEAST, total // FREQUENT_MOST)
    counts = described.where("gram IS NOT NULL").groupBy("gram").agg(F.sum("times").alias("times"))
    rows = counts.where(F.col("times") >= least).toPandas().sort_values(["times", "gram"])
    return rows["gram"].to_numpy(np.int64).view(np.uint64)


def prefixes(source: DataFrame, width: int, percent: int, frequent) -> DataFrame:
    """Prefix n-grams ``gram, signature, n, pos`` up to the longest prefix; ``pos`` is the place in the order.

    A task that meets a set again writes it once.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranked = frequent.value
        order = np.argsort(ranked)
        known, seen = ranked[order], set()
        for _, texts in _batches(batches):
            out = []
            for text in texts:
                grams = shingle_set(text or b"", width)
                n = len(grams)
                mark = signature(grams) if n else None
                if not n or mark in seen:
                    continue
                seen.add(mark)
                most = min(n, n - -(-percent * n // 100) + MOST_MATCHES)
                if len(known):
                    at = np.minimum(np.searchsorted(known, grams), len(known) - 1)
                    common = known[at] == grams
                    grams = np.concatenate([grams[~common], ranked[np.sort(order[at[common]])]])
                out.append((grams[:most], np.full(most, mark), np.full(most, n), np.arange(most)))
            if out:
                gram, mark, n, pos = map(np.concatenate, zip(*out))
                yield pa.RecordBatch.from_arrays(
                    [_signed(gram), pa.array(mark), pa.array(n.astype(np.int32)), pa.array(pos.astype(np.int32))],
                    ["gram", "signature", "n", "pos"],
                )

    return source.mapInArrow(run, "gram bigint, signature bigint, n int, pos int")


def postings(rows: DataFrame, percent: int) -> DataFrame:
    """Prefix rows of n-grams that at least two sets hold, cut to each set's own number of matches ``l``.

    ``level`` is the least ``l`` whose prefix holds the n-gram. ``l`` minimises ``postings * (1 +
    VERIFY_COST / l)``: a candidate that shares ``l`` n-grams uses up ``l`` postings, so there are at most
    ``postings / l`` of them. ``l`` is at most the number of n-grams that similar sets must share. ``shared`` is
    the part of the prefix that other prefixes hold too. ``own`` counts the n-grams up to ``pos`` that no other prefix
    holds. One shuffle by n-gram serves both the counts and the rows; the counts read all columns so that it is the
    same shuffle.
    """
    rows = rows.repartition("gram")
    held = rows.groupBy("gram").agg(
        F.min("signature").alias("low"),
        F.max("signature").alias("high"),
        F.count("*").alias("times"),
        F.min("n").alias("least_n"),
        F.min("pos").alias("least_pos"),
    )
    held = held.where("low < high AND least_n > 0 AND least_pos >= 0")
    shared = rows.join(held.select("gram", "times"), "gram").dropDuplicates(["gram", "signature"])
    need = F.expr(f"int((n * {percent} + 99) div 100)")
    shared = shared.withColumn("need", need).withColumn("level", F.expr("greatest(1, pos - n + need + 1)"))
    shared = settle(shared, "shared")
    cost = [
        (F.sum(F.when(F.col("level") <= m, F.col("times") - 1).otherwise(0)) * (1 + VERIFY_COST / m)).alias(f"c{m}")
        for m in range(1, MOST_MATCHES + 1)
    ]
    length = F.least("n", F.col("n") - F.col("need") + MOST_MATCHES)
    costs = shared.groupBy("signature", "n", "need").agg(*cost, F.count("*").alias("held"))
    costs = costs.withColumn("shared", F.col("held") / length)
    allowed = [F.when(F.col("need") >= m, F.col(f"c{m}")) for m in range(1, MOST_MATCHES + 1)]
    cheapest = F.least(*allowed)
    chosen = F.coalesce(*[F.when(c == cheapest, m) for m, c in enumerate(allowed, 1)])
    rank = F.row_number().over(Window.partitionBy("signature").orderBy("pos"))
    ranked = shared.withColumn("own", F.col("pos") + 1 - rank)
    picked = ranked.join(costs.select("signature", "shared", chosen.alias("matches")), "signature")
    return settle(picked.where("level <= matches").drop("times", "need"), "postings")


def compare(pairs: DataFrame, classes: DataFrame, source: DataFrame, width: int, percent: int) -> DataFrame:
    """Pairs ``a, b`` of signatures whose sets reach the similarity, worked out from the texts."""
    pairs = settle(pairs, "pairs")
    named = pairs.select(F.explode(F.array("a", "b")).alias("signature")).distinct()
    wanted = settle(classes.join(named, "signature").select("doc_id", "signature"), "wanted")
    if wanted.count() <= BROADCAST_IDS:
        wanted = F.broadcast(wanted)
    texts = source.join(wanted, source["doc_id"].eqNullSafe(wanted["doc_id"])).select("signature", "text")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for marks, bodies in _batches(batches):
            found = [shingle_set(t or b"", width) for t in bodies]
            right = [signature(s) == m for s, m in zip(found, marks.to_pylist())]
            grams = pa.array([s.tobytes() for s in found], pa.binary())
            yield pa.RecordBatch.from_arrays([marks, grams], ["signature", "grams"]).filter(pa.array(right))

    grams = texts.mapInArrow(sets, "signature bigint, grams binary").dropDuplicates(["signature"])
    grams = settle(grams, "grams")
    left = grams.select(F.col("signature").alias("a"), F.col("grams").alias("left"))
    right = grams.select(F.col("signature").alias("b"), F.col("grams").alias("right"))
    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                good.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select([0, 1]).filter(pa.array(good, pa.bool_()))

    return settle(joined.mapInArrow(verify, "a bigint, b bigint"), "links")


def candidates(matched: DataFrame, percent: int) -> DataFrame:
    """``a, b, count`` of pairs with enough matches whose places allow the similarity.

    ``matched`` has a row per common n-gram of two sets, as structs ``x`` and ``y``. What stands before the last match
    without matching is in no common part, so it bounds the overlap of the two sets. So does each match by itself: a common
    n-gram before it is in both prefixes, thus no ``own`` one of either.
    """
    before = F.least(F.expr("x.pos - x.own"), F.expr("y.pos - y.own"))
    behind = F.least(F.expr("x.n - x.pos"), F.expr("y.n - y.pos"))
    fewest = F.least("x.matches", "y.matches")
    pairs = (
        matched.where((F.col("x.n") * 100 >= F.col("y.n") * percent) & (F.col("y.n") * 100 >= F.col("x.n") * percent))
        .where((before + behind) * (100 + percent) >= F.expr("x.n + y.n") * percent)
        .where(F.greatest("x.level", "y.level") <= fewest)
        .groupBy(
            F.col("x.signature").alias("a"), F.col("y.signature").alias("b"), F.col("x.n").alias("m"),
            F.col("y.n").alias("n"), fewest.alias("fewest"),
        )
        .agg(F.count("*").alias("count"), F.max("x.pos").alias("i"), F.max("y.pos").alias("j"))
    )
    most = F.least(F.expr("m - i - 1 + count"), F.expr("n - j - 1 + count"))
    return pairs.where(F.col("count") >= F.col("fewest")).where(most * (100 + percent) >= F.expr("m + n") * percent)


SIDE = ["signature", "n", "pos", "level", "matches", "own"]


def leader_pairs(posts: DataFrame, percent: int) -> DataFrame:
    """Each set with the leader it shares most prefix n-grams with.

    The leader of an n-gram is the set with the largest ``shared`` part of those that hold it; in a group of near
    copies that is one with few changes, which is similar to most of the others.
    """
    lead = F.max(F.struct("shared", *SIDE)).alias("y")
    matched = posts.join(posts.groupBy("gram").agg(lead), "gram").select(F.struct(*SIDE).alias("x"), "y")
    found = candidates(matched.where("x.signature <> y.signature"), percent)
    return found.groupBy("a").agg(F.max_by("b", F.struct("count", "b")).alias("b"))


def pairs_between(posts: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """Candidate pairs whose sets are in different components."""
    marked = posts.join(labels.withColumnRenamed("node", "signature"), "signature", "left")
    marked = settle(marked.withColumn("label", F.coalesce("label", "signature")), "marked")
    mixed_lists = marked.groupBy("gram").agg(F.min("label").alias("p"), F.max("label").alias("q")).where("p < q")
    marked = marked.join(mixed_lists.select("gram"), "gram").select("gram", F.struct(*SIDE, "label").alias("x"))
    marked = settle(marked, "mixed")
    matched = marked.join(marked.withColumnRenamed("x", "y"), "gram")
    return candidates(matched.where("x.label <> y.label AND x.signature < y.signature"), percent).select("a", "b")


def near_groups(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    width: int = WIDTH,
    percent: int = PERCENT,
) -> DataFrame:
    """``doc_id, n_shingles, component_id`` per row: documents connected by links share a component.

    Two rows link if their sets of word n-grams (words are runs of anything but ASCII white space,
    A-Z in lower case) have a Jaccard similarity of at least ``percent`` hundredths. A text with fewer
    words than ``width`` is one n-gram. A null text and one without words have no n-grams and link with nothing;
    such a row is its own component. ``component_id`` is the least non-null id of the component.
    Repeated rows and equal texts are linked. Other columns are ignored.
    """
    source = documents.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    described = settle(describe(source, width), "described")
    rows = described.where("gram IS NULL").select("doc_id", "n", "signature")
    classes = rows.where("signature IS NOT NULL").groupBy("signature")
    classes = settle(classes.agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("rows")), "classes")
    frequent = source.sparkSession.sparkContext.broadcast(frequent_grams(described))
    posts = postings(prefixes(source, width, percent, frequent), percent)
    links = compare(leader_pairs(posts, percent), classes, source, width, percent)
    more = compare(pairs_between(posts, connected(links), percent), classes, source, width, percent)
    labels = connected(links.unionByName(more)).withColumnRenamed("node", "signature")
    grouped = classes.join(labels, "signature", "left").withColumn("label", F.coalesce("label", "signature"))
    least = grouped.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    named = settle(grouped.join(least, "label").select("signature", "rows", "component_id"), "components")
    joined = join_terms(
        rows.where("signature IS NOT NULL"), named, "signature", "rows", "doc_id", limit=8 * 1024 * 1024
    )
    alone = rows.where("signature IS NULL").select("doc_id", "n", F.col("doc_id").alias("component_id"))
    return joined.select("doc_id", "n", "component_id").unionByName(alone).withColumnRenamed("n", "n_shingles")
