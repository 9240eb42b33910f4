"""A linear perceptron on long term weights, in two distributed forms.

``fit_summed``, the default, adds up the corrections of all misjudged documents per epoch. Terms are numbered and
their weights kept in blocks; the training rows are dealt by document once and stay where they are. Per
epoch the blocks visit the rows, margins, test and correction happen in place, and only partly summed
corrections are shuffled, by term. Neither the driver nor a task holds more than a block of weights.

``fit_mixed`` is iterative parameter mixing (McDonald, Hall and Mann, 2010): each epoch
every shard runs over its documents from the shared weights and the shards' changes are
averaged. All weights travel to all tasks, so it takes ``MIXED_TERMS`` terms at most.

A model is a table ``(term, w, n)``: weight and number of training documents of each
term, and one row for the bias.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from assayer.functions.fixed_values import PERCEPTRON_EPOCHS, SEED
from assayer.functions.ordering import shuffle_key
from assayer.operators import metrics
from assayer.operators.lookup import join_terms
from assayer.session import discard, settle

SHARDS = 8
MIXED_TERMS = 1_000_000  # most terms that ``fit_mixed`` takes
BLOCK_TERMS = 4_000_000  # terms of a block, whose weights are broadcast (8 bytes each)
BLOCKS_AT_ONCE = 2
RUN_BITS = 12  # weights of 4,096 numbers that follow one another are a row of the broadcast
BIAS_NUMBER = -1
PATIENCE = 5
BIAS = "\u0001bias"  # no cleaned term holds this character
MODEL = "term string, w double, n bigint"


@dataclass
class Stopper:
    """Says stop after ``PATIENCE`` epochs in a row that did not get ``tol`` better."""

    tol: float | None
    best: float = float("inf")
    idle: int = 0

    def done(self, loss: float) -> bool:
        if self.tol is None:
            return False
        self.idle = self.idle + 1 if loss > self.best - self.tol else 0
        self.best = min(self.best, loss)
        return self.idle >= PATIENCE


def bias_of(model: DataFrame) -> Column:
    row = model.where(F.col("term") == BIAS).agg(F.coalesce(F.sum("w"), F.lit(0.0)).alias("b"))
    return row.scalar()


def with_margin(docs: DataFrame, weights: DataFrame, key: str, model: DataFrame) -> DataFrame:
    """Add each document's signed distance; without known terms it is the bias alone."""
    found = join_terms(
        weights.select(key, "term", "weight"), model.where(F.col("term") != BIAS), "term", "n", key
    )
    sums = found.groupBy(key).agg(F.sum(F.col("weight") * F.col("w")).alias("sum"))
    margin = F.coalesce(F.col("sum"), F.lit(0.0)) + bias_of(model)
    return docs.join(sums, key, "left").withColumn("margin", margin).drop("sum")


def predict(docs: DataFrame, weights: DataFrame, key: str, model: DataFrame) -> DataFrame:
    scored = with_margin(docs, weights, key, model)
    return scored.withColumn("prediction", F.when(F.col("margin") > 0, 1).otherwise(0))


def signed_labels(labels: DataFrame, key: str, label: str) -> DataFrame:
    return labels.select(key, F.when(F.col(label) == 1, 1.0).otherwise(-1.0).alias("y"))


def numbered_terms(rows: DataFrame, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """``(term, n, block, i)``: documents per term, its number, and the block of some ``block_terms`` terms it is in.

    Blocks are ranges of the sorted terms; numbers rise within a block but do not follow one another across blocks.
    """
    counts = settle(rows.groupBy("term").agg(F.count("*").alias("n")), "term-counts")
    blocks = max(1, -(-counts.count() // block_terms))
    placed = counts.repartitionByRange(blocks, "term")
    numbered = placed.select(
        "term", "n", F.spark_partition_id().alias("block"), F.monotonically_increasing_id().alias("i")
    )
    return settle(numbered, "numbered-terms")


def weight_runs(model: DataFrame) -> DataFrame:
    """``(run, first, ws)`` of ``model(i, w)``: the weights of each run of numbers in one array, from the run's ``first`` on.

    A broadcast of single weights holds some 80 bytes of each on the driver, which builds it, this one 8.
    Numbers that the model lacks have a null between others.
    """
    cells = F.array_sort(F.collect_list(F.struct("i", "w"))).alias("cells")
    runs = model.groupBy(F.shiftright("i", RUN_BITS).alias("run")).agg(cells)
    runs = runs.select("run", "cells", F.get("cells.i", F.lit(0)).alias("first"), F.element_at("cells.i", -1).alias("last"))
    known = F.map_from_entries("cells")
    filled = F.transform(F.sequence("first", "last"), lambda i: F.element_at(known, i))
    gapless = F.col("last") - F.col("first") + 1 == F.size("cells")
    return runs.select("run", "first", F.when(gapless, F.col("cells.w")).otherwise(filled).alias("ws"))


@dataclass
class KeptRows:
    """Training rows ``(key, y, block, i, weight)``, dealt by document once; each document has a row for the bias.

    ``open`` deals and keeps them in memory and on disk; a lost part is dealt again. What is kept of ``y`` and ``weight``
    is their product ``signed``, whose sum over a document is the margin times the side.
    """

    rows: DataFrame
    key: str
    blocks: int
    held: DataFrame | None = None

    def __enter__(self) -> KeptRows:
        signed = (F.col("y") * F.col("weight")).alias("signed")
        dealt = self.rows.select(self.key, "block", "i", signed).repartition(self.key).sortWithinPartitions(self.key)
        self.held = dealt.persist(StorageLevel.MEMORY_AND_DISK)
        return self

    def __exit__(self, *failure) -> None:
        self.held.unpersist()

    def _products(self, rows: DataFrame, model: DataFrame) -> DataFrame:
        """``rows`` where they are, each with its ``signed`` times its weight; without a weight it has none."""
        found = rows.withColumn("run", F.shiftright("i", RUN_BITS)).join(F.broadcast(weight_runs(model)), "run")
        w = F.get("ws", (F.col("i") - F.col("first")).cast("int"))
        return found.select(self.key, "i", "signed", (F.col("signed") * w).alias("product"))

    def misjudged(self, model: DataFrame) -> DataFrame:
        """Rows ``(i, correction)`` of the documents that ``model(block, i, w)`` puts on the wrong side, or on neither.

        With one block the margin is a sum over the document's rows where they are. With more, each block's part of
        the margins is summed in place, and only these parts and the misjudged documents are shuffled.
        """
        key, correction = self.key, F.col("signed").alias("correction")
        if self.blocks == 1:
            products = self._products(self.held, model)
            margin = F.sum("product").over(W.partitionBy(key))
            return products.withColumn("margin", margin).where(F.col("margin") <= 0).select("i", correction)
        parts = []
        for first in range(0, self.blocks, BLOCKS_AT_ONCE):
            some = [
                self._products(self.held.where(F.col("block") == b), model.where(F.col("block") == b))
                .groupBy(key)
                .agg(F.sum("product").alias("part"))
                for b in range(first, min(self.blocks, first + BLOCKS_AT_ONCE))
            ]
            parts.append(settle(reduce(DataFrame.unionByName, some), "margins"))
        sums = reduce(DataFrame.unionByName, parts).groupBy(key).agg(F.sum("part").alias("margin"))
        wrong = settle(sums.where(F.col("margin") <= 0).select(key), "misjudged")
        for part in parts:
            discard(part)
        return self.held.join(wrong, key, "left_semi").select("i", correction)


def fit_summed(
    weights: DataFrame,
    labels: DataFrame,
    key: str,
    label: str,
    epochs: Sequence[int] = PERCEPTRON_EPOCHS,
    tol: float | None = 1e-3,
    block_terms: int = BLOCK_TERMS,
) -> dict[int, DataFrame]:
    """Models after each wanted number of epochs, by summed corrections; one training run yields them all.

    Sums are divided by the number of documents, which scales all weights alike and
    changes no prediction. The loss is the share of misjudged documents. A document whose margin is 0 is
    misjudged. Without documents the model is a bias of 0. Null keys join nothing and take no part.
    """
    docs = settle(signed_labels(labels, key, label).where(F.col(key).isNotNull()), "labels")
    terms = settle(docs.join(weights, key).select(key, "y", "term", "weight"), "training-terms")
    size = docs.count()
    numbered = numbered_terms(terms, block_terms)
    blocks = (numbered.agg(F.max("block")).first()[0] or 0) + 1
    bias_rows = docs.select(
        key, "y", F.lit(0).alias("block"), F.lit(BIAS_NUMBER).cast("bigint").alias("i"), F.lit(1.0).alias("weight")
    )
    known = join_terms(terms, numbered, "term", "n", key).select(key, "y", "block", "i", "weight")
    rows = known.unionByName(bias_rows)
    bias = terms.sparkSession.createDataFrame(
        [(0, BIAS_NUMBER, 0.0, size)], "block int, i bigint, w double, hits bigint"
    )
    start = numbered.select("block", "i", F.lit(0.0).alias("w"), F.lit(0).cast("bigint").alias("hits"))
    model = settle(start.unionByName(bias), "perceptron")
    stopper, wanted, kept_models = Stopper(tol), sorted(set(epochs)), {}
    with KeptRows(rows, key, blocks) as kept:
        for epoch in range(1, (wanted[-1] if size else 0) + 1):
            shifts = kept.misjudged(model).groupBy("i").agg(
                F.sum("correction").alias("shift"), F.count("*").alias("wrong")
            )
            moved = F.col("w") + F.coalesce(F.col("shift"), F.lit(0.0)) / size
            hits = F.coalesce(F.col("wrong"), F.lit(0)).alias("hits")
            newer = settle(model.join(shifts, "i", "left").select("block", "i", moved.alias("w"), hits), "perceptron")
            if epoch - 1 not in wanted:
                discard(model)
            model = newer
            if epoch in wanted:
                kept_models[epoch] = model
            # the bias has a row in every document
            wrong = model.where(F.col("i") == BIAS_NUMBER).first()["hits"]
            if stopper.done(wrong / size):
                break
    discard(terms)
    named = numbered.select("term", "n", "i").unionByName(
        terms.sparkSession.createDataFrame([(BIAS, size, BIAS_NUMBER)], "term string, n bigint, i bigint")
    )

    def as_table(learned: DataFrame) -> DataFrame:
        return settle(named.join(learned, "i").select("term", "w", "n"), "perceptron")

    final = as_table(model)
    return {e: as_table(kept_models[e]) if kept_models.get(e, model) is not model else final for e in wanted}


def shard_epoch(documents: DataFrame, shared, seed: int, epoch: int) -> pd.Series:
    """Weight changes summed over shards, after one online pass of each shard.

    Negative positions carry the sums of loss, documents and shards.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        local, last = shared.value.copy(), len(shared.value) - 1
        loss, n = 0.0, 0
        for batch in batches:
            order = np.random.default_rng([seed, epoch, n]).permutation(len(batch))
            ys, positions, values = (batch[c].to_numpy() for c in ("y", "i", "x"))
            for row in order:
                at = np.append(positions[row], last).astype(np.int64)
                x = np.append(values[row], 1.0)
                margin = ys[row] * float(local[at] @ x)
                loss += max(0.0, -margin)
                if margin <= 0:
                    local[at] += ys[row] * x
            n += len(batch)
        if n:
            changed = np.flatnonzero(local != shared.value)
            yield pd.DataFrame({"i": changed, "change": (local - shared.value)[changed]})
            yield pd.DataFrame({"i": [-1, -2, -3], "change": [loss, float(n), 1.0]})

    changes = documents.select("y", "i", "x").mapInPandas(run, "i bigint, change double")
    # At most one row per vocabulary entry comes back.
    return changes.groupBy("i").agg(F.sum("change").alias("change")).toPandas().set_index("i")["change"]


def fit_mixed(
    weights: DataFrame,
    labels: DataFrame,
    key: str,
    label: str,
    epochs: Sequence[int] = PERCEPTRON_EPOCHS,
    tol: float | None = 1e-3,
    shards: int = SHARDS,
    seed: int = SEED,
) -> dict[int, DataFrame]:
    """Models after each wanted number of epochs; one training run yields them all.

    Shards are cut by key hash, so the result depends on their number but on no other
    partitioning or setting of the cluster. More than ``MIXED_TERMS`` terms are refused.
    """
    spark = weights.sparkSession
    terms = weights.select("term").distinct().count()
    if terms > MIXED_TERMS:
        raise ValueError(f"{terms} terms are too many to send to every task; use method='summed'")
    vocabulary = weights.groupBy("term").agg(F.count("*").alias("n")).orderBy("term").toPandas()
    vocabulary["i"] = np.arange(len(vocabulary), dtype=np.int32)
    indexed = settle(
        spark.createDataFrame(vocabulary, "term string, n bigint, i int"), "vocabulary-index"
    )
    cell = F.struct("i", "weight")
    cells = (
        join_terms(weights, indexed, "term", "n", key)
        .groupBy(key)
        .agg(F.array_sort(F.collect_list(cell)).alias("cells"))
    )
    documents = settle(
        signed_labels(labels, key, label)
        .join(cells, key, "left")
        .select(
            key,
            "y",
            F.coalesce("cells.i", F.array().cast("array<int>")).alias("i"),
            F.coalesce("cells.weight", F.array().cast("array<double>")).alias("x"),
        ),
        "training-documents",
    )
    documents = documents.repartition(shards, key).sortWithinPartitions(shuffle_key(key, seed), key).persist()
    values = np.zeros(len(vocabulary) + 1)
    stopper, wanted, out = Stopper(tol), sorted(set(epochs)), {}
    try:
        for epoch in range(1, wanted[-1] + 1):
            shared = spark.sparkContext.broadcast(values)
            moved = shard_epoch(documents, shared, seed, epoch)
            shared.unpersist()
            changed = moved[moved.index >= 0]
            values = values.copy()
            values[changed.index.to_numpy()] += changed.to_numpy() / moved[-3]
            if epoch in wanted:
                out[epoch] = values
            if stopper.done(moved[-1] / moved[-2]):
                break
    finally:
        documents.unpersist()

    def as_table(learned: np.ndarray) -> DataFrame:
        size = int(vocabulary["n"].max()) if len(vocabulary) else 0
        frame = pd.DataFrame(
            {"term": [*vocabulary["term"], BIAS], "w": learned, "n": [*vocabulary["n"], size]}
        )
        return settle(spark.createDataFrame(frame, MODEL), "perceptron")

    final = as_table(values)
    return {e: final if out.get(e, values) is values else as_table(out[e]) for e in wanted}


def fit_perceptron(
    weights: DataFrame,
    labels: DataFrame,
    key: str,
    label: str,
    epochs: Sequence[int] = PERCEPTRON_EPOCHS,
    tol: float | None = 1e-3,
    method: str = "summed",
    shards: int = SHARDS,
) -> dict[int, DataFrame]:
    """``{epochs: model}`` by the ``method`` asked for: ``summed`` or ``mixed``.

    The two learn differently, so the size of the data never chooses between them: ``summed`` takes any
    vocabulary, ``mixed`` sends the weights of the whole vocabulary to every task and refuses a large one.
    ``shards`` counts for ``mixed`` only. ``weights(key, term, weight)`` holds the documents of ``labels(key, label)``.
    """
    if method not in ("mixed", "summed"):
        raise ValueError(f"unknown method {method!r}")
    if method == "mixed":  # reads the weights several times
        weights = settle(weights.select(key, "term", "weight"), "training-weights")
        return fit_mixed(weights, labels, key, label, epochs, tol, shards)
    return fit_summed(weights, labels, key, label, epochs, tol)


def sweep_epochs(
    models: dict[int, DataFrame], docs: DataFrame, weights: DataFrame, key: str, label: str
) -> DataFrame:
    """Validation F1 and accuracy by number of epochs, in one pass over the documents.

    Numbers of epochs that share a model (training had stopped before) are scored once.
    """
    distinct = {id(m): m for m in models.values()}
    stacked = reduce(
        DataFrame.unionByName, [m.withColumn("model", F.lit(i)) for i, m in enumerate(distinct.values())]
    )
    vectors = settle(
        stacked.groupBy("term").agg(
            F.max("n").alias("n"),
            *[F.max(F.when(F.col("model") == i, F.col("w"))).alias(f"w{i}") for i in range(len(distinct))],
        ),
        "models",
    )
    found = join_terms(weights.select(key, "term", "weight"), vectors.where(F.col("term") != BIAS), "term", "n", key)
    sums = found.groupBy(key).agg(
        *[F.sum(F.col("weight") * F.col(f"w{i}")).alias(f"s{i}") for i in range(len(distinct))]
    )
    bias = vectors.where(F.col("term") == BIAS).first()
    said = [
        F.struct(
            F.lit(i).alias("model"),
            (F.coalesce(F.col(f"s{i}"), F.lit(0.0)) + bias[f"w{i}"] > 0).cast("int").alias("prediction"),
        )
        for i in range(len(distinct))
    ]
    judged = docs.select(key, label).join(sums, key, "left").select(label, F.inline(F.array(*said)))
    scores = metrics.binary_scores(metrics.confusion(judged, label, "prediction", ["model"]), by=["model"])
    number = {known: i for i, known in enumerate(distinct)}
    points = docs.sparkSession.createDataFrame(
        [(i, e, number[id(m)]) for i, (e, m) in enumerate(models.items())], "grid_pos int, epochs int, model int"
    )
    return points.join(F.broadcast(scores), "model").select("grid_pos", "epochs", "f1", "accuracy")
