"""Hash, stratified and k-fold splits, and a seeded random row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from assayer.functions.fixed_values import FOLDS, SEED, STRATIFIED_PERCENTS, TRAIN_PERCENT
from assayer.functions.ordering import hash_slot, shuffle_key
from assayer.session import settle

BUCKET_DIGITS = 4  # 65,536 buckets of the shuffle key per class


def hash_split(
    df: DataFrame, key: str, train_percent: int = TRAIN_PERCENT, seed: int = SEED
) -> DataFrame:
    """Train/test by hash of the key: repeatable on any partitioning, no shuffle."""
    side = F.when(hash_slot(key, seed, 100) < train_percent, "train").otherwise("test")
    return df.withColumn("split", side)


def random_split(
    df: DataFrame, train_percent: int = TRAIN_PERCENT, seed: int = SEED
) -> tuple[DataFrame, DataFrame]:
    """Spark's Bernoulli split; which rows land where depends on the partitioning."""
    train, test = df.randomSplit([train_percent / 100, 1 - train_percent / 100], seed=seed)
    return train, test


def with_folds(df: DataFrame, key: str, folds: int = FOLDS, seed: int = SEED) -> DataFrame:
    """Fold number ``0 .. folds-1`` per row, for ``CrossValidator(foldCol=...)``."""
    return df.withColumn("fold", hash_slot(key, f"fold{seed}", folds))


def random_row(df: DataFrame, key: str, seed: int = SEED) -> DataFrame:
    """One random row, the same one for the same seed."""
    return df.orderBy(shuffle_key(key, seed), F.col(key)).limit(1)


def stratified_cuts(
    df: DataFrame,
    key: str,
    label: str,
    percents: Sequence[tuple[str, int]] = STRATIFIED_PERCENTS,
    seed: int = SEED,
) -> DataFrame:
    """Per class the last (shuffle key, key) that still belongs to each split.

    Rows are counted per (class, bucket of the shuffle key). The running count over
    those buckets names the one bucket each cut falls into, and only rows of these
    buckets are looked at one by one. So no class is ever sorted as a whole.
    """
    rows = df.select(F.col(label), F.col(key), shuffle_key(key, seed).alias("h")).withColumn(
        "bucket", F.substring("h", 1, BUCKET_DIGITS)
    )
    buckets = settle(
        rows.groupBy(label, "bucket").agg(F.count("*").alias("n")), "split-buckets"
    )
    so_far = W.partitionBy(label).orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    sizes = buckets.groupBy(label).agg(F.sum("n").alias("class_n"))
    bounds = [sum(p for _, p in percents[: i + 1]) for i in range(len(percents) - 1)]
    targets = F.array(
        *[
            F.struct(F.lit(i).alias("cut"), F.expr(f"class_n * {b} div 100").alias("target"))
            for i, b in enumerate(bounds)
        ]
    )
    # The bucket in which each target lies: before < target <= before + n.
    holding = (
        buckets.withColumn("before", F.coalesce(F.sum("n").over(so_far), F.lit(0)))
        .join(sizes, label)
        .select(label, "bucket", "n", "before", F.inline(targets))
        .where((F.col("before") < F.col("target")) & (F.col("target") <= F.col("before") + F.col("n")))
    )
    holding = settle(holding, "split-holding")
    # Equal keys count together, so a repeated key is never torn apart.
    in_bucket = W.partitionBy(label, "bucket", "cut").orderBy("h", key)
    inside = (
        rows.join(holding, [label, "bucket"])
        .groupBy(label, "bucket", "cut", "before", "target", "h", key)
        .agg(F.count("*").alias("same"))
        .withColumn("reached", F.col("before") + F.sum("same").over(in_bucket))
        .where(F.col("reached") <= F.col("target"))
        .groupBy(label, "cut")
        .agg(F.max(F.struct("h", F.col(key).alias("key"))).alias("last"))
    )
    # Without a fitting row, everything before the bucket belongs below the cut.
    last = F.coalesce(
        F.col("last"),
        F.struct(F.col("bucket").alias("h"), F.lit(None).cast(df.schema[key].dataType).alias("key")),
    )
    per_cut = holding.join(inside, [label, "cut"], "left").select(label, "cut", last.alias("last"))
    return settle(
        per_cut.groupBy(label).agg(
            *[F.max(F.when(F.col("cut") == i, F.col("last"))).alias(f"cut{i}") for i in range(len(bounds))]
        ),
        "split-cuts",
    )


def stratified_split(
    df: DataFrame,
    key: str,
    label: str,
    percents: Sequence[tuple[str, int]] = STRATIFIED_PERCENTS,
    seed: int = SEED,
) -> DataFrame:
    """Exact split sizes with class shares kept.

    Within a class of ``n`` rows in shuffle order, the first ``n * p div 100`` rows go
    to the first split, and so on by cumulative percentage. Rows are placed by
    comparing their shuffle key with the class's cuts, so the table itself is
    joined to one row per class and never shuffled. A row without label is in no split: its
    ``split`` is null.
    """
    cuts = stratified_cuts(df, key, label, percents, seed)
    # A projection of its own, so that a row's digest is computed once for all cuts.
    here = F.struct(shuffle_key(key, seed).alias("h"), F.col(key).alias("key"))
    side = None
    for i, (name, _) in enumerate(percents[:-1]):
        below = F.col("here") <= F.col(f"cut{i}")
        side = F.when(below, name) if side is None else side.when(below, name)
    placed = (
        df.withColumn("here", here)
        .join(cuts, label, "left")
        .withColumn("split", F.when(F.col(label).isNotNull(), side.otherwise(percents[-1][0])))
    )
    return placed.select(*df.columns, "split")
