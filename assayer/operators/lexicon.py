"""Lexicon features, the lexicon rule and its threshold sweep."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assayer.functions.fixed_values import (
    INDICATOR_TERMS,
    INDICATOR_THRESHOLDS,
    SENTIMENT_THRESHOLDS,
)
from assayer.functions.rules import is_correct, lexicon_rule, steps_passed
from assayer.operators.lookup import BROADCAST_BYTES, fits_broadcast, join_terms
from assayer.operators.sweep import grid_counts
from assayer.operators.tokens import term_totals
from assayer.session import settle

KINDS = ("positive", "negative", "indicator")
INLINE_TERMS = 1_000


def indicator_lexicon(spark: SparkSession) -> DataFrame:
    """The built-in indicator terms as a lexicon table."""
    return spark.createDataFrame([(t, "indicator") for t in INDICATOR_TERMS], "term string, kind string")


def lexicon_sizes(lexicon: DataFrame) -> DataFrame:
    return lexicon.groupBy("kind").agg(F.count_distinct("term").alias("terms"))


def with_score(df: DataFrame) -> DataFrame:
    """Score from counts; a document without tokens scores 0."""
    balance = (F.col("positive") - F.col("negative")).cast("double")
    score = F.coalesce(balance / F.nullif(F.col("n_tokens").cast("double"), F.lit(0.0)), F.lit(0.0))
    return df.withColumn("score", score)


def lexicon_features(
    df: DataFrame,
    key: str,
    tokens: str,
    lexicon: DataFrame,
    carry: Sequence[str] = (),
    inline_terms: int = INLINE_TERMS,
) -> DataFrame:
    """Token, positive, negative and indicator counts and the score, repeats counted.

    ``lexicon(term, kind)`` may list a term under several kinds. Up to
    ``inline_terms`` entries become hash sets inside the expression, so rows are
    neither joined nor shuffled; a larger lexicon is joined to the token rows. Both give the same:
    a null array counts as empty, null tokens do not count, rows that share a key stay apart.
    """
    entries = lexicon.where(F.col("kind").isin(*KINDS)).distinct().limit(inline_terms + 1).collect()
    if len(entries) <= inline_terms:
        listed = {kind: [e["term"] for e in entries if e["kind"] == kind] for kind in KINDS}

        held = F.coalesce(F.col(tokens), F.array().cast("array<string>"))

        def hits(kind: str):
            if not listed[kind]:
                return F.lit(0)
            return F.size(F.filter(held, lambda t: t.isin(listed[kind])))

        counted = df.select(
            key,
            *carry,
            F.size(F.filter(held, lambda t: t.isNotNull())).cast("bigint").alias("n_tokens"),
            *[hits(kind).cast("bigint").alias(kind) for kind in KINDS],
        )
    else:
        counted = joined_features(df, key, tokens, lexicon, carry)
    return with_score(counted)


def joined_features(
    df: DataFrame,
    key: str,
    tokens: str,
    lexicon: DataFrame,
    carry: Sequence[str] = (),
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """The counts by joining token rows with the lexicon, one row per term."""
    numbered = df.withColumn("row number", F.monotonically_increasing_id())
    spread = numbered.select("row number", key, *carry, F.explode_outer(tokens).alias("term"))
    marks = lexicon.groupBy("term").agg(
        *[F.max(F.when(F.col("kind") == kind, 1).otherwise(0)).alias(kind) for kind in KINDS]
    )
    table = settle(marks, "lexicon")
    if fits_broadcast(table, "term", limit):
        found = spread.join(F.broadcast(table), "term", "left")
    else:
        used = settle(table.join(term_totals(df, tokens), "term"), "lexicon-used")
        found = join_terms(spread, used, "term", "n", key, "left", limit)
    return (
        found
        .groupBy("row number", key, *carry)
        .agg(
            F.count("term").alias("n_tokens"),
            *[F.coalesce(F.sum(kind), F.lit(0)).cast("bigint").alias(kind) for kind in KINDS],
        )
        .drop("row number")
    )


def with_lexicon_rule(
    features: DataFrame, min_score: float, min_indicators: int, label: str | None = None
) -> DataFrame:
    """Add the rule's prediction and, given a label, whether it is right."""
    out = features.withColumn(
        "prediction", lexicon_rule(F.col("score"), F.col("indicator"), min_score, min_indicators)
    )
    return out if label is None else out.withColumn("correct", is_correct(F.col(label), F.col("prediction")))


def sweep_lexicon(
    features: DataFrame,
    label: str,
    score_thresholds: Sequence[float] = SENTIMENT_THRESHOLDS,
    indicator_thresholds: Sequence[int] = INDICATOR_THRESHOLDS,
) -> DataFrame:
    """Confusion counts of every grid point, from one pass over the rows.

    Rows collapse to (score step, indicator step, label) cells, at most one per grid
    cell and class, before the grid is laid over them.
    """
    cells = features.groupBy(
        F.col(label).cast("int").alias("label"),
        steps_passed(F.col("score"), list(score_thresholds), False).alias("step_0"),
        steps_passed(F.col("indicator"), list(indicator_thresholds), True).alias("step_1"),
    ).agg(F.count("*").alias("n"))

    def predict(point_0, point_1):
        passed = (F.col("step_0") > point_0) | (F.col("step_1") > point_1)
        return F.when(passed, 1).otherwise(0)

    return grid_counts(
        cells,
        {"min_score": [float(t) for t in score_thresholds], "min_indicators": list(indicator_thresholds)},
        predict,
    )
