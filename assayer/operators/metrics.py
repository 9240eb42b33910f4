"""Classification metrics, all from one small table of (label, prediction) counts.

Every function takes ``by``: with grouping columns the metrics come out per group,
which is how a threshold sweep scores all its grid points at once.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from assayer.session import settle


def ratio(part: Column, whole: Column) -> Column:
    """Division in which nothing over nothing is 0."""
    return F.coalesce(part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0)), F.lit(0.0))


def confusion(df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    """Rows per (label, prediction), both as integers."""
    return df.groupBy(
        *by, F.col(label).cast("int").alias("label"), F.col(prediction).cast("int").alias("prediction")
    ).agg(F.count("*").alias("n"))


def confusion_matrix(counts: DataFrame, classes: Sequence[int]) -> DataFrame:
    """Rows are true classes, columns ``pred_<class>``; absent cells are 0."""
    cells = [
        F.sum(F.when(F.col("prediction") == c, F.col("n")).otherwise(0)).alias(f"pred_{c}")
        for c in classes
    ]
    return counts.groupBy("label").agg(*cells)


def class_scores(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Precision, recall, F1 and support of every class seen as label or prediction."""
    hit = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)
    zero = F.lit(0).cast("bigint")
    views = F.array(
        F.struct(
            F.col("label").alias("class"), hit.alias("tp"), F.col("n").alias("support"), zero.alias("predicted")
        ),
        F.struct(
            F.col("prediction").alias("class"), zero.alias("tp"), zero.alias("support"), F.col("n").alias("predicted")
        ),
    )
    sums = (
        counts.select(*by, F.inline(views))
        .groupBy(*by, "class")
        .agg(*[F.sum(c).alias(c) for c in ("tp", "support", "predicted")])
    )
    return sums.select(
        *by,
        "class",
        ratio(F.col("tp"), F.col("predicted")).alias("precision"),
        ratio(F.col("tp"), F.col("support")).alias("recall"),
        ratio(2 * F.col("tp"), F.col("predicted") + F.col("support")).alias("f1"),
        "support",
        "tp",
    )


def accuracy(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    right = F.sum(F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0))
    return counts.groupBy(*by).agg(
        ratio(right, F.sum("n")).alias("accuracy"), F.sum("n").alias("n_rows")
    )


def weighted_scores(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Accuracy and support-weighted precision, recall and F1."""
    return class_scores(counts, by).groupBy(*by).agg(
        ratio(F.sum("tp"), F.sum("support")).alias("accuracy"),
        *[
            ratio(F.sum(F.col(m) * F.col("support")), F.sum("support")).alias(m)
            for m in ("precision", "recall", "f1")
        ],
    )


def macro_scores(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Accuracy and the plain mean over classes of precision, recall and F1."""
    return class_scores(counts, by).groupBy(*by).agg(
        ratio(F.sum("tp"), F.sum("support")).alias("accuracy"),
        *[F.avg(m).alias(m) for m in ("precision", "recall", "f1")],
    )


def binary_scores(counts: DataFrame, positive: int = 1, by: Sequence[str] = ()) -> DataFrame:
    """Accuracy and precision, recall and F1 of the positive class."""
    label, prediction, n = F.col("label"), F.col("prediction"), F.col("n")

    def total(condition: Column) -> Column:
        return F.sum(F.when(condition, n).otherwise(0))

    tp = total((label == positive) & (prediction == positive))
    said = total(prediction == positive)
    real = total(label == positive)
    return counts.groupBy(*by).agg(
        ratio(total(label == prediction), F.sum("n")).alias("accuracy"),
        ratio(tp, said).alias("precision"),
        ratio(tp, real).alias("recall"),
        ratio(2 * tp, said + real).alias("f1"),
    )


def class_report(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Per-class rows plus ``accuracy``, ``macro avg`` and ``weighted avg`` rows.

    Each class row counts towards its own line and, with the fitting weight, towards
    the three summary lines, so that one aggregation yields the whole report.
    """
    one = F.lit(1.0)
    hit_rate = ratio(F.col("tp"), F.col("support"))

    def line(name: Column, weight: Column, p: Column, r: Column, f: Column) -> Column:
        return F.struct(
            name.alias("class"), weight.alias("w"), p.alias("p"), r.alias("r"), f.alias("f"), F.col("support").alias("s")
        )

    p, r, f = F.col("precision"), F.col("recall"), F.col("f1")
    support = F.col("support").cast("double")
    lines = F.array(
        line(F.col("class").cast("string"), one, p, r, f),
        line(F.lit("accuracy"), support, hit_rate, hit_rate, hit_rate),
        line(F.lit("macro avg"), one, p, r, f),
        line(F.lit("weighted avg"), support, p, r, f),
    )
    return (
        class_scores(counts, by)
        .select(*by, F.inline(lines))
        .groupBy(*by, "class")
        .agg(
            *[
                ratio(F.sum(F.col(c) * F.col("w")), F.sum("w")).alias(name)
                for c, name in (("p", "precision"), ("r", "recall"), ("f", "f1"))
            ],
            F.sum("s").alias("support"),
        )
    )


def score_counts(
    df: DataFrame, label: str, prediction: str, score: str, by: Sequence[str] = ()
) -> DataFrame:
    """Rows per (score, label, prediction) within ``by``: all that any of the metrics needs, from one aggregation."""
    return df.groupBy(
        *by,
        F.col(score).cast("double").alias("score"),
        F.col(label).cast("int").alias("label"),
        F.col(prediction).cast("int").alias("prediction"),
    ).agg(F.count("*").alias("n"))


def auc(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """Exact area under ROC as a rank sum with ties at half; null with one class only.

    With ``by`` one row per group, all groups at once; a group without a scored and labelled row has none.
    """
    pairs = df.select(*by, F.col(label).alias("label"), F.col(score).alias("score"), F.lit(1).alias("n"))
    return auc_of_counts(pairs, by)


def auc_of_counts(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``auc`` from rows ``(*by, label, score, n)`` that each stand for ``n`` rows.

    Rows collapse to one per distinct score of a group, which a range shuffle cuts into slices
    of rising scores. Totals per slice and group tell each slice how many negatives lie below it,
    so scores are sorted within slices only and no group needs to fit in one. The slice number is stored with the
    points: a range shuffle run twice could cut elsewhere.
    """
    positive = F.when(F.col("label").cast("int") == 1, F.col("n")).otherwise(0)
    points = settle(
        counts.where(F.col("score").isNotNull() & F.col("label").isNotNull())
        .groupBy(*by, F.col("score").cast("double").alias("score"))
        .agg(F.sum(positive).alias("pos"), F.sum(F.col("n") - positive).alias("neg"))
        .repartitionByRange(*by, "score")
        .withColumn("slice", F.spark_partition_id()),
        "auc-points",
    )
    below = W.partitionBy("slice", *by).orderBy("score").rowsBetween(W.unboundedPreceding, -1)
    pos, neg = F.col("pos").cast("double"), F.col("neg").cast("double")
    per_slice = (
        points.withColumn("neg_below", F.coalesce(F.sum(neg).over(below), F.lit(0.0)))
        .groupBy("slice", *by)
        .agg(
            F.sum(pos).alias("pos"),
            F.sum(neg).alias("neg"),
            F.sum(pos * (F.col("neg_below") + neg / 2.0)).alias("within"),
        )
    )
    # One row per slice of a group, at most spark.sql.shuffle.partitions of them, meets this window.
    lower = W.partitionBy(*(by or [F.lit(0)])).orderBy("slice").rowsBetween(W.unboundedPreceding, -1)
    wins = F.sum(F.col("within") + F.col("pos") * F.col("lower"))
    pairs = F.sum("pos") * F.sum("neg")
    return (
        per_slice.withColumn("lower", F.coalesce(F.sum("neg").over(lower), F.lit(0.0)))
        .groupBy(*by)
        .agg((wins / F.nullif(pairs, F.lit(0.0))).alias("auc"))
    )


def stacked(df: DataFrame, label: str, scored: dict[str, tuple[Column, Column]]) -> DataFrame:
    """``(model, label, prediction, score)``: one row per row and model, from one pass over ``df``.

    ``scored`` maps a model's name to its prediction and its score.
    """
    said = [
        F.struct(
            F.lit(name).alias("model"),
            F.col(label).alias("label"),
            prediction.cast("int").alias("prediction"),
            score.cast("double").alias("score"),
        )
        for name, (prediction, score) in scored.items()
    ]
    return df.select(F.inline(F.array(*said)))


def evaluate_models(rows: DataFrame, order: Sequence[str] | None = None) -> DataFrame:
    """Per model accuracy, AUC and weighted F1, precision and recall of ``(model, label, prediction, score)``.

    The rows are read once, into counts that are stored; confusion and AUC of all models come from these.
    ``order`` numbers the models in a column ``position``; a model that is not in it has a null there, one
    without rows has no row.
    """
    counts = settle(score_counts(rows, "label", "prediction", "score", ["model"]), "score-counts")
    cells = counts.groupBy("model", "label", "prediction").agg(F.sum("n").alias("n"))
    areas = auc_of_counts(counts, ["model"])
    table = weighted_scores(cells, ["model"]).join(areas, "model", "left")
    table = table.select("model", "accuracy", "auc", "f1", "precision", "recall")
    if order is None:
        return table
    places = F.create_map(*[F.lit(x) for i, name in enumerate(order) for x in (name, i)])
    return table.withColumn("position", F.element_at(places, F.col("model")))


def evaluate(df: DataFrame, name: str, label: str, prediction: str, score: str) -> DataFrame:
    """One row: accuracy, AUC and weighted F1, precision and recall of scored rows, which are read once.

    No rows give no row.
    """
    return evaluate_models(stacked(df, label, {name: (F.col(prediction), F.col(score))}))


def compare(evaluations: Sequence[DataFrame]) -> DataFrame:
    """Evaluations one below the other, numbered in the order given."""
    numbered = [e.withColumn("position", F.lit(i)) for i, e in enumerate(evaluations)]
    return reduce(DataFrame.unionByName, numbered)


def best_model(comparison: DataFrame) -> DataFrame:
    """The row with the highest AUC; the first on ties."""
    return comparison.orderBy(F.desc_nulls_last("auc"), "position").limit(1)
