"""Grid search over folds: all folds and points run together on one kept table.

A fold is a mask on that table, so no fold is copied. Points whose models are prefixes of one another share a fit: the
first ten rounds of a boosted model of fifty are the model of ten. Each fit writes the scores of its held-out rows;
one aggregation over all of them yields the exact areas of all points and folds.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from itertools import product
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Model
from pyspark.ml.classification import Classifier, GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from assayer.functions.fixed_values import FOLDS, SEED
from assayer.functions.ordering import shuffle_key
from assayer.operators import metrics
from assayer.session import discard, new_folder

PARALLELISM = 8
PREFIXES = {GBTClassifier: "maxIter"}  # the parameter whose smaller values are prefixes of larger ones
SCORED = "point int, label int, score double, fold int"


@dataclass
class Tuned:
    """Grid points in order, their mean areas, and the first best one fitted on all rows."""

    points: list[dict]
    areas: list[float | None]
    model: Model

    @property
    def best(self) -> dict:
        return self.points[first_best(self.areas)]


def first_best(areas: Sequence[float | None]) -> int:
    """The first point with the highest area, compared at 12 digits; a point without an area counts as least."""
    return max(range(len(areas)), key=lambda i: (-1.0 if areas[i] is None else round(areas[i], 12), -i))


def grid_points(grid: dict[str, Sequence]) -> list[dict]:
    """Every choice of values, the last parameter changing fastest."""
    return [dict(zip(grid, values)) for values in product(*grid.values())]


def families(points: list[dict], prefix: str | None) -> list[tuple[dict, list[tuple[int, int]]]]:
    """Parameters to fit with, and the points that the fit answers as ``(position, value of prefix)``."""
    if prefix is None or prefix not in points[0]:
        return [(point, [(i, 0)]) for i, point in enumerate(points)]
    shared: dict[tuple, list[tuple[int, int]]] = {}
    for i, point in enumerate(points):
        rest = tuple((name, value) for name, value in point.items() if name != prefix)
        shared.setdefault(rest, []).append((i, point[prefix]))
    return [({**dict(rest), prefix: max(v for _, v in members)}, members) for rest, members in shared.items()]


def with_params(estimator: Classifier, params: dict) -> Classifier:
    return estimator.copy({estimator.getParam(name): value for name, value in params.items()})


def prefix_scores(model: GBTClassificationModel, rows: DataFrame, label: str, members: list[tuple[int, int]]) -> DataFrame:
    """``(point, label, score)`` of the first ``value`` rounds, for each ``(point, value)``, in one pass over the rows."""
    weights, out = model.treeWeights, rows.select(label, model.getFeaturesCol())
    for i, tree in enumerate(model.trees):
        out = tree.setFeaturesCol(model.getFeaturesCol()).setPredictionCol(f"round_{i}").transform(out)

    def margin(rounds: int):
        # a model that stopped early has fewer rounds than asked for
        parts = [F.col(f"round_{i}") * w for i, w in enumerate(weights[:rounds])]
        return sum(parts[1:], parts[0])

    said = [
        F.struct(F.lit(point).alias("point"), F.col(label).cast("int").alias("label"), margin(n).alias("score"))
        for point, n in members
    ]
    return out.select(F.inline(F.array(*said)))


def point_scores(model: Model, rows: DataFrame, label: str, members: list[tuple[int, int]]) -> DataFrame:
    """``(point, label, score)`` of rows under a family's model."""
    if len(members) > 1:
        return prefix_scores(model, rows, label, members)
    return model.transform(rows).select(
        F.lit(members[0][0]).alias("point"),
        F.col(label).cast("int").alias("label"),
        F.get(vector_to_array("rawPrediction"), 1).alias("score"),
    )


def bounded(rows: DataFrame, key: str, most: int, seed: int = SEED) -> DataFrame:
    """At most ``most`` rows, chosen by a hash of ``key`` so that the choice can be repeated."""
    return rows.orderBy(shuffle_key(key, seed), key).limit(most)


def tune(
    train: DataFrame,
    estimator: Classifier,
    grid: dict[str, Sequence],
    label: str,
    fold: str = "fold",
    folds: int = FOLDS,
    parallelism: int = PARALLELISM,
) -> Tuned:
    """Best grid point by mean exact AUC over the folds ``0 .. folds - 1`` in column ``fold``.

    A fold whose held-out rows hold one class has no area and does not count. ``parallelism`` fits run at a time.
    """
    spark = train.sparkSession
    points = grid_points(grid)
    shared = families(points, PREFIXES.get(type(estimator)))
    work = [(number, k, *family) for number, (k, family) in enumerate(product(range(folds), shared))]
    folder = new_folder(spark, "tuning")
    features = estimator.getFeaturesCol()
    rows = train.select(features, label, fold).persist(StorageLevel.MEMORY_AND_DISK)

    def fit(task: tuple[int, int, dict, list[tuple[int, int]]]) -> None:
        number, k, params, members = task
        model = with_params(estimator, params).fit(rows.where(F.col(fold) != k))
        scored = point_scores(model, rows.where(F.col(fold) == k), label, members)
        scored.withColumn("fold", F.lit(k)).write.parquet(f"{folder}/task={number}")

    try:
        rows.count()
        with ThreadPool(min(parallelism, len(work))) as pool:
            pool.map(inheritable_thread_target(spark)(fit), work, chunksize=1)
        scored = spark.read.schema(SCORED).parquet(folder)
        areas = metrics.auc(scored, "label", "score", ["point", "fold"])
        # one row a point
        means = {r["point"]: r["mean"] for r in areas.groupBy("point").agg(F.avg("auc").alias("mean")).collect()}
        listed = [means.get(i) for i in range(len(points))]
        discard(scored)
        model = with_params(estimator, points[first_best(listed)]).fit(rows)
    finally:
        rows.unpersist()
    return Tuned(points, listed, model)


def tuning_table(tuned: Tuned, train: DataFrame) -> DataFrame:
    """Grid points with their mean AUC, in grid order."""
    rows = [
        (i, ", ".join(f"{name}={value}" for name, value in point.items()), area)
        for i, (point, area) in enumerate(zip(tuned.points, tuned.areas))
    ]
    return train.sparkSession.createDataFrame(rows, "grid_pos int, point string, auc double")
