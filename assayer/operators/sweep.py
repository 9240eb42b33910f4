"""Threshold grids laid over pre-aggregated cells, and the choice among grid points."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def grid_counts(
    cells: DataFrame, grid: dict[str, Sequence], predict: Callable[[Column, Column], Column]
) -> DataFrame:
    """(grid point, label, prediction) counts of a two-threshold rule.

    ``cells(label, step_0, step_1, n)`` says how many thresholds of either kind a row
    passes; ``predict`` gets the two positions of a grid point. ``grid_pos`` numbers
    the points in the order of two nested loops.
    """
    (name_0, values_0), (name_1, values_1) = grid.items()
    ranks_0 = {v: i for i, v in enumerate(sorted(values_0))}
    ranks_1 = {v: i for i, v in enumerate(sorted(values_1))}
    points = F.array(
        *[
            F.struct(
                F.lit(i * len(values_1) + j).alias("grid_pos"),
                F.lit(a).alias(name_0),
                F.lit(b).alias(name_1),
                F.lit(ranks_0[a]).alias("rank_0"),
                F.lit(ranks_1[b]).alias("rank_1"),
            )
            for i, a in enumerate(values_0)
            for j, b in enumerate(values_1)
        ]
    )
    return (
        cells.select("*", F.inline(points))
        .withColumn("prediction", predict(F.col("rank_0"), F.col("rank_1")))
        .groupBy("grid_pos", name_0, name_1, "label", "prediction")
        .agg(F.sum("n").alias("n"))
    )


def top_points(scores: DataFrame, metric: str = "f1", k: int = 10, digits: int = 4) -> DataFrame:
    """The ``k`` best grid points by the rounded metric; ties in grid order."""
    return scores.orderBy(F.desc(F.round(metric, digits)), "grid_pos").limit(k)


def best_point(scores: DataFrame, metric: str = "f1") -> DataFrame:
    """The first grid point with the highest metric.

    Compared at 12 digits: the order in which a mean is summed must not break ties.
    """
    return scores.orderBy(F.desc(F.round(metric, 12)), "grid_pos").limit(1)
