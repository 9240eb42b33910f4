"""Colour-band ratios per image, the colour rule and its threshold sweep."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayer.functions.colour import hsv, in_band
from assayer.functions.fixed_values import (
    COLOUR_BANDS,
    COLOUR_THRESHOLDS,
    EARLY_BLIGHT,
    HEALTHY,
    LATE_BLIGHT,
)
from assayer.functions.rules import colour_rule, is_correct, steps_passed
from assayer.operators.sweep import grid_counts


def with_hsv(pixels: DataFrame) -> DataFrame:
    """Add ``h``, ``s`` and ``v`` to pixel rows with ``r``, ``g`` and ``b``."""
    hue, saturation, value = hsv(F.col("r"), F.col("g"), F.col("b"))
    return pixels.withColumns({"h": hue, "s": saturation, "v": value})


def colour_ratios(pixels: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Share of an image's pixels in each band, from pixel rows."""
    share = {
        name: F.avg(in_band(name, F.col("h"), F.col("s"), F.col("v")).cast("int"))
        for name in COLOUR_BANDS
    }
    return with_hsv(pixels).groupBy(*keys).agg(*[c.alias(f"{name}_ratio") for name, c in share.items()])


def with_colour_rule(
    ratios: DataFrame, min_brown: float, min_dark: float, label: str | None = None
) -> DataFrame:
    """Add the rule's class and, given a label, whether it is right."""
    out = ratios.withColumn(
        "prediction", colour_rule(F.col("brown_ratio"), F.col("dark_ratio"), min_brown, min_dark)
    )
    return out if label is None else out.withColumn("correct", is_correct(F.col(label), F.col("prediction")))


def sweep_colours(
    ratios: DataFrame,
    label: str,
    brown_thresholds: Sequence[float] = COLOUR_THRESHOLDS,
    dark_thresholds: Sequence[float] = COLOUR_THRESHOLDS,
) -> DataFrame:
    """Confusion counts of every pair of thresholds, from one pass over the images."""
    cells = ratios.groupBy(
        F.col(label).cast("int").alias("label"),
        steps_passed(F.col("brown_ratio"), list(brown_thresholds), True).alias("step_0"),
        steps_passed(F.col("dark_ratio"), list(dark_thresholds), True).alias("step_1"),
    ).agg(F.count("*").alias("n"))

    def predict(brown, dark):
        return (
            F.when(F.col("step_1") > dark, LATE_BLIGHT)
            .when(F.col("step_0") > brown, EARLY_BLIGHT)
            .otherwise(HEALTHY)
        )

    return grid_counts(
        cells,
        {"min_brown": [float(t) for t in brown_thresholds], "min_dark": [float(t) for t in dark_thresholds]},
        predict,
    )
