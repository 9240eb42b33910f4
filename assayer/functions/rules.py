"""Rule classifiers as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from assayer.functions.fixed_values import EARLY_BLIGHT, HEALTHY, LATE_BLIGHT


def lexicon_rule(score: Column, indicators: Column, min_score: float, min_indicators: int) -> Column:
    """1 if the score is strictly above its threshold or the count reaches its own."""
    hit = (score > F.lit(float(min_score))) | (indicators >= F.lit(int(min_indicators)))
    return F.when(hit, 1).otherwise(0)


def colour_rule(brown: Column, dark: Column, min_brown: float, min_dark: float) -> Column:
    """Dark leaves first, then brown ones, the rest is healthy."""
    return (
        F.when(dark >= F.lit(float(min_dark)), LATE_BLIGHT)
        .when(brown >= F.lit(float(min_brown)), EARLY_BLIGHT)
        .otherwise(HEALTHY)
    )


def is_correct(label: Column, prediction: Column) -> Column:
    return label.cast("int") == prediction.cast("int")


def steps_passed(value: Column, thresholds: list, inclusive: bool) -> Column:
    """How many of the ascending thresholds ``value`` passes.

    The count says all a threshold sweep needs: threshold ``i`` is passed exactly
    when the count exceeds ``i``. It turns a continuous value into a few cells.
    """
    total = F.lit(0)
    for threshold in sorted(thresholds):
        passed = value >= F.lit(threshold) if inclusive else value > F.lit(threshold)
        total = total + F.when(passed, 1).otherwise(0)
    return total
