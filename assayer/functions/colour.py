"""Colour expressions over integer red, green and blue columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from assayer.functions.fixed_values import COLOUR_BANDS


def hsv(red: Column, green: Column, blue: Column) -> tuple[Column, Column, Column]:
    """Hexcone model with hue halved to 0..179, saturation and value in 0..255."""
    high = F.greatest(red, green, blue)
    low = F.least(red, green, blue)
    spread = (high - low).cast("double")
    safe = F.nullif(spread, F.lit(0.0))
    # Sixty degrees per sextant, halved; ties between channels go red, green, blue.
    turn = (
        F.when(high == red, (green - blue) / safe)
        .when(high == green, (blue - red) / safe + 2.0)
        .otherwise((red - green) / safe + 4.0)
    )
    half_degrees = F.round(F.when(turn < 0, turn + 6.0).otherwise(turn) * 30.0)
    hue = F.coalesce(F.pmod(half_degrees, F.lit(180.0)), F.lit(0.0)).cast("int")
    saturation = F.coalesce(
        F.round(255.0 * spread / F.nullif(high.cast("double"), F.lit(0.0))), F.lit(0.0)
    ).cast("int")
    return hue, saturation, high.cast("int")


def in_band(name: str, hue: Column, saturation: Column, value: Column) -> Column:
    """Inclusive test of all three channels against a named band."""
    (h0, h1), (s0, s1), (v0, v1) = COLOUR_BANDS[name]
    return hue.between(h0, h1) & saturation.between(s0, s1) & value.between(v0, v1)
