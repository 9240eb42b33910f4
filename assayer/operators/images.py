"""Decoded images to fixed-size RGB, colour ratios and pixel vectors, in Arrow batches.

One image stays one row all the way: pixels are never spread over rows here. Images of
a batch are handled one after the other, since their sizes may differ.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayer.functions.fixed_values import COLOUR_BANDS, IMAGE_SIDE

IMAGE_COLUMNS = ["height", "width", "channels", "data"]
OUTPUT_BYTES = 16 * 1024 * 1024  # pixels or vectors that a task hands on at once


def slices(batches: Iterator[pd.DataFrame], row_bytes: int) -> Iterator[pd.DataFrame]:
    """The rows of the batches in pieces whose output, at ``row_bytes`` a row, keeps to ``OUTPUT_BYTES``."""
    rows = max(1, OUTPUT_BYTES // row_bytes)
    for batch in batches:
        for start in range(0, len(batch), rows):
            yield batch.iloc[start : start + rows]


def as_rgb(data: bytes, height: int, width: int, channels: int) -> np.ndarray:
    """Bytes in blue-green-red order to (height, width, 3); grey is repeated, alpha dropped."""
    pixels = np.frombuffer(data, dtype=np.uint8).reshape(height, width, channels)
    return np.repeat(pixels, 3, axis=2) if channels == 1 else pixels[:, :, 2::-1]


def sample_positions(size: int, wanted: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Neighbours and weight of each output position, pixel centres aligned, edges held."""
    at = np.clip((np.arange(wanted) + 0.5) * size / wanted - 0.5, 0, size - 1)
    low = np.floor(at).astype(int)
    return low, np.minimum(low + 1, size - 1), at - low


def resize(rgb: np.ndarray, side: int) -> np.ndarray:
    """Bilinear resize to ``side`` x ``side``, rounded half up."""
    y0, y1, fy = sample_positions(rgb.shape[0], side)
    x0, x1, fx = sample_positions(rgb.shape[1], side)
    rows = rgb.astype(np.float64)
    rows = rows[y0] * (1 - fy)[:, None, None] + rows[y1] * fy[:, None, None]
    out = rows[:, x0] * (1 - fx)[None, :, None] + rows[:, x1] * fx[None, :, None]
    return np.floor(np.round(out, 9) + 0.5).astype(np.uint8)


def band_ratios(rgb: np.ndarray) -> list[float]:
    """Share of pixels in each colour band, bands in their fixed order."""
    r, g, b = (rgb[:, :, i].astype(np.float64) for i in range(3))
    high, spread = rgb.max(axis=2).astype(np.float64), np.ptp(rgb, axis=2).astype(np.float64)
    safe = np.where(spread == 0, 1, spread)
    turn = np.select(
        [spread == 0, high == r, high == g],
        [0, (g - b) / safe, (b - r) / safe + 2],
        (r - g) / safe + 4,
    )
    hue = np.floor(np.where(turn < 0, turn + 6, turn) * 30 + 0.5) % 180
    saturation = np.floor(255 * spread / np.where(high == 0, 1, high) + 0.5)
    ratios = []
    for bounds in COLOUR_BANDS.values():
        inside = [(c >= lo) & (c <= hi) for c, (lo, hi) in zip((hue, saturation, high), bounds)]
        ratios.append(float(np.logical_and.reduce(inside).mean()))
    return ratios


def resize_images(images: DataFrame, carry: Sequence[str], side: int = IMAGE_SIDE) -> DataFrame:
    """``carry`` columns and ``rgb``: side x side x 3 bytes in row, column, channel order."""
    kept = images.select(*carry, *IMAGE_COLUMNS)
    schema = T.StructType([kept.schema[c] for c in carry] + [T.StructField("rgb", T.BinaryType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in slices(batches, side * side * 3):
            cells = zip(batch["data"], batch["height"], batch["width"], batch["channels"])
            rgb = [resize(as_rgb(*cell), side).tobytes() for cell in cells]
            yield batch[list(carry)].assign(rgb=rgb)

    return kept.mapInPandas(run, schema)


def image_features(
    resized: DataFrame, carry: Sequence[str], side: int = IMAGE_SIDE, vectors: bool = True
) -> DataFrame:
    """Colour ratios and, if asked for, the flattened vector in [0, 1], in one pass."""
    kept = resized.select(*carry, "rgb")
    ratio_names = [f"{name}_ratio" for name in COLOUR_BANDS]
    fields = [kept.schema[c] for c in carry]
    fields += [T.StructField(name, T.DoubleType()) for name in ratio_names]
    if vectors:
        fields.append(T.StructField("features", T.ArrayType(T.FloatType())))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in slices(batches, side * side * 3 * 4):
            pixels = [np.frombuffer(b, dtype=np.uint8).reshape(side, side, 3) for b in batch["rgb"]]
            ratios = pd.DataFrame([band_ratios(p) for p in pixels], columns=ratio_names, index=batch.index)
            out = pd.concat([batch[list(carry)], ratios], axis=1)
            if vectors:
                out["features"] = [p.reshape(-1).astype(np.float32) / 255.0 for p in pixels]
            yield out

    return kept.mapInPandas(run, T.StructType(fields))


def pixel_rows(resized: DataFrame, carry: Sequence[str], side: int = IMAGE_SIDE) -> DataFrame:
    """Pixel rows ``(x, y, r, g, b)`` of resized images; for inspection, not for scale."""
    kept = resized.where(F.col("rgb").isNotNull()).select(*carry, "rgb")
    names, cells = ["x", "y", "r", "g", "b"], side * side
    schema = T.StructType([kept.schema[c] for c in carry] + [T.StructField(n, T.IntegerType()) for n in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = max(1, OUTPUT_BYTES // (cells * 4 * len(schema)))
        for batch in batches:
            for part in (batch.slice(i, rows) for i in range(0, batch.num_rows, rows)):
                data = np.frombuffer(b"".join(part.column(len(carry)).to_pylist()), np.uint8).reshape(-1, 3)
                pos = np.tile(np.arange(cells, dtype=np.int32), part.num_rows)
                owner = pa.array(np.repeat(np.arange(part.num_rows), cells))
                columns = [part.column(i).take(owner) for i in range(len(carry))]
                columns += [pa.array(v.astype(np.int32)) for v in (pos % side, pos // side, *data.T)]
                yield pa.RecordBatch.from_arrays(columns, [*carry, *names])

    return kept.mapInArrow(run, schema)
