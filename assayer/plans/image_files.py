"""Image files written from the given embeddings, so that the file scan has input."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assayer.plans.standins import pixel_arrays
from assayer.session import new_folder

DEALT = 4  # tasks a core that write images


def png(rgb: np.ndarray) -> bytes:
    """A minimal PNG of an (H, W, 3) array: lossless, so pixels survive the round trip."""

    def chunk(kind: bytes, body: bytes) -> bytes:
        return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))

    height, width, _ = rgb.shape
    lines = b"".join(b"\x00" + line.tobytes() for line in rgb)
    head = struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(lines)) + chunk(b"IEND", b"")


def write_images(images: DataFrame, root: str, side: int) -> int:
    """Write ``(image_id, class, cells)`` as ``root/<class>/<image_id>.jpg``; the number written.

    ``cells`` are an image's channel values in (y, x, channel) order. Tasks write straight to the shared folder. Every seventh image gets an upper-case
    ending, and every eleventh a broken neighbour file.
    """
    schema = "image_id bigint"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        target, base = fs.FileSystem.from_uri(root if "://" in root else f"file://{root}")
        there = set()
        for batch in batches:
            for i, name, cells in zip(batch["image_id"], batch["class"], batch["cells"]):
                folder = f"{base}/{name}"
                if name not in there:
                    target.create_dir(folder, recursive=True)
                    there.add(name)
                ending = "JPG" if i % 7 == 0 else "jpg"
                rgb = np.asarray(cells).astype(np.uint8).reshape(side, side, 3)
                with target.open_output_stream(f"{folder}/{i}.{ending}") as out:
                    out.write(png(rgb))
                if i % 11 == 0:
                    with target.open_output_stream(f"{folder}/broken{i}.jpg") as out:
                        out.write(b"not an image")
                    with target.open_output_stream(f"{folder}/note{i}.txt") as out:
                        out.write(b"not scanned")
            yield batch[["image_id"]]

    return images.mapInPandas(run, schema).count()


def leaf_image_folder(spark: SparkSession, folder: str) -> str:
    """A fresh folder with the 8 x 8 leaf images as files. An image is one row all the way, so nothing is shuffled but
    whole rows, dealt out as the table may have fewer partitions than there are cores."""
    rows = pixel_arrays(spark, folder).repartition(spark.sparkContext.defaultParallelism * DEALT, "image_id")
    images = rows.select("image_id", F.concat(F.lit("class_"), F.col("label") % 3).alias("class"), "cells")
    # Without a scheme the path belongs to the default file system, which tasks must be told.
    path = spark._jvm.org.apache.hadoop.fs.Path(new_folder(spark, "leaf-images"))
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    root = files.makeQualified(path).toString().removeprefix("file:")
    write_images(images, root, 8)
    return root
