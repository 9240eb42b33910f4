"""Image folders: class from the parent folder, broken files reported apart."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCANNED_TOGETHER = 8
LEAST_DEALT = 4  # tasks a core that are kept where there are as many


def scan_images(spark: SparkSession, root: str, glob: str = "*.[jJ][pP][gG]") -> DataFrame:
    """``(path, class, height, width, channels, data)`` of ``root/<class>/<file>``.

    Spark's image source decodes in the JVM; ``data`` holds rows of blue-green-red
    bytes. A file that does not decode keeps its path and has height -1. Spark's scan
    reads some 32 small files in a partition; ``SCANNED_TOGETHER`` of these are one task's
    where there are many, as a task costs more than such files do.
    """
    files = (
        spark.read.format("image")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", True)
        .load(root)
    )
    parts, least = files.rdd.getNumPartitions(), spark.sparkContext.defaultParallelism * LEAST_DEALT
    files = files.coalesce(max(1, min(parts, least), parts // SCANNED_TOGETHER))
    return files.select(
        F.col("image.origin").alias("path"),
        F.element_at(F.split("image.origin", "/"), -2).alias("class"),
        F.col("image.height").alias("height"),
        F.col("image.width").alias("width"),
        F.col("image.nChannels").alias("channels"),
        F.col("image.data").alias("data"),
    )


def readable(images: DataFrame) -> DataFrame:
    return images.where(F.col("height") > 0)


def unreadable(images: DataFrame) -> DataFrame:
    """Paths and classes of files that are no images."""
    return images.where(F.col("height") <= 0).select("path", "class")
