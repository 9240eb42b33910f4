"""Joins of rows with a table that says how many rows each of its keys has."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT_SHARE = 1000  # keys with at least 1/HOT_SHARE of all rows are hot, so at most HOT_SHARE are


def join_counted(rows: DataFrame, table: DataFrame, keys: list[str], times: str, total: int) -> DataFrame:
    """Inner join; ``table``, settled and with one row per key, counts the key's rows in ``times``.

    Rows of hot keys stay where they are and meet a broadcast of the hot part of the table. The
    others are shuffled, and none of their keys can fill a task.
    """
    hot = table.where(F.col(times) * HOT_SHARE >= total)
    cold = table.where(F.col(times) * HOT_SHARE < total)
    here = rows.join(F.broadcast(hot), keys)
    rest = rows.join(F.broadcast(hot.select(keys)), keys, "left_anti")
    return here.unionByName(rest.join(cold, keys))
