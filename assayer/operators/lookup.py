"""Joins of term rows with a table of one row per term."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_BYTES = 64 * 1024 * 1024
HOT_SHARE = 1000  # a term is hot if it makes up a thousandth of all occurrences
SALTS = 64


def fits_broadcast(table: DataFrame, term: str, limit: int = BROADCAST_BYTES) -> bool:
    """Measure a settled table: term bytes plus 64 bytes a row against the limit."""
    size = table.agg(F.coalesce(F.sum(F.octet_length(term) + 64), F.lit(0))).first()[0]
    return size <= limit


def join_terms(
    rows: DataFrame,
    table: DataFrame,
    term: str,
    occurrences: str,
    spread_by: str,
    how: str = "inner",
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """Join ``rows`` with ``table`` on ``term``; ``table`` holds a term once.

    A table measured to fit is broadcast. A larger one is shuffled, with hot terms
    salted: ``occurrences`` counts how often ``rows`` holds a term, so at most
    ``HOT_SHARE`` terms can be hot. That list is broadcast, hot rows spread over
    ``SALTS`` keys by ``spread_by``, and only hot table rows are repeated to match.
    """
    if fits_broadcast(table, term, limit):
        return rows.join(F.broadcast(table), term, how)
    total = table.agg(F.sum(occurrences)).scalar()
    is_hot = F.col(occurrences) * HOT_SHARE >= total
    hot = table.where(is_hot).select(term, F.lit(True).alias("is_hot"))
    spread = F.pmod(F.xxhash64(spread_by), F.lit(SALTS)).cast("int")
    salted_rows = rows.join(F.broadcast(hot), term, "left").withColumn(
        "salt", F.when(F.col("is_hot"), spread).otherwise(0)
    )
    salts = F.when(is_hot, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    salted_table = table.withColumn("salt", F.explode(salts))
    return salted_rows.join(salted_table, [term, "salt"], how).drop("salt", "is_hot")
