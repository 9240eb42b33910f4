"""Seeded, engine-independent row order from md5."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def shuffle_key(key: str | Column, seed: int | str) -> Column:
    """32 hex digits that order rows at random but repeatably: md5 of ``key|seed``."""
    key = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat_ws("|", key.cast("string"), F.lit(str(seed))))


def hash_slot(key: str | Column, seed: int | str, slots: int) -> Column:
    """Stable slot in ``0 .. slots-1`` from the first seven hex digits of the shuffle key."""
    return F.pmod(
        F.conv(F.substring(shuffle_key(key, seed), 1, 7), 16, 10).cast("bigint"),
        F.lit(slots).cast("bigint"),
    ).cast("int")
