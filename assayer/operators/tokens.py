"""Token arrays, and dictionary stems and lemmas applied to them."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayer.functions.text import words
from assayer.operators.lookup import BROADCAST_BYTES, fits_broadcast, join_terms
from assayer.session import settle


TERMS_AT_ONCE = 200_000  # terms of a batch that are worked on in one piece


def pieces(batch: pa.RecordBatch, at: int) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in pieces whose arrays in column ``at`` hold ``TERMS_AT_ONCE`` values at most, or one row's."""
    ends = np.cumsum(batch.column(at).value_lengths().fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64)
    start = 0
    while start < len(ends):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + TERMS_AT_ONCE, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def with_tokens(df: DataFrame, text: str, stop_words: Sequence[str], out: str = "tokens") -> DataFrame:
    """Add the cleaned tokens of a text column."""
    return df.withColumn(out, words(F.col(text), stop_words))


def term_totals(df: DataFrame, tokens: str) -> DataFrame:
    """Every distinct term with its number of occurrences."""
    terms = df.select(F.explode_outer(tokens).alias("term")).where(F.col("term").isNotNull())
    return terms.groupBy("term").agg(F.count("*").alias("n"))


def replace_terms(
    df: DataFrame,
    key: str,
    tokens: str,
    dictionary: DataFrame,
    carry: Sequence[str] = (),
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """Replace each token by its root in ``dictionary(term, root, n)``, order kept.

    Terms without an entry stay as they are. ``n`` is how often the tokens hold the
    term and ``carry`` names short columns that go along. A null array stays null, and
    rows that share a key stay apart. A
    dictionary measured to fit goes to the tasks and rows stay where they are; with a
    larger one, token rows are joined to it and regrouped a document at a time.
    """
    if fits_broadcast(dictionary, "term", limit):
        return swap_in_place(df.select(key, *carry, tokens), tokens, dictionary)
    numbered = df.withColumn("row number", F.monotonically_increasing_id()).withColumn("no array", F.isnull(tokens))
    own = ["row number", "no array", key, *carry]
    spread = numbered.select(*own, F.posexplode_outer(tokens).alias("pos", "term"))
    root = F.coalesce(F.col("root"), F.col("term"))
    # A null position marks a document without tokens: its one row must come back empty.
    cell = F.when(F.col("pos").isNotNull(), F.struct("pos", root.alias("term")))
    return (
        join_terms(spread, dictionary, "term", "n", key, "left", limit)
        .groupBy(*own)
        .agg(F.array_sort(F.collect_list(cell)).alias("cells"))
        .select(key, *carry, F.when(~F.col("no array"), F.col("cells.term")).alias(tokens))
    )


def swap_in_place(df: DataFrame, tokens: str, dictionary: DataFrame) -> DataFrame:
    """Swap tokens inside Arrow batches; the dictionary is asked once per distinct term."""
    shared = df.sparkSession.sparkContext.broadcast(
        dict(dictionary.select("term", "root").toPandas().itertuples(index=False, name=None))
    )
    at = df.columns.index(tokens)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roots = shared.value
        for batch in (piece for whole in batches for piece in pieces(whole, at)):
            lists = batch.column(at)
            encoded = lists.flatten().dictionary_encode()
            terms = encoded.dictionary
            swapped = pa.array([roots.get(t, t) for t in terms.to_pylist()], terms.type)
            ends = np.cumsum(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
            offsets = pa.array(np.concatenate(([0], ends)), pa.int32())
            column = pa.ListArray.from_arrays(
                offsets, swapped.take(encoded.indices), type=lists.type, mask=lists.is_null()
            )
            yield batch.set_column(at, batch.schema.field(at), column)

    return df.mapInArrow(run, df.schema)


def dictionary_for(
    df: DataFrame, tokens: str, roots: DataFrame, limit: int = BROADCAST_BYTES
) -> DataFrame:
    """``(term, root, n)`` from a supplied ``(term, root)`` table, for :func:`replace_terms`.

    A term that is its own root is left out: the lookup falls back to the term. Only a
    table too large to broadcast is cut down to the terms in use and given their counts.
    """
    known = roots.where(F.col("term") != F.col("root")).groupBy("term").agg(F.min("root").alias("root"))
    table = settle(known.withColumn("n", F.lit(1).cast("bigint")), "dictionary")
    if fits_broadcast(table, "term", limit):
        return table
    used = term_totals(df, tokens)
    return settle(used.join(table.drop("n"), "term").select("term", "root", "n"), "dictionary-used")
