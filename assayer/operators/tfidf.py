"""TF-IDF on long tables of (document, term, weight).

Arrays are unrolled with ``explode_outer`` and nulls dropped afterwards: for a plain
``explode`` the optimizer adds a test of the array's size below the shuffle, and with
it a second evaluation of the expression that builds the array.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayer.functions.fixed_values import MAX_DOCUMENT_SHARE, MIN_DOCUMENTS, TOP_TERMS
from assayer.functions.text import smooth_idf, sublinear
from assayer.operators.lookup import BROADCAST_BYTES, fits_broadcast, join_terms
from assayer.operators.tokens import pieces
from assayer.session import settle


def fit_vocabulary(
    train: DataFrame,
    terms: str,
    min_documents: int = MIN_DOCUMENTS,
    max_share: float = MAX_DOCUMENT_SHARE,
) -> DataFrame:
    """``(term, df, idf)`` of the training documents, both bounds inclusive.

    A document's terms are made distinct inside its row, so the only shuffle is that
    of partly summed document counts by term.
    """
    documents = train.agg(F.count("*").alias("documents")).scalar()
    counted = (
        train.select(F.explode_outer(F.array_distinct(terms)).alias("term"))
        .where(F.col("term").isNotNull())
        .groupBy("term")
        .agg(F.count("*").alias("df"))
    )
    kept = counted.where(
        (F.col("df") >= min_documents) & (F.col("df") <= F.lit(float(max_share)) * documents)
    )
    return settle(kept.withColumn("idf", smooth_idf(documents, F.col("df"))), "vocabulary")


def counted_terms(df: DataFrame, key: str, terms: str) -> DataFrame:
    """``(key, term, tf)`` of documents that are one row each, counted within Arrow batches and not shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, 1):
                lists = part.column(1)
                lengths = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
                encoded = lists.flatten().dictionary_encode()
                there = encoded.is_valid().to_numpy(zero_copy_only=False)
                codes = encoded.indices.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
                row, size = np.repeat(np.arange(part.num_rows), lengths), max(1, len(encoded.dictionary))
                cell, tf = np.unique((row * size + codes)[there], return_counts=True)
                columns = [part.column(0).take(pa.array(cell // size)), encoded.dictionary.take(pa.array(cell % size))]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(tf, pa.int32())], [key, "term", "tf"])

    schema = T.StructType([df.schema[key], T.StructField("term", T.StringType()), T.StructField("tf", T.IntegerType())])
    return df.select(key, terms).mapInArrow(run, schema)


def tfidf(
    df: DataFrame, key: str, terms: str, vocabulary: DataFrame, limit: int = BROADCAST_BYTES
) -> DataFrame:
    """``(key, term, weight)``: sublinear counts times idf, unit length per document.

    Terms outside the vocabulary drop out; a document without known terms has no rows.
    With a vocabulary that fits a broadcast, documents are shuffled by key once, while
    still one row each, and counting and scaling follow without another shuffle. With a larger one terms are counted
    where their documents are, and only these counts are shuffled to the vocabulary and back.
    """
    if fits_broadcast(vocabulary, "term", limit):
        known = (
            df.select(key, terms)
            .repartition(key)
            .select(key, F.explode_outer(terms).alias("term"))
            .join(F.broadcast(vocabulary.select("term", "idf")), "term")
        )
        counted = known.groupBy(key, "term").agg(F.count("*").alias("tf"), F.first("idf").alias("idf"))
    else:
        pairs = counted_terms(df, key, terms)
        counted = join_terms(pairs, vocabulary.select("term", "df", "idf"), "term", "df", key, limit=limit)
    raw = counted.select(key, "term", (sublinear(F.col("tf")) * F.col("idf")).alias("raw"))
    length = F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(W.partitionBy(key)))
    return raw.select(key, "term", (F.col("raw") / length).alias("weight"))


def top_terms(weights: DataFrame, key: str, k: int = TOP_TERMS) -> DataFrame:
    """The ``k`` heaviest terms per document, ties in alphabetical order."""
    ranked = W.partitionBy(key).orderBy(F.desc(F.round("weight", 9)), "term")
    return weights.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)


def top_term_lists(weights: DataFrame, key: str, k: int = TOP_TERMS) -> DataFrame:
    """One row per document with its heaviest terms, heaviest first."""
    cell = F.struct("rank", "term")
    return (
        top_terms(weights, key, k)
        .groupBy(key)
        .agg(F.array_sort(F.collect_list(cell)).alias("cells"))
        .select(key, F.col("cells.term").alias("top_terms"))
    )
