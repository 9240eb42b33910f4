"""Dictionaries of stems and noun lemmas, worked out once per distinct term."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayer.functions.stem import before, porter_stem
from assayer.operators.tokens import term_totals
from assayer.session import settle


def stem_dictionary(df: DataFrame, tokens: str, variant: str = "paper") -> DataFrame:
    """``(term, root, n)`` with the stems of all terms in use, by the named variant of the stemmer."""
    stems = term_totals(df, tokens).withColumn("root", porter_stem(F.col("term"), variant))
    return settle(stems.select("term", "root", "n"), "stems")


# Noun endings and what replaces them.
NOUN_ENDINGS = {
    "s": "", "ses": "s", "ves": "f", "xes": "x", "zes": "z", "ches": "ch", "shes": "sh",
    "men": "man", "ies": "y",
}


def noun_dictionary(
    df: DataFrame, tokens: str, nouns: DataFrame, exceptions: DataFrame
) -> DataFrame:
    """``(term, root, n)`` with noun lemmas from a word list.

    ``nouns(term)`` lists known nouns, ``exceptions(term, root)`` the irregular ones.
    A term's candidates are itself, its exceptions, and its endings swapped as above;
    those on the noun list count, and the shortest wins.
    """
    used = term_totals(df, tokens)
    candidates = F.array(
        F.col("term"),
        *[
            F.when(F.col("term").endswith(end), F.concat(before(F.col("term"), end), F.lit(swap)))
            for end, swap in NOUN_ENDINGS.items()
        ],
    )
    regular = used.select("term", "n", F.explode(F.array_compact(candidates)).alias("root"))
    irregular = used.join(exceptions.select("term", "root"), "term").select("term", "n", "root")
    # With an exception on file, only it and the term itself are candidates.
    regular = regular.join(exceptions.select("term"), "term", "left_anti").unionByName(
        used.join(exceptions.select("term").distinct(), "term", "left_semi").withColumn("root", F.col("term"))
    )
    known = regular.unionByName(irregular).join(
        nouns.select(F.col("term").alias("root")).distinct(), "root", "left_semi"
    )
    best = known.groupBy("term", "n").agg(F.min(F.struct(F.length("root").alias("size"), "root")).alias("pick"))
    lemmas = best.select("term", F.col("pick.root").alias("root"), "n")
    return settle(lemmas.where(F.col("term") != F.col("root")), "lemmas")
