"""Column expressions over text and token arrays. All stay in the JVM."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from assayer.functions.binding import bind


def clean_text(text: Column) -> Column:
    """Lower-case; anything but ``a-z`` and whitespace becomes a space."""
    return F.regexp_replace(F.lower(text), r"[^a-z\s]", " ")


def split_words(text: Column) -> Column:
    """Whitespace split without empty tokens."""
    return F.filter(F.split(text, r"\s+"), lambda t: t != "")


def drop_noise(tokens: Column, stop_words: Sequence[str]) -> Column:
    """Drop stop words and one-letter tokens; repeats stay."""
    stops = list(stop_words)

    def keep(token: Column) -> Column:
        long_enough = F.length(token) > 1
        return long_enough & ~token.isin(stops) if stops else long_enough

    return F.filter(tokens, keep)


def words(text: Column, stop_words: Sequence[str]) -> Column:
    """Cleaned tokens of a raw text."""
    # One filter over the split array: the length test also drops empty tokens.
    return drop_noise(F.split(clean_text(text), r"\s+"), stop_words)


def bigrams(tokens: Column) -> Column:
    """Neighbouring token pairs joined by a space."""
    pairs = F.greatest(F.size(tokens) - 1, F.lit(0))
    return F.zip_with(
        F.slice(tokens, 1, pairs),
        F.slice(tokens, 2, pairs),
        lambda left, right: F.concat(left, F.lit(" "), right),
    )


def ngram_terms(tokens: Column) -> Column:
    """Unigrams and bigrams, over tokens of at least two letters."""
    long_enough = F.filter(tokens, lambda t: F.length(t) > 1)
    return bind(long_enough, lambda kept: F.concat(kept, bigrams(kept)))


def sublinear(tf: Column) -> Column:
    return 1.0 + F.ln(tf.cast("double"))


def smooth_idf(documents: Column, document_frequency: Column) -> Column:
    ratio = (1.0 + documents.cast("double")) / (1.0 + document_frequency.cast("double"))
    return F.ln(ratio) + 1.0
