"""The given tables shaped like the three workflows' inputs, in Spark and in SQL.

Every name has a DataFrame builder and, in ``SQL``, the same rows as a common table
expression for the SQL side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from assayer.functions.text import words
from assayer.session import settle

STOP_WORDS = ["the", "of", "and", "by", "that", "is", "in", "to", "for", "with"]
SENTINELS = ["tax", "discount"]
FEATURES = ["pregnancies", "tax", "discount", "quantity", "price"]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def clinical(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines as clinical rows: two columns with zero sentinels, a learnable label."""
    identifier = F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    noise = F.conv(F.substring(F.md5(F.col("id")), 1, 3), 16, 10).cast("double") / 4096.0
    risk = F.col("price") / 105000.0 + (noise - 0.5) * 0.6
    return (
        table(spark, folder, "lineitem")
        .select(
            identifier.alias("id"),
            F.col("l_linenumber").alias("pregnancies"),
            F.col("l_tax").alias("tax"),
            F.col("l_discount").alias("discount"),
            F.col("l_quantity").alias("quantity"),
            F.col("l_extendedprice").alias("price"),
        )
        .withColumn("outcome", F.when(risk > 0.45, 1).otherwise(0))
    )


def headlines(spark: SparkSession, folder: str, labelled: bool = True) -> DataFrame:
    """Documents, whole texts: those with a label, or all with the label where there is one."""
    labels = table(spark, folder, "labels").select("doc_id", "quality")
    return (
        table(spark, folder, "documents")
        .select("doc_id", "text")
        .join(labels, "doc_id", "inner" if labelled else "left")
        .select(F.col("doc_id").alias("id"), "text", F.col("quality").alias("label"))
    )


def headline_tokens(spark: SparkSession, folder: str, labelled: bool = True) -> DataFrame:
    """``(id, label, tokens)`` of the labelled documents, or of all."""
    return headlines(spark, folder, labelled).select("id", "label", words(F.col("text"), STOP_WORDS).alias("tokens"))


def distinct_terms(tokens: DataFrame) -> DataFrame:
    """``term``, written once: a later filter would otherwise be pushed below the ``distinct`` and judge every occurrence."""
    terms = tokens.select(F.explode_outer("tokens").alias("term")).where(F.col("term").isNotNull())
    return settle(terms.distinct(), "terms")


def lexicon(terms: DataFrame) -> DataFrame:
    """Distinct terms in use sorted into kinds by their md5; stands in for word lists."""
    digit = F.substring(F.md5("term"), 1, 1)
    kind = (
        F.when(digit.isin("0", "1"), "positive")
        .when(digit.isin("2", "3"), "negative")
        .when(digit == "4", "indicator")
    )
    return settle(terms.withColumn("kind", kind).where(F.col("kind").isNotNull()), "lexicon")


def roots(terms: DataFrame, pattern: str) -> DataFrame:
    """``(term, root)`` by cutting an ending; stands in for stem and lemma tables."""
    return terms.withColumn("root", F.regexp_replace("term", pattern, ""))


STEM_PATTERN = "(ing|ed|s)$"
LEMMA_PATTERN = "s$"


def channel(pos: Column, shift: int) -> Column:
    """An embedding's component as a channel value of the pixel at ``pos``."""
    value = F.get("embedding", F.pmod(pos + shift, F.lit(64))).cast("double")
    return F.least(F.greatest(F.round(128.0 + 512.0 * value), F.lit(0.0)), F.lit(255.0)).cast("int")


def pixels(spark: SparkSession, folder: str) -> DataFrame:
    """Embeddings as 8 x 8 images, one row per pixel."""

    pos = F.col("pos")
    return (
        table(spark, folder, "embeddings")
        .select("vec_id", "label", "embedding", F.explode(F.sequence(F.lit(0), F.lit(63))).alias("pos"))
        .select(
            F.col("vec_id").alias("image_id"),
            "label",
            (F.col("pos") % 8).alias("x"),
            F.expr("int(pos div 8)").alias("y"),
            channel(pos, 0).alias("r"),
            channel(pos, 21).alias("g"),
            channel(pos, 42).alias("b"),
        )
    )


def pixel_arrays(spark: SparkSession, folder: str) -> DataFrame:
    """The same images with one row each: ``cells`` holds the channel values in (y, x, channel) order."""
    rgb = F.transform(F.sequence(F.lit(0), F.lit(63)), lambda pos: F.array(*[channel(pos, s) for s in (0, 21, 42)]))
    return table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("image_id"), "label", F.flatten(rgb).alias("cells")
    )


def leaves(spark: SparkSession, folder: str) -> DataFrame:
    """Pixel rows whose ten labels are folded onto three leaf classes."""
    return pixels(spark, folder).withColumn("label", F.col("label") % 3)


def vectors(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("id"),
        F.transform("embedding", lambda x: x.cast("double")).alias("features"),
        "label",
    )


_STOPS = ", ".join(f"'{w}'" for w in STOP_WORDS)


def sql_words(text: str) -> str:
    cleaned = rf"regexp_replace(lower({text}), '[^a-z\s]', ' ', 'g')"
    return (
        rf"list_filter(string_split_regex({cleaned}, '\s+'), "
        rf"lambda t: length(t) > 1 AND t NOT IN ({_STOPS}))"
    )


def sql_split(source: str, key: str, label: str, seed: int = 42) -> str:
    """Common table expression ``placed``: ``source`` with its stratified split."""
    return f"""
        ranked AS (
          SELECT *,
                 row_number() OVER (PARTITION BY {label}
                   ORDER BY md5(cast({key} AS varchar) || '|{seed}'), {key}) AS rn,
                 count(*) OVER (PARTITION BY {label}) AS class_n
          FROM {source}),
        placed AS (
          SELECT * EXCLUDE (rn, class_n),
                 CASE WHEN rn <= class_n * 70 // 100 THEN 'train'
                      WHEN rn <= class_n * 85 // 100 THEN 'val' ELSE 'test' END AS split
          FROM ranked)"""


def _channel(shift: int) -> str:
    return (
        "cast(least(greatest(round(128.0::double + 512.0::double * "
        f"cast(embedding[(pos + {shift}) % 64 + 1] AS double)), 0.0::double), 255.0::double) AS int)"
    )


SQL = {
    "clinical": """
        clinical AS (
          SELECT *, CASE WHEN price / 105000.0::double
                           + (cast('0x' || substr(md5(id), 1, 3) AS int) / 4096.0::double
                              - 0.5::double) * 0.6::double > 0.45::double
                         THEN 1 ELSE 0 END AS outcome
          FROM (SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS id,
                       l_linenumber AS pregnancies, l_tax AS tax, l_discount AS discount,
                       l_quantity AS quantity, l_extendedprice AS price
                FROM lineitem))""",
    "headlines": """
        headlines AS (
          SELECT doc_id AS id, text, quality AS label
          FROM documents JOIN labels USING (doc_id))""",
    "texts": """
        headlines AS (
          SELECT doc_id AS id, text, quality AS label
          FROM documents LEFT JOIN labels USING (doc_id))""",
    "tokens": f"""
        tokens AS (SELECT id, label, {sql_words('text')} AS tokens FROM headlines)""",
    "lexicon": """
        lexicon AS (
          SELECT term, CASE WHEN d IN ('0', '1') THEN 'positive'
                            WHEN d IN ('2', '3') THEN 'negative' ELSE 'indicator' END AS kind
          FROM (SELECT term, substr(md5(term), 1, 1) AS d
                FROM (SELECT DISTINCT unnest(tokens) AS term FROM tokens))
          WHERE d IN ('0', '1', '2', '3', '4'))""",
    "pixels": f"""
        pixels AS (
          SELECT vec_id AS image_id, label, cast(pos % 8 AS int) AS x, cast(pos // 8 AS int) AS y,
                 {_channel(0)} AS r, {_channel(21)} AS g, {_channel(42)} AS b
          FROM embeddings, (SELECT unnest(range(64)) AS pos))""",
    "leaves": """
        leaves AS (SELECT * REPLACE (label % 3 AS label) FROM pixels)""",
}


def sql_with(names: str, *more: str) -> str:
    """``WITH`` clause of the named expressions, then any further ones."""
    parts = [SQL[n].strip() for n in names.split()] + [m.strip() for m in more]
    return "WITH " + ",\n".join(parts)
