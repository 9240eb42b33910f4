"""Documents made ready for training, in five stages.

Language identification drops what no language can be told of, exact and near copies go, personal
data is masked, and what is left is packed into training sequences. Each stage is written as
Parquet and read again before the next.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assayer.llm import language_id, personal_data
from assayer.llm.exact_dedup import exact_groups
from assayer.llm.ngram_join import near_groups
from assayer.llm.packing import pack, token_pieces
from assayer.session import new_folder, settle

NEAR_WIDTH, NEAR_PERCENT = 5, 80
BROADCAST_KEYS = 1_000_000  # keys of some 100 bytes
VOCABULARY = "word_bpe_49k.json"


def without(documents: DataFrame, keys: DataFrame, how: str = "left_anti") -> DataFrame:
    """Rows of ``documents`` whose key is not in ``keys`` (or is); few keys, counted, are broadcast."""
    keys = settle(keys, "dropped")
    if keys.count() <= BROADCAST_KEYS:
        keys = F.broadcast(keys)
    same = [documents[name].eqNullSafe(keys[name]) for name in keys.columns]
    return documents.join(keys, same, how)


def free_name(docs: DataFrame, wish: str) -> str:
    """A column name that ``docs`` does not have."""
    taken = {name.lower() for name in docs.columns}
    while wish in taken:
        wish += "_"
    return wish


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents of undetermined language; fill in the language where it is null.

    Columns pass through under names of their own, so that they may be called like a result.
    """
    samples = language_id.learn(docs)
    names = {f"given {i}": name for i, name in enumerate(docs.columns)}
    inside = {name: given for given, name in names.items()}
    given = docs.toDF(*names)
    found = language_id.identify(given, samples, keep=tuple(names), text_column=inside["text"])
    clean = found.where(F.col("lang_pred") != language_id.UNDETERMINED)
    filled = clean.withColumn(inside["lang"], F.coalesce(inside["lang"], "lang_pred"))
    return filled.select(*names).toDF(*docs.columns)


def without_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest id stays; rows that agree in id and text count once."""
    mark = free_name(docs, "text_sha256")
    groups = settle(exact_groups(docs).withColumnRenamed("text_sha256", mark), "exact-groups")
    keys = groups.where("group_size > 1").groupBy("doc_id", mark)
    keys = settle(keys.agg(F.max("kept").alias("stays"), F.count("*").alias("rows")), "keys")
    marked = docs.withColumn(mark, F.sha2(F.coalesce("text", F.lit("")), 256))
    left = without(marked, keys.where("NOT stays").select("doc_id", mark))
    repeated = keys.where("stays AND rows > 1").select("doc_id", mark)
    if repeated.isEmpty():
        return left.select(docs.columns)
    once = without(left, repeated)
    again = without(left, repeated, "left_semi").dropDuplicates(["doc_id", mark])
    return once.unionByName(again).select(docs.columns)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of similar documents the one with the least id stays.

    A document is known by its id and text, as rows with different texts may share an id. A null id counts as greater
    than all others; of one id, the text with the least md5 stays.
    """
    mark = free_name(docs, "text_md5")
    digest = F.unhex(F.md5(F.coalesce("text", F.lit(""))))
    name = F.struct(F.col("doc_id").isNull().alias("unnamed"), F.col("doc_id").alias("id"), digest.alias("mark"))
    groups = near_groups(docs.select(name.alias("doc_id"), "text"), width=NEAR_WIDTH, percent=NEAR_PERCENT)
    copies = groups.where("doc_id <> component_id").select(
        F.col("doc_id.id").alias("doc_id"), F.col("doc_id.mark").alias(mark)
    )
    return without(docs.withColumn(mark, digest), copies.distinct()).select(docs.columns)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mask personal data in the texts and count their characters anew."""
    clean = personal_data.redact(docs, personal_data.learn(docs))
    return clean.withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their places in sequences."""
    pieces = token_pieces(docs, public_tokenizers.path(VOCABULARY))
    return pack(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))


STAGES = [
    ("language_id", identified),
    ("exact_dedup", without_exact_copies),
    ("ngram_join", without_near_copies),
    ("personal_data", without_personal_data),
    ("best_fit_packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = new_folder(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


ORACLE_SQL = None  # the first and fourth stages apply trained models

QUERIES = {"pipeline": run}
SQL = {}
