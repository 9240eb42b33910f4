"""Exact duplicates by deterministic block naming, in DataFrame operations only.

A text is cut into blocks of fixed size. The distinct blocks are sorted and numbered, so each
block has an integer name. Then the names of adjacent blocks are paired, the distinct pairs
sorted and numbered, and so on until one name is left per document. Equal texts have equally
many blocks, so ``(level, name)`` is equal exactly when the texts are; no hash decides it.

Blocks (or pairs) that make up a thousandth of all are *hot*: at most 1,000 can be, so they are
named in a broadcast table and never meet in one task. All others are named where the shuffle
by their content puts them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayer.operators.lookup import join_terms
from assayer.session import settle

BLOCK_BYTES = 8192
HOT_SHARE = 1000  # blocks with at least 1/HOT_SHARE of all rows are hot
HOT_LEAST = 64
BROADCAST_BYTES = 8 * 1024 * 1024


def name_values(rows: DataFrame, value: str, label: str) -> DataFrame:
    """Add ``name``, a number equal in two rows exactly when ``value`` is.

    A hash of the value only decides who is hot; names follow the values themselves.
    """
    rows = rows.withColumn("spot", F.xxhash64(value))
    counts = rows.groupBy("spot").agg(F.count("*").alias("n"))
    counts = settle(counts.where(F.col("n") >= HOT_LEAST), f"{label}-counts")
    total = rows.agg(F.count("*")).first()[0]
    hot = counts.where(F.col("n") * HOT_SHARE >= total).select("spot", F.lit(True).alias("is_hot"))
    marked = rows.join(F.broadcast(hot), "spot", "left").drop("spot")

    def named(part: DataFrame) -> DataFrame:
        distinct = part.select(value).distinct().sortWithinPartitions(value)
        return distinct.withColumn("rank", F.monotonically_increasing_id())

    cold_rows = marked.where(F.col("is_hot").isNull()).drop("is_hot")
    hot_rows = marked.where("is_hot").drop("is_hot")
    cold = cold_rows.join(named(cold_rows).hint("merge"), value)
    warm = hot_rows.join(F.broadcast(named(hot_rows)), value)
    both = cold.withColumn("name", F.col("rank") * 2).unionByName(
        warm.withColumn("name", F.col("rank") * 2 + 1)
    )
    return both.drop("rank", value)


def exact_groups(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Group equal texts; one row per input row.

    ``doc_id, keep_id, group_size, kept, text_sha256``: of equal texts the row with the largest
    id stays. A null text counts as empty; a null id sorts below all others. If the same id
    occurs twice with one text, exactly one of these rows is kept. Other columns are ignored;
    an empty table gives an empty result.
    """
    body = F.coalesce(F.col(text_column), F.lit("")).cast("binary")
    size = F.octet_length("body")
    rows = documents.select(F.col(id_column).alias("doc_id"), body.alias("body")).select(
        F.monotonically_increasing_id().alias("row"),
        "doc_id",
        F.sha2("body", 256).alias("text_sha256"),
        F.greatest(F.lit(1), F.ceil(size / block_bytes)).cast("int").alias("blocks"),
        "body",
    )
    cut = f"transform(sequence(0, blocks - 1), i -> substring(body, i * {block_bytes} + 1, {block_bytes}))"
    pieces = rows.select(
        "row", "doc_id", "text_sha256", "blocks", F.posexplode(F.expr(cut)).alias("place", "block")
    )
    level, left = 0, settle(name_values(pieces, "block", "blocks"), "names")
    finished = []
    while True:
        at = F.lit(level).cast("string")
        finished.append(
            left.where("blocks = 1").select(
                "row", "doc_id", "text_sha256", F.concat_ws(":", at, "name").alias("identity")
            )
        )
        left = left.where("blocks > 1")
        if left.isEmpty():
            break
        level += 1
        left = settle(pair_names(left, f"pairs-{level}"), "names")
    identities = finished[0]
    for more in finished[1:]:
        identities = identities.unionByName(more)
    return choose(settle(identities, "identities"))


def pair_names(names: DataFrame, label: str) -> DataFrame:
    """Replace the names at places 2i and 2i+1 by one name of the pair at place i."""
    even = F.col("place") % 2 == 0
    pairs = (
        names.groupBy("row", "doc_id", "text_sha256", "blocks", F.expr("place div 2").alias("half"))
        .agg(F.max(F.when(even, F.col("name"))).alias("a"), F.max(F.when(~even, F.col("name"))).alias("b"))
        .select(
            "row",
            "doc_id",
            "text_sha256",
            F.expr("(blocks + 1) div 2").cast("int").alias("blocks"),
            F.col("half").cast("int").alias("place"),
            F.struct("a", F.coalesce("b", F.lit(-1)).alias("b")).alias("pair"),
        )
    )
    return name_values(pairs, "pair", label)


def choose(identities: DataFrame) -> DataFrame:
    """Count each group and mark the row that stays."""
    last = F.max(F.struct(F.col("doc_id"), (-F.col("row")).alias("turn")))
    groups = settle(
        identities.groupBy("identity").agg(F.count("*").alias("group_size"), last.alias("last")), "groups"
    )
    joined = join_terms(identities, groups, "identity", "group_size", "row", limit=BROADCAST_BYTES)
    return joined.select(
        "doc_id",
        F.col("last.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row") == -F.col("last.turn")).alias("kept"),
        "text_sha256",
    )
