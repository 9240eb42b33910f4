"""Registered queries of this subpackage and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assayer.llm import importance, language_id, lm_scoring, periodic_runs, sentence_pieces, simhash_groups
from assayer.llm.exact_dedup import exact_groups
from assayer.llm.html_extraction import extract
from assayer.llm.ngram_join import near_groups
from assayer.llm.packing import pack, token_pieces
from assayer.llm.personal_data import BASE_KINDS, KINDS, find_spans, learn
from assayer.llm.prefix_forest import nearest
from assayer.llm.substring_dedup import remove_repeats

WORD_VOCABULARY = "word_bpe_49k.json"
PIECE_MODEL = "piece_bpe_32k.model"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_language_id(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    samples = language_id.learn(documents.where(language_id.remainder("doc_id", 4) != 2))
    held_out = language_id.remainder("doc_id", 4) == 2
    return language_id.identify(documents, samples).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score", "bits"
    )


def op2_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    held_out = language_id.remainder("doc_id", 5) == 1
    scored = lm_scoring.score(documents, ~held_out, public_tokenizers.path(WORD_VOCABULARY))
    return scored.withColumn("held_out", held_out)


def op3_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_groups(table(spark, folder, "documents"))


def op4_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    rank = F.create_map(*[F.lit(x) for i, kind in enumerate(KINDS) for x in (kind, i)])

    def listed(spans):
        keyed = F.transform(
            spans, lambda s: F.struct(s["start"].alias("start"), rank[s["kind"]].alias("rank"), s["end"].alias("end"), s["kind"].alias("kind"))
        )
        written = F.transform(F.array_sort(keyed), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
        return F.array_join(written, ",")

    added = F.transform("added", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    counts = [
        F.expr(f"cast(size(filter(base, s -> s.kind = '{kind}')) AS bigint) AS n_{kind}") for kind in BASE_KINDS
    ]
    return find_spans(documents, learn(documents)).select(
        "doc_id",
        *counts,
        F.sha2(listed(F.col("base")), 256).alias("base_sha256"),
        listed(F.concat("base", added)).alias("spans"),
    )


def op5_prefix_forest(spark: SparkSession, folder: str) -> DataFrame:
    return nearest(table(spark, folder, "embeddings"), lambda vec_id: vec_id % 20 == 0)


def op6_sentence_pieces(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of every whole text, and the text that decoding them gives back."""
    model = public_tokenizers.path(PIECE_MODEL)
    encoded = sentence_pieces.encode(table(spark, folder, "documents"), model)
    size = F.expr("cast(octet_length(ids) div 4 AS bigint)").alias("n_ids")
    digests = sentence_pieces.decode(encoded.select("doc_id", size, F.crc32("ids").alias("ids_crc32"), "ids"), model)
    return digests.select("doc_id", "n_ids", "ids_crc32", F.sha2("text", 256).alias("text_sha256"))


def op7_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    kept = remove_repeats(table(spark, folder, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op8_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return near_groups(table(spark, folder, "documents"))


def op9_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    pieces = token_pieces(table(spark, folder, "documents"), public_tokenizers.path(WORD_VOCABULARY))
    return pack(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))


def op10_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return extract(table(spark, folder, "pages")).withColumn("n_chars", F.length("text").cast("long"))


def op11_simhash_groups(spark: SparkSession, folder: str) -> DataFrame:
    return simhash_groups.near_groups(table(spark, folder, "documents"))


def op12_importance(spark: SparkSession, folder: str) -> DataFrame:
    drawn = importance.resample(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    found = periodic_runs.find_runs(documents, edit=periodic_runs.with_repeated_tail)
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    written = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *[F.col(f"strongest.{name}").alias(name) for name in ("start", "length", "period")],
        F.expr("strongest.length * 1000 div strongest.period").alias("exponent_milli"),
        F.sha2(written, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_lm_scoring": op2_lm_scoring,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_personal_data": op4_personal_data,
    "op5_prefix_forest": op5_prefix_forest,
    "op6_sentence_pieces": op6_sentence_pieces,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_ngram_join": op8_ngram_join,
    "op9_best_fit_packing": op9_best_fit_packing,
    "op10_html_extraction": op10_html_extraction,
    "op11_simhash_groups": op11_simhash_groups,
    "op12_importance": op12_importance,
    "op13_periodic_runs": op13_periodic_runs,
}

SQL = {
    "op3_exact_dedup": """
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents)
        SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id,
               count(*) OVER (PARTITION BY t) AS group_size,
               doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
        FROM d""",
    "op12_importance": r"""
        WITH RECURSIVE texts AS (
          SELECT 'd' AS kind, doc_id AS id, text FROM documents
          UNION ALL SELECT 'b', item_id, text FROM benchmark
        ), words AS (
          SELECT kind, id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts
        ), runs AS (
          SELECT kind, id, unnest([word, word || ' ' || next, word || ' ' || next || ' ' || lead(next) OVER later]) AS run
          FROM (SELECT kind, id, place, word, lead(word) OVER (PARTITION BY kind, id ORDER BY place) AS next
                FROM (SELECT kind, id, unnest(w) AS word, unnest(range(len(w))) AS place FROM words))
          WINDOW later AS (PARTITION BY kind, id ORDER BY place)
        ), counted AS MATERIALIZED (
          SELECT kind, id, run, count(*) AS n FROM runs WHERE run IS NOT NULL GROUP BY ALL
        ), longest AS MATERIALIZED (
          SELECT max(strlen(run)) AS size FROM counted
        ), steps AS (
          SELECT b, list_reduce(list_prepend(b, range(8)),
                 lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) AS step
          FROM range(256) bytes(b)
        ), states AS (  -- what byte b, or for 256 the state at the start, leaves of itself after k more bytes
          SELECT b, 0::BIGINT AS k, step AS state FROM steps UNION ALL SELECT 256, 0, 4294967295
          UNION ALL
          SELECT x.b, x.k + 1, xor(y.step, x.state >> 8) FROM states x JOIN steps y ON y.b = x.state & 255
          WHERE x.k < (SELECT size FROM longest)
        ), places AS (
          SELECT run, hex(encode(run)) AS h, strlen(run) AS size, unnest(range(-1, size)) AS i
          FROM (SELECT DISTINCT run FROM counted)
        ), sums AS (
          SELECT run, xor(4294967295, bit_xor(state)) % 10000 AS bucket
          FROM places JOIN states ON k = size - 1 - i
           AND b = CASE WHEN i < 0 THEN 256 ELSE ('0x' || substr(h, 2 * i + 1, 2))::BIGINT END
          GROUP BY run
        ), buckets AS (
          SELECT bucket, sum(CASE WHEN kind = 'd' THEN n ELSE 0 END) AS s, sum(CASE WHEN kind = 'b' THEN n ELSE 0 END) AS t
          FROM counted JOIN sums USING (run) GROUP BY bucket
        ), gains AS (
          SELECT bucket, floor(1000 * ln((t + 1.0::DOUBLE) * ((SELECT sum(s) FROM buckets)::DOUBLE + 10000)
                 / ((s + 1.0::DOUBLE) * ((SELECT sum(t) FROM buckets)::DOUBLE + 10000))))::BIGINT AS gain FROM buckets
        ), weights AS (
          SELECT id, sum(n)::BIGINT AS n_features, sum(n * gain)::BIGINT AS weight
          FROM counted JOIN sums USING (run) JOIN gains USING (bucket) WHERE kind = 'd' GROUP BY id
        ), scored AS (
          SELECT id AS doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
                 coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('42:' || id::VARCHAR), 1, 8))::BIGINT + 0.5::DOUBLE)
                 / 4294967296)))::BIGINT AS score
          FROM words LEFT JOIN weights USING (id) WHERE kind = 'd'
        )
        SELECT doc_id, n_features, weight, score, CASE WHEN place * 100 <= 5 * able AND n_words >= 20 THEN place END AS rank
        FROM (SELECT *, count(*) FILTER (n_words >= 20) OVER () AS able,
                     row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id) AS place FROM scored)""",
}
