"""Queries over clinical rows: profile, impute, split, evaluate, compare."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assayer.functions.ordering import hash_slot
from assayer.operators import metrics, profile
from assayer.operators.impute import fill_sentinels, impute, sentinel_means
from assayer.operators.split import hash_split, random_row, stratified_split, with_folds
from assayer.operators.vectors import with_label_codes
from assayer.plans import standins
from assayer.plans.standins import SENTINELS, clinical, sql_split, sql_with

QUERIES = {}
SQL = {}


def query(name: str, sql: str | None = None):
    def register(build):
        QUERIES[name] = build
        if sql is not None:
            SQL[name] = sql
        return build

    return register


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


IMPUTED = """
        means AS (
          SELECT avg(tax) FILTER (WHERE tax <> 0) AS m_tax,
                 avg(discount) FILTER (WHERE discount <> 0) AS m_discount FROM clinical),
        imputed AS (
          SELECT clinical.* REPLACE (
                   CASE WHEN tax = 0 THEN coalesce(m_tax, tax) ELSE tax END AS tax,
                   CASE WHEN discount = 0 THEN coalesce(m_discount, discount) ELSE discount END
                     AS discount)
          FROM clinical, means)"""


@query(
    "impute_sentinel_mean",
    sql_with("clinical", IMPUTED)
    + """
    SELECT id, pregnancies, round(tax, 6) AS tax, round(discount, 6) AS discount, quantity, price, outcome
    FROM imputed""",
)
def impute_sentinel_mean(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(impute(clinical(spark, folder), SENTINELS), *SENTINELS)


@query(
    "impute_guarded_allzero",
    sql_with("clinical")
    + """,
    nulled AS (SELECT id, nullif(tax, 0.01::double) AS tax, discount * 0 AS discount FROM clinical),
    m AS (SELECT avg(tax) FILTER (WHERE tax <> 0) AS m_tax,
                 avg(discount) FILTER (WHERE discount <> 0) AS m_discount FROM nulled)
    SELECT id, round(CASE WHEN tax = 0 THEN coalesce(m_tax, tax) ELSE tax END, 6) AS tax,
           round(CASE WHEN discount = 0 THEN coalesce(m_discount, discount) ELSE discount END, 6) AS discount
    FROM nulled, m""",
)
def impute_guarded_allzero(spark: SparkSession, folder: str) -> DataFrame:
    """Nulls stay null, and a column of zeros only keeps them."""
    rows = clinical(spark, folder).select(
        "id",
        F.nullif("tax", F.lit(0.01)).alias("tax"),
        (F.col("discount") * 0).alias("discount"),
    )
    return rounded(impute(rows, SENTINELS), *SENTINELS)


@query(
    "impute_train_means",
    sql_with("clinical", sql_split("clinical", "id", "outcome"))
    + """,
    m AS (SELECT avg(tax) FILTER (WHERE tax <> 0) AS m_tax,
                 avg(discount) FILTER (WHERE discount <> 0) AS m_discount
          FROM placed WHERE split = 'train')
    SELECT id, split, round(CASE WHEN tax = 0 THEN m_tax ELSE tax END, 6) AS tax,
           round(CASE WHEN discount = 0 THEN m_discount ELSE discount END, 6) AS discount
    FROM placed, m""",
)
def impute_train_means(spark: SparkSession, folder: str) -> DataFrame:
    """Means learned from training rows only, so held-out rows do not leak into them."""
    placed = stratified_split(clinical(spark, folder), "id", "outcome").select("id", "split", *SENTINELS)
    return rounded(impute(placed, SENTINELS, fit_on=F.col("split") == "train"), *SENTINELS)


@query(
    "stratified_split",
    sql_with("clinical", sql_split("clinical", "id", "outcome"))
    + " SELECT id, outcome, split FROM placed",
)
def split_rows(spark: SparkSession, folder: str) -> DataFrame:
    return stratified_split(clinical(spark, folder).select("id", "outcome"), "id", "outcome")


@query(
    "hash_split",
    sql_with("clinical")
    + """
    SELECT id, CASE WHEN cast('0x' || substr(md5(id || '|42'), 1, 7) AS bigint) % 100 < 80
                    THEN 'train' ELSE 'test' END AS split
    FROM clinical""",
)
def split_by_hash(spark: SparkSession, folder: str) -> DataFrame:
    return hash_split(clinical(spark, folder).select("id"), "id")


@query(
    "kfold_sizes",
    sql_with("clinical")
    + """
    SELECT cast(cast('0x' || substr(md5(id || '|fold42'), 1, 7) AS bigint) % 5 AS int) AS fold,
           outcome, count(*) AS n
    FROM clinical GROUP BY ALL""",
)
def kfold_sizes(spark: SparkSession, folder: str) -> DataFrame:
    rows = with_folds(clinical(spark, folder).select("id", "outcome"), "id")
    return rows.groupBy("fold", "outcome").agg(F.count("*").alias("n"))


@query(
    "random_row",
    sql_with("clinical") + " SELECT * FROM clinical ORDER BY md5(id || '|42'), id LIMIT 1",
)
def one_random_row(spark: SparkSession, folder: str) -> DataFrame:
    return random_row(clinical(spark, folder), "id")


@query(
    "preview_rows",
    sql_with("clinical") + " SELECT id, price, outcome FROM clinical ORDER BY price DESC, id LIMIT 5",
)
def preview_rows(spark: SparkSession, folder: str) -> DataFrame:
    rows = clinical(spark, folder).select("id", "price", "outcome")
    return profile.preview(rows, [F.desc("price"), "id"])


@query(
    "profile_shape",
    sql_with("clinical") + " SELECT count(*) AS n_rows, cast(7 AS bigint) AS n_columns FROM clinical",
)
def profile_shape(spark: SparkSession, folder: str) -> DataFrame:
    return profile.shape(clinical(spark, folder))


@query(
    "profile_nulls",
    sql_with("clinical")
    + """,
    nulled AS (SELECT id, nullif(tax, 0.01::double) AS tax, nullif(pregnancies, 3) AS pregnancies FROM clinical)
    SELECT 'id' AS "column", count(*) - count(id) AS nulls, count(*) AS n_rows FROM nulled
    UNION ALL SELECT 'tax', count(*) - count(tax), count(*) FROM nulled
    UNION ALL SELECT 'pregnancies', count(*) - count(pregnancies), count(*) FROM nulled""",
)
def profile_nulls(spark: SparkSession, folder: str) -> DataFrame:
    rows = clinical(spark, folder).select(
        "id",
        F.nullif("tax", F.lit(0.01)).alias("tax"),
        F.nullif("pregnancies", F.lit(3)).alias("pregnancies"),
    )
    return profile.null_counts(rows)


@query(
    "class_distribution",
    sql_with("clinical")
    + """
    SELECT outcome, count(*) AS n, round(count(*) * 100.0::double / sum(count(*)) OVER (), 6) AS pct
    FROM clinical GROUP BY outcome""",
)
def class_distribution(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(profile.class_distribution(clinical(spark, folder), "outcome"), "pct")


@query(
    "imbalance_ratio",
    """
    WITH counts AS (SELECT source, count(*) AS n FROM documents GROUP BY source)
    SELECT (SELECT source FROM counts ORDER BY n DESC, source LIMIT 1) AS majority,
           (SELECT max(n) FROM counts) AS majority_n,
           (SELECT source FROM counts ORDER BY n, source LIMIT 1) AS minority,
           (SELECT min(n) FROM counts) AS minority_n,
           round(max(n)::double / min(n)::double, 6) AS ratio
    FROM counts""",
)
def imbalance_ratio(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(profile.imbalance(standins.table(spark, folder, "documents"), "source"), "ratio")


@query(
    "split_report",
    sql_with("clinical", sql_split("clinical", "id", "outcome"))
    + """,
    counts AS (SELECT split, outcome, count(*) AS n FROM placed GROUP BY ALL)
    SELECT split, outcome, n,
           round(n * 100.0::double / sum(n) OVER (PARTITION BY split), 6) AS pct_of_split,
           cast(sum(n) OVER (PARTITION BY split) AS bigint) AS split_rows,
           round(sum(n) OVER (PARTITION BY split) * 100.0::double / sum(n) OVER (), 6) AS split_pct
    FROM counts""",
)
def split_report(spark: SparkSession, folder: str) -> DataFrame:
    placed = stratified_split(clinical(spark, folder).select("id", "outcome"), "id", "outcome")
    return rounded(profile.split_report(placed, "split", "outcome"), "pct_of_split", "split_pct")


@query(
    "label_encode",
    """
    SELECT source, cast(dense_rank() OVER (ORDER BY source) - 1 AS int) AS label_code, count(*) AS n
    FROM documents GROUP BY source""",
)
def label_encode(spark: SparkSession, folder: str) -> DataFrame:
    coded = with_label_codes(standins.table(spark, folder, "documents").select("source"), "source")
    return coded.groupBy("source", "label_code").agg(F.count("*").alias("n"))


# Scores of the classes of ``scored(label, prediction)``.
PRF_SQL = """
        counts AS (SELECT label, prediction, count(*) AS n FROM scored GROUP BY ALL),
        classes AS (
          SELECT c AS class,
                 coalesce(sum(n) FILTER (WHERE label = c AND prediction = c), 0) AS tp,
                 coalesce(sum(n) FILTER (WHERE prediction = c), 0) AS predicted,
                 coalesce(sum(n) FILTER (WHERE label = c), 0) AS support
          FROM counts, (SELECT label AS c FROM counts UNION SELECT prediction FROM counts)
          GROUP BY c),
        prf AS (
          SELECT class, support, tp,
                 coalesce(tp::double / nullif(predicted, 0), 0) AS p,
                 coalesce(tp::double / nullif(support, 0), 0) AS r,
                 coalesce(2.0::double * tp / nullif(predicted + support, 0), 0) AS f
          FROM classes)"""
# Three classes, one rule over order lines that sometimes misses: the metric queries' input.
SCORED_SQL = """
        scored AS (
          SELECT id, outcome + CASE WHEN pregnancies = 7 THEN 1 ELSE 0 END AS label,
                 CASE WHEN price > 70000 THEN 2 WHEN price > 47250 THEN 1 ELSE 0 END AS prediction
          FROM clinical),
        """ + PRF_SQL.strip()


def scored(spark: SparkSession, folder: str) -> DataFrame:
    price = F.col("price")
    return clinical(spark, folder).select(
        "id",
        (F.col("outcome") + F.when(F.col("pregnancies") == 7, 1).otherwise(0)).alias("label"),
        F.when(price > 70000, 2).when(price > 47250, 1).otherwise(0).alias("prediction"),
    )


def scored_counts(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.confusion(scored(spark, folder), "label", "prediction")


@query("confusion_matrix", sql_with("clinical", SCORED_SQL) + " SELECT label, prediction, n FROM counts")
def confusion_counts(spark: SparkSession, folder: str) -> DataFrame:
    return scored_counts(spark, folder)


@query(
    "confusion_pivot",
    sql_with("clinical", SCORED_SQL)
    + """
    SELECT label, cast(coalesce(sum(n) FILTER (WHERE prediction = 0), 0) AS bigint) AS pred_0,
           cast(coalesce(sum(n) FILTER (WHERE prediction = 1), 0) AS bigint) AS pred_1,
           cast(coalesce(sum(n) FILTER (WHERE prediction = 2), 0) AS bigint) AS pred_2
    FROM counts GROUP BY label""",
)
def confusion_pivot(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.confusion_matrix(scored_counts(spark, folder), [0, 1, 2])


@query(
    "accuracy",
    sql_with("clinical", SCORED_SQL)
    + """
    SELECT round(avg(CASE WHEN label = prediction THEN 1.0::double ELSE 0 END), 6) AS accuracy,
           count(*) AS n_rows FROM scored""",
)
def accuracy(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(metrics.accuracy(scored_counts(spark, folder)), "accuracy")


PRF = ("accuracy", "precision", "recall", "f1")


@query(
    "weighted_prf",
    sql_with("clinical", SCORED_SQL)
    + """
    SELECT round(sum(tp)::double / sum(support), 6) AS accuracy,
           round(sum(p * support) / sum(support), 6) AS precision,
           round(sum(r * support) / sum(support), 6) AS recall,
           round(sum(f * support) / sum(support), 6) AS f1 FROM prf""",
)
def weighted_prf(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(metrics.weighted_scores(scored_counts(spark, folder)), *PRF)


@query(
    "macro_prf",
    sql_with("clinical", SCORED_SQL)
    + """
    SELECT round(sum(tp)::double / sum(support), 6) AS accuracy, round(avg(p), 6) AS precision,
           round(avg(r), 6) AS recall, round(avg(f), 6) AS f1 FROM prf""",
)
def macro_prf(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(metrics.macro_scores(scored_counts(spark, folder)), *PRF)


@query(
    "binary_prf",
    sql_with("clinical", SCORED_SQL)
    + """
    SELECT (SELECT round(sum(tp)::double / sum(support), 6) FROM prf) AS accuracy,
           round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f1
    FROM prf WHERE class = 1""",
)
def binary_prf(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(metrics.binary_scores(scored_counts(spark, folder)), *PRF)


REPORT_SQL = """
    SELECT cast(class AS varchar) AS class, round(p, 6) AS precision, round(r, 6) AS recall,
           round(f, 6) AS f1, cast(support AS bigint) AS support FROM prf
    UNION ALL
    SELECT 'accuracy', round(sum(tp)::double / sum(support), 6), round(sum(tp)::double / sum(support), 6),
           round(sum(tp)::double / sum(support), 6), cast(sum(support) AS bigint) FROM prf
    UNION ALL
    SELECT 'macro avg', round(avg(p), 6), round(avg(r), 6), round(avg(f), 6), cast(sum(support) AS bigint) FROM prf
    UNION ALL
    SELECT 'weighted avg', round(sum(p * support) / sum(support), 6), round(sum(r * support) / sum(support), 6),
           round(sum(f * support) / sum(support), 6), cast(sum(support) AS bigint) FROM prf"""


@query("class_report", sql_with("clinical", SCORED_SQL) + REPORT_SQL)
def class_report(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(metrics.class_report(scored_counts(spark, folder)), "precision", "recall", "f1")


def sql_auc(source: str, score: str, label: str = "outcome") -> str:
    return f"""
      (SELECT sum(pos * (below + neg / 2.0::double)) / (sum(pos)::double * sum(neg)::double)
       FROM (SELECT *, coalesce(sum(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING
                                                AND 1 PRECEDING), 0)::double AS below
             FROM (SELECT {score} AS s, sum({label})::double AS pos,
                          sum(1 - {label})::double AS neg
                   FROM {source} GROUP BY s)))"""


@query(
    "auc_exact",
    sql_with("clinical") + f" SELECT round({sql_auc('clinical', 'price')}, 6) AS auc",
)
def auc_exact(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(metrics.auc(clinical(spark, folder), "outcome", "price"), "auc")


@query(
    "auc_tied_scores",
    sql_with("clinical") + f" SELECT round({sql_auc('clinical', 'quantity')}, 6) AS auc",
)
def auc_tied_scores(spark: SparkSession, folder: str) -> DataFrame:
    """A score with fifty distinct values: almost every pair is decided by the tie rule."""
    return rounded(metrics.auc(clinical(spark, folder), "outcome", "quantity"), "auc")


RULES = {"price": 47250.0, "quantity": 25.0, "discount": 0.05}


def sql_weighted(source: str) -> str:
    """Accuracy and weighted scores of a two-class ``source(outcome, prediction)``."""
    return f"""
      SELECT sum(tp)::double / sum(support) AS accuracy, sum(f * support) / sum(support) AS f1,
             sum(p * support) / sum(support) AS precision, sum(r * support) / sum(support) AS recall
      FROM (SELECT *, coalesce(tp::double / nullif(predicted, 0), 0) AS p,
                   coalesce(tp::double / nullif(support, 0), 0) AS r,
                   coalesce(2.0::double * tp / nullif(predicted + support, 0), 0) AS f
            FROM (SELECT c, count(*) FILTER (WHERE outcome = c AND prediction = c) AS tp,
                         count(*) FILTER (WHERE prediction = c) AS predicted,
                         count(*) FILTER (WHERE outcome = c) AS support
                  FROM {source}, (SELECT unnest([0, 1]) AS c) GROUP BY c))"""


def _comparison_sql() -> str:
    rows = [
        f"""SELECT 'rule_{c}' AS model, round(w.accuracy, 6) AS accuracy,
               round({sql_auc('clinical', c)}, 6) AS auc, round(w.f1, 6) AS f1,
               round(w.precision, 6) AS precision, round(w.recall, 6) AS recall, {i} AS position
        FROM ({sql_weighted(f'(SELECT outcome, CASE WHEN {c} > {t} THEN 1 ELSE 0 END AS prediction FROM clinical)')}) w"""
        for i, (c, t) in enumerate(RULES.items())
    ]
    return sql_with("clinical") + "\n" + "\nUNION ALL\n".join(rows)


def rule_comparison(spark: SparkSession, folder: str) -> DataFrame:
    scored = {f"rule_{c}": (F.when(F.col(c) > t, 1).otherwise(0), F.col(c)) for c, t in RULES.items()}
    rows = metrics.stacked(clinical(spark, folder), "outcome", scored)
    return metrics.evaluate_models(rows, list(scored))


FIVE = ("accuracy", "auc", "f1", "precision", "recall")


@query("model_comparison", _comparison_sql())
def model_comparison(spark: SparkSession, folder: str) -> DataFrame:
    """Five metrics of each rule, all rules from one pass over the rows."""
    return rounded(rule_comparison(spark, folder), *FIVE)


@query("best_model", f"SELECT * FROM ({_comparison_sql()}) ORDER BY auc DESC, position LIMIT 1")
def best_model(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(metrics.best_model(rule_comparison(spark, folder)), *FIVE)


@query(
    "rule_eval_clinical",
    sql_with("clinical", IMPUTED, sql_split("imputed", "id", "outcome"))
    + f""",
    ruled AS (SELECT outcome, CASE WHEN price > 47250 AND tax > 0.01 THEN 1 ELSE 0 END AS prediction
              FROM placed WHERE split = 'test')
    SELECT round(accuracy, 6) AS accuracy, round(precision, 6) AS precision,
           round(recall, 6) AS recall, round(f1, 6) AS f1
    FROM ({sql_weighted('ruled')})""",
)
def rule_eval_clinical(spark: SparkSession, folder: str) -> DataFrame:
    """How good is a fixed rule on held-out rows, after imputing and splitting."""
    rows = clinical(spark, folder).select("id", "price", "tax", "outcome")
    imputed = fill_sentinels(rows, sentinel_means(rows, ["tax"]), ["tax"])
    held_out = stratified_split(imputed, "id", "outcome").where(F.col("split") == "test")
    hit = (F.col("price") > 47250) & (F.col("tax") > 0.01)
    ruled = held_out.withColumn("prediction", F.when(hit, 1).otherwise(0))
    return rounded(metrics.weighted_scores(metrics.confusion(ruled, "outcome", "prediction")), *PRF)
