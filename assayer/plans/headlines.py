"""Queries over labelled texts: tokens, lexicon rule and its sweep, TF-IDF."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assayer.functions.fixed_values import (
    INDICATOR_TERMS,
    INDICATOR_THRESHOLDS,
    SENTIMENT_THRESHOLDS,
)
from assayer.functions.text import bigrams, ngram_terms
from assayer.operators import lexicon as lex
from assayer.operators import metrics, sweep
from assayer.operators.split import stratified_split
from assayer.operators.roots import stem_dictionary
from assayer.operators.tfidf import fit_vocabulary, tfidf, top_term_lists, top_terms
from assayer.operators.tokens import dictionary_for, replace_terms
from assayer.plans import standins
from assayer.plans.standins import (
    LEMMA_PATTERN,
    STEM_PATTERN,
    headline_tokens,
    sql_split,
    sql_with,
)
from assayer.session import new_folder, settle
from assayer.sources.tables import read_headlines

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


TOKENS = "headlines tokens"
ALL_TOKENS = "texts tokens"


@query(
    "clean_tokens",
    sql_with(ALL_TOKENS)
    + " SELECT id, array_to_string(tokens, ' ') AS cleaned, cast(len(tokens) AS int) AS n_tokens FROM tokens",
)
def clean_tokens(spark: SparkSession, folder: str) -> DataFrame:
    return headline_tokens(spark, folder, labelled=False).select(
        "id", F.array_join("tokens", " ").alias("cleaned"), F.size("tokens").alias("n_tokens")
    )


def sql_roots(pattern: str) -> str:
    return f"""
        rooted AS (
          SELECT id, label, list_transform(tokens,
                   lambda t: regexp_replace(t, '{pattern}', '')) AS tokens FROM tokens)"""


def stored_tokens(spark: SparkSession, folder: str, labelled: bool = True) -> DataFrame:
    """Tokens written once, for queries that read them several times."""
    return settle(headline_tokens(spark, folder, labelled), "tokens")


def rooted(tokens: DataFrame, pattern: str, terms: DataFrame | None = None) -> DataFrame:
    """Stored tokens by their roots; ``terms`` are the distinct ones, where the caller has them."""
    roots = standins.roots(standins.distinct_terms(tokens) if terms is None else terms, pattern)
    return replace_terms(tokens, "id", "tokens", dictionary_for(tokens, "tokens", roots), carry=["label"])


def joined(df: DataFrame) -> DataFrame:
    return df.select("id", "label", F.array_join("tokens", " ").alias("tokens"))


@query(
    "stem_tokens",
    sql_with(ALL_TOKENS, sql_roots(STEM_PATTERN)) + " SELECT id, label, array_to_string(tokens, ' ') AS tokens FROM rooted",
)
def stem_tokens(spark: SparkSession, folder: str) -> DataFrame:
    return joined(rooted(stored_tokens(spark, folder, labelled=False), STEM_PATTERN))


@query(
    "lemma_tokens",
    sql_with(ALL_TOKENS, sql_roots(LEMMA_PATTERN)) + " SELECT id, label, array_to_string(tokens, ' ') AS tokens FROM rooted",
)
def lemma_tokens(spark: SparkSession, folder: str) -> DataFrame:
    return joined(rooted(stored_tokens(spark, folder, labelled=False), LEMMA_PATTERN))


@query("porter_stems")
def porter_stems(spark: SparkSession, folder: str) -> DataFrame:
    """Every term in use with its count and Porter stem."""
    return stem_dictionary(headline_tokens(spark, folder, labelled=False), "tokens")


@query("extended_stems")
def extended_stems(spark: SparkSession, folder: str) -> DataFrame:
    """Every term in use with its count and its stem by the extended variant."""
    return stem_dictionary(headline_tokens(spark, folder, labelled=False), "tokens", "extended")


@query(
    "bigrams",
    sql_with(ALL_TOKENS)
    + """
    SELECT id, array_to_string(list_transform(range(1, len(tokens)),
             lambda i: tokens[i] || ' ' || tokens[i + 1]), '|') AS bigrams
    FROM tokens""",
)
def bigram_rows(spark: SparkSession, folder: str) -> DataFrame:
    return headline_tokens(spark, folder, labelled=False).select(
        "id", F.array_join(bigrams(F.col("tokens")), "|").alias("bigrams")
    )


# Lemmas of two letters or more, with their bigrams, for the split documents.
TERMS_SQL = """
        lemmas AS (SELECT id, label, split, list_filter(list_transform(tokens,
                            lambda t: regexp_replace(t, 's$', '')), lambda t: length(t) > 1) AS tokens
                   FROM placed),
        terms AS (SELECT id, split, unnest(list_concat(tokens, list_transform(range(1, len(tokens)),
                            lambda i: tokens[i] || ' ' || tokens[i + 1]))) AS term FROM lemmas),
        tf AS (SELECT id, split, term, count(*) AS tf FROM terms GROUP BY ALL),
        n AS (SELECT count(*) AS n FROM placed WHERE split = 'train'),
        vocabulary AS (SELECT term, count(*) AS df,
                              ln((1.0::double + any_value(n)) / (1.0::double + count(*))) + 1 AS idf
                       FROM tf, n WHERE split = 'train' GROUP BY term
                       HAVING count(*) >= 2 AND count(*) <= 0.9::double * any_value(n)),
        raw AS (SELECT id, split, term, (1 + ln(tf::double)) * idf AS w FROM tf JOIN vocabulary USING (term)),
        weights AS (SELECT id, split, term, w / sqrt(sum(w * w) OVER (PARTITION BY id)) AS weight FROM raw)"""
TFIDF = sql_with(TOKENS, sql_split("tokens", "id", "label"), TERMS_SQL)


def term_arrays(spark: SparkSession, folder: str) -> DataFrame:
    """Split documents with their unigram and bigram terms; those without a label are in no split and stay out."""
    return terms_of(stored_tokens(spark, folder))


def terms_of(tokens: DataFrame, terms: DataFrame | None = None) -> DataFrame:
    """``term_arrays`` of stored tokens of labelled documents."""
    placed = stratified_split(settle(rooted(tokens, LEMMA_PATTERN, terms), "lemmas"), "id", "label")
    return placed.select("id", "label", "split", ngram_terms(F.col("tokens")).alias("terms"))


def only(df: DataFrame, split: str) -> DataFrame:
    return df.where(F.col("split") == split)


@query("vocabulary", TFIDF + " SELECT term, df, round(idf, 6) AS idf FROM vocabulary")
def vocabulary(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(fit_vocabulary(only(term_arrays(spark, folder), "train"), "terms"), "idf")


@query(
    "vocabulary_size",
    TFIDF
    + """ SELECT CASE WHEN term LIKE '% %' THEN 'bigram' ELSE 'unigram' END AS kind, count(*) AS terms
          FROM vocabulary GROUP BY ALL""",
)
def vocabulary_size(spark: SparkSession, folder: str) -> DataFrame:
    kind = F.when(F.col("term").contains(" "), "bigram").otherwise("unigram").alias("kind")
    fitted = fit_vocabulary(only(term_arrays(spark, folder), "train"), "terms")
    return fitted.groupBy(kind).agg(F.count("*").alias("terms"))


def weights_of(spark: SparkSession, folder: str, split: str) -> DataFrame:
    rows = term_arrays(spark, folder)
    return tfidf(only(rows, split), "id", "terms", fit_vocabulary(only(rows, "train"), "terms"))


@query("tfidf_train", TFIDF + " SELECT id, term, round(weight, 6) AS weight FROM weights WHERE split = 'train'")
def tfidf_train(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(weights_of(spark, folder, "train"), "weight")


@query(
    "tfidf_transform_test",
    TFIDF + " SELECT id, term, round(weight, 6) AS weight FROM weights WHERE split = 'test'",
)
def tfidf_transform_test(spark: SparkSession, folder: str) -> DataFrame:
    """Held-out documents under the training vocabulary; unseen terms drop out."""
    return rounded(weights_of(spark, folder, "test"), "weight")


@query(
    "top_terms",
    TFIDF
    + """ SELECT id, term, round(weight, 6) AS weight, cast(rn AS int) AS rank
          FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY round(weight, 9) DESC, term) AS rn
                FROM weights WHERE split = 'test') WHERE rn <= 5""",
)
def top_term_rows(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(top_terms(weights_of(spark, folder, "test"), "id"), "weight")


FEATURES_SQL = """
        marks AS (SELECT list(term) FILTER (WHERE kind = 'positive') AS pos,
                         list(term) FILTER (WHERE kind = 'negative') AS neg,
                         list(term) FILTER (WHERE kind = 'indicator') AS ind FROM lexicon),
        hits AS (SELECT id, label, count(term) AS n_tokens,
                        count(*) FILTER (WHERE kind = 'positive') AS positive,
                        count(*) FILTER (WHERE kind = 'negative') AS negative,
                        count(*) FILTER (WHERE kind = 'indicator') AS indicator
                 FROM (SELECT id, label, unnest(CASE WHEN len(tokens) = 0 THEN [NULL] ELSE tokens END) AS term
                       FROM tokens) LEFT JOIN lexicon USING (term)
                 GROUP BY ALL),
        features AS (SELECT *, coalesce((positive - negative)::double / nullif(n_tokens, 0), 0) AS score
                     FROM hits)"""


def features(spark: SparkSession, folder: str, among: DataFrame | None = None) -> DataFrame:
    rows = stored_tokens(spark, folder)
    return features_of(rows, standins.distinct_terms(rows), among)


def features_of(tokens: DataFrame, terms: DataFrame, among: DataFrame | None = None) -> DataFrame:
    """Lexicon features of stored tokens, with the lexicon of all ``terms``; of the documents ``among`` some ids only.

    The ids are written first, so that they are broadcast by their true size and the token arrays stay where they are.
    """
    rows = tokens if among is None else tokens.join(settle(among.select("id"), "ids"), "id", "left_semi")
    return lex.lexicon_features(rows, "id", "tokens", standins.lexicon(terms), carry=["label"])


@query(
    "lexicon_features",
    sql_with(ALL_TOKENS + " lexicon", FEATURES_SQL)
    + " SELECT id, label, n_tokens, positive, negative, indicator, round(score, 6) AS score FROM features",
)
def lexicon_features(spark: SparkSession, folder: str) -> DataFrame:
    rows = stored_tokens(spark, folder, labelled=False)
    return rounded(features_of(rows, standins.distinct_terms(rows)), "score")


@query(
    "lexicon_features_joined",
    sql_with(ALL_TOKENS + " lexicon", FEATURES_SQL)
    + " SELECT id, label, n_tokens, positive, negative, indicator, round(score, 6) AS score FROM features",
)
def lexicon_features_joined(spark: SparkSession, folder: str) -> DataFrame:
    """The form for lexicons too large to put into an expression."""
    rows = stored_tokens(spark, folder, labelled=False)
    counted = lex.joined_features(rows, "id", "tokens", standins.lexicon(standins.distinct_terms(rows)), ["label"])
    return rounded(lex.with_score(counted), "score")


@query(
    "indicator_counts",
    sql_with(ALL_TOKENS)
    + f""" SELECT id, len(list_filter(tokens, lambda t: t IN ({", ".join(f"'{t}'" for t in INDICATOR_TERMS)})))
                  AS indicator FROM tokens""",
)
def indicator_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Hits of the built-in indicator terms."""
    counted = lex.lexicon_features(
        headline_tokens(spark, folder, labelled=False), "id", "tokens", lex.indicator_lexicon(spark)
    )
    return counted.select("id", "indicator")


@query(
    "lexicon_sizes",
    sql_with(ALL_TOKENS + " lexicon") + " SELECT kind, count(DISTINCT term) AS terms FROM lexicon GROUP BY kind",
)
def lexicon_sizes(spark: SparkSession, folder: str) -> DataFrame:
    terms = standins.distinct_terms(headline_tokens(spark, folder, labelled=False))
    return lex.lexicon_sizes(standins.lexicon(terms))


@query(
    "lexicon_rule",
    sql_with(TOKENS + " lexicon", FEATURES_SQL)
    + """
    SELECT id, label, prediction, label = prediction AS correct
    FROM (SELECT id, label, CASE WHEN score > 0.0::double OR indicator >= 40 THEN 1 ELSE 0 END AS prediction
          FROM features)""",
)
def lexicon_rule(spark: SparkSession, folder: str) -> DataFrame:
    ruled = lex.with_lexicon_rule(features(spark, folder), 0.0, 40, "label")
    return ruled.select("id", "label", "prediction", "correct")


# Whole documents are long, so besides the fixed small indicator thresholds the
# sweep also runs over ones that such texts may or may not reach.
LONG_THRESHOLDS = [10, 20, 40]


def _grid(indicator_thresholds: list[int]) -> str:
    points = [
        f"({i * len(indicator_thresholds) + j}, {s!r}::double, {c})"
        for i, s in enumerate(SENTIMENT_THRESHOLDS)
        for j, c in enumerate(indicator_thresholds)
    ]
    return f"grid(grid_pos, min_score, min_indicators) AS (VALUES {', '.join(points)})"


def sql_sweep(indicator_thresholds: list[int]) -> str:
    return sql_with(
        TOKENS + " lexicon",
        FEATURES_SQL,
        sql_split("features", "id", "label"),
        _grid(indicator_thresholds),
        """
        said AS (SELECT grid_pos, min_score, min_indicators, label,
                        CASE WHEN score > min_score OR indicator >= min_indicators THEN 1 ELSE 0 END AS p
                 FROM placed, grid WHERE split = 'val'),
        points AS (SELECT grid_pos, min_score, min_indicators,
                          avg(CASE WHEN label = p THEN 1.0::double ELSE 0 END) AS accuracy,
                          coalesce(2.0::double * sum(label * p) / nullif(sum(label) + sum(p), 0), 0) AS f1
                   FROM said GROUP BY ALL)""",
    )


def sweep_scores(spark: SparkSession, folder: str, indicator_thresholds: list[int]) -> DataFrame:
    placed = stratified_split(settle(features(spark, folder), "features"), "id", "label")
    counts = lex.sweep_lexicon(
        only(placed, "val"), "label", indicator_thresholds=indicator_thresholds
    )
    point = ["grid_pos", "min_score", "min_indicators"]
    return metrics.binary_scores(counts, by=point).select(*point, "accuracy", "f1")


@query(
    "lexicon_sweep",
    sql_sweep(INDICATOR_THRESHOLDS)
    + """ SELECT grid_pos, round(min_score, 3) AS min_score, min_indicators, round(accuracy, 4) AS accuracy,
                 round(f1, 4) AS f1 FROM points ORDER BY round(f1, 4) DESC, grid_pos LIMIT 10""",
)
def lexicon_sweep(spark: SparkSession, folder: str) -> DataFrame:
    top = sweep.top_points(sweep_scores(spark, folder, INDICATOR_THRESHOLDS))
    return rounded(rounded(top, "accuracy", "f1", digits=4), "min_score", digits=3)


@query(
    "lexicon_sweep_long",
    sql_sweep(LONG_THRESHOLDS)
    + """ SELECT grid_pos, round(min_score, 3) AS min_score, min_indicators, round(accuracy, 6) AS accuracy,
                 round(f1, 6) AS f1 FROM points""",
)
def lexicon_sweep_long(spark: SparkSession, folder: str) -> DataFrame:
    scores = sweep_scores(spark, folder, LONG_THRESHOLDS)
    return rounded(rounded(scores, "accuracy", "f1"), "min_score", digits=3)


@query(
    "lexicon_best",
    sql_sweep(LONG_THRESHOLDS)
    + """ SELECT grid_pos, round(min_score, 6) AS min_score, min_indicators, round(accuracy, 6) AS accuracy,
                 round(f1, 6) AS f1 FROM points ORDER BY round(f1, 12) DESC, grid_pos LIMIT 1""",
)
def lexicon_best(spark: SparkSession, folder: str) -> DataFrame:
    best = sweep.best_point(sweep_scores(spark, folder, LONG_THRESHOLDS))
    return rounded(best, "min_score", "accuracy", "f1")


@query(
    "lexicon_test_report",
    sql_sweep(LONG_THRESHOLDS)
    + """,
    best AS (SELECT * FROM points ORDER BY round(f1, 12) DESC, grid_pos LIMIT 1),
    test AS (SELECT label, CASE WHEN score > min_score OR indicator >= min_indicators THEN 1 ELSE 0 END AS p
             FROM placed, best WHERE split = 'test'),
    prf AS (SELECT c, coalesce(tp::double / nullif(predicted, 0), 0) AS p,
                   coalesce(tp::double / nullif(support, 0), 0) AS r,
                   coalesce(2.0::double * tp / nullif(predicted + support, 0), 0) AS f, support, tp
            FROM (SELECT c, count(*) FILTER (WHERE label = c AND p = c) AS tp,
                         count(*) FILTER (WHERE p = c) AS predicted, count(*) FILTER (WHERE label = c) AS support
                  FROM test, (SELECT DISTINCT unnest([label, p]) AS c FROM test) GROUP BY c))
    SELECT cast(c AS varchar) AS class, round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f1,
           cast(support AS bigint) AS support FROM prf
    UNION ALL SELECT 'accuracy', round(sum(tp)::double / sum(support), 6), round(sum(tp)::double / sum(support), 6),
           round(sum(tp)::double / sum(support), 6), cast(sum(support) AS bigint) FROM prf
    UNION ALL SELECT 'macro avg', round(avg(p), 6), round(avg(r), 6), round(avg(f), 6),
           cast(sum(support) AS bigint) FROM prf
    UNION ALL SELECT 'weighted avg', round(sum(p * support) / sum(support), 6),
           round(sum(r * support) / sum(support), 6), round(sum(f * support) / sum(support), 6),
           cast(sum(support) AS bigint) FROM prf""",
)
def lexicon_test_report(spark: SparkSession, folder: str) -> DataFrame:
    """Thresholds chosen on validation rows, reported on test rows."""
    placed = stratified_split(settle(features(spark, folder), "features"), "id", "label")
    point = ["grid_pos", "min_score", "min_indicators"]
    counts = lex.sweep_lexicon(only(placed, "val"), "label", indicator_thresholds=LONG_THRESHOLDS)
    best = sweep.best_point(metrics.binary_scores(counts, by=point)).first()
    ruled = lex.with_lexicon_rule(only(placed, "test"), best["min_score"], best["min_indicators"])
    report = metrics.class_report(metrics.confusion(ruled, "label", "prediction"))
    return rounded(report, "precision", "recall", "f1")


SIDE_BY_SIDE_SQL = (
    sql_with("lexicon").removeprefix("WITH")
    + ",\n"
    + FEATURES_SQL.strip()
    + """,
    side_by_side AS (
      SELECT p.id, p.label, round(f.score, 6) AS score, f.indicator,
             CASE WHEN f.score > 0.0::double OR f.indicator >= 40 THEN 1 ELSE 0 END AS rule_prediction,
             p.label = CASE WHEN f.score > 0.0::double OR f.indicator >= 40 THEN 1 ELSE 0 END AS rule_correct,
             t.top_terms
      FROM placed p JOIN features f USING (id)
      LEFT JOIN (SELECT id, string_agg(term, '|' ORDER BY rn) AS top_terms
                 FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY round(weight, 9) DESC, term) AS rn
                       FROM weights) WHERE rn <= 5 GROUP BY id) t USING (id)
      WHERE p.split = 'test')"""
)


@query("side_by_side_rule", TFIDF + ",\n" + SIDE_BY_SIDE_SQL + " SELECT * FROM side_by_side")
def side_by_side_rule(spark: SparkSession, folder: str) -> DataFrame:
    """Per test document: rule inputs, rule label, correctness and heaviest terms."""
    tokens = stored_tokens(spark, folder)
    terms = standins.distinct_terms(tokens)
    rows = terms_of(tokens, terms)
    test = only(rows, "test")
    weights = tfidf(test, "id", "terms", fit_vocabulary(only(rows, "train"), "terms"))
    listed = top_term_lists(weights, "id").withColumn("top_terms", F.array_join("top_terms", "|"))
    ruled = lex.with_lexicon_rule(features_of(tokens, terms, among=test), 0.0, 40, "label")
    return (
        test.select("id")
        .join(ruled, "id")
        .join(listed, "id", "left")
        .select(
            "id", "label", F.round("score", 6).alias("score"), "indicator",
            F.col("prediction").alias("rule_prediction"), F.col("correct").alias("rule_correct"), "top_terms",
        )
    )


@query(
    "headline_roundtrip",
    sql_with("texts")
    + """,
    rows AS (SELECT text, label, md5(concat_ws('|', coalesce(cast(label AS varchar), ''),
                                               CASE WHEN text IS NULL THEN '0' ELSE '1' END, text)) AS mark
             FROM headlines)
    SELECT mark || '-' || (row_number() OVER (PARTITION BY mark) - 1) AS id, text, label FROM rows""",
)
def headline_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """All texts through a CSV file with quotes and line breaks inside fields, and their ids by content."""
    path = new_folder(spark, "headlines-csv")
    rows = standins.headlines(spark, folder, labelled=False)
    rows.select(F.col("text").alias("news_headline"), F.col("label").cast("int").alias("is_sarcastic")).write.options(
        header=True, quote='"', escape='"'
    ).csv(path)
    return read_headlines(spark, path, many_lines=True)
