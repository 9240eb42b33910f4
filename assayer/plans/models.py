"""Queries that train: tuned classifiers, perceptron, layer sweep, side by side."""

from __future__ import annotations

from pyspark.ml import Model
from pyspark.ml.classification import DecisionTreeClassificationModel, DecisionTreeClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assayer.functions.fixed_values import FOLDS, PERCEPTRON_EPOCHS, SEED
from assayer.operators import classifiers, metrics, perceptron, sweep
from assayer.operators.impute import impute
from assayer.operators.lexicon import with_lexicon_rule
from assayer.operators.split import hash_split, stratified_split, with_folds
from assayer.operators.tfidf import fit_vocabulary, tfidf, top_term_lists
from assayer.operators.tuning import bounded
from assayer.operators.vectors import assemble, fit_scaler, scale
from assayer.plans import headlines
from assayer.plans.clinical import FIVE, IMPUTED, PRF_SQL, REPORT_SQL, sql_auc, sql_weighted
from assayer.plans.standins import FEATURES, SENTINELS, clinical, sql_with, vectors
from assayer.session import new_folder, settle

QUERIES = {}
SQL = {}


def query(name: str, sql: str | None = None):
    def register(build):
        QUERIES[name] = build
        if sql is not None:
            SQL[name] = sql
        return build

    return register


FIT_ROWS = 2_000  # most labelled rows that classifiers are tuned and fitted on; tests use all held-out rows


def clinical_sides(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Imputed, assembled training rows with folds, at most ``FIT_ROWS`` of them, and all test rows.

    No filter gets below the assembler, which may raise, so rows are chosen first and only those of a side assembled.
    """
    rows = hash_split(impute(clinical(spark, folder), SENTINELS), "id").select("id", *FEATURES, "outcome", "split")
    train = assemble(bounded(headlines.only(rows, "train"), "id", FIT_ROWS), FEATURES)
    test = assemble(headlines.only(rows, "test"), FEATURES)
    kept = ["id", "features", "outcome", "split"]
    return with_folds(train.select(*kept), "id", FOLDS), test.select(*kept)


def tuned(name: str):
    """All grid points of a classifier over five folds, and the best one's metrics on test rows."""

    def build(spark: SparkSession, folder: str) -> DataFrame:
        train, test = clinical_sides(spark, folder)
        grid = classifiers.candidates("outcome")[name][1]
        return classifiers.compare_classifiers(train, test, "outcome", {name: grid})[0]

    return build


query("logreg_cv")(tuned("Logistic Regression"))
query("tree_cv")(tuned("Decision Tree"))
query("forest_cv")(tuned("Random Forest"))
query("gbt_cv")(tuned("Gradient Boosted Trees"))


@query("tuning_table")
def tuning_table(spark: SparkSession, folder: str) -> DataFrame:
    """Mean AUC over the folds for each grid point of the decision tree."""
    train, _ = clinical_sides(spark, folder)
    estimator, grid = classifiers.candidates("outcome")["Decision Tree"]
    return classifiers.tuning_table(classifiers.tune(train, estimator, grid, "outcome"), train)


# Columns with few values each, so that the tree tries every cut between two of them.
STUMP_FEATURES = ["pregnancies", "tax", "discount", "quantity"]
STUMP_BINS = 64

# A tree of depth one: per column and value the class counts up to it, per cut the impurity that is left, the
# best cut of all. Sides that vote alike are one leaf.
STUMP_SQL = sql_with("clinical", IMPUTED) + f""",
    sides AS (SELECT *, cast('0x' || substr(md5(id || '|42'), 1, 7) AS bigint) % 100 < 80 AS train FROM imputed),
    long AS ({" UNION ALL ".join(
        f"SELECT {i} AS f, {c}::double AS v, outcome FROM sides WHERE train" for i, c in enumerate(STUMP_FEATURES)
    )}),
    steps AS (SELECT f, v, sum(outcome)::bigint AS pos, sum(1 - outcome)::bigint AS neg FROM long GROUP BY ALL),
    cuts AS (SELECT f, (v + lead(v) OVER w) / 2 AS cut, sum(pos) OVER w AS lp, sum(neg) OVER w AS ln,
                    sum(pos) OVER (PARTITION BY f) AS ap, sum(neg) OVER (PARTITION BY f) AS an
             FROM steps WINDOW w AS (PARTITION BY f ORDER BY v)),
    best AS (SELECT f, cut, lp, ln, ap - lp AS rp, an - ln AS rn, ap, an FROM cuts WHERE cut IS NOT NULL
             ORDER BY lp::double * ln / (lp + ln) + (ap - lp)::double * (an - ln) / (ap - lp + an - ln), f, cut LIMIT 1),
    stump AS (SELECT id, outcome, train, (CASE f {" ".join(f"WHEN {i} THEN {c}" for i, c in enumerate(STUMP_FEATURES))}
                                  END) <= cut AS low, best.* FROM sides, best),
    scored AS (SELECT id, outcome,
                      CASE WHEN (lp > ln) = (rp > rn) THEN ap WHEN low THEN lp ELSE rp END::double AS score,
                      CASE WHEN low THEN lp > ln ELSE rp > rn END::int AS prediction
               FROM stump WHERE NOT train)"""


def stored_stump(spark: SparkSession, folder: str) -> tuple[Model, DataFrame]:
    """A depth-one tree fitted on all training rows, stored and loaded again, and the test rows."""
    filled = impute(clinical(spark, folder), SENTINELS)
    rows = hash_split(assemble(filled, STUMP_FEATURES), "id").select("id", "features", "outcome", "split")
    tree = DecisionTreeClassifier(labelCol="outcome", maxDepth=1, maxBins=STUMP_BINS, seed=SEED)
    path = new_folder(spark, "stump")
    tree.fit(headlines.only(rows, "train")).write().save(path)
    return DecisionTreeClassificationModel.load(path), headlines.only(rows, "test")


@query("tree_stump_scores", STUMP_SQL + " SELECT id, outcome, prediction, score FROM scored")
def tree_stump_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Test rows scored by a stored model: predicted class, and training rows of class 1 in the leaf."""
    model, test = stored_stump(spark, folder)
    return classifiers.score_rows(model, test, ["id", "outcome"])


@query(
    "tree_stump_metrics",
    STUMP_SQL
    + f""" SELECT 'stump' AS model, round(w.accuracy, 6) AS accuracy, round({sql_auc('scored', 'score')}, 6) AS auc,
           round(w.f1, 6) AS f1, round(w.precision, 6) AS precision, round(w.recall, 6) AS recall
    FROM ({sql_weighted('scored')}) w""",
)
def tree_stump_metrics(spark: SparkSession, folder: str) -> DataFrame:
    model, test = stored_stump(spark, folder)
    return headlines.rounded(classifiers.evaluate_model(model, test, "stump", "outcome"), *FIVE)


def perceptron_sides(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Split documents with their weights under the training vocabulary."""
    rows = headlines.term_arrays(spark, folder)  # read from stored lemmas, so the longer arrays are not stored too
    vocabulary = fit_vocabulary(headlines.only(rows, "train"), "terms")
    sides = settle(rows.select("id", "label", "split"), "sides")
    # Weights come out dealt and sorted by document, so a merge moves the sides alone and the driver builds no table of them.
    split = sides.select("id", "split").hint("merge")
    weights = settle(tfidf(rows, "id", "terms", vocabulary).join(split, "id"), "weights")
    return {"rows": sides, "weights": weights}


SUMMED_EPOCHS = 3


def _summed_sql() -> str:
    """The first epochs written out one after the other."""
    parts = [
        "docs AS (SELECT id, CASE WHEN label = 1 THEN 1.0::double ELSE -1.0::double END AS y "
        "FROM placed WHERE split = 'train')",
        "train AS (SELECT w.id, y, term, weight FROM weights w JOIN docs USING (id) WHERE split = 'train')",
        "m0 AS (SELECT term, 0.0::double AS w FROM train GROUP BY term)",
        "b0 AS (SELECT 0.0::double AS b)",
    ]
    for e in range(SUMMED_EPOCHS):
        parts += [
            f"""wrong{e} AS (
                SELECT id, y FROM docs LEFT JOIN
                  (SELECT id, sum(weight * w) AS s FROM train JOIN m{e} USING (term) GROUP BY id) USING (id), b{e}
                WHERE y * (coalesce(s, 0) + b) <= 0)""",
            f"""m{e + 1} AS (
                SELECT term, w + coalesce(shift, 0) / (SELECT count(*) FROM docs) AS w
                FROM m{e} LEFT JOIN (SELECT term, sum(y * weight) AS shift FROM train
                                     WHERE id IN (SELECT id FROM wrong{e}) GROUP BY term) USING (term))""",
            f"""b{e + 1} AS (SELECT b + coalesce((SELECT sum(y) FROM wrong{e}), 0)
                                     / (SELECT count(*) FROM docs) AS b FROM b{e})""",
        ]
    return headlines.TFIDF + ",\n" + ",\n".join(parts)


@query("perceptron_summed", _summed_sql() + f" SELECT term, round(w, 6) AS w FROM m{SUMMED_EPOCHS}")
def perceptron_summed(spark: SparkSession, folder: str) -> DataFrame:
    """Term weights after three epochs of the form without shared weights."""
    sides = perceptron_sides(spark, folder)
    models = perceptron.fit_summed(
        headlines.only(sides["weights"], "train"), headlines.only(sides["rows"], "train"),
        "id", "label", [SUMMED_EPOCHS], tol=None,
    )
    terms = models[SUMMED_EPOCHS].where(F.col("term") != perceptron.BIAS)
    return terms.select("term", F.round("w", 6).alias("w"))


# Training as a recursion over epochs: the weights of all terms and, in every row, how many epochs in a row have
# not bettered the best loss. The bias is a term that each document holds with weight 1.
EPOCHS_SQL = (
    "WITH RECURSIVE"
    + headlines.TFIDF.removeprefix("WITH")
    + f""",
    bias AS (SELECT chr(1) || 'bias' AS term),
    docs AS (SELECT id, CASE WHEN label = 1 THEN 1.0::double ELSE -1.0::double END AS y
             FROM placed WHERE split = 'train'),
    size AS (SELECT count(*) AS size FROM docs),
    train AS MATERIALIZED (SELECT id, y, term, weight FROM weights JOIN docs USING (id)
                           UNION ALL SELECT id, y, term, 1.0::double FROM docs, bias),
    epochs AS (
      SELECT 0 AS epoch, term, 0.0::double AS w, 0 AS idle, 'Infinity'::double AS best
      FROM (SELECT DISTINCT term FROM train)
      UNION ALL
      (WITH wrong AS (SELECT id FROM train JOIN epochs USING (term) GROUP BY id, y HAVING y * sum(weight * w) <= 0),
            shifts AS (SELECT term, sum(y * weight) AS shift FROM train JOIN wrong USING (id) GROUP BY term),
            loss AS (SELECT count(*) / any_value(size) AS loss FROM wrong, size)
       SELECT epoch + 1, term, w + coalesce(shift, 0) / size,
              CASE WHEN coalesce(loss, 0) > best - 0.001::double THEN idle + 1 ELSE 0 END, least(best, coalesce(loss, 0))
       FROM epochs LEFT JOIN shifts USING (term), loss, size
       WHERE idle < {perceptron.PATIENCE} AND epoch < {max(PERCEPTRON_EPOCHS)})),
    wanted(grid_pos, wanted_epochs) AS (VALUES {', '.join(f"({i}, {e})" for i, e in enumerate(PERCEPTRON_EPOCHS))}),
    last AS (SELECT max(epoch) AS last FROM epochs),
    models AS (SELECT grid_pos, wanted_epochs, term, w
               FROM wanted JOIN epochs ON epoch = least(wanted_epochs, (SELECT last FROM last))),
    held_out AS (SELECT id, split, term, weight FROM weights WHERE split <> 'train'
                 UNION ALL SELECT id, split, term, 1.0::double FROM placed, bias WHERE split <> 'train'),
    judged AS (SELECT grid_pos, wanted_epochs, id, split, CASE WHEN sum(weight * w) > 0 THEN 1 ELSE 0 END AS prediction
               FROM held_out JOIN models USING (term) GROUP BY ALL),
    scores AS (SELECT grid_pos, any_value(wanted_epochs) AS epochs,
                      coalesce(2.0::double * sum(label * prediction) / nullif(sum(label) + sum(prediction), 0), 0) AS f1,
                      avg(CASE WHEN label = prediction THEN 1.0::double ELSE 0 END) AS accuracy
               FROM judged JOIN placed USING (id) WHERE judged.split = 'val' GROUP BY grid_pos),
    tested AS (SELECT id, label, prediction FROM judged JOIN placed USING (id)
               WHERE judged.split = 'test'
                 AND grid_pos = (SELECT grid_pos FROM scores ORDER BY round(f1, 12) DESC, grid_pos LIMIT 1))"""
)


def trained(spark: SparkSession, folder: str) -> tuple[dict[str, DataFrame], dict[int, DataFrame], DataFrame]:
    """The default form, all six numbers of epochs from one run."""
    sides = perceptron_sides(spark, folder)
    models = perceptron.fit_perceptron(
        headlines.only(sides["weights"], "train"), headlines.only(sides["rows"], "train"), "id", "label"
    )
    scores = perceptron.sweep_epochs(
        models, headlines.only(sides["rows"], "val"), headlines.only(sides["weights"], "val"), "id", "label"
    )
    return sides, models, settle(scores, "epoch-scores")


@query(
    "perceptron_sweep",
    EPOCHS_SQL + " SELECT grid_pos, epochs, round(f1, 6) AS f1, round(accuracy, 6) AS accuracy FROM scores",
)
def perceptron_sweep(spark: SparkSession, folder: str) -> DataFrame:
    return headlines.rounded(trained(spark, folder)[2], "f1", "accuracy")


@query("perceptron_test_report", EPOCHS_SQL + ",\nscored AS (SELECT * FROM tested)," + PRF_SQL + REPORT_SQL)
def perceptron_test_report(spark: SparkSession, folder: str) -> DataFrame:
    """Epochs chosen on validation documents, reported on test documents."""
    sides, models, scores = trained(spark, folder)
    best = sweep.best_point(scores).first()["epochs"]
    judged = perceptron.predict(
        headlines.only(sides["rows"], "test"), headlines.only(sides["weights"], "test"), "id", models[best]
    )
    report = metrics.class_report(metrics.confusion(judged, "label", "prediction"))
    return headlines.rounded(report, "precision", "recall", "f1")


@query(
    "side_by_side",
    EPOCHS_SQL
    + ",\n"
    + headlines.SIDE_BY_SIDE_SQL
    + """
    SELECT s.*, t.prediction AS ml_prediction, s.label = t.prediction AS ml_correct
    FROM side_by_side s JOIN tested t USING (id)""",
)
def side_by_side(spark: SparkSession, folder: str) -> DataFrame:
    """Per test document the rule's and the perceptron's label, and the heaviest terms."""
    sides, models, scores = trained(spark, folder)
    best = sweep.best_point(scores).first()["epochs"]
    test = headlines.only(sides["rows"], "test")
    weights = headlines.only(sides["weights"], "test")
    learned = perceptron.predict(test.select("id"), weights, "id", models[best])
    ruled = with_lexicon_rule(headlines.features(spark, folder, among=test), 0.0, 40, "label")
    return (
        test.select("id")
        .join(ruled, "id")
        .join(learned.select("id", F.col("prediction").alias("ml_prediction")), "id")
        .join(top_term_lists(weights, "id"), "id", "left")
        .select(
            "id", "label", F.round("score", 6).alias("score"), "indicator",
            F.col("prediction").alias("rule_prediction"), F.col("correct").alias("rule_correct"),
            "ml_prediction", (F.col("label") == F.col("ml_prediction")).alias("ml_correct"),
            F.array_join("top_terms", "|").alias("top_terms"),
        )
    )


def scaled_vectors(spark: SparkSession, folder: str) -> DataFrame:
    placed = stratified_split(vectors(spark, folder), "id", "label")
    scaler = fit_scaler(headlines.only(placed, "train"), "features")
    scaled = scale(placed, "features", scaler)
    return scaled.select("id", "label", "split", array_to_vector("scaled").alias("features"))


@query("mlp_sweep")
def mlp_sweep(spark: SparkSession, folder: str) -> DataFrame:
    """All layouts at full length, trained on at most ``FIT_ROWS`` rows and compared on all validation rows."""
    rows = scaled_vectors(spark, folder)
    train = bounded(headlines.only(rows, "train"), "id", FIT_ROWS)
    return classifiers.sweep_layers(train, headlines.only(rows, "val"), "label", 64, 10)[0]
