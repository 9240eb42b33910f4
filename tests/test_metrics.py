from __future__ import annotations

import math
import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from assayer.operators import metrics

# Class 2 is never predicted, so its precision is nothing over nothing.
HAND_WORKED = [(0, 0, 5), (0, 1, 1), (1, 0, 2), (1, 1, 2), (2, 0, 1)]


@pytest.fixture
def counts(spark):
    return spark.createDataFrame(HAND_WORKED, "label int, prediction int, n bigint")


def test_hand_worked_table(counts):
    weighted = metrics.weighted_scores(counts).first()
    macro = metrics.macro_scores(counts).first()
    assert weighted["accuracy"] == pytest.approx(7 / 11)
    assert weighted["recall"] == pytest.approx(7 / 11)
    assert weighted["f1"] == pytest.approx(46 / 77)
    assert macro["f1"] == pytest.approx(3 / 7)
    assert metrics.binary_scores(counts).first()["f1"] == pytest.approx(4 / 7)


def test_report_lines(counts):
    lines = {r["class"]: r for r in metrics.class_report(counts).collect()}
    assert set(lines) == {"0", "1", "2", "accuracy", "macro avg", "weighted avg"}
    assert lines["2"]["precision"] == 0.0 and lines["2"]["support"] == 1
    assert lines["accuracy"]["f1"] == pytest.approx(7 / 11)
    assert lines["macro avg"]["f1"] == pytest.approx(3 / 7)
    assert lines["weighted avg"]["f1"] == pytest.approx(46 / 77)
    assert lines["macro avg"]["support"] == 11


def test_matrix_has_absent_cells(counts):
    rows = {r["label"]: (r["pred_0"], r["pred_1"], r["pred_2"]) for r in
            metrics.confusion_matrix(counts, [0, 1, 2]).collect()}
    assert rows == {0: (5, 1, 0), 1: (2, 2, 0), 2: (1, 0, 0)}


def test_a_class_only_predicted_counts_in_the_macro_mean(spark):
    counts = spark.createDataFrame([(0, 0, 1), (0, 3, 1)], "label int, prediction int, n bigint")
    assert metrics.macro_scores(counts).first()["recall"] == pytest.approx(0.25)


def test_weighted_scores_equal_spark_evaluator(spark):
    rng = random.Random(1)
    rows = [(float(rng.randrange(4)), float(rng.randrange(4))) for _ in range(500)]
    df = spark.createDataFrame(rows, "label double, prediction double")
    ours = metrics.weighted_scores(metrics.confusion(df, "label", "prediction")).first()
    for name, theirs in (
        ("accuracy", "accuracy"), ("f1", "f1"),
        ("precision", "weightedPrecision"), ("recall", "weightedRecall"),
    ):
        value = MulticlassClassificationEvaluator(metricName=theirs).evaluate(df)
        assert ours[name] == pytest.approx(value)


@pytest.mark.parametrize("levels", [3, 40, 100_000])
def test_auc_equals_pair_counting_and_exact_evaluator(spark, levels):
    rng = random.Random(levels)
    rows = [(rng.randrange(levels) / levels, int(rng.random() < 0.3)) for _ in range(400)]
    df = spark.createDataFrame(rows, "score double, label int")
    pairs = [(p, n) for p, a in rows if a for n, b in rows if not b]
    wins = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p, n in pairs)
    ours = metrics.auc(df, "label", "score").first()["auc"]
    assert ours == pytest.approx(wins / len(pairs))
    exact = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label", numBins=0)
    assert ours == pytest.approx(exact.evaluate(df))


def test_auc_does_not_depend_on_partitioning_or_a_hot_score(spark):
    # A third of all rows share one score.
    df = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, 0.5).otherwise(F.rand(7)).alias("score"),
        (F.col("id") % 5 == 0).cast("int").alias("label"),
    ).cache()
    one = metrics.auc(df.repartition(1), "label", "score").first()["auc"]
    many = metrics.auc(df.repartition(13), "label", "score").first()["auc"]
    assert one == pytest.approx(many, abs=1e-12)


def test_auc_of_one_class_is_null(spark):
    df = spark.createDataFrame([(0.1, 1), (0.2, 1)], "score double, label int")
    assert metrics.auc(df, "label", "score").first()["auc"] is None


def test_best_model_takes_the_first_of_a_tie(spark):
    rows = [("a", 0.5), ("b", 0.9), ("c", 0.9), ("d", None)]
    parts = [spark.createDataFrame([r], "model string, auc double") for r in rows]
    assert metrics.best_model(metrics.compare(parts)).first()["model"] == "b"


def test_evaluate_one_row(spark):
    df = spark.createDataFrame(
        [(1, 1, 0.9), (0, 0, 0.1), (0, 1, 0.8), (1, 0, 0.3)], "label int, prediction int, score double"
    )
    row = metrics.evaluate(df, "m", "label", "prediction", "score").first()
    assert row["accuracy"] == 0.5 and math.isclose(row["auc"], 0.75)


def test_grouped_auc_equals_one_by_one(spark):
    rng = random.Random(6)
    rows = [(rng.choice("abc"), rng.randint(0, 1), rng.choice([0.1, 0.2, 0.2, 0.5, rng.random()])) for _ in range(900)]
    rows += [("one", 1, 0.3), ("one", 1, 0.4), ("null", None, 0.1), ("null", 1, None)]
    df = spark.createDataFrame(rows, "model string, label int, score double").repartition(7)
    got = {r["model"]: r["auc"] for r in metrics.auc(df, "label", "score", ["model"]).collect()}
    assert got.keys() == {"a", "b", "c", "one"} and got["one"] is None
    for name in "abc":
        one = metrics.auc(df.where(F.col("model") == name), "label", "score").first()["auc"]
        assert got[name] == pytest.approx(one)
        pos = [s for m, y, s in rows if m == name and y == 1]
        neg = [s for m, y, s in rows if m == name and y == 0]
        wins = sum((p > n) + (p == n) / 2 for p in pos for n in neg)
        assert got[name] == pytest.approx(wins / (len(pos) * len(neg)))


def test_models_are_compared_in_one_scan(spark, tmp_path):
    path = str(tmp_path / "rows")
    spark.range(500).select((F.col("id") % 2).alias("label"), F.rand(1).alias("x"), F.rand(2).alias("y")).write.parquet(path)
    df = spark.read.parquet(path)
    scored = {c: ((F.col(c) > 0.5).cast("int"), F.col(c)) for c in ("x", "y")}
    rows = metrics.stacked(df, "label", scored)
    plan = metrics.score_counts(rows, "label", "prediction", "score", ["model"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1
    table = metrics.evaluate_models(rows, ["y", "x"])
    # what is read afterwards is the stored counts, not the rows
    assert not any(path in name for name in table.inputFiles())
    got = {r["model"]: r for r in table.collect()}
    assert (got["y"]["position"], got["x"]["position"]) == (0, 1)
    for c in ("x", "y"):
        one = metrics.evaluate(df.select("label", scored[c][0].alias("p"), c), c, "label", "p", c).first()
        for name in ("accuracy", "auc", "f1", "precision", "recall"):
            assert got[c][name] == pytest.approx(one[name])
