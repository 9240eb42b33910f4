from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from assayer.functions import fixed_values as fixed
from assayer.operators import classifiers, metrics, perceptron, tuning
from assayer.operators.split import with_folds
from assayer.plans import models as plans


@pytest.fixture
def separable(spark):
    """Documents about two topics, with words of neither in between."""
    df = spark.range(240).select("id", (F.col("id") % 2).cast("int").alias("label"))
    topic = F.concat(F.when(F.col("label") == 1, "yes").otherwise("no"), (F.col("id") % 5).cast("string"))
    terms = F.array(topic, F.concat(F.lit("other"), (F.col("id") % 7).cast("string")))
    weights = df.select("id", F.explode(terms).alias("term"), F.lit(0.7).alias("weight"))
    return df, weights


@pytest.mark.parametrize("method", ["mixed", "summed"])
def test_perceptron_separates(separable, method):
    docs, weights = separable
    models = perceptron.fit_perceptron(
        weights, docs, "id", "label", epochs=[15, 30], method=method, shards=3
    )
    judged = perceptron.predict(docs, weights, "id", models[30])
    assert metrics.accuracy(metrics.confusion(judged, "label", "prediction")).first()["accuracy"] == 1.0


def weights_of(model):
    return {r["term"]: (pytest.approx(r["w"]), r["n"]) for r in model.collect()}


def test_blocks_of_weights_train_alike(separable):
    """One block, three, and more than are read at once; with unknown words and a document without any."""
    docs, weights = separable
    docs = docs.unionByName(docs.sparkSession.createDataFrame([(900, 1), (901, 0)], "id bigint, label int"))
    runs = [
        perceptron.fit_summed(weights, docs, "id", "label", [1, 4], None, block_terms=size) for size in (100, 6, 2)
    ]
    assert weights_of(runs[0][4]).keys() > {perceptron.BIAS, "yes1"}
    for other in runs[1:]:
        for epochs in (1, 4):
            assert {r["term"]: (r["w"], r["n"]) for r in other[epochs].collect()} == weights_of(runs[0][epochs])


def test_training_rows_stay_where_they_are(separable):
    """An epoch shuffles corrections by term and nothing by document."""
    docs, weights = separable
    rows = weights.join(docs, "id").select(
        "id", F.when(F.col("label") == 1, 1.0).otherwise(-1.0).alias("y"), F.lit(0).alias("block"),
        F.abs(F.xxhash64("term")).alias("i"), "weight",
    )
    model = rows.select("block", "i", F.lit(0.0).alias("w")).distinct()
    with perceptron.KeptRows(rows, "id", 1) as kept:
        kept.held.count()
        plan = kept.misjudged(model)._jdf.queryExecution().executedPlan().toString()
    top = plan.split("InMemoryRelation")[0]
    assert "Window" in top and "Exchange hashpartitioning(id" not in top


def test_weights_are_broadcast_by_runs(spark, monkeypatch):
    """The driver builds a row for thousands of weights, not one for each; numbers may be missing in between."""
    sent, broadcast = [], perceptron.F.broadcast
    monkeypatch.setattr(perceptron.F, "broadcast", lambda df: sent.append(df) or broadcast(df))
    number = F.when(F.col("id") % 3000 == 0, -1).otherwise(F.col("id") + (1 << 33))
    rows = spark.range(20_000).select(
        (F.col("id") % 50).alias("doc"), F.lit(1.0).alias("y"), F.lit(0).alias("block"), number.alias("i"), F.lit(1.0).alias("weight")
    )
    known = rows.where((F.col("i") < 0) | (F.col("i") % 7 > 0)).select("block", "i").distinct()
    model = known.withColumn("w", F.when(F.col("i") % 50 < 20, -1.0).otherwise(0.5))
    with perceptron.KeptRows(rows, "doc", 1) as kept:
        found = sorted(r["i"] for r in kept.misjudged(model).collect())
    weight = {r["i"]: r["w"] for r in model.collect()}
    sums, dealt = {}, [(r["doc"], r["i"]) for r in rows.collect()]
    for doc, i in dealt:
        sums[doc] = sums.get(doc, 0) + weight.get(i, 0)
    assert found == sorted(i for doc, i in dealt if sums[doc] <= 0) and 0 < len(found) < 20_000
    assert len(sent) == 1 and sent[0].count() <= 7


def test_sides_meet_weights_in_a_merge(spark, small, monkeypatch):
    """The driver builds no table of all documents, and weights are not shuffled once more for it."""
    written, settle = {}, plans.settle

    def seen(df, name):
        written[name] = df
        return settle(df, name)

    monkeypatch.setattr(plans, "settle", seen)
    plans.perceptron_sides(spark, small)
    plan = written["weights"]._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin [id" in plan and "BroadcastHashJoin [id" not in plan
    assert plan.count("Exchange hashpartitioning(id") == 2  # documents and sides


def test_summed_stops_and_shares_the_last_model(separable):
    docs, weights = separable
    models = perceptron.fit_perceptron(weights, docs, "id", "label")
    assert list(models) == fixed.PERCEPTRON_EPOCHS and models[50] is models[2000]
    table = perceptron.sweep_epochs(models, docs, weights, "id", "label").orderBy("grid_pos").collect()
    assert [r["epochs"] for r in table] == fixed.PERCEPTRON_EPOCHS and {r["f1"] for r in table} == {1.0}


def test_training_without_documents(separable):
    docs, weights = separable
    model = perceptron.fit_summed(weights, docs.limit(0), "id", "label", [3])[3].collect()
    assert [(r["term"], r["w"]) for r in model] == [(perceptron.BIAS, 0.0)]


def test_mixing_refuses_a_large_vocabulary(separable, monkeypatch):
    docs, weights = separable
    monkeypatch.setattr(perceptron, "MIXED_TERMS", 3)
    with pytest.raises(ValueError, match="too many"):
        perceptron.fit_mixed(weights, docs, "id", "label", [1])


def test_mixing_is_repeatable_on_any_partitioning(separable):
    docs, weights = separable

    def run(parts):
        models = perceptron.fit_mixed(
            weights.repartition(parts), docs.repartition(parts), "id", "label", [3], None, shards=3
        )
        return {r["term"]: r["w"] for r in models[3].collect()}

    first, second = run(1), run(5)
    assert first.keys() == second.keys()
    assert all(first[t] == pytest.approx(second[t]) for t in first)


def test_documents_without_known_terms_get_the_bias(spark, separable):
    docs, weights = separable
    model = spark.createDataFrame([("yes1", 1.0, 9), (perceptron.BIAS, -0.5, 9)], perceptron.MODEL)
    unknown = spark.createDataFrame([(999,)], "id bigint")
    row = perceptron.predict(unknown, weights, "id", model).first()
    assert (row["margin"], row["prediction"]) == (-0.5, 0)


def test_stopper_waits_five_epochs():
    stop = perceptron.Stopper(1e-3)
    assert [stop.done(v) for v in (1.0, 0.5, 0.5, 0.5, 0.5, 0.5, 0.5)] == [False] * 6 + [True]
    assert not any(perceptron.Stopper(None).done(1.0) for _ in range(20))


def test_epoch_sweep(separable):
    docs, weights = separable
    models = perceptron.fit_mixed(weights, docs, "id", "label", [1, 20], shards=2)
    table = perceptron.sweep_epochs(models, docs, weights, "id", "label").orderBy("grid_pos").collect()
    assert [r["epochs"] for r in table] == [1, 20] and table[1]["f1"] == 1.0


def test_full_grids():
    sizes = {name: len(classifiers.param_maps(e, g)) for name, (e, g) in classifiers.candidates("y").items()}
    assert list(sizes.values()) == [18, 16, 18, 27]
    assert all(e.getSeed() == fixed.SEED for e, _ in classifiers.candidates("y").values() if e.hasParam("seed"))


@pytest.fixture
def noisy(spark):
    df = spark.range(600).select("id", F.rand(1).alias("a"), F.rand(2).alias("b"))
    df = df.withColumn("label", (F.col("a") + 0.3 * F.rand(3) > 0.65).cast("int"))
    return with_folds(df.withColumn("features", array_to_vector(F.array("a", "b"))), "id", folds=2).cache()


def test_comparison_of_tuned_classifiers(noisy):
    train, test = noisy.where("id % 4 > 0"), noisy.where("id % 4 = 0")
    grids = {
        "Logistic Regression": {"regParam": [0.01], "elasticNetParam": [0.0, 1.0], "maxIter": [20]},
        "Decision Tree": {"maxDepth": [3], "minInstancesPerNode": [1, 5], "impurity": ["gini"]},
    }
    table, models = classifiers.compare_classifiers(train, test, "label", grids, folds=2)
    rows = table.orderBy("position").collect()
    assert [r["model"] for r in rows] == list(grids)
    assert all(r["auc"] > 0.85 and r["recall"] == pytest.approx(r["accuracy"]) for r in rows)
    points = classifiers.tuning_table(models["Decision Tree"], train).collect()
    assert len(points) == 2 and "minInstancesPerNode=5" in points[1]["point"]


def test_families_share_fits():
    points = tuning.grid_points(fixed.BOOSTED_GRID)
    shared = tuning.families(points, "maxIter")
    assert len(points) == 27 and len(shared) == 9
    assert all(params["maxIter"] == 50 and [v for _, v in members] == [10, 20, 50] for params, members in shared)
    assert sorted(i for _, members in shared for i, _ in members) == list(range(27))
    assert len(tuning.families(points, None)) == 27


def test_nested_boosting_equals_separate_fits(noisy):
    """Areas from prefixes of one model against models fitted by themselves, fold by fold."""
    grid = {"maxIter": [1, 3, 5], "maxDepth": [2], "stepSize": [0.1]}
    estimator = GBTClassifier(labelCol="label", seed=fixed.SEED)
    tuned = tuning.tune(noisy, estimator, grid, "label", folds=2)
    exact = BinaryClassificationEvaluator(labelCol="label", numBins=0)
    for i, rounds in enumerate(grid["maxIter"]):
        areas = []
        for k in range(2):
            model = estimator.copy({estimator.maxIter: rounds, estimator.maxDepth: 2}).fit(noisy.where(F.col("fold") != k))
            areas.append(exact.evaluate(model.transform(noisy.where(F.col("fold") == k))))
        assert tuned.areas[i] == pytest.approx(np.mean(areas))
    assert tuned.points[i]["maxIter"] == 5 and tuned.model.getNumTrees == tuned.best["maxIter"]


@pytest.mark.parametrize("name", ["Random Forest", "Logistic Regression"])
def test_tuning_equals_separate_fits(noisy, name):
    grids = {
        "Random Forest": {"numTrees": [2, 4], "maxDepth": [3], "minInstancesPerNode": [1, 2]},
        "Logistic Regression": {"regParam": [0.01, 1.0], "elasticNetParam": [0.5], "maxIter": [5, 10]},
    }
    estimator, _ = classifiers.candidates("label")[name]
    tuned = tuning.tune(noisy, estimator, grids[name], "label", folds=2)
    exact = BinaryClassificationEvaluator(labelCol="label", numBins=0)
    for point, area in zip(classifiers.param_maps(estimator, grids[name]), tuned.areas):
        areas = [
            exact.evaluate(estimator.copy(point).fit(noisy.where(f"fold <> {k}")).transform(noisy.where(f"fold = {k}")))
            for k in range(2)
        ]
        assert area == pytest.approx(np.mean(areas))


def test_first_best():
    assert tuning.first_best([0.5, 0.75, 0.75 + 1e-15, None]) == 1
    assert tuning.first_best([None, 0.0]) == 1


def test_a_fold_of_one_class_does_not_count(noisy):
    """The third fold holds negatives only, so the mean is that of the other two."""
    rows = noisy.where("id % 10 < 9 OR label = 0").withColumn("fold", F.expr("if(id % 10 = 9, 2, fold)"))
    estimator, _ = classifiers.candidates("label")["Decision Tree"]
    tuned = tuning.tune(rows, estimator, {"maxDepth": [2]}, "label", folds=3)
    model = estimator.copy({estimator.maxDepth: 2})
    exact = BinaryClassificationEvaluator(labelCol="label", numBins=0)
    areas = [
        exact.evaluate(model.fit(rows.where(f"fold <> {k}")).transform(rows.where(f"fold = {k}"))) for k in range(2)
    ]
    assert tuned.areas[0] == pytest.approx(np.mean(areas))


def test_bounded_rows_do_not_depend_on_partitions(noisy):
    first, second = ({r["id"] for r in tuning.bounded(noisy.repartition(n), "id", 50).collect()} for n in (1, 7))
    assert first == second and len(first) == 50


def test_layer_sweep_keeps_the_best(noisy):
    table, model = classifiers.sweep_layers(noisy, noisy, "label", 2, 2, hidden=[(2,), (4,)], max_iter=30)
    rows = table.orderBy("grid_pos").collect()
    best = max(rows, key=lambda r: (r["f1"], -r["grid_pos"]))
    assert model.getLayers() == [2, *map(int, best["hidden_layers"].split(",")), 2]
    assert not np.isnan(best["f1"])


def test_only_a_sides_rows_are_assembled(spark, monkeypatch):
    sizes, assemble = [], plans.assemble

    def counted(rows, columns):
        sizes.append(rows.count())
        return assemble(rows, columns)

    monkeypatch.setattr(plans, "assemble", counted)
    monkeypatch.setattr(plans, "FIT_ROWS", 50)
    train, test = plans.clinical_sides(spark, "/root/testdata/sf0.001")
    assert sizes == [50, test.count()] and train.count() == 50 and train.columns == [*test.columns, "fold"]
