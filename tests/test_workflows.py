from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from assayer.plans.image_files import png
from assayer.plans.workflows import (
    compare_clinical_models,
    compare_headline_methods,
    compare_image_methods,
)
from tests.test_streaming import write


def test_clinical(spark, tmp_path):
    write(tmp_path, "rows.csv", 400)
    grids = {"Decision Tree": {"maxDepth": [2, 3], "minInstancesPerNode": [1], "impurity": ["gini"]}}
    for fit_on in ("all", "train"):
        out = compare_clinical_models(spark, str(tmp_path / "rows.csv"), grids, folds=2, fit_on=fit_on)
        row = out.scores.first()
        assert row["model"] == "Decision Tree" and row["auc"] > 0.7
        assert out.tuning["Decision Tree"].count() == 2
        assert out.reports["best"].first()["model"] == "Decision Tree"


def test_headlines(spark):
    rng = random.Random(2)
    rows = []
    for i in range(200):
        label = i % 2
        own = rng.sample(["amazing", "joyful", "delights"], 2) if label else rng.sample(["budget", "grim", "fails"], 2)
        rows.append((i, " ".join([*own, *rng.sample(["the", "city", "council", "team", "votes"], 3)]) + "!", label))
    headlines = spark.createDataFrame(rows, "id bigint, text string, label int")
    lexicon = spark.createDataFrame(
        [("joyful", "positive"), ("delights", "positive"), ("grim", "negative"), ("fails", "negative")],
        "term string, kind string",
    )
    out = compare_headline_methods(headlines, lexicon, ["the"], match_on="surface", epochs=[5, 20], shards=2)
    scores = {r["method"]: r["f1"] for r in out.scores.collect()}
    assert scores["perceptron"] == 1.0 and scores["lexicon rule"] > 0.9
    assert out.tuning["lexicon rule"].count() == 42 and out.tuning["perceptron"].count() == 2
    both = out.rows.collect()
    assert len(both) == 30 and all(r["ml_correct"] and 1 <= len(r["top_terms"]) <= 5 for r in both)
    # The default call: six numbers of epochs, stopped when they bring nothing more.
    plain = compare_headline_methods(headlines, lexicon, ["the"])
    assert plain.tuning["perceptron"].count() == 6
    assert {r["method"]: r["f1"] for r in plain.scores.collect()}["perceptron"] > 0.9
    mixed = compare_headline_methods(headlines, lexicon, ["the"], match_on="surface", epochs=[5], method="mixed")
    assert {r["method"]: r["f1"] for r in mixed.scores.collect()}["perceptron"] == 1.0
    # Stemmed tokens no longer match words that stemming changes.
    stemmed = compare_headline_methods(headlines, lexicon, ["the"], epochs=[5], shards=2)
    assert stemmed.rows.agg(F.sum("positive")).first()[0] < out.rows.agg(F.sum("positive")).first()[0]


def test_a_missing_class_folder_raises(spark, tmp_path):
    for name in ("Potato___Early_blight", "Potato___healthy"):
        (tmp_path / name).mkdir()
        (tmp_path / name / "0.jpg").write_bytes(png(np.full((4, 4, 3), 90, np.uint8)))
    with pytest.raises(ValueError, match="absent classes"):
        compare_image_methods(spark, str(tmp_path), image_side=4, hidden=[(4,)], max_iter=5)


def test_images(spark, tmp_path):
    rng = np.random.default_rng(1)
    colours = {"Potato___Early_blight": (150, 100, 50), "Potato___Late_blight": (30, 25, 20), "Potato___healthy": (60, 180, 60)}
    for name, colour in colours.items():
        (tmp_path / name).mkdir()
        for i in range(20):
            pixels = np.clip(np.array(colour) + rng.integers(-10, 11, (9, 9, 3)), 0, 255).astype(np.uint8)
            (tmp_path / name / f"{i}.jpg").write_bytes(png(pixels))
    out = compare_image_methods(spark, str(tmp_path), image_side=4, hidden=[(4,)], max_iter=40)
    scores = {r["method"]: r["f1"] for r in out.scores.collect()}
    assert scores == {"colour rule": 1.0, "network": 1.0}
    assert out.tuning["colour rule"].count() == 49
    assert out.rows.count() == 9
