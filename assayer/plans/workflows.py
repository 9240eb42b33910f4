"""The three comparisons end to end, on files and tables the caller names."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assayer.functions import fixed_values as fixed
from assayer.functions.text import ngram_terms
from assayer.operators import classifiers, colour, metrics, perceptron, sweep
from assayer.operators import lexicon as lex
from assayer.operators.images import image_features, resize_images
from assayer.operators.impute import fill_sentinels, sentinel_means
from assayer.operators.roots import stem_dictionary
from assayer.operators.split import hash_split, stratified_split, with_folds
from assayer.operators.tfidf import fit_vocabulary, tfidf, top_term_lists
from assayer.operators.tokens import replace_terms, with_tokens
from assayer.operators.vectors import assemble, fit_scaler, scale, with_class_codes
from assayer.session import settle
from assayer.sources.images import readable, scan_images
from assayer.sources.tables import (
    CLINICAL_SCHEMA,
    OUTCOME,
    PREDICTORS,
    SENTINEL_COLUMNS,
    read_csv,
    stream_csv,
)
from assayer.sources.versions import ModelStore
from assayer.streaming.retrain import Retrainer, start


@dataclass
class Comparison:
    """What a comparison of two or more methods yields, all as tables."""

    scores: DataFrame
    tuning: dict[str, DataFrame]
    reports: dict[str, DataFrame]
    rows: DataFrame | None = None


def side(df: DataFrame, name: str) -> DataFrame:
    return df.where(F.col("split") == name)


def compare_clinical_models(
    spark: SparkSession,
    path: str,
    grids: dict[str, dict] | None = None,
    folds: int = fixed.FOLDS,
    seed: int = fixed.SEED,
    fit_on: str = "all",
    parallelism: int = classifiers.PARALLELISM,
) -> Comparison:
    """Clinical CSV to the comparison of the tuned classifiers.

    ``fit_on='train'`` learns the means from training rows only; ``'all'`` from every
    row, before the split.
    """
    raw = settle(read_csv(spark, path, CLINICAL_SCHEMA), "clinical")
    # Rows carry no key: the whole row decides its side and its fold, so equal rows stay together.
    placed = hash_split(raw.withColumn("row_key", F.to_json(F.struct(*PREDICTORS, OUTCOME))), "row_key", seed=seed)
    train, test = (side(placed, name).drop("split") for name in ("train", "test"))
    means = sentinel_means(train if fit_on == "train" else raw, SENTINEL_COLUMNS)

    def ready(rows: DataFrame) -> DataFrame:
        return assemble(fill_sentinels(rows, means, SENTINEL_COLUMNS), PREDICTORS)

    folded = with_folds(ready(train), "row_key", folds, seed).select("features", OUTCOME, "fold")
    scores, models = classifiers.compare_classifiers(
        folded, ready(test).select("features", OUTCOME), OUTCOME, grids, folds, parallelism
    )
    tuning = {name: classifiers.tuning_table(model, folded) for name, model in models.items()}
    return Comparison(scores, tuning, {"best": metrics.best_model(scores)})


def retrain_on_arrival(
    spark: SparkSession, incoming: str, root: str, checkpoint: str, every: str | None = None
):
    """Start the clinical stream: one new CSV file, one model."""
    store = ModelStore(spark, root)
    return start(stream_csv(spark, incoming), Retrainer(store), checkpoint, every)


def compare_headline_methods(
    headlines: DataFrame,
    lexicon: DataFrame,
    stop_words: Sequence[str],
    lemmas: DataFrame | None = None,
    match_on: str = "stem",
    stems: str = "extended",
    epochs: Sequence[int] = fixed.PERCEPTRON_EPOCHS,
    indicator_thresholds: Sequence[int] = fixed.INDICATOR_THRESHOLDS,
    method: str = "summed",
    shards: int = perceptron.SHARDS,
    seed: int = fixed.SEED,
) -> Comparison:
    """Lexicon rule against TF-IDF and perceptron on ``headlines(id, text, label)``.

    ``lexicon(term, kind)`` lists the positive and negative terms; without indicators of
    its own it gets the built-in ones. ``match_on='surface'`` looks up unstemmed words;
    ``stems`` names the stemmer's variant.
    ``lemmas(term, root, n)`` comes from ``noun_dictionary`` or ``dictionary_for``.
    """
    spark = headlines.sparkSession
    placed = stratified_split(headlines, "id", "label", seed=seed)
    tokens = settle(with_tokens(placed, "text", stop_words).drop("text"), "tokens")
    carry = ["label", "split"]

    if lexicon.where(F.col("kind") == "indicator").isEmpty():
        lexicon = lexicon.unionByName(lex.indicator_lexicon(spark))
    matched = tokens
    if match_on == "stem":
        matched = replace_terms(tokens, "id", "tokens", stem_dictionary(tokens, "tokens", stems), carry)
    features = settle(lex.lexicon_features(matched, "id", "tokens", lexicon, carry), "features")
    counts = lex.sweep_lexicon(side(features, "val"), "label", indicator_thresholds=indicator_thresholds)
    points = metrics.binary_scores(counts, by=["grid_pos", "min_score", "min_indicators"])
    points = settle(points, "lexicon-points")
    best = sweep.best_point(points).first()
    ruled = lex.with_lexicon_rule(side(features, "test"), best["min_score"], best["min_indicators"], "label")
    ruled = settle(ruled, "ruled")

    learned = tokens if lemmas is None else replace_terms(tokens, "id", "tokens", lemmas, carry)
    terms = settle(learned.select("id", *carry, ngram_terms(F.col("tokens")).alias("terms")), "terms")
    vocabulary = fit_vocabulary(side(terms, "train"), "terms")

    def weights(name: str) -> DataFrame:
        return settle(tfidf(side(terms, name), "id", "terms", vocabulary), f"weights-{name}")

    models = perceptron.fit_perceptron(
        weights("train"), side(terms, "train"), "id", "label", epochs, method=method, shards=shards
    )
    passes = settle(
        perceptron.sweep_epochs(models, side(terms, "val"), weights("val"), "id", "label"), "epochs"
    )
    chosen = models[sweep.best_point(passes).first()["epochs"]]
    test_weights = weights("test")
    judged = settle(
        perceptron.predict(side(terms, "test").select("id", "label"), test_weights, "id", chosen), "judged"
    )

    rule_counts = metrics.confusion(ruled, "label", "prediction")
    ml_counts = metrics.confusion(judged, "label", "prediction")
    both = (
        ruled.withColumnsRenamed({"prediction": "rule_prediction", "correct": "rule_correct"})
        .join(judged.select("id", "margin", F.col("prediction").alias("ml_prediction")), "id")
        .withColumn("ml_correct", F.col("label") == F.col("ml_prediction"))
        .join(top_term_lists(test_weights, "id"), "id", "left")
    )
    return Comparison(
        named_scores({"lexicon rule": rule_counts, "perceptron": ml_counts}, metrics.binary_scores),
        {"lexicon rule": points, "perceptron": passes},
        {"lexicon rule": metrics.class_report(rule_counts), "perceptron": metrics.class_report(ml_counts)},
        both,
    )


def named_scores(counts: dict[str, DataFrame], score) -> DataFrame:
    rows = [score(c).withColumn("method", F.lit(name)) for name, c in counts.items()]
    return metrics.compare(rows)


def compare_image_methods(
    spark: SparkSession,
    root: str,
    image_side: int = fixed.IMAGE_SIDE,
    hidden: Sequence[Sequence[int]] = fixed.HIDDEN_LAYERS,
    max_iter: int = 300,
    seed: int = fixed.SEED,
    classes: Sequence[str] = fixed.LEAF_CLASSES,
) -> Comparison:
    """Colour rule against a network on ``root/<class>/<file>.jpg``.

    ``classes`` names the folders of early blight, late blight and healthy leaves, which the rule knows by their place
    there. Another folder with images, or none for one of them, raises.
    """
    resized = resize_images(readable(scan_images(spark, root)), ["path", "class"], image_side)
    featured = settle(image_features(resized, ["path", "class"], image_side), "image-features")
    coded = with_class_codes(featured, "class", classes)
    placed = stratified_split(coded, "path", "label", seed=seed)

    counts = colour.sweep_colours(side(placed, "val"), "label")
    points = settle(
        metrics.macro_scores(counts, by=["grid_pos", "min_brown", "min_dark"]), "colour-points"
    )
    best = sweep.best_point(points).first()
    ruled = colour.with_colour_rule(side(placed, "test"), best["min_brown"], best["min_dark"], "label")

    scaler = fit_scaler(side(placed, "train"), "features")
    scaled = scale(placed.select("path", "label", "split", "features"), "features", scaler)
    vectors = settle(
        scaled.select("path", "label", "split", array_to_vector("scaled").alias("features")), "vectors"
    )
    layers, network = classifiers.sweep_layers(
        side(vectors, "train"), side(vectors, "val"), "label", image_side * image_side * 3, len(classes),
        hidden, max_iter, seed,
    )
    judged = settle(
        network.transform(side(vectors, "test")).select(
            "path", "label", F.col("prediction").cast("int").alias("ml_prediction")
        ),
        "judged",
    )

    rule_counts = metrics.confusion(ruled, "label", "prediction")
    ml_counts = metrics.confusion(judged, "label", "ml_prediction")
    both = (
        ruled.drop("features")
        .withColumnsRenamed({"prediction": "rule_prediction", "correct": "rule_correct"})
        .join(judged.select("path", "ml_prediction"), "path")
        .withColumn("ml_correct", F.col("label") == F.col("ml_prediction"))
    )
    return Comparison(
        named_scores({"colour rule": rule_counts, "network": ml_counts}, metrics.macro_scores),
        {"colour rule": points, "network": layers},
        {"colour rule": metrics.class_report(rule_counts), "network": metrics.class_report(ml_counts)},
        both,
    )
