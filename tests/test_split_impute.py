from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from assayer.operators import profile
from assayer.operators.impute import impute
from assayer.operators.split import (
    hash_split,
    random_row,
    stratified_cuts,
    stratified_split,
    with_folds,
)


def plain_split(rows, seed=42):
    """The same split by sorting each class as a whole."""
    out = {}
    for label in {label for _, label in rows}:
        keys = sorted(
            (hashlib.md5(f"{k}|{seed}".encode()).hexdigest(), k) for k, at in rows if at == label
        )
        for rank, (_, key) in enumerate(keys, 1):
            n = len(keys)
            out[key] = "train" if rank <= n * 70 // 100 else "val" if rank <= n * 85 // 100 else "test"
    return out


@pytest.mark.parametrize("n", [1, 2, 7, 100, 3000])
def test_equals_whole_class_sort(spark, n):
    rows = [(i, 0 if i % 3 else 1) for i in range(n)]
    df = spark.createDataFrame(rows, "id bigint, label int")
    got = {r["id"]: r["split"] for r in stratified_split(df, "id", "label").collect()}
    assert got == plain_split(rows)


def test_partitioning_does_not_matter(spark):
    df = spark.range(2000).select("id", (F.col("id") % 4).cast("int").alias("label"))
    one = stratified_split(df.repartition(1), "id", "label").orderBy("id").collect()
    many = stratified_split(df.repartition(11), "id", "label").orderBy("id").collect()
    assert one == many


def test_copies_of_a_key_stay_together_and_no_row_is_lost(spark):
    # One key holds a third of all rows.
    df = spark.range(3000).select(
        F.when(F.col("id") < 1000, 0).otherwise(F.col("id")).alias("id"), F.lit(1).alias("label")
    )
    split = stratified_split(df, "id", "label")
    assert split.count() == 3000
    assert split.where("id = 0").select("split").distinct().count() == 1
    sizes = {r["split"]: r["n"] for r in split.groupBy("split").agg(F.count("*").alias("n")).collect()}
    assert sizes["train"] <= 2100


def test_cuts_hold_one_row_per_class(spark):
    df = spark.range(500).select("id", (F.col("id") % 2).alias("label"))
    assert stratified_cuts(df, "id", "label").count() == 2


def test_hash_split_share_and_folds(spark):
    rows = with_folds(hash_split(spark.range(20000), "id"), "id")
    share = rows.where("split = 'train'").count() / 20000
    assert 0.78 < share < 0.82
    sizes = [r["n"] for r in rows.groupBy("fold").agg(F.count("*").alias("n")).collect()]
    assert len(sizes) == 5 and min(sizes) > 3700


def test_random_row_follows_the_seed(spark):
    df = spark.range(1000)
    assert random_row(df, "id", 1).first() == random_row(df.repartition(7), "id", 1).first()
    assert len({random_row(df, "id", s).first()["id"] for s in range(8)}) > 1


def test_impute(spark):
    df = spark.createDataFrame([(0, 0, 5), (2, 0, 0), (4, 0, None)], "a int, b int, c int")
    got = [tuple(r) for r in impute(df, ["a", "b", "c"]).collect()]
    # Zeros of a take the mean of 2 and 4; b has no other value; the null of c stays.
    assert got == [(3.0, 0.0, 5.0), (2.0, 0.0, 5.0), (4.0, 0.0, None)]


def test_impute_learns_from_chosen_rows(spark):
    df = spark.createDataFrame([(0.0, "test"), (10.0, "test"), (2.0, "train")], "a double, split string")
    got = impute(df, ["a"], fit_on=F.col("split") == "train").collect()
    assert [r["a"] for r in got] == [2.0, 10.0, 2.0]


def test_imputing_neither_joins_nor_shuffles_rows(spark):
    df = spark.range(10).select(F.col("id").alias("a"), F.col("id").alias("b"))
    plan = impute(df, ["a", "b"])._jdf.queryExecution().executedPlan().toString()
    main = plan.split("Subquery")[0]
    assert "Join" not in main and "CartesianProduct" not in main


def test_imbalance_ties_go_to_the_first_class(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",)], "label string")
    row = profile.imbalance(df, "label").first()
    assert (row["minority"], row["majority"], row["ratio"]) == ("a", "c", 2.0)


def test_profile_tables(spark):
    df = spark.createDataFrame([(1, None), (None, None), (3, "x")], "a int, b string")
    nulls = {r["column"]: r["nulls"] for r in profile.null_counts(df).collect()}
    assert nulls == {"a": 1, "b": 2}
    assert profile.shape(df).first().asDict() == {"n_rows": 3, "n_columns": 2}
    assert [r["type"] for r in profile.column_types(df).orderBy("position").collect()] == ["int", "string"]
