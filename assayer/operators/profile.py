"""Row counts, null counts, class balance and split reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def share_of(part: Column, whole: Column) -> Column:
    """Percentage of ``part`` in ``whole``; null when there is nothing to share."""
    return part.cast("double") * 100.0 / F.nullif(whole.cast("double"), F.lit(0.0))


def shape(df: DataFrame) -> DataFrame:
    """One row: number of rows and of columns."""
    return df.agg(
        F.count("*").alias("n_rows"), F.lit(len(df.columns)).cast("bigint").alias("n_columns")
    )


def column_types(df: DataFrame) -> DataFrame:
    """Column names and types in schema order."""
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema)]
    return df.sparkSession.createDataFrame(
        rows, "position int, column string, type string, nullable boolean"
    )


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Nulls per column, all columns in one pass."""
    cells = [
        F.struct(
            F.lit(c).alias("column"),
            F.count_if(F.col(c).isNull()).alias("nulls"),
            F.count("*").alias("n_rows"),
        )
        for c in (columns or df.columns)
    ]
    return df.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))


def class_distribution(df: DataFrame, label: str) -> DataFrame:
    """Rows and percentage per class."""
    counts = df.groupBy(label).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("total")).scalar()
    return counts.withColumn("pct", share_of(F.col("n"), total))


def imbalance(df: DataFrame, label: str) -> DataFrame:
    """Largest and smallest class and their ratio; ties go to the first class name."""
    counts = df.groupBy(label).agg(F.count("*").alias("n"))
    smallest = F.min(F.struct("n", label))
    largest = F.min(F.struct((-F.col("n")).alias("minus_n"), F.col(label)))
    ends = counts.agg(smallest.alias("low"), largest.alias("high"))
    return ends.select(
        F.col(f"high.{label}").alias("majority"),
        (-F.col("high.minus_n")).alias("majority_n"),
        F.col(f"low.{label}").alias("minority"),
        F.col("low.n").alias("minority_n"),
        (-F.col("high.minus_n") / F.col("low.n")).alias("ratio"),
    )


def split_report(df: DataFrame, split: str, label: str) -> DataFrame:
    """Per split and class: rows, share of the split, split size and its share of all."""
    counts = df.groupBy(split, label).agg(F.count("*").alias("n"))
    # The totals read the small counts, whose shuffle both branches share.
    totals = counts.groupBy(split).agg(F.sum("n").alias("split_rows"))
    total = counts.agg(F.sum("n").alias("total")).scalar()
    return counts.join(totals, split).select(
        split,
        label,
        "n",
        share_of(F.col("n"), F.col("split_rows")).alias("pct_of_split"),
        "split_rows",
        share_of(F.col("split_rows"), total).alias("split_pct"),
    )


def preview(df: DataFrame, order_by: Sequence[str], n: int = 5) -> DataFrame:
    """First ``n`` rows in a stated order."""
    return df.orderBy(*order_by).limit(n)
