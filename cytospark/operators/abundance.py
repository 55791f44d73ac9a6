"""Counts and shares of predicted classes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cytospark.functions.names import col, cols
from cytospark.operators.sizing import settle

PREDICTION = "CellTypePrediction"


def class_counts(df: DataFrame, groups: Sequence[str], label: str = PREDICTION) -> DataFrame:
    """Rows per group and class: the one pass that all figures here share."""
    return settle(df.groupBy(*cols(groups), col(label).alias("class")).agg(F.count(F.lit(1)).alias("n")), "class_counts")


def class_shares(counts: DataFrame, groups: Sequence[str] = ()) -> DataFrame:
    """Counts with percent of their group; needs one row per group and class."""
    total = F.sum("n").over(W.partitionBy(*cols(groups)) if groups else W.partitionBy(F.lit(1)))
    return counts.withColumn("percentage", F.col("n") / total * 100)


def class_order(counts: DataFrame) -> list[str]:
    """Classes by overall frequency, most frequent first."""
    totals = counts.filter(F.col("class").isNotNull()).groupBy("class").agg(F.sum("n").alias("n"))
    return [r["class"] for r in totals.orderBy(F.desc("n"), "class").collect()]


def abundance_matrix(counts: DataFrame, sample: str, classes: Sequence[str] | None = None) -> DataFrame:
    """Sample x class percent, absent classes 0, columns by overall frequency."""
    classes = class_order(counts) if classes is None else list(classes)
    shares = class_shares(counts.filter(F.col("class").isNotNull()), [sample])
    return shares.groupBy(col(sample)).pivot("class", classes).agg(F.sum("percentage")).na.fill(0.0, classes)


def cells_per_sample(counts: DataFrame, sample: str) -> DataFrame:
    return counts.groupBy(col(sample)).agg(F.sum("n").alias("cells"))


def cohort_size(counts: DataFrame, sample: str) -> DataFrame:
    """Number of samples and of classes."""
    return counts.agg(
        F.countDistinct(col(sample)).alias("samples"), F.countDistinct("class").alias("classes"))


def abundance_totals(flagged: DataFrame, label: str = PREDICTION) -> DataFrame:
    """Total cells, most and least frequent class, cells in sparse bins; one row."""
    per_class = flagged.groupBy(col(label).alias("class")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if("low_bin_density").alias("low"))
    named = F.col("class").isNotNull()
    by_frequency = F.struct((-F.col("n")).alias("n"), "class")
    return per_class.agg(
        F.sum("n").alias("total_predicted_cells"),
        F.min_by("class", F.when(named, by_frequency)).alias("most_common_prediction"),
        F.max_by("class", F.when(named, by_frequency)).alias("most_rare_prediction"),
        F.sum("low").alias("total_low_density_cells"),
    )


def abundance_summary(flagged: DataFrame, sample: str, label: str = PREDICTION) -> dict[str, DataFrame]:
    """The tables of the abundance report."""
    counts = class_counts(flagged, [sample], label)
    return {
        "matrix": abundance_matrix(counts, sample),
        "cells_per_sample": cells_per_sample(counts, sample),
        "cohort": cohort_size(counts, sample),
        "totals": abundance_totals(flagged, label),
    }
