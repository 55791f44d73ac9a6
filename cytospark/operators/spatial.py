"""Spatial density of cells and coordinates for display."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cytospark.functions.names import X_COLUMN, Y_COLUMN, col, cols
from cytospark.functions.scalars import bin_index
from cytospark.operators.sizing import join_stored, join_summary

# Bin edge and the count up to which a bin is sparse.
BIN_SIZE = 120.0
DENSITY_CUTOFF = 3


def with_bins(df: DataFrame, x: str = X_COLUMN, y: str = Y_COLUMN, size: float = BIN_SIZE) -> DataFrame:
    return df.withColumns({"binX": bin_index(col(x), size), "binY": bin_index(col(y), size)})


def bin_counts(binned: DataFrame, image: str = "Image") -> DataFrame:
    """Cells per image and bin."""
    return binned.groupBy(col(image), "binX", "binY").agg(F.count(F.lit(1)).alias("bin_density"))


def bin_density(df: DataFrame, image: str = "Image", x: str = X_COLUMN, y: str = Y_COLUMN,
                size: float = BIN_SIZE, cutoff: int = DENSITY_CUTOFF) -> DataFrame:
    """Adds binX, binY, bin_density and low_bin_density.

    Counting first and joining back combines a crowded bin on the map side; a
    window over the bins would bring all its rows into one task. The bins grow
    with the slides, so their counts are stored, and beyond the broadcast bound
    the join is a shuffle in which adaptive execution splits crowded bins.
    """
    binned = with_bins(df, x, y, size)
    joined = join_stored(binned, bin_counts(binned, image), [image, "binX", "binY"])
    return joined.select(
        *cols(df.columns), "binX", "binY", "bin_density",
        (F.col("bin_density") <= cutoff).alias("low_bin_density"),
    )


def sparse_bin_cells(df: DataFrame, groups: Sequence[str], image: str = "Image", x: str = X_COLUMN,
                     y: str = Y_COLUMN, size: float = BIN_SIZE, cutoff: int = DENSITY_CUTOFF) -> DataFrame:
    """Cells in all and in sparse bins, per group, without joining back.

    Counts by (groups, image, bin) are summed per bin over a window and rolled
    up, so cells are shuffled only as partial counts, a bin has as many
    rows as groups, and a missing image or position is a bin like any other.
    """
    fine = with_bins(df, x, y, size).groupBy(
        *cols(dict.fromkeys([*groups, image])), "binX", "binY"
    ).agg(F.count(F.lit(1)).alias("_n"))
    bins = W.partitionBy(col(image), "binX", "binY")
    return fine.withColumn("bin_density", F.sum("_n").over(bins)).groupBy(*cols(groups)).agg(
        F.sum("_n").alias("cells"),
        F.sum(F.when(F.col("bin_density") <= cutoff, F.col("_n")).otherwise(0)).alias("low_density_cells"),
    ).withColumn("low_density_share", F.col("low_density_cells") / F.col("cells"))


def low_density_summary(flagged: DataFrame, groups: Sequence[str] = ()) -> DataFrame:
    """Count and share of cells in sparse bins."""
    return flagged.groupBy(*cols(groups)).agg(
        F.count(F.lit(1)).alias("cells"),
        F.count_if("low_bin_density").alias("low_density_cells"),
    ).withColumn("low_density_share", F.try_divide("low_density_cells", "cells"))


def flip_y(df: DataFrame, slide: str, y: str = Y_COLUMN, name: str = "invertY") -> DataFrame:
    """Y counted from the other edge: largest Y of the slide plus 1, minus Y."""
    tops = df.groupBy(col(slide)).agg((F.max(col(y)) + 1).alias("_top"))
    return join_summary(df, tops, [slide], "left").select(
        *cols(df.columns), (F.col("_top") - col(y)).alias(name))
