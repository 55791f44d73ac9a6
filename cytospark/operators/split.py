"""Annotated cells: cleaning, class counts, holdout and training rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cytospark.functions.names import col, cols
from cytospark.functions.scalars import NEGATIVE_LABELS, clean_label
from cytospark.operators.ranking import cutoffs, fraction_quota, order_hash
from cytospark.operators.sizing import join_summary, null_safe_join, settle


def annotated(df: DataFrame, label: str, negatives: Sequence[str] = NEGATIVE_LABELS) -> DataFrame:
    """Trim the label; drop rows without one and rows with a negative one."""
    return df.withColumn(label, clean_label(col(label))).filter(
        col(label).isNotNull() & ~col(label).isin([*negatives, ""])
    )


def label_counts(df: DataFrame, label: str) -> DataFrame:
    """Class, count and percent (two decimals) of all rows."""
    counts = df.groupBy(col(label)).agg(F.count(F.lit(1)).alias("counts"))
    total = F.sum("counts").over(W.partitionBy(F.lit(1)))  # one row per class
    return counts.withColumn("percent", F.round(F.col("counts") / total * 100, 2))


def holdout_split(df: DataFrame, label: str, batch: str, keys: Sequence[str], frac: float = 0.1,
                  min_count: int = 20, seed: int = 42) -> DataFrame:
    """Tag annotated rows with ``split``: holdout, training or unused.

    Per (batch, class) of at least ``min_count`` rows a share goes to the
    holdout. Classes without any holdout row are unused. Both sides of the
    split follow from comparing a row's hash with its group's cutoff, so there
    is no anti join and the rows are not shuffled.
    """
    quota = fraction_quota(frac, min_count)
    cut = settle(cutoffs(df, [batch, label], keys, [quota], seed), "holdout_cutoffs")
    kept = cut.groupBy(col(label)).agg((F.max(quota(F.col("n"))) > 0).alias("_kept"))
    plan = cut.select(col(batch), col(label), F.col("cutoffs")[0].alias("_cut"))
    plan = null_safe_join(plan, kept, [label])
    tagged = join_summary(df.withColumn("_hash", order_hash(keys, seed)), plan, [batch, label])
    return tagged.select(
        *cols(df.columns),
        F.when(F.col("_hash") <= F.col("_cut"), "holdout")
        .when(F.col("_kept"), "training").otherwise("unused").alias("split"),
    )


def class_table(tagged: DataFrame, label: str) -> DataFrame:
    """Class counts with percent and holdout count (null where there is none)."""
    held = F.count_if(F.col("split") == "holdout")
    counts = tagged.groupBy(col(label)).agg(F.count(F.lit(1)).alias("counts"), F.when(held > 0, held).alias("holdout"))
    total = F.sum("counts").over(W.partitionBy(F.lit(1)))  # one row per class
    return counts.select(col(label), "counts", F.round(F.col("counts") / total * 100, 2).alias("percent"), "holdout")


def kept_classes(table: DataFrame, label: str) -> DataFrame:
    """Classes with holdout rows."""
    return table.filter(F.col("holdout").isNotNull()).select(col(label)).distinct()


def rows_of_classes(df: DataFrame, classes: DataFrame, label: str) -> DataFrame:
    """Rows whose class is on the list."""
    return join_summary(df, classes.select(col(label)).distinct(), [label], "left_semi")


def classes_with(df: DataFrame, label: str, more_than: int | None = None,
                 at_least: int | None = None) -> DataFrame:
    """Classes by number of rows, strict or not."""
    counts = df.groupBy(col(label)).agg(F.count(F.lit(1)).alias("n"))
    if more_than is not None:
        counts = counts.filter(F.col("n") > more_than)
    if at_least is not None:
        counts = counts.filter(F.col("n") >= at_least)
    return counts.select(col(label))


def split_report(everything: DataFrame, tagged: DataFrame, frac: float = 0.1, min_count: int = 20,
                 negatives: Sequence[str] = NEGATIVE_LABELS) -> DataFrame:
    """Total, annotated, holdout and training counts, one row."""
    total = everything.agg(F.count(F.lit(1)).alias("total_cells"))
    parts = tagged.agg(
        F.count(F.lit(1)).alias("total_annotated_cells"),
        F.count_if(F.col("split") == "holdout").alias("total_holdout"),
        F.count_if(F.col("split") == "training").alias("total_training"),
    )
    return total.crossJoin(parts).select(
        F.lit(frac).alias("holdout_fraction"),
        F.lit(", ".join([*negatives, ""])).alias("negative_classes"),
        F.lit(min_count).alias("min_holdout_thresh"),
        "*",
    )


def binarise(df: DataFrame, label: str, cls: str, name: str = "target") -> DataFrame:
    """1 for rows of the class, 0 for the rest."""
    return df.withColumn(name, F.coalesce((col(label) == F.lit(cls)).cast("int"), F.lit(0)))


def training_summary(df: DataFrame, label: str, threshold: int) -> DataFrame:
    """Annotations per class and whether the class is used (count > threshold)."""
    counts = df.groupBy(col(label).alias("cell_type")).agg(F.count(F.lit(1)).alias("annotations"))
    return counts.withColumn("included", F.col("annotations") > threshold)
