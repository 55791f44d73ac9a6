"""Evaluation of hard predictions, all from one confusion table.

The table has at most classes x classes rows. It is the only pass over the
predictions; everything else works on it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cytospark.functions.names import col
from cytospark.functions.scalars import balance_band, holdout_band, report_band
from cytospark.operators.sizing import settle

def _all_rows():
    """One window over all rows; only used on tables with a row per class."""
    return W.partitionBy(F.lit(1))


def confusion(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """actual, predicted, n; kept as a local table when small."""
    return settle(
        df.groupBy(col(actual).cast("string").alias("actual"), col(predicted).cast("string").alias("predicted"))
        .agg(F.count(F.lit(1)).alias("n")),
        "confusion",
    )


def confusion_matrix(pairs: DataFrame, classes: Sequence[str]) -> DataFrame:
    return pairs.groupBy("actual").pivot("predicted", list(classes)).agg(F.sum("n")).na.fill(0, list(classes))


def accuracy(pairs: DataFrame) -> Column:
    return F.sum(F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0)) / F.sum("n")


def class_scores(pairs: DataFrame) -> DataFrame:
    """Per actual class: support, tp, fp, fn, tn, precision, recall, f1, auc.

    With hard labels the ROC has three points and its area is the mean of
    sensitivity and specificity.
    """
    total = pairs.agg(F.sum("n").alias("total"))
    support = pairs.groupBy(F.col("actual").alias("class")).agg(
        F.sum("n").alias("support"),
        F.sum(F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0)).alias("tp"),
    )
    called = pairs.groupBy(F.col("predicted").alias("class")).agg(F.sum("n").alias("called"))
    base = support.join(called, "class", "left").crossJoin(F.broadcast(total)).select(
        "class", "support", "tp",
        (F.coalesce("called", F.lit(0)) - F.col("tp")).alias("fp"),
        (F.col("support") - F.col("tp")).alias("fn"),
        (F.col("total") - F.col("support") - F.coalesce("called", F.lit(0)) + F.col("tp")).alias("tn"),
    )
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return base.select(
        "*",
        F.coalesce(F.try_divide(tp, tp + fp), F.lit(0.0)).alias("precision"),
        F.try_divide(tp, tp + fn).alias("recall"),
        F.coalesce(F.try_divide(2 * tp, 2 * tp + fp + fn), F.lit(0.0)).alias("f1"),
        F.try_divide(fp, fp + tn).alias("fpr"),
        ((F.try_divide(tp, tp + fn) + F.try_divide(tn, tn + fp)) / 2).alias("auc"),
    )


def roc_points(scores: DataFrame) -> DataFrame:
    """Three points of the curve per class."""
    points = F.array(
        F.struct(F.lit(0).alias("point"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")),
        F.struct(F.lit(1).alias("point"), F.col("fpr").alias("fpr"), F.col("recall").alias("tpr")),
        F.struct(F.lit(2).alias("point"), F.lit(1.0).alias("fpr"), F.lit(1.0).alias("tpr")),
    )
    return scores.select("class", F.explode(points).alias("_p")).select("class", "_p.point", "_p.fpr", "_p.tpr")


def imbalance(counts: DataFrame, count: str = "support", threshold: float = 0.1) -> DataFrame:
    """Smallest share below the threshold, or largest over ten times the smallest."""
    return counts.agg(
        (F.min(count) / F.sum(count)).alias("min_share"),
        (F.max(count) / F.sum(count)).alias("max_share"),
    ).select(
        "min_share", "max_share",
        ((F.col("min_share") < threshold) | (F.col("max_share") / F.col("min_share") > 10)).alias("imbalanced"),
    )


def auc_ranking(scores: DataFrame) -> DataFrame:
    """Classes by area, with the level of each."""
    rank = F.row_number().over(_all_rows().orderBy(F.desc("auc"), "class"))
    return scores.select(
        rank.alias("rank"), "class", F.round("auc", 3).alias("auc_score"), holdout_band(F.col("auc")).alias("performance")
    )


def overall(pairs: DataFrame, scores: DataFrame | None = None) -> DataFrame:
    """Headline numbers in one row: accuracy, weighted F1, extremes of the area, imbalance."""
    scores = class_scores(pairs) if scores is None else scores
    head = scores.agg(
        (F.sum("tp") / F.sum("support")).alias("accuracy"),
        (F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("f1_score"),
        F.max("auc").alias("max_auc"),
        F.min_by("class", F.struct((-F.col("auc")).alias("a"), "class")).alias("best_class"),
        F.min("auc").alias("min_auc"),
        F.max_by("class", F.struct((-F.col("auc")).alias("a"), "class")).alias("worst_class"),
        F.count(F.lit(1)).alias("n_classes"),
        F.sum("support").alias("total_samples"),
    )
    return head.crossJoin(F.broadcast(imbalance(scores).select(F.col("imbalanced").alias("class_imbalance_detected"))))


def evaluation_document(pairs: DataFrame) -> DataFrame:
    """The evaluation as one JSON document."""
    scores = class_scores(pairs)
    per_class = scores.agg(F.sort_array(F.collect_list(F.struct(
        (-F.col("auc")).alias("order"), F.col("class").alias("class_name"), "auc", "support"))).alias("_c"))
    return overall(pairs, scores).crossJoin(F.broadcast(per_class)).select(F.to_json(F.struct(
        "accuracy", "f1_score", "class_imbalance_detected", "n_classes", "total_samples",
        F.struct(F.col("best_class").alias("class_name"), F.col("max_auc").alias("auc")).alias("max_auc"),
        F.struct(F.col("worst_class").alias("class_name"), F.col("min_auc").alias("auc")).alias("min_auc"),
        F.transform("_c", lambda s: F.struct(
            s["class_name"].alias("class_name"), s["auc"].alias("auc"), s["support"].alias("count"),
        )).alias("auc_scores"),
    )).alias("document"))


def class_report(counts: DataFrame, aucs: DataFrame) -> DataFrame:
    """Report rows per class: count, share and its level, area and its level, order.

    ``counts`` holds (class, support) of the holdout, ``aucs`` (class, auc); a
    class without area sorts last.
    """
    joined = counts.select("class", "support").join(aucs.select("class", "auc"), "class", "left")
    percent = F.col("support") / F.sum("support").over(_all_rows()) * 100
    sort_value = F.coalesce("auc", F.lit(-1.0))
    return joined.select(
        "class", "support",
        percent.alias("percentage"),
        "auc",
        sort_value.alias("sort_value"),
        F.row_number().over(_all_rows().orderBy(sort_value.desc(), "class")).alias("position"),
    ).select(
        "*", balance_band(F.col("percentage")).alias("class_balance"), report_band(F.col("auc")).alias("performance_level"))


def holdout_performance(model: str, pairs: DataFrame) -> DataFrame:
    """One row per model for the comparison of models."""
    return overall(pairs).select(
        F.lit(model).alias("model"), "accuracy", "max_auc", "min_auc")


def best_model(performance: DataFrame) -> DataFrame:
    """Model with the highest accuracy; the earlier model wins a tie.

    Needs (model, position, accuracy); a handful of rows.
    """
    return performance.agg(
        F.max_by("model", F.struct("accuracy", -F.col("position"))).alias("model"),
        F.max("accuracy").alias("accuracy"),
    )
