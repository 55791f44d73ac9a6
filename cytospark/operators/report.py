"""Roll-ups of step metrics into the tables of the run report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cytospark.functions.names import cols


def normalization_rollup(metrics: DataFrame, method: str = "transformation_type",
                         batch: str = "batch_name") -> DataFrame:
    """Distinct methods and batches; the method itself if there is only one, else N/A."""
    return metrics.agg(
        F.sort_array(F.collect_set(method)).alias("normalization_methods"),
        F.sort_array(F.collect_set(batch)).alias("batch_names"),
    ).select(
        "normalization_methods", "batch_names",
        F.size("batch_names").cast("long").alias("total_batches"),
        F.when(F.size("normalization_methods") == 1, F.col("normalization_methods")[0])
        .otherwise("N/A").alias("primary_method"),
    )


def selection_rollup(metrics: DataFrame, celltype: str = "celltype") -> DataFrame:
    """Classes processed and their number."""
    return metrics.agg(
        F.sort_array(F.collect_list(celltype)).alias("cell_types_processed"),
        F.count(celltype).alias("total_cell_types"),
    )


def ordered_models(evaluations: DataFrame, model: str = "model_name") -> DataFrame:
    """First model, second model, then the rest."""
    rank = F.when(F.col(model).contains("First"), 0).when(F.col(model).contains("Second"), 1).otherwise(2)
    return evaluations.withColumn("model_order", rank).orderBy("model_order", model)


def model_rollup(evaluations: DataFrame, model: str = "model_name") -> DataFrame:
    """Headline numbers of the first model; zeros if it is missing."""
    first = F.col(model) == "First"
    pick = lambda c: F.max(F.when(first, F.col(c)))
    return evaluations.agg(
        F.coalesce(pick("n_classes"), F.lit(0)).cast("long").alias("training_classes"),
        F.coalesce(pick("accuracy"), F.lit(0.0)).alias("holdout_accuracy"),
        F.coalesce(pick("f1_score"), F.lit(0.0)).alias("f1_score"),
        pick("class_imbalance_detected").alias("class_imbalance"),
        F.coalesce(pick("best_class"), F.lit("")).alias("best_class"),
        F.coalesce(pick("worst_class"), F.lit("")).alias("worst_class"),
    )


def run_summary(split: DataFrame, normalization: DataFrame, models: DataFrame, version: str = "") -> DataFrame:
    """The header table of the report, from three one-row roll-ups."""
    return split.crossJoin(F.broadcast(normalization)).crossJoin(F.broadcast(models)).select(
        F.lit(version).alias("pipeline_version"),
        F.date_format(F.current_date(), "MMMM dd, yyyy").alias("generation_date"),
        "total_cells", "total_batches",
        F.col("total_annotated_cells").alias("total_labels"),
        "training_classes", F.col("primary_method").alias("normalization_method"),
        "holdout_accuracy", "f1_score",
    )


def shared_keys(left: DataFrame, right: DataFrame) -> list[str]:
    """Keys that two metric documents both hold."""
    return sorted(set(left.columns) & set(right.columns))


def merged_documents(frames: list[DataFrame]) -> DataFrame:
    """One-row metric documents side by side; a later key replaces an earlier one."""
    out = frames[0]
    for f in frames[1:]:
        out = out.drop(*shared_keys(out, f)).crossJoin(F.broadcast(f.select(cols(f.columns))))
    return out
