"""Sinks for tables, predictions, small results, metrics and models."""

from __future__ import annotations

from pyspark.ml.feature import StringIndexerModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cytospark.functions.names import col, cols

EXPORT_COLUMNS = ["Centroid X µm", "Centroid Y µm", "Image", "CellTypePrediction"]


def write_stage(df: DataFrame, path: str, batch: str = "Batch") -> DataFrame:
    """Parquet by batch between two steps; returns the stored table."""
    df.write.mode("errorifexists").partitionBy(batch).parquet(path)
    return df.sparkSession.read.parquet(path)


def write_text_by(df: DataFrame, path: str, by: str, sep: str = "\t") -> None:
    """Delimited files in one folder per value of ``by``.

    The rebalance hint gathers each value's rows and lets adaptive execution
    split values that hold too many rows for one task and join tiny ones.
    """
    # The partition column leaves the file, so keep a copy inside it.
    out = df.select(*cols(df.columns), col(by).alias(f"{by}_key")).hint("rebalance", f"{by}_key")
    out.write.mode("errorifexists").options(header=True, sep=sep).partitionBy(f"{by}_key").csv(path)


def write_normalized(df: DataFrame, path: str, batch: str = "Batch") -> None:
    """Normalised or gated table as tab text per batch."""
    write_text_by(df, path, batch)


def write_predictions(df: DataFrame, path: str, columns: list[str] | None = None, image: str = "Image") -> None:
    """Exported prediction columns as tab text per image."""
    write_text_by(df.select(cols(columns or EXPORT_COLUMNS)), path, image)


def write_qc_predictions(flagged: DataFrame, path: str, image: str = "Image") -> None:
    """Predictions with the density columns, as tab text per image."""
    write_text_by(flagged, path, image)


def write_result(df: DataFrame, path: str) -> None:
    """A small result table as CSV with header. Only for bounded tables."""
    df.coalesce(1).write.mode("errorifexists").option("header", True).csv(path)


def write_class_list(classes: DataFrame, path: str) -> None:
    classes.coalesce(1).write.mode("errorifexists").csv(path)


def write_metrics(df: DataFrame, path: str) -> None:
    """Metric rows as JSON lines; values JSON cannot hold become text."""
    plain = {"string", "double", "float", "bigint", "int", "smallint", "tinyint", "boolean"}
    kept = [
        col(n) if t in plain or t.startswith(("array", "struct", "map")) else col(n).cast("string").alias(n)
        for n, t in df.dtypes
    ]
    df.select(kept).coalesce(1).write.mode("errorifexists").json(path)


def metrics_document(sections: dict[str, DataFrame]) -> DataFrame:
    """All metric tables as one JSON document, one array per section.

    For report tables only: each section is bounded by batches and classes.
    """
    out = None
    for name, df in sections.items():
        part = df.agg(F.collect_list(F.struct(*cols(df.columns))).alias(name))
        out = part if out is None else out.crossJoin(F.broadcast(part))
    return out.select(F.to_json(F.struct(*cols(sections))).alias("document"))


def save_encoder(model: StringIndexerModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_encoder(path: str) -> StringIndexerModel:
    return StringIndexerModel.load(path)
