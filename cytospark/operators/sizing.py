"""Joins against summaries: broadcast only behind a check of the size."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cytospark.session import durable

MAX_BROADCAST_ROWS = 200_000
MAX_BROADCAST_BYTES = 64 * 1024 * 1024
TEXT_BYTES = 128  # what a text column of a summary (a class, a slide) counts for


def _row_bytes(df: DataFrame) -> int | None:
    """Bytes of a row where the schema tells; None if a column can hold any number of values."""
    total = 0
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType, T.BinaryType)):
            return None
        total += TEXT_BYTES if isinstance(f.dataType, T.StringType) else 8
    return total


def held(summary: DataFrame, max_rows: int = MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES) -> tuple[DataFrame | None, DataFrame]:
    """(local table if the summary is within the bounds, what to read it from otherwise).

    Flat rows have a bounded width, so a row limit bounds the bytes before anything
    reaches the driver. Rows with arrays are stored first and measured there.
    """
    spark, width = summary.sparkSession, _row_bytes(summary)
    if width is None:
        summary = durable(summary, "summary")
        size = F.sum(F.length(F.to_json(F.struct(F.lit(0).alias("_"), F.struct("*").alias("row")))))
        rows, text = summary.agg(F.count(F.lit(1)), size).first()
        if rows > max_rows or (text or 0) > max_bytes:
            return None, summary
        table = summary.toArrow()
    else:
        limit = min(max_rows, max_bytes // max(1, width))
        table = summary.limit(limit + 1).toArrow()
        if table.num_rows > limit:
            return None, summary
    return spark.createDataFrame(table, schema=summary.schema), summary


def small_or_none(
    summary: DataFrame, max_rows: int = MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES
) -> DataFrame | None:
    """The summary as a local table if it is within the bounds, else None."""
    return held(summary, max_rows, max_bytes)[0]


def null_safe_join(df: DataFrame, other: DataFrame, on: Sequence[str], how: str = "inner",
                   small: bool = False) -> DataFrame:
    """Equi-join that also matches null keys, so rows of a null group are kept."""
    keys = {k: f"_on{i}" for i, k in enumerate(on)}
    renamed = other.withColumnsRenamed(keys)
    renamed = F.broadcast(renamed) if small else renamed
    same = reduce(and_, [F.col("`" + k.replace("`", "``") + "`").eqNullSafe(F.col(v)) for k, v in keys.items()])
    return df.join(renamed, same, how).drop(*keys.values())


def join_summary(
    df: DataFrame,
    summary: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    max_rows: int = MAX_BROADCAST_ROWS,
) -> DataFrame:
    """Join rows to a per-group summary; null is a group like any other.

    A summary within the bounds is broadcast, so the rows are not shuffled. A
    larger one is joined by shuffle, where adaptive execution splits hot keys.
    """
    small, rest = held(summary, max_rows, MAX_BROADCAST_BYTES)
    if small is None:
        return null_safe_join(df, rest, on, how)
    return null_safe_join(df, small, on, how, small=True)


def join_stored(df: DataFrame, summary: DataFrame, on: Sequence[str], how: str = "left",
                max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Like ``join_summary`` for a summary that grows with the rows.

    It is computed once into the shared folder and its size read from there, so
    a large one costs no second pass and no rows on the driver.
    """
    stored = durable(summary, "summary")
    width = _row_bytes(stored)
    small = width is not None and stored.count() <= min(max_rows, MAX_BROADCAST_BYTES // max(1, width))
    return null_safe_join(df, stored, on, how, small=small)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Partition small inputs of heavy per-group work by their keys.

    Adaptive execution would merge such small partitions into one task; an
    explicit number of partitions is left alone.
    """
    count = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(count, *[F.col(f"`{k}`") for k in keys])


def settle(summary: DataFrame, name: str, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Compute a summary once: a local table where it is small, else a stored one."""
    small, rest = held(summary, max_rows, MAX_BROADCAST_BYTES)
    if small is not None:
        return small
    return durable(rest, name) if rest is summary else rest
