"""Reading the tables of a folder, keeping intermediate ones, sizing shuffles."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cytospark.session import durable

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def kept(df: DataFrame, name: str) -> DataFrame:
    """Written to the shared folder and read back: computed once, safe from lost executors."""
    return durable(df, name)


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def col(name: str):
    return F.col(quoted(name))


def shuffle_partitions(spark: SparkSession) -> int:
    """The session's own measure for a shuffle of the whole input."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


@contextmanager
def small_batches(spark: SparkSession, rows: int = 256) -> Iterator[None]:
    """Rows with large values go to Python so many at a time while this holds."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def small_join(df: DataFrame, other: DataFrame, on: str, max_rows: int = 200_000,
               max_bytes: int = 32 << 20, width: int = 64) -> DataFrame:
    """Left join to a stored table; broadcast only if its counted rows are few.

    ``width`` bounds the bytes of a row, so both bounds are checked by the count.
    """
    count = other.count()
    small = count <= max_rows and count * width <= max_bytes
    return df.join(F.broadcast(other) if small else other.hint("merge"), on, "left")
