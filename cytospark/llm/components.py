"""Connected components of a table of links, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cytospark.llm.tables import kept


def _both(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def label(links: DataFrame) -> DataFrame:
    """(key, label) of every key in ``links`` (a, b): the smallest key that it is joined to.

    Each turn hangs neighbours on the smallest key they know of, until all hang on one that
    hangs on nothing; the number of turns grows with the logarithm of the longest path. Turns are
    stored in the shared folder.
    """
    edges = kept(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                 .where(F.col("a") != F.col("b")).distinct(), "links")
    while not _flat(edges):
        # Large star: larger neighbours move to the smallest one.
        near = _both(edges)
        least = near.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = near.join(least, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where(F.col("a") != F.col("b"))
        # Small star: smaller neighbours and the key itself move to the smallest one.
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = kept(small.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), "links")
    roots = edges.select(F.col("b").alias("key")).distinct()
    return edges.select(F.col("a").alias("key"), F.col("b").alias("label")).unionByName(
        roots.select("key", F.col("key").alias("label")))


def _flat(edges: DataFrame) -> bool:
    """Every key hangs on one other, which itself hangs on none."""
    ends = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.lit(None).cast("bigint").alias("b")))
    seen = ends.groupBy("a").agg(F.min("b").alias("lo"), F.max("b").alias("hi"), F.count_if(F.col("b").isNull()).alias("under"))
    return seen.where("lo != hi or (lo is not null and under > 0)").isEmpty()


def relabel(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels after further links: only links between components are looked at."""
    def of(key: str) -> DataFrame:
        return labels.select(F.col("key").alias(key), F.col("label").alias(f"{key}_label"))

    ends = links.select("a", "b").join(of("a"), "a", "left").join(of("b"), "b", "left")
    between = ends.select(F.coalesce("a_label", "a").alias("a"), F.coalesce("b_label", "b").alias("b")).where(F.col("a") != F.col("b"))
    merged = kept(label(between), "merged_labels")
    new = merged.select(F.col("key").alias("label"), F.col("label").alias("to"))
    old = labels.join(new, "label", "left").select("key", F.coalesce("to", "label").alias("label"))
    return old.unionByName(merged.join(labels, "key", "left_anti"))
