"""Marker panels: which batch has which marker, and filling what is missing."""

from __future__ import annotations

import random
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cytospark.functions.names import (
    col,
    cols,
    marker_of,
    matching,
    per_column,
    stat_suffixes,
)
from cytospark.functions.scalars import at_least
from cytospark.operators.quantiles import quantiles
from cytospark.operators.sizing import join_summary, null_safe_join

# Number of noise centres and the quantile that bounds them.
NOISE_CENTRES = 3
NOISE_TOP_QUANTILE = 0.05
SUMMARY_PROBS = [0.01, 0.02, 0.05, 0.5, 0.9]


def batch_markers(spark: SparkSession, headers: Mapping[str, Sequence[str]],
                  pattern: str = "Mean") -> DataFrame:
    """(marker, batch) rows from the column names of every batch."""
    rows = sorted(
        {(marker_of(c), b) for b, names in headers.items() for c in names if pattern in c}
    )
    return spark.createDataFrame(rows, "marker string, batch string")


def observed_markers(long: DataFrame, batch: str, name: str = "column") -> DataFrame:
    """(marker, batch) rows from a long table: markers that hold values."""
    return long.select(
        F.split_part(col(name), F.lit(":"), F.lit(1)).alias("marker"), col(batch).alias("batch")
    ).distinct()


def present_columns(df: DataFrame, batch: str, columns: Sequence[str]) -> DataFrame:
    """(column, batch) of measures with at least one value, in one pass."""
    seen = df.groupBy(col(batch).alias("batch")).agg(*[F.count(col(c)).alias(c) for c in columns])
    return seen.unpivot(["batch"], cols(columns), "column", "n").filter("n > 0").select("column", "batch")


def union_markers(frames: Sequence[DataFrame]) -> DataFrame:
    """Distinct union of marker lists."""
    out = frames[0].select("marker")
    for f in frames[1:]:
        out = out.union(f.select("marker"))
    return out.distinct()


def panel_design(markers: DataFrame, batches: Sequence[str]) -> DataFrame:
    """Marker x batch matrix of 0/1."""
    return (
        markers.groupBy("marker")
        .pivot("batch", list(batches))
        .agg(F.lit(1))
        .na.fill(0, list(batches))
        .orderBy("marker")
    )


def missing_markers(markers: DataFrame) -> DataFrame:
    """(marker, batch) pairs of the panel that are absent from the batch."""
    every = markers.select("marker").distinct().crossJoin(markers.select("batch").distinct())
    return every.join(markers, ["marker", "batch"], "left_anti")


def column_summary(df: DataFrame, columns: Sequence[str], groups: Sequence[str] = ()) -> DataFrame:
    """count, mean, std, min, percentiles and max per column, long form."""
    base = per_column(
        df, columns, groups,
        F.count("value").alias("count"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    q = quantiles(df, columns, SUMMARY_PROBS, groups)
    names = ["p1", "p2", "p5", "p50", "p90"]
    return join_summary(base, q.drop("n"), [*groups, "column"]).select(
        *cols(groups), "column", "count", "mean", "std", "min",
        *[F.col("quantiles")[i].alias(n) for i, n in enumerate(names)], "max",
    )


def average_summary(summary: DataFrame, groups: Sequence[str] = ()) -> DataFrame:
    """Every statistic averaged over the columns of the summary."""
    stats = ["count", "mean", "std", "min", "p1", "p2", "p5", "p50", "p90", "max"]
    return summary.groupBy(*cols(groups)).agg(*[F.avg(s).alias(s) for s in stats])


def fill_bounds(df: DataFrame, suffixes: Sequence[str], groups: Sequence[str] = ()) -> DataFrame:
    """Per suffix: mean of the minima and mean of the 5% quantiles over its columns.

    A suffix is searched as a pattern, so its dots match any character.
    """
    by_suffix = {s: matching(df, s) for s in suffixes}
    used = sorted({c for v in by_suffix.values() for c in v})
    if not used:
        raise ValueError("no column carries any of the suffixes")
    stats = quantiles(df, used, [0.0, NOISE_TOP_QUANTILE], groups)
    member = F.array(*[
        F.struct(F.lit(s).alias("suffix"), F.array(*[F.lit(c) for c in v]).alias("members"))
        for s, v in by_suffix.items() if v
    ])
    return (
        stats.select("*", F.explode(member).alias("_m"))
        .filter(F.array_contains(F.col("_m.members"), F.col("column")))
        .groupBy(*cols(groups), F.col("_m.suffix").alias("suffix"))
        .agg(
            F.avg(F.col("quantiles")[0]).alias("low"),
            F.avg(F.col("quantiles")[1]).alias("high"),
        )
        .withColumn("spread", F.ceil((F.col("high") - F.col("low")) / 6).cast("double"))
    )


def _uniform(keys: Sequence[str], tag: str) -> Column:
    """Uniform (0, 1) number fixed by the row's keys and a tag."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(tag), *cols(keys)), 11)
    return (bits.cast("double") + 0.5) / float(2**53)


def normal_noise(keys: Sequence[str], tag: str) -> Column:
    """Standard normal number fixed by the row's keys and a tag.

    A recomputed task gives the same noise, which ``randn`` does not promise.
    """
    radius = F.sqrt(-2.0 * F.log(_uniform(keys, tag + "/r")))
    return radius * F.cos(_uniform(keys, tag + "/a") * F.lit(6.283185307179586))


def fill_missing(
    df: DataFrame,
    missing: Sequence[str],
    keys: Sequence[str],
    per_compartment: bool = False,
    suffixes: Sequence[str] | None = None,
    seed: int = 42,
) -> DataFrame:
    """Add low noise columns for the markers a batch lacks.

    Per new column three centres are drawn between the bounds of its suffix;
    each row takes one of them by a hash of its keys, plus normal noise, and
    negative values become 0. One projection for all new columns.
    """
    if not missing:
        return df
    suffixes = list(suffixes or stat_suffixes(per_compartment))
    bounds = {r["suffix"]: r for r in fill_bounds(df, suffixes).collect()}  # one row per suffix
    centre = F.pmod(F.xxhash64(F.lit(f"{seed}/centre"), *cols(keys)), F.lit(NOISE_CENTRES))
    added = []
    for suffix in suffixes:
        if suffix not in bounds:
            continue
        b = bounds[suffix]
        for marker in missing:
            name = marker + suffix
            rng = random.Random(f"{seed}|{name}")
            spots = [rng.uniform(b["low"], b["high"]) for _ in range(NOISE_CENTRES)]
            place = F.element_at(F.array(*[F.lit(s) for s in spots]), F.col("_centre").cast("int") + 1)
            noise = normal_noise(keys, f"{seed}/{name}") * F.lit(b["spread"])
            added.append(at_least(place + noise, 0.0).alias(name))
    return df.withColumn("_centre", centre).select(*cols(df.columns), *added)


def fill_batches(
    df: DataFrame,
    absent: DataFrame,
    batch: str,
    keys: Sequence[str],
    per_compartment: bool = False,
    suffixes: Sequence[str] | None = None,
    seed: int = 42,
) -> DataFrame:
    """Fill what each batch lacks, for all batches in one projection.

    ``absent`` holds (marker, batch). Bounds come from each batch's own columns;
    centres are drawn by hash from (batch, column). The per-batch parameters,
    one row each, are joined to the rows.
    """
    lacking = absent.groupBy(F.col("batch").alias(batch)).agg(F.collect_set("marker").alias("_lacking"))
    markers = sorted(r["marker"] for r in absent.select("marker").distinct().collect())  # the panel
    if not markers:
        return df
    suffixes = list(suffixes or stat_suffixes(per_compartment))
    known = [s for s in suffixes if matching(df, s)]
    bounds = fill_bounds(df, known, [batch]).groupBy(col(batch)).agg(F.map_from_entries(F.collect_list(
        F.struct("suffix", F.struct("low", "high", "spread")))).alias("_bounds"))
    plan = null_safe_join(lacking, bounds, [batch])
    centre = F.pmod(F.xxhash64(F.lit(f"{seed}/centre"), *cols(keys)), F.lit(NOISE_CENTRES))
    rows = join_summary(df, plan, [batch], "left").withColumn("_centre", centre)
    filled = {}
    for marker in markers:
        for suffix in known:
            name = marker + suffix
            b = F.col("_bounds")[suffix]
            spot = _uniform([batch, "_centre"], f"{seed}/{name}")
            value = at_least(b["low"] + spot * (b["high"] - b["low"]) + normal_noise(keys, f"{seed}/{name}") * b["spread"], 0.0)
            own = col(name) if name in df.columns else F.lit(None).cast("double")
            filled[name] = F.when(F.array_contains("_lacking", marker), value).otherwise(own).alias(name)
    return rows.select(
        *[filled.pop(c) if c in filled else col(c) for c in df.columns], *filled.values())


def fill_report(spark: SparkSession, batch: str, before: Sequence[str], after: Sequence[str],
                missing: Sequence[str]) -> DataFrame:
    """Column counts of the fill, one row."""
    added = len(after) - len(before)
    row = (batch, not missing, len(before), list(missing), added, len(after),
           100.0 * added / len(after) if missing else 0.0)
    return spark.createDataFrame(
        [row],
        "batch_id string, skipped boolean, original_features long, missing_markers array<string>, "
        "synthetic_features_added long, final_features long, percent_synthetic double",
    )
