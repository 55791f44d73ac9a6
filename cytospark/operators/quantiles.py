"""Exact quantiles of many columns and groups at once.

Small tables with few probabilities use the built-in ``percentile``, whose cost and memory grow with both
distinct values and probabilities. Otherwise the order statistics are found by descent:

1. rows are counted in buckets of a code that follows the order of the values (sign and binary logarithm),
   with the least and greatest value of each bucket;
2. running counts tell the bucket of every wanted rank, of all groups and columns at once. A bucket of one value is an answer,
   however many rows it has;
3. the other wanted buckets are cut evenly between their least and greatest value and counted again, until few rows
   are left in them, whose distinct values are counted through.

Every pass adds up counts on the map side; what is shuffled and ordered are buckets, never the rows of one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cytospark.functions.names import cols, melt, melt_indexed, named, per_column
from cytospark.operators.sizing import join_summary, null_safe_join
from cytospark.session import durable

EXACT_ROWS = 2_000_000
#: More probabilities than this are found by descent at any size.
FEW_PROBS = 32
#: Rows in wanted buckets that are counted value by value.
FEW_ROWS = 1_000_000
#: Buckets of the first pass for each doubling, and of later passes for each bucket.
FIRST_CUTS, CUTS, MOST_CUTS = 256, 1024, 4
APPROXIMATE_ACCURACY = 100_000


def quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probs: Sequence[float],
    groups: Sequence[str] = (),
    exact_rows: int = EXACT_ROWS,
    exact: bool = True,
    few_rows: int = FEW_ROWS,
) -> DataFrame:
    """groups, column, n, quantiles (array aligned to probs), linear interpolation.

    With ``exact=False`` a table of any size takes one sketch pass with a rank
    error of at most 1 / 100,000 instead of the descent. ``exact_rows`` and ``few_rows`` only
    choose between exact ways.
    """
    if exact:
        fits = len(probs) <= FEW_PROBS and df.count() <= exact_rows
        long = melt_indexed(df, columns, groups)
        return named(long_quantiles(long, [*groups, "_pos"], probs, fits, few_rows), columns)
    marks = F.array(*[F.lit(float(p)) for p in probs])
    return per_column(
        df, columns, groups, F.count("value").alias("n"),
        F.percentile_approx("value", marks, F.lit(APPROXIMATE_ACCURACY)).alias("quantiles"))


def long_quantiles(long: DataFrame, keys: Sequence[str], probs: Sequence[float],
                   fits: bool, few_rows: int = FEW_ROWS) -> DataFrame:
    """Quantiles of ``value`` per key set of a long table."""
    keys = list(keys)
    wanted = F.array(*[F.lit(float(p)) for p in probs])
    if fits:
        return long.groupBy(*cols(keys)).agg(
            F.count("value").alias("n"), F.percentile("value", wanted).alias("quantiles")
        )
    return _descend(long, keys, probs, few_rows)


def _first_code(v: Column) -> Column:
    """A number that never falls as the value rises; infinite values have their own."""
    size = F.abs(v)
    steps = F.floor((F.log2(size) + 1100) * FIRST_CUTS)
    return F.when(size == 0, 0).otherwise(
        F.signum(v).cast("long") * F.when(size == float("inf"), F.lit(1 << 20).cast("long")).otherwise(steps))


def _counted(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.groupBy(*cols(keys), "_path").agg(
        F.count(F.lit(1)).alias("_c"), F.min("value").alias("_low"), F.max("value").alias("_high"))


def _descend(long: DataFrame, keys: list[str], probs: Sequence[float], few_rows: int) -> DataFrame:
    rows = long.withColumn("value", F.col("value") + 0.0).withColumn("_path", _first_code(F.col("value")))
    counts = durable(_counted(rows, keys), "bucket_counts")
    sizes = durable(counts.groupBy(*cols(keys)).agg(F.sum("_c").alias("n")), "group_sizes")
    position = (F.col("n") - 1) * F.col("_p")
    points = sizes.select(*cols(keys), "n", F.posexplode(F.array(*[F.lit(float(p)) for p in probs])).alias("_i", "_p")).select(
        *cols(keys), "n", "_i", position.alias("_h"))
    ranks = points.select(*cols(keys), F.explode(F.array(F.floor("_h"), F.ceil("_h"))).alias("_rank")).distinct()
    ranks = ranks.withColumn("_parent", F.lit(None).cast("long"))
    before = sizes.select(*cols(keys), F.lit(None).cast("long").alias("_parent"), F.lit(0).cast("long").alias("_before"))
    found, cuts = None, 0
    counts = counts.withColumn("_parent", F.lit(None).cast("long"))
    while True:
        hit = durable(_located(counts, ranks, before, keys), "rank_buckets")
        closed = hit.filter("_low = _high").select(*cols(keys), "_rank", F.col("_low").alias("value"))
        found = closed if found is None else found.unionByName(closed)
        rest = hit.filter("_low < _high")
        buckets = rest.select(*cols(keys), "_path", "_start", "_c", "_low", "_high").distinct()
        left = buckets.agg(F.sum("_c")).first()[0] or 0
        if not left:
            break
        ranks = rest.select(*cols(keys), "_rank", F.col("_path").alias("_parent"))
        before = buckets.select(*cols(keys), F.col("_path").alias("_parent"), F.col("_start").alias("_before"))
        inside = join_summary(rows, buckets.select(*cols(keys), "_path", "_low", "_high"), [*keys, "_path"])
        if left <= few_rows or cuts == MOST_CUTS:
            # Few rows, or after all cuts few different values, each bucket.
            counts = inside.groupBy(*cols(keys), F.col("_path").alias("_parent"), F.col("value").alias("_low")).agg(
                F.count(F.lit(1)).alias("_c")).withColumn("_high", F.col("_low")).withColumn("_path", F.lit(None).cast("long"))
            continue
        # Shares of a half avoid an overflow of the difference.
        share = (F.col("value") / 2 - F.col("_low") / 2) / (F.col("_high") / 2 - F.col("_low") / 2)
        cut = F.least(F.floor(share * CUTS), F.lit(CUTS - 1))
        rows = inside.withColumn("_parent", F.col("_path")).withColumn("_path", F.col("_path") * CUTS + cut).drop("_low", "_high")
        counts = durable(_counted(rows, [*keys, "_parent"]), "bucket_counts")
        rows = rows.drop("_parent")
        cuts += 1
    table = found.groupBy(*cols(keys)).agg(F.map_from_entries(F.collect_list(F.struct("_rank", "value"))).alias("_at"))
    at = lambda rank: F.element_at("_at", rank.cast("long"))
    low, high = at(F.floor("_h")), at(F.ceil("_h"))
    value = F.when(low == high, low).otherwise(F.least(low + (F.col("_h") - F.floor("_h")) * (high - low), high))
    return (
        null_safe_join(points, table, keys)
        .withColumn("_v", F.struct("_i", value.alias("v")))
        .groupBy(*cols(keys), "n")
        .agg(F.sort_array(F.collect_list("_v")).alias("_vs"))
        .select(*cols(keys), "n", F.transform("_vs", lambda s: s["v"]).alias("quantiles"))
    )


def _located(counts: DataFrame, ranks: DataFrame, before: DataFrame, keys: list[str]) -> DataFrame:
    """The bucket of every rank, and how many rows precede that.

    ``counts`` are the buckets inside each ``_parent``, ``before`` the rows before that. Buckets and ranks are ordered by
    position together, so that a rank's bucket is the last that begins before it.
    """
    part = [*cols(keys), F.col("_parent")]
    running = W.partitionBy(*part).orderBy("_low").rowsBetween(W.unboundedPreceding, -1)
    inner = counts.withColumn("_inner", F.coalesce(F.sum("_c").over(running), F.lit(0)))
    placed = null_safe_join(inner, before, [*keys, "_parent"]).withColumn("_start", F.col("_before") + F.col("_inner"))
    bucket = F.struct("_path", "_start", "_c", "_low", "_high")
    events = placed.select(*part, F.col("_start").alias("_at"), F.lit(0).alias("_kind"), bucket.alias("_bucket")).unionByName(
        ranks.select(*part, F.col("_rank").alias("_at"), F.lit(1).alias("_kind")), allowMissingColumns=True)
    last = F.last("_bucket", ignorenulls=True).over(
        W.partitionBy(*part).orderBy("_at", "_kind").rowsBetween(W.unboundedPreceding, W.currentRow))
    return events.withColumn("_bucket", last).filter("_kind = 1").select(*cols(keys), F.col("_at").alias("_rank"), "_bucket.*")


def box_statistics(
    df: DataFrame,
    value: str,
    groups: Sequence[str],
    exact_rows: int = EXACT_ROWS,
) -> DataFrame:
    """Box-plot numbers: n, quartiles, whiskers at 1.5 IQR (last values inside)."""
    long = melt(df, [value], groups).drop("column")
    return boxes(long, groups, df.count() <= exact_rows)


def boxes(long: DataFrame, groups: Sequence[str], fits: bool) -> DataFrame:
    """Box-plot numbers of ``value`` per group of a long table."""
    quarts = long_quantiles(long, list(groups), [0.25, 0.5, 0.75], fits)
    box = quarts.select(
        *cols(groups), "n",
        F.col("quantiles")[0].alias("q1"),
        F.col("quantiles")[1].alias("median"),
        F.col("quantiles")[2].alias("q3"),
    )
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    inside = F.col("value").between(F.col("q1") - reach, F.col("q3") + reach)
    return (
        join_summary(long, box, groups)
        .groupBy(*cols(groups))
        .agg(
            F.first("n").alias("n"),
            F.first("q1").alias("q1"),
            F.first("median").alias("median"),
            F.first("q3").alias("q3"),
            F.min(F.when(inside, F.col("value"))).alias("whisker_low"),
            F.max(F.when(inside, F.col("value"))).alias("whisker_high"),
        )
    )
