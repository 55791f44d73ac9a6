"""Variation, distribution and comparison figures of the measure columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cytospark.functions.names import col, cols, matching, melt, nuclear_only, per_column, display_name, without_nuclear
from cytospark.functions.scalars import every_nth, guarded_ratio
from cytospark.operators.quantiles import EXACT_ROWS, boxes
from cytospark.operators.sizing import join_summary


def _short(columns: Sequence[str]) -> Column:
    return F.create_map(*[x for c in columns for x in (F.lit(c), F.lit(display_name(c)))])[F.col("column")]


def cv_by_slide(df: DataFrame, slide: str, columns: Sequence[str], name: str) -> DataFrame:
    """Coefficient of variation per (marker, slide); null unless the mean is positive."""
    cv = per_column(df, columns, [slide], guarded_ratio(F.stddev_samp("value"), F.avg("value")).alias(name))
    return cv.select(col(slide).alias("slide"), "column", name)


def cv_metrics(before: DataFrame, after: DataFrame, slide: str, columns: Sequence[str]) -> DataFrame:
    """marker, slide, cv_original, cv_transformed, cv_improvement."""
    both = cv_by_slide(before, slide, columns, "cv_original").unionByName(
        cv_by_slide(after, slide, columns, "cv_transformed"), allowMissingColumns=True)
    # Grouped, not joined: a null slide is a slide.
    both = both.groupBy("slide", "column").agg(F.max("cv_original").alias("cv_original"), F.max("cv_transformed").alias("cv_transformed"))
    return both.select(
        _short(columns).alias("marker"), "slide", "cv_original", "cv_transformed",
        (F.col("cv_original") - F.col("cv_transformed")).alias("cv_improvement"),
    )


def cv_summary(cv: DataFrame) -> DataFrame:
    return cv.agg(
        F.avg("cv_improvement").alias("mean_cv_improvement"),
        F.median("cv_improvement").alias("median_cv_improvement"),
        F.count_if(F.col("cv_improvement") > 0).alias("markers_improved"),
        F.count_if(F.col("cv_improvement") < 0).alias("markers_worsened"),
    )


def cv_matrix(cv: DataFrame, slides: Sequence[str], value: str = "cv_improvement") -> DataFrame:
    """Marker x slide matrix of one figure."""
    return cv.groupBy("marker").pivot("slide", list(slides)).agg(F.first(value))


def worst_markers(cv: DataFrame, n: int = 5) -> DataFrame:
    """The n markers with the smallest mean improvement."""
    return (
        cv.groupBy("marker")
        .agg(F.avg("cv_improvement").alias("cv_improvement"), F.avg("cv_transformed").alias("cv_transformed"))
        .filter(F.col("cv_improvement").isNotNull())
        .orderBy("cv_improvement", "marker")
        .limit(n)
    )


def distinct_counts(df: DataFrame, slide: str, n_markers: int) -> DataFrame:
    """Number of slides, markers and cells."""
    return df.agg(
        F.countDistinct(col(slide)).alias("total_slides"),
        F.lit(n_markers).cast("long").alias("total_markers"),
        F.count(F.lit(1)).alias("total_cells"),
    )


def histogram(df: DataFrame, columns: Sequence[str], bins: int = 16, groups: Sequence[str] = (),
              pooled: bool = False) -> DataFrame:
    """Equal-width histogram per column, or over all columns pooled.

    Bin id from 0; the last bin is closed. Columns: count, density, bin_low.
    A constant column has all rows in bin 0.
    """
    keys = [*groups] if pooled else [*groups, "column"]
    long = melt(df, columns, groups)
    if not keys:
        long, keys = long.withColumn("_all", F.lit(1)), ["_all"]
    spans = long.groupBy(*cols(keys)).agg(
        F.min("value").alias("_low"), F.max("value").alias("_high"), F.count("value").alias("_n"))
    placed = join_summary(long, spans, keys)
    width = (F.col("_high") - F.col("_low")) / bins
    spot = F.when(width > 0, F.floor((F.col("value") - F.col("_low")) / F.when(width > 0, width))).otherwise(0)
    out = (
        placed.groupBy(*cols(keys), F.least(spot, F.lit(bins - 1)).cast("int").alias("bin"))
        .agg(
            F.count(F.lit(1)).alias("count"),
            F.first("_low").alias("_low"), F.first("_high").alias("_high"), F.first("_n").alias("_n"),
        )
        .select(
            *cols(keys), "bin", "count",
            F.when(width > 0, F.col("count") / F.col("_n") / F.when(width > 0, width)).alias("density"),
            (F.col("_low") + F.col("bin") * width).alias("bin_low"),
        )
    )
    return out.drop("_all")


def slide_boxes(df: DataFrame, slide: str, columns: Sequence[str], exact_rows: int = EXACT_ROWS) -> DataFrame:
    """Box statistics per slide over the pooled columns (whiskers at 1.5 IQR)."""
    long = melt(df, columns, [slide]).drop("column")
    return boxes(long, [slide], df.count() * len(columns) <= exact_rows)


def marker_extremes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Darkest and brightest column by mean."""
    means = per_column(df, columns, [], F.avg("value").alias("mean"))
    return means.agg(
        F.min_by("column", F.struct("mean", "column")).alias("darkest"),
        F.min("mean").alias("darkest_mean"),
        F.max_by("column", F.struct("mean", "column")).alias("brightest"),
        F.max("mean").alias("brightest_mean"),
    )


def method_comparison(df: DataFrame, nuclear: str, columns: Sequence[str], bins: int = 16) -> DataFrame:
    """Histogram data of one normalised table: nuclear stain, all others pooled,
    darkest and brightest of the others."""
    nuc = [c for c in nuclear_only(df, nuclear) if c in set(columns)][:1]
    others = [c for c in without_nuclear(df, nuclear) if c in set(columns)]
    extremes = marker_extremes(df, others).first()  # one row
    parts = [
        histogram(df, nuc, bins).select(F.lit("nuclear").alias("panel"), "column", "bin", "count", "bin_low"),
        histogram(df, others, bins, pooled=True).select(
            F.lit("others").alias("panel"), F.lit("all others").alias("column"), "bin", "count", "bin_low"),
        histogram(df, [extremes["darkest"]], bins).select(
            F.lit("darkest").alias("panel"), "column", "bin", "count", "bin_low"),
        histogram(df, [extremes["brightest"]], bins).select(
            F.lit("brightest").alias("panel"), "column", "bin", "count", "bin_low"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def example_markers(df: DataFrame, nuclear: str, n_examples: int = 5) -> DataFrame:
    """(place, column) of mean columns spread evenly over the panel, the nuclear stain among them.

    The stain takes the first place where the spread misses it; without a stain
    the first mean column counts as one.
    """
    panel = [F.lit(c) for c in matching(df, "Mean")]
    one = df.sparkSession.range(1).select(F.array(*panel).cast("array<string>").alias("means"))
    stain = F.coalesce(F.try_element_at(F.filter("means", lambda c: c.contains(nuclear)), F.lit(1)), F.try_element_at("means", F.lit(1)))
    spread = every_nth(F.col("means"), F.greatest(F.lit(1), F.floor(F.size("means") / n_examples).cast("int")), F.lit(n_examples))
    chosen = one.select(spread.alias("spread"), stain.alias("stain")).select(
        F.when(F.array_contains("spread", F.col("stain")), F.col("spread"))
        .otherwise(F.concat(F.array("stain"), F.slice("spread", 2, n_examples))).alias("chosen"))
    return chosen.select(F.posexplode("chosen").alias("place", "column")).filter(F.col("column").isNotNull())


def scatter_reference(before: DataFrame, after: DataFrame, nuclear: str, n_examples: int = 5) -> DataFrame:
    """Largest value before and after per example column."""
    columns = matching(before, "Mean")
    a = per_column(before, columns, [], F.max("value").alias("max_original"))
    b = per_column(after, columns, [], F.max("value").alias("max_transformed"))
    shown = F.broadcast(example_markers(before, nuclear, n_examples).select("column"))  # n_examples rows
    return a.join(b, "column").join(shown, "column").select(_short(columns).alias("marker"), "max_original", "max_transformed")
