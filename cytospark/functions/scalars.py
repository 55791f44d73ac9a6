"""Scalar expressions used by the operators and in reports."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# The penalty grid exp(FIRST + i * ln(10) * SPAN / STEPS).
ALPHA_FIRST = -5.1
ALPHA_SPAN = 5.0996
ALPHA_STEPS = 95
# Labels that count as no annotation. ``Ignore*`` is literal text.
NEGATIVE_LABELS = ["??", "?", "0", "Negative", "Ignore*"]


def log_plus_one(c: Column) -> Column:
    """ln(x + 1); null at or below -1, where the logarithm is undefined."""
    return F.when(c > -1, F.log1p(c))


def bin_index(c: Column, size: float) -> Column:
    return F.floor(c / F.lit(float(size))).cast("int")


def name_part(c: Column, sep: str, part: int) -> Column:
    """Part of a text by separator, counted from 1."""
    return F.split_part(c, F.lit(sep), F.lit(part))


def alnum_only(c: Column) -> Column:
    return F.regexp_replace(c, "[^a-zA-Z0-9]", "")


def underscored(c: Column) -> Column:
    """Spaces and pipes to underscores, slashes dropped."""
    return F.translate(c, " |/", "__")


def compact_label(c: Column) -> Column:
    """White space and slashes dropped, pipes to underscores."""
    return F.regexp_replace(F.regexp_replace(c, r"[\s/]+", ""), r"\|", "_")


def without_brackets(c: Column) -> Column:
    return F.translate(c, "[]", "")


def clean_label(c: Column) -> Column:
    return F.trim(c)


def percent_text(c: Column, digits: int = 2) -> Column:
    """Fraction as text, e.g. 0.5 -> ``50.00%``; ties go to the even digit."""
    return F.format_string(f"%.{digits}f%%", F.bround(c * 100.0, digits))


def percent_value(c: Column) -> Column:
    """Percent text back to a fraction."""
    return F.try_divide(F.rtrim(c, F.lit("%")).try_cast("double"), F.lit(100.0))


def range_text(first: Column, last: Column) -> Column:
    return F.concat(F.round(first, 4).cast("string"), F.lit("-"), F.round(last, 4).cast("string"))


def range_start(c: Column) -> Column:
    return F.split_part(c, F.lit("-"), F.lit(1)).try_cast("double")


def at_least(c: Column, floor: Column | float) -> Column:
    """Raise values below the floor to it; null stays null."""
    floor = floor if isinstance(floor, Column) else F.lit(float(floor))
    return F.when(c < floor, floor).otherwise(c)


def guarded_ratio(num: Column, den: Column) -> Column:
    """num / den where den is positive, else null."""
    return F.when(den > 0, num / den)


def power_transform(x: Column, lam: Column | float) -> Column:
    """(x^l - 1) / l, and ln x at l = 0, for positive x."""
    lam = lam if isinstance(lam, Column) else F.lit(float(lam))
    return F.when(
        x > 0,
        F.when(F.abs(lam) < 1e-12, F.log(x)).otherwise((F.pow(x, lam) - 1.0) / F.when(F.abs(lam) >= 1e-12, lam)),
    )


def z_score(c: Column, mean: Column, std: Column) -> Column:
    """Distance to the mean in deviations; 0 where the deviation is not positive."""
    return F.when(std > 0, (c - mean) / std).otherwise(c * 0.0)


def thousands(c: Column) -> Column:
    return F.format_number(c, 0)


def now_text(fmt: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    return F.date_format(F.current_timestamp(), fmt)


def holdout_band(auc: Column) -> Column:
    """Level of a class in the ranking table."""
    return (
        F.when(auc >= 0.9, "Excellent").when(auc >= 0.8, "Good").when(auc >= 0.7, "Fair").otherwise("Poor")
    )


def report_band(auc: Column) -> Column:
    """Level of a class in the report; null score -> N/A."""
    return (
        F.when(auc.isNull(), "N/A")
        .when(auc >= 0.9, "Excellent")
        .when(auc >= 0.8, "Good")
        .when(auc >= 0.7, "Moderate")
        .when(auc >= 0.6, "Poor")
        .otherwise("Very Poor")
    )


def balance_band(percent: Column) -> Column:
    return (
        F.when(percent < 5, "Severely Under.")
        .when(percent < 10, "Underrepresented")
        .when(percent > 40, "Dominant")
        .otherwise("Balanced")
    )


def alpha_grid() -> list[float]:
    """The 96 penalties of the search."""
    return [
        math.exp(ALPHA_FIRST + i * (math.log(10) * ALPHA_SPAN / ALPHA_STEPS))
        for i in range(ALPHA_STEPS + 1)
    ]


def alpha_grid_column() -> Column:
    """The same grid as an array expression."""
    return F.transform(
        F.sequence(F.lit(0), F.lit(ALPHA_STEPS)),
        lambda i: F.exp(F.lit(ALPHA_FIRST) + i * (F.log(F.lit(10.0)) * F.lit(ALPHA_SPAN) / F.lit(ALPHA_STEPS))),
    )


def kept_share(optimal: Column, original: Column) -> Column:
    """Selected features in percent of all; null without features."""
    return F.when(original > 0, optimal / original * 100.0)


def every_nth(items: Column, step: Column, count: Column) -> Column:
    """Every n-th element of an array, at most ``count`` of them."""
    return F.slice(F.filter(items, lambda _, i: i % step == 0), F.lit(1), count)
