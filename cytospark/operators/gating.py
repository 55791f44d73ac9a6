"""Background gating: raise marker values below a fitted background level."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cytospark.functions.names import col, cols, site_of, marker_of, melt_indexed, named, numeric_columns
from cytospark.operators.sizing import join_summary, null_safe_join, settle, small_or_none, spread

# Fixed values of the fit: deviations above the background mean, density grid,
# stop rule and variance floor of the mixture.
BACKGROUND_DEVIATIONS = 2.0
DENSITY_POINTS = 1000
MIXTURE_TOLERANCE = 1e-3
MIXTURE_ITERATIONS = 100
VARIANCE_FLOOR = 1e-6
HISTOGRAM_BINS = 2048

FIT_FIELDS = (
    "components int, threshold double, bg_mean double, bg_std double, means array<double>, "
    "stds array<double>, weights array<double>, bic1 double, bic2 double, low double, high double"
)


def fine_histogram(df: DataFrame, columns: Sequence[str], groups: Sequence[str] = (),
                   bins: int = HISTOGRAM_BINS) -> DataFrame:
    """Rows and mean value per narrow bin: groups, column, bin, weight, centre.

    Two map-side combined passes; at most ``bins`` rows per (group, column).
    """
    keys = [*groups, "_pos"]
    long = melt_indexed(df, columns, groups)
    spans = long.groupBy(*cols(keys)).agg(F.min("value").alias("low"), F.max("value").alias("high"))
    width = (F.col("high") - F.col("low")) / bins
    spot = F.when(width > 0, F.floor((F.col("value") - F.col("low")) / F.when(width > 0, width))).otherwise(0)
    binned = (
        join_summary(long, spans, keys)
        .groupBy(*cols(keys), F.least(spot, F.lit(bins - 1)).cast("int").alias("bin"))
        .agg(
            F.count(F.lit(1)).cast("double").alias("weight"),
            F.avg("value").alias("centre"),
            F.first("low").alias("low"), F.first("high").alias("high"),
        )
    )
    return named(binned, columns)


def _mixture(x: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Two normals on weighted points; starts from the best two-part split."""
    cw, cx, cxx = np.cumsum(w), np.cumsum(w * x), np.cumsum(w * x * x)
    left, right = cw[:-1], cw[-1] - cw[:-1]
    loss = (cxx[:-1] - cx[:-1] ** 2 / left) + (cxx[-1] - cxx[:-1] - (cx[-1] - cx[:-1]) ** 2 / right)
    cut = int(np.argmin(loss)) + 1
    resp = np.zeros((len(x), 2))
    resp[:cut, 0] = 1.0
    resp[cut:, 1] = 1.0
    total, last = w.sum(), -np.inf
    for _ in range(MIXTURE_ITERATIONS + 1):
        mass = (resp * w[:, None]).sum(axis=0) + 10 * np.finfo(float).eps
        mu = (resp * (w * x)[:, None]).sum(axis=0) / mass
        var = (resp * w[:, None] * (x[:, None] - mu) ** 2).sum(axis=0) / mass + VARIANCE_FLOOR
        logp = np.log(mass / total) - 0.5 * (np.log(2 * np.pi * var) + (x[:, None] - mu) ** 2 / var)
        norm = np.logaddexp(logp[:, 0], logp[:, 1])
        resp = np.exp(logp - norm[:, None])
        score = float((w * norm).sum() / total)
        if abs(score - last) < MIXTURE_TOLERANCE:
            break
        last = score
    return mu, np.sqrt(var), mass / total, score * total


def _first_valley(x: np.ndarray, w: np.ndarray, low: float, high: float) -> float | None:
    """First interior minimum of a kernel density with Scott's bandwidth."""
    n = w.sum()
    if n < 2 or high <= low:
        return None
    mean = (w * x).sum() / n
    var = (w * (x - mean) ** 2).sum() / (n - 1)
    if not var > 0:
        return None
    bandwidth = np.sqrt(var) * n ** (-0.2)
    grid = np.linspace(low, high, DENSITY_POINTS)
    density = np.exp(-0.5 * ((grid[:, None] - x[None, :]) / bandwidth) ** 2) @ w
    inner = (density[1:-1] < density[:-2]) & (density[1:-1] < density[2:])
    spots = np.flatnonzero(inner)
    return float(grid[spots[0] + 1]) if len(spots) else None


def fit_background(hist: pd.DataFrame) -> dict:
    """Threshold of one column from its fine histogram."""
    hist = hist.sort_values("centre")
    x, w = hist["centre"].to_numpy(), hist["weight"].to_numpy()
    low, high = float(hist["low"].iloc[0]), float(hist["high"].iloc[0])
    n = w.sum()
    mean = (w * x).sum() / n
    var = (w * (x - mean) ** 2).sum() / n + VARIANCE_FLOOR
    single = float((w * (-0.5 * (np.log(2 * np.pi * var) + (x - mean) ** 2 / var))).sum())
    bic1 = -2 * single + 2 * np.log(n)
    means, stds, weights, bic2 = np.array([mean]), np.array([np.sqrt(var)]), np.array([1.0]), np.nan
    if len(x) > 1:
        mu, sd, share, fit = _mixture(x, w)
        bic2 = -2 * fit + 5 * np.log(n)
        if bic2 < bic1:
            means, stds, weights = mu, sd, share
    order = np.argsort(means)
    bg_mean, bg_std = float(means[order[0]]), float(stds[order[0]])
    threshold = bg_mean + BACKGROUND_DEVIATIONS * bg_std
    valley = _first_valley(x, w, low, high)
    if valley is not None:
        threshold = min(threshold, valley)
    return {
        "components": len(means), "threshold": threshold, "bg_mean": bg_mean, "bg_std": bg_std,
        "means": means[order].tolist(), "stds": stds[order].tolist(), "weights": weights[order].tolist(),
        "bic1": float(bic1), "bic2": float(bic2), "low": low, "high": high,
    }


def thresholds(df: DataFrame, columns: Sequence[str], groups: Sequence[str] = (),
               bins: int = HISTOGRAM_BINS) -> DataFrame:
    """Fitted background per (group, column), from histograms only.

    A fit sees at most ``bins`` rows, whatever the number of cells.
    """
    keys = [*groups, "column"]
    hist = fine_histogram(df, columns, groups, bins)
    types = dict(hist.dtypes)
    schema = ", ".join(f"`{k}` {types[k]}" for k in keys) + ", " + FIT_FIELDS

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([{**{k: pdf[k].iloc[0] for k in keys}, **fit_background(pdf)}])

    return spread(hist, *keys).groupBy(*cols(keys)).applyInPandas(fit, schema)


def _touches(source: str, other: str, prefix_match: str) -> tuple[bool, bool]:
    """Whether the delta and the floor of a column reach another column."""
    if prefix_match == "startswith":
        return other.startswith(marker_of(source)), other.startswith(site_of(source))
    return (
        marker_of(other) == marker_of(source),
        site_of(other) == site_of(source),
    )


def _layers(sources: Sequence[str], reach: dict[str, set[str]]) -> list[list[str]]:
    """Columns in order, grouped so that those of one layer do not interact."""
    level: dict[str, int] = {}
    for i, c in enumerate(sources):
        level[c] = 1 + max((level[e] for e in sources[:i] if reach[e] & reach[c]), default=-1)
    out: list[list[str]] = [[] for _ in range(max(level.values(), default=-1) + 1)]
    for c in sources:
        out[level[c]].append(c)
    return out


def gate(df: DataFrame, columns: Sequence[str], fitted: DataFrame, groups: Sequence[str] = (),
         prefix_match: str = "exact", trace: bool = False) -> DataFrame:
    """Apply fitted thresholds in column order.

    Each column is raised to its threshold; the rise is added to the other
    columns of the marker, and those of the same compartment are floored at
    the background level. Later columns see earlier rises. Columns that do not
    interact share a projection, so the plan has as many steps as a marker has
    mean columns. ``prefix_match="startswith"`` also reaches markers whose
    name merely begins alike.
    """
    columns = list(columns)
    measures = numeric_columns(df)
    reach = {c: {o for o in measures if any(_touches(c, o, prefix_match))} | {c} for c in columns}

    packed = fitted.groupBy(*cols(groups)).agg(F.map_from_entries(F.collect_list(F.struct(
        "column", F.struct("threshold", "bg_mean", "bg_std")))).alias("_fit"))
    out = join_summary(df, packed, groups, "left") if groups else df.crossJoin(F.broadcast(packed))
    kept = list(df.columns)
    for layer in _layers(columns, reach):
        prepared = out.select(*cols(kept), F.col("_fit"), *[
            F.col("_fit")[c].alias(f"_t{i}") for i, c in enumerate(layer)
        ])
        rises = prepared.select("*", *[
            F.when(col(c) < F.col(f"_t{i}.threshold"), F.col(f"_t{i}.threshold") - col(c))
            .when(col(c).isNotNull(), F.lit(0.0)).alias(f"_d{i}")
            for i, c in enumerate(layer)
        ])
        new = {c: col(c) for c in kept}
        for i, c in enumerate(layer):
            fit = F.col(f"_t{i}")
            new[c] = F.when(col(c) < fit["threshold"], fit["threshold"]).otherwise(col(c))
            for other in reach[c] - {c}:
                adds, floors = _touches(c, other, prefix_match)
                v = new[other]
                if adds:
                    v = v + F.coalesce(F.col(f"_d{i}"), F.lit(0.0))
                if floors:
                    level = fit["bg_mean"] + BACKGROUND_DEVIATIONS * fit["bg_std"]
                    below = F.when(
                        fit["bg_std"] > 0,
                        (v - fit["bg_mean"]) / F.when(fit["bg_std"] > 0, fit["bg_std"]) < BACKGROUND_DEVIATIONS,
                    ).otherwise(v.isNotNull())
                    v = F.when(below, level).otherwise(v)
                new[other] = v
        traced = []
        if trace:
            for i, c in enumerate(layer):
                traced += [col(c).alias(f"_pre:{c}"), new[c].alias(f"_post:{c}")]
        out = rises.select(*[new[c].alias(c) for c in kept], *traced, "_fit")
        kept += [f"{p}:{c}" for c in layer for p in ("_pre", "_post")] if trace else []
    return out.drop("_fit")


def gate_background(df: DataFrame, columns: Sequence[str] | None = None, groups: Sequence[str] = (),
                    prefix_match: str = "exact", bins: int = HISTOGRAM_BINS) -> DataFrame:
    """Fit and apply in one call."""
    columns = [c for c in df.columns if "Mean" in c] if columns is None else list(columns)
    fitted = thresholds(df, columns, groups, bins)
    small = small_or_none(fitted)
    return gate(df, columns, fitted if small is None else small, groups, prefix_match)


def gating_summary(df: DataFrame, columns: Sequence[str], fitted: DataFrame, groups: Sequence[str] = (),
                   prefix_match: str = "exact") -> DataFrame:
    """Per (group, column): threshold, mixture, means before, after and of the rise."""
    fitted = settle(fitted, "gating_fit")  # the mixtures are read twice
    traced = gate(df, columns, fitted, groups, prefix_match, trace=True)
    wide = traced.groupBy(*cols(groups)).agg(F.array(*[
        F.struct(
            F.lit(c).alias("column"),
            F.avg(col(f"_pre:{c}")).alias("pre_mean"),
            F.avg(col(f"_post:{c}")).alias("post_mean"),
            F.avg(col(f"_post:{c}") - col(f"_pre:{c}")).alias("delta_mean"),
        )
        for c in columns
    ]).alias("_a"))
    figures = wide.select(*cols(groups), F.inline("_a"))
    return null_safe_join(fitted.select(*cols(groups), "column", "threshold", "means", "stds"), figures, [*groups, "column"])


def density_curve(fitted: DataFrame, groups: Sequence[str] = (), points: int = DENSITY_POINTS) -> DataFrame:
    """Fitted mixture density on an even grid between minimum and maximum."""
    grid = fitted.select("*", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("i")).withColumn(
        "x", F.col("low") + (F.col("high") - F.col("low")) * F.col("i") / (points - 1))

    def normal(part: Column) -> Column:
        return (
            part["w"] / (part["s"] * F.lit(float(np.sqrt(2 * np.pi))))
            * F.exp(-0.5 * F.pow((F.col("x") - part["m"]) / part["s"], 2))
        )

    parts = F.arrays_zip(F.col("means").alias("m"), F.col("stds").alias("s"), F.col("weights").alias("w"))
    return grid.select(
        *cols(groups), "column", "i", "x",
        F.aggregate(parts, F.lit(0.0), lambda acc, p: acc + normal(p)).alias("density"),
    )
