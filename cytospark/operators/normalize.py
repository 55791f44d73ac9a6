"""Four transforms of the measure columns, fitted per batch or on the table."""

from __future__ import annotations

import warnings
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cytospark.functions.names import (
    BOXCOX_PATTERN,
    SCALER_PATTERN,
    col,
    cols,
    matching,
    melt,
    melt_indexed,
    named,
    nan_to_null,
    numeric_columns,
    per_column,
)
from cytospark.functions.scalars import log_plus_one, power_transform
from cytospark.operators import dispersion
from cytospark.operators.quantiles import EXACT_ROWS, quantiles
from cytospark.operators.sizing import MAX_BROADCAST_BYTES, MAX_BROADCAST_ROWS, held, join_summary, null_safe_join

# Output range of the min-max scaling, number of quantile references.
MINMAX_RANGE = (-2.0, 2.0)
QUANTILE_REFERENCES = 1024
# Both names of the logarithm are accepted.
METHODS = ("boxcox", "quantile", "minmax", "logscale")
METHOD_ALIASES = {"log": "logscale"}


# -- parameters as a wide row per group ---------------------------------------

def _per_group(df: DataFrame, params: DataFrame, groups: Sequence[str]) -> tuple[DataFrame, str]:
    """Attach long-form parameters (groups, column, ...) as one map column.

    There is one row per group and a map entry per column, so the table is
    checked to be small and broadcast; rows are not shuffled.
    """
    extra = [c for c in params.columns if c not in (*groups, "column")]
    packed = params.groupBy(*cols(groups)).agg(
        F.map_from_entries(F.collect_list(F.struct("column", F.struct(*cols(extra))))).alias("_params")
    )
    if groups:
        return join_summary(df, packed, groups, how="left"), "_params"
    return df.crossJoin(F.broadcast(packed)), "_params"


def _apply(df: DataFrame, params: DataFrame, groups: Sequence[str], columns: Sequence[str],
           formula, fill: float | None = 0.0) -> DataFrame:
    """One projection that replaces every column by formula(value, parameters)."""
    joined, name = _per_group(df, params, groups)
    # Read every column's parameters once per row before the formulas use them.
    wide = joined.select(
        *cols(df.columns), *[col(name)[c].alias(f"_p{i}") for i, c in enumerate(columns)]
    )
    position = {c: i for i, c in enumerate(columns)}
    out = []
    for f in df.schema.fields:
        if f.name in position:
            x = nan_to_null(col(f.name).cast("double"))
            y = formula(x, F.col(f"_p{position[f.name]}"))
            y = F.coalesce(y, F.lit(fill)) if fill is not None else y
            out.append(y.alias(f.name))
        else:
            out.append(col(f.name))
    return wide.select(out)


# -- min-max ------------------------------------------------------------------

def minmax_fit(df: DataFrame, columns: Sequence[str], groups: Sequence[str] = ()) -> DataFrame:
    return per_column(df, columns, groups, F.min("value").alias("low"), F.max("value").alias("high"))


def minmax(df: DataFrame, columns: Sequence[str] | None = None, groups: Sequence[str] = (),
           bounds: tuple[float, float] = MINMAX_RANGE) -> DataFrame:
    """Linear scaling to the bounds; a constant column gives the lower one, null gives 0."""
    columns = matching(df, SCALER_PATTERN) if columns is None else list(columns)
    lo, hi = bounds

    def formula(x: Column, p: Column) -> Column:
        width = p["high"] - p["low"]
        return F.when(width > 0, (x - p["low"]) / width * (hi - lo) + lo).when(x.isNotNull(), F.lit(lo))

    return _apply(df, minmax_fit(df, columns, groups), groups, columns, formula)


# -- logarithm ----------------------------------------------------------------

def logscale(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """ln(x + 1) on every numeric column except centroids; map-only."""
    columns = [c for c in numeric_columns(df) if "Centroid" not in c] if columns is None else list(columns)
    chosen = set(columns)
    return df.select(*[
        log_plus_one(nan_to_null(col(c).cast("double"))).alias(c) if c in chosen else col(c) for c in df.columns
    ])


# -- quantile -----------------------------------------------------------------

def quantile_fit(df: DataFrame, columns: Sequence[str], groups: Sequence[str] = (),
                 n_quantiles: int = QUANTILE_REFERENCES, exact_rows: int = EXACT_ROWS,
                 exact: bool = True) -> DataFrame:
    """Reference values at evenly spaced probabilities, on all rows."""
    probs = np.linspace(0.0, 1.0, n_quantiles).tolist()
    return quantiles(df, columns, probs, groups, exact_rows, exact=exact).drop("n")


def _uniform_scores(x: np.ndarray, refs: np.ndarray, probs: np.ndarray) -> np.ndarray:
    """Rank share of x among the references, ties averaged from both sides."""
    out = np.zeros(len(x))
    ok = np.isfinite(x)
    v = x[ok]
    up = np.interp(v, refs, probs)
    down = np.interp(-v, -refs[::-1], -probs[::-1])
    score = 0.5 * (up - down)
    score[v == refs[-1]] = 1.0
    score[v == refs[0]] = 0.0
    out[ok] = score
    return out


def _search_columns(rows: DataFrame, groups: Sequence[str], count: int, count_columns: int) -> DataFrame:
    """Of each ``_refs<i>``: its distinct values, the place of the first of each, and the steps of a binary search.

    Values are padded with infinity to a power of two less one, so that no step falls outside.
    """
    powers = ", ".join(str(1 << b) for b in reversed(range(count.bit_length())))
    each = range(count_columns)
    out = rows.selectExpr(*_names(groups), *[f"array_distinct(_refs{i}) as _d{i}" for i in each], *[f"_refs{i}" for i in each])
    out = out.selectExpr(*_names(groups), *[f"_d{i}" for i in each], *[f"_refs{i}" for i in each],
                         *[f"filter(array({powers}), s -> s <= size(_d{i})) as _steps{i}" for i in each])
    return out.selectExpr(
        *_names(groups), *[f"_steps{i}" for i in each],
        *[f"concat(_d{i}, array_repeat(double('infinity'), 2 * get(_steps{i}, 0) - 1 - size(_d{i}))) as _x{i}" for i in each],
        *[f"concat(transform(_d{i}, r -> cast(array_position(_refs{i}, r) as int) - 1), array({count})) as _first{i}" for i in each],
        *[f"array_max(_d{i}) as _top{i}" for i in each], *[f"array_min(_d{i}) as _least{i}" for i in each])


def _names(columns: Sequence[str]) -> list[str]:
    return ["`" + c.replace("`", "``") + "`" for c in columns]


def _uniform_score(i: int, count: int) -> str:
    """Rank share of ``_value<i>`` among the references, ties averaged from both sides; null gives 0."""
    x, first, value = f"_x{i}", f"_first{i}", f"_value{i}"

    def share(place: str) -> str:  # as linspace gives it
        return f"if({place} = {count - 1}, 1.0D, ({place}) * {1 / max(count - 1, 1)!r}D)"

    found = f"aggregate(_steps{i}, -1, (at, s) -> if({x}[at + s] <= {value}, at + s, at))"
    # In the order of _uniform_scores, so that both give the same last digit.
    low, high = share(f"{first}[at + 1] - 1"), share(f"{first}[at + 1]")
    slope = f"(({high} - {low}) / ({x}[at + 1] - {x}[at]))"
    score = f"""if({x}[at] = {value}, 0.5D * ({low} + {share(f"{first}[at]")}),
        0.5D * (({slope} * ({value} - {x}[at]) + {low}) - ({slope} * ({x}[at + 1] - {value}) - {high})))"""
    # A lambda names the place found, so that the search is done once.
    return f"""case when {value} is null or {x} is null or {value} <= _least{i} then 0.0D
        when {value} >= _top{i} then 1.0D else transform(array({found}), at -> {score})[0] end"""


def quantile(df: DataFrame, columns: Sequence[str] | None = None, groups: Sequence[str] = (),
             n_quantiles: int = QUANTILE_REFERENCES, exact_rows: int = EXACT_ROWS,
             exact: bool = True, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Map every column to uniform [0, 1] by its own quantiles; null gives 0.

    The table is scanned once whatever the number of groups. References of up to ``max_bytes`` travel with a vectorised
    search on Arrow batches of the measures. Beyond, those of a group are one row of arrays, rows meet theirs in
    a hash join by group, and the search is an expression; that copies the arrays for every row, so it is slower.
    """
    columns = matching(df, SCALER_PATTERN) if columns is None else list(columns)
    if not columns:
        return df
    groups = list(groups)
    small, fitted = held(quantile_fit(df, columns, groups, n_quantiles, exact_rows, exact), max_bytes=max_bytes)
    if small is not None:
        return _interpolated(df, columns, groups, small, n_quantiles)
    place = {c: i for i, c in enumerate(columns)}
    rows = fitted.groupBy(*cols(groups)).agg(*[
        F.max(F.when(F.col("column") == c, F.col("quantiles"))).alias(f"_refs{i}") for c, i in place.items()])
    rows = _search_columns(rows, groups, n_quantiles, len(columns))
    joined = null_safe_join(df, rows.hint("shuffle_hash"), groups, "left") if groups else df.crossJoin(F.broadcast(rows))  # one row
    taken = joined.select("*", *[nan_to_null(col(c).cast("double")).alias(f"_value{i}") for c, i in place.items()])
    return taken.select(*[
        F.expr(_uniform_score(place[c], n_quantiles)).alias(c) if c in place else col(c) for c in df.columns
    ])


def _interpolated(df: DataFrame, columns: Sequence[str], groups: Sequence[str], fitted: DataFrame,
                  n_quantiles: int) -> DataFrame:
    """Scores by a vectorised search of references of checked size; only keys and measures leave the JVM."""
    refs = {}
    for r in fitted.toLocalIterator():
        refs[(tuple(r[g] for g in groups), r["column"])] = np.maximum.accumulate(np.asarray(r["quantiles"]))
    probs = np.linspace(0.0, 1.0, n_quantiles)
    shared = df.sparkSession.sparkContext.broadcast(refs)
    out_type = T.StructType([T.StructField(f"c{i}", T.DoubleType()) for i in range(len(columns))])
    n_groups = len(groups)

    @F.pandas_udf(out_type)
    def scores(batch: pd.DataFrame) -> pd.DataFrame:
        table = shared.value
        values = batch.iloc[:, n_groups:].to_numpy(dtype=float)
        result = np.zeros_like(values)
        if n_groups:
            # pandas writes a missing key in several ways; the references have None.
            keys = batch.iloc[:, :n_groups]
            parts = keys.groupby(list(keys.columns), sort=False, dropna=False).indices.items()
        else:
            parts = [((), np.arange(len(batch)))]
        for key, rows in parts:
            key = key if isinstance(key, tuple) else (key,)
            key = tuple(None if pd.isna(k) else k for k in key)
            for i, c in enumerate(columns):
                ref = table.get((key, c))
                if ref is not None:
                    result[rows, i] = _uniform_scores(values[rows, i], ref, probs)
        return pd.DataFrame(result, columns=[f"c{i}" for i in range(len(columns))])

    packed = F.struct(
        *[col(g).alias(f"g{i}") for i, g in enumerate(groups)],
        *[nan_to_null(col(c).cast("double")).alias(f"v{i}") for i, c in enumerate(columns)],
    )
    position = {c: i for i, c in enumerate(columns)}
    return df.withColumn("_scores", scores(packed)).select(*[
        F.col(f"_scores.c{position[c]}").alias(c) if c in position else col(c) for c in df.columns
    ])


# -- Box-Cox ------------------------------------------------------------------

@dataclass(frozen=True)
class BoxCoxSearch:
    """Grid of ``points`` lambdas around a centre; the step shrinks by ``shrink``."""

    start: float = 0.0
    step: float = 1.0
    points: int = 7
    shrink: float = 8.0
    smallest_step: float = 1e-3
    max_passes: int = 24


def _shifted(df: DataFrame, columns: Sequence[str], groups: Sequence[str]) -> DataFrame:
    """Long form (groups, _pos, x) of x + 1, missing values counted as 0."""
    long = melt_indexed(df, columns, groups, fill=0.0)
    return long.select(*cols(groups), "_pos", (F.col("value") + 1.0).alias("x"))


def log_likelihood(df: DataFrame, columns: Sequence[str], groups: Sequence[str],
                   lambdas: Sequence[float]) -> DataFrame:
    """Box-Cox log-likelihood of x + 1 at fixed lambdas: groups, column, lambda, llf.

    (l - 1) * sum(ln x) - n/2 * ln(var_pop(y_l)), one aggregation for all.
    """
    keys = [*groups, "_pos"]
    shifted = _shifted(df, columns, groups)
    spreads = [
        F.var_pop(power_transform(F.col("x"), lam)).alias(f"_v{i}") for i, lam in enumerate(lambdas)
    ]
    stats = shifted.filter("x > 0").groupBy(*cols(keys)).agg(
        F.count("x").alias("_n"), F.sum(F.log("x")).alias("_s"), *spreads
    )
    rows = F.explode(F.array(*[
        F.struct(F.lit(float(lam)).alias("lambda"), F.col(f"_v{i}").alias("v"))
        for i, lam in enumerate(lambdas)
    ]))
    out = stats.select(*cols(keys), "_n", "_s", rows.alias("_r")).select(
        *cols(keys),
        F.col("_r.lambda").alias("lambda"),
        ((F.col("_r.lambda") - 1) * F.col("_s") - F.col("_n") / 2 * F.log("_r.v")).alias("llf"),
    )
    return named(out, columns)


def _times(base: Column, factor: Column, count: int) -> Column:
    """base * factor^count for a small whole number."""
    for _ in range(abs(count)):
        base = base * factor if count > 0 else base / factor
    return base


def boxcox_fit(df: DataFrame, columns: Sequence[str], groups: Sequence[str] = (),
               search: BoxCoxSearch = BoxCoxSearch()) -> DataFrame:
    """Maximum-likelihood lambda per (group, column); null where it cannot be fitted.

    Each pass evaluates a few lambdas for all columns in one map-side combined
    aggregation. A best value inside the grid becomes the new centre (vertex of
    the parabola through its neighbours) with a smaller step; one on the border
    moves the grid. Only one row per group and column travels between passes.
    """
    keys = [*groups, "_pos"]
    long = _shifted(df, columns, groups)
    base = long.groupBy(*cols(keys)).agg(
        F.count("x").alias("n"), F.min("x").alias("_min"), F.max("x").alias("_max"),
        F.avg(F.log(F.when(F.col("x") > 0, F.col("x")))).alias("_mu"),
    )
    rows = base.collect()  # a few numbers for each (group, column), whatever the number of cells
    state = {
        tuple(r[k] for k in keys): [search.start, search.step, r["_mu"], r["n"]]
        for r in rows if r["_min"] > 0 and r["_max"] > r["_min"]
    }
    best: dict[tuple, float] = {}
    key_types = ", ".join(f"`{k}` {t}" for k, t in base.dtypes if k in keys)
    half = search.points // 2
    for _ in range(search.max_passes):
        active = {k: v for k, v in state.items() if v[1] >= search.smallest_step}
        if not active:
            break
        grid = df.sparkSession.createDataFrame(
            [(*k, v[0], v[1], v[2]) for k, v in active.items()],
            f"{key_types}, _c double, _h double, _mu double")
        # Relative to the geometric mean the likelihood is -n/2 ln var(x^l / l).
        centred = F.log("x") - F.col("_mu")
        # x^(c + k h) = x^c * (x^h)^k, so a value needs two exponentials for all lambdas.
        powers = null_safe_join(long, grid, keys, small=len(active) <= MAX_BROADCAST_ROWS).select(
            *cols(keys), centred.alias("_z"), F.exp(F.col("_c") * centred).alias("_e"),
            F.exp(F.col("_h") * centred).alias("_s"))
        scan = powers.groupBy(*cols(keys)).agg(
            F.var_pop("_z").alias("_v"),
            *[F.var_pop(_times(F.col("_e"), F.col("_s"), i - half)).alias(f"_v{i}") for i in range(search.points)],
        )
        for r in scan.collect():
            k = tuple(r[c] for c in keys)
            centre, step, _, n = state[k]
            lams = [centre + step * (i - half) for i in range(search.points)]
            llf = np.array([
                -n / 2 * (np.log(r["_v"]) if abs(lam) < 1e-9 else np.log(r[f"_v{i}"]) - 2 * np.log(abs(lam)))
                for i, lam in enumerate(lams)
            ])
            top = int(np.nanargmax(llf))
            if 0 < top < search.points - 1:
                bend = llf[top - 1] - 2 * llf[top] + llf[top + 1]
                lean = step * 0.5 * (llf[top - 1] - llf[top + 1]) / bend if bend < 0 else 0.0
                state[k][:2] = [float(lams[top] + lean), step / search.shrink]
                best[k] = float(lams[top] + lean)
            else:
                state[k][0] = float(lams[top])
    open_ended = [k for k in state if k not in best]
    if open_ended:
        warnings.warn(f"no Box-Cox optimum within {search.max_passes} passes, counted as failed: "
                      f"{[(*k[:-1], columns[k[-1]]) for k in open_ended]}", stacklevel=2)
    fitted = df.sparkSession.createDataFrame(
        [(*k, int(r["n"]), best.get(k)) for r in rows for k in [tuple(r[c] for c in keys)]],
        f"{key_types}, n bigint, lambda double")
    return named(fitted, columns)


def boxcox(df: DataFrame, columns: Sequence[str] | None = None, groups: Sequence[str] = (),
           search: BoxCoxSearch = BoxCoxSearch(), fitted: DataFrame | None = None) -> DataFrame:
    """Power transform of x + 1 at the fitted lambda; a column without fit gives 0."""
    columns = matching(df, BOXCOX_PATTERN) if columns is None else list(columns)
    params = boxcox_fit(df, columns, groups, search) if fitted is None else fitted
    filled = df.select(*[
        F.coalesce(nan_to_null(col(f.name).cast("double")), F.lit(0.0)).alias(f.name)
        if isinstance(f.dataType, T.NumericType) and f.name in set(columns) else col(f.name)
        for f in df.schema.fields
    ])
    return _apply(filled, params.select(*cols(groups), "column", "lambda"), groups, columns,
                  lambda x, p: power_transform(x + 1.0, p["lambda"]))


def boxcox_record(before: DataFrame, after: DataFrame, fitted: DataFrame, columns: Sequence[str],
                  groups: Sequence[str] = ()) -> DataFrame:
    """Per feature: mean before, lambda (3 decimals, or Failed), mean/min/max after."""
    keys = [*groups, "column"]
    filled = per_column(before, columns, groups, F.avg("value").alias("pre_mean"), fill=0.0)
    post = per_column(
        after, columns, groups,
        F.avg("value").alias("post_mean"), F.min("value").alias("post_min"), F.max("value").alias("post_max"))
    text = F.coalesce(F.format_string("%.3f", F.col("lambda")), F.lit("Failed"))
    return null_safe_join(null_safe_join(filled, fitted, keys), post, keys).select(
        *cols(groups), F.col("column").alias("feature"), "pre_mean",
        F.when(F.col("lambda").isNull(), "Failed").otherwise(text).alias("lambda"),
        "post_mean", "post_min", "post_max",
    )


def lambda_summary(record: DataFrame) -> DataFrame:
    """Counts of fitted and failed features, mean and median lambda."""
    value = F.when(F.col("lambda") != "Failed", F.col("lambda")).try_cast("double")
    return record.agg(
        F.count(F.lit(1)).alias("total_features"),
        F.count_if(F.col("lambda") != "Failed").alias("successful_transforms"),
        F.count_if(F.col("lambda") == "Failed").alias("failed_transforms"),
        F.avg(value).alias("mean_lambda"),
        F.median(value).alias("median_lambda"),
    )


def scaling_summary(after: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Number of columns, mean of the ranges, overall minimum and maximum."""
    ranges = minmax_fit(after, columns)
    return ranges.agg(
        F.count(F.lit(1)).alias("total_features_transformed"),
        F.avg(F.col("high") - F.col("low")).alias("mean_scale_factor"),
        F.min("low").alias("min_transformed_value"),
        F.max("high").alias("max_transformed_value"),
    )


def finite_max(df: DataFrame, columns: Sequence[str], default: float = 65535.0) -> DataFrame:
    """Largest finite value of the columns, or the default where there is none."""
    finite = F.when(F.abs("value") < float("inf"), F.col("value"))
    return melt(df, columns).agg(F.coalesce(F.max(finite), F.lit(default)).alias("max_value"))


# -- choice of the method -----------------------------------------------------

def normalize(df: DataFrame, method: str, columns: Sequence[str] | None = None,
              groups: Sequence[str] = (), n_quantiles: int = QUANTILE_REFERENCES,
              exact: bool = True) -> DataFrame:
    method = METHOD_ALIASES.get(method, method)
    if method == "boxcox":
        return boxcox(df, columns, groups)
    if method == "quantile":
        return quantile(df, columns, groups, n_quantiles, exact=exact)
    if method == "minmax":
        return minmax(df, columns, groups)
    if method == "logscale":
        return logscale(df, columns)
    raise ValueError(f"unknown method {method!r}; one of {', '.join(METHODS)} or log")


def normalize_all(df: DataFrame, columns: Sequence[str] | None = None, groups: Sequence[str] = (),
                  n_quantiles: int = QUANTILE_REFERENCES, exact: bool = True) -> dict[str, DataFrame]:
    """The table under every method, by method name."""
    return {m: normalize(df, m, columns, groups, n_quantiles, exact) for m in METHODS}


def compare_methods(df: DataFrame, tables: dict[str, DataFrame], slide: str,
                    columns: Sequence[str]) -> DataFrame:
    """Summary of the variation coefficients, one row per method."""
    parts = []
    for method, table in tables.items():
        cv = dispersion.cv_metrics(df, table, slide, columns)
        parts.append(dispersion.cv_summary(cv).select(F.lit(method).alias("method"), "*"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def pick_best(comparison: DataFrame) -> str:
    """Method with the largest mean improvement; the comparison has a row per method."""
    best = comparison.orderBy(F.desc_nulls_last("mean_cv_improvement"), "method").first()
    return best["method"]
