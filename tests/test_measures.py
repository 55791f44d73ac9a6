"""Quantiles, transforms, variation and gating on small hand-made tables."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cytospark.functions import names
from cytospark.operators import dispersion, gating, normalize, panel, quantiles


@pytest.fixture(scope="module")
def odd(spark):
    """Null, NaN, constant, zero, at or below -1, ties and a dotted name."""
    rows = [
        (1, "a", 1.0, 5.0, -1.0, 0.0, 1.0), (2, "a", 2.0, 5.0, -3.0, 0.0, 2.0), (3, "a", 4.0, 5.0, 0.0, 0.0, 2.0),
        (4, "b", None, 5.0, 2.0, 1.0, 2.0), (5, "b", float("nan"), 5.0, 3.0, 1.0, 3.0), (6, "b", 8.0, 5.0, 4.0, 2.0, 9.0),
    ]
    return spark.createDataFrame(
        rows, "id long, Batch string, `CD3: Mean` double, `CD8: Mean` double, `CD31: Mean` double, "
              "`CD4: Std.Dev.` double, `CD4: Mean` double")


def column(df, name):
    return [r[0] for r in df.orderBy("id").select(names.col(name)).collect()]


def test_quantile_paths_agree_on_skewed_values_with_ties(spark):
    hot = F.when(F.col("id") % 3 == 0, 7.0).otherwise(F.exp(F.rand(3) * 20))
    df = spark.range(20_000).select("id", F.when(F.col("id") % 2 == 0, 1).alias("g"), hot.alias("v"), F.lit(4.0).alias("flat"))
    probs = [0.0, 0.05, 0.25, 0.333, 0.5, 0.9, 0.999, 1.0]
    a = quantiles.quantiles(df, ["v", "flat"], probs, ["g"])
    b = quantiles.quantiles(df, ["v", "flat"], probs, ["g"], exact_rows=0, few_rows=50)
    left = {(r["g"], r["column"]): (r["n"], r["quantiles"]) for r in a.collect()}
    right = {(r["g"], r["column"]): (r["n"], r["quantiles"]) for r in b.collect()}
    assert left.keys() == right.keys()
    for k in left:
        assert left[k][0] == right[k][0]
        assert np.allclose(left[k][1], right[k][1], rtol=1e-12)


def test_descent_on_hard_values(spark):
    """Both signs, tiny and huge, infinite, neighbouring doubles, one value in a group, a null group."""
    r = np.random.default_rng(2)
    near = np.nextafter(1.0, 2.0) - np.arange(40) * 2.0 ** -52
    values = np.concatenate([r.normal(size=500) * 10.0 ** r.integers(-300, 300, 500), near, near, [0.0, -0.0, 5e-324, -5e-324, np.inf, -np.inf, 1.7e308, -1.7e308]])
    rows = [(None if i % 3 else "a", float(v)) for i, v in enumerate(values)] + [("one", 3.0)] * 5 + [("two", 1.0), ("two", 2.0)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(4)
    probs = np.linspace(0, 1, 41).tolist()
    for few in (0, 1_000_000):
        got = quantiles.quantiles(df, ["v"], probs, ["g"], exact_rows=0, few_rows=few).collect()
        assert {r["g"] for r in got} == {None, "a", "one", "two"}
        for r in got:
            mine = np.sort([v for g, v in rows if g == r["g"]])
            h = (len(mine) - 1) * np.array(probs)
            low, high = mine[np.floor(h).astype(int)], mine[np.ceil(h).astype(int)]
            with np.errstate(all="ignore"):
                want = np.where(low == high, low, low + (h - np.floor(h)) * (high - low))
            assert r["n"] == len(mine) and np.array_equal(r["quantiles"], want, equal_nan=True)
    assert quantiles.quantiles(df.limit(0), ["v"], probs, ["g"], exact_rows=0).count() == 0


def test_descent_over_ten_million_equal_values(spark):
    """The bucket of one value is an answer whatever its size: no task orders its rows."""
    df = spark.range(10_000_000, numPartitions=8).select(F.when(F.col("id") < 9_999_000, 7.25).otherwise(F.col("id").cast("double")).alias("v"))
    got = quantiles.quantiles(df, ["v"], [0.0, 0.5, 0.9999, 1.0], exact_rows=0).first()
    assert got["n"] == 10_000_000
    share = 9_999_999 * 0.9999 % 1  # between the last of the equal values and the next
    assert got["quantiles"] == [7.25, 7.25, pytest.approx(7.25 + share * (9_999_000 - 7.25)), 9_999_999.0]


def test_quantiles_match_numpy(odd):
    got = quantiles.quantiles(odd, ["CD3: Mean"], [0.05, 0.5, 0.95]).first()
    assert got["n"] == 4
    assert np.allclose(got["quantiles"], np.quantile([1, 2, 4, 8], [0.05, 0.5, 0.95]))


def test_minmax_edges(odd):
    out = normalize.minmax(odd, ["CD3: Mean", "CD8: Mean"])
    assert column(out, "CD8: Mean") == [-2.0] * 6  # constant
    v = column(out, "CD3: Mean")
    assert v[0] == -2.0 and v[5] == 2.0 and v[3] == 0.0 and v[4] == 0.0  # null and NaN -> 0
    assert all(-2 <= x <= 2 for x in v)


def test_default_scaler_columns_skip_deviation_names(odd):
    out = normalize.minmax(odd)
    assert column(out, "CD4: Std.Dev.") == column(odd, "CD4: Std.Dev.")
    assert "CD4: Std.Dev." in names.matching(odd, names.BOXCOX_PATTERN)


def test_log_edges(odd):
    v = column(normalize.logscale(odd, ["CD31: Mean"]), "CD31: Mean")
    assert v[:2] == [None, None] and v[2] == 0.0 and math.isclose(v[3], math.log(3))
    whole = normalize.logscale(odd)
    assert math.isclose(column(whole, "id")[0], math.log(2))  # other numbers change too


def test_quantile_transform_edges(odd):
    v = column(normalize.quantile(odd, ["CD3: Mean", "CD8: Mean", "CD4: Mean"], n_quantiles=6), "CD4: Mean")
    assert v[0] == 0.0 and v[5] == 1.0
    assert v[1] == v[2] == v[3]  # ties share the mean of both sides
    assert v == sorted(v)
    out = normalize.quantile(odd, ["CD3: Mean", "CD8: Mean"], n_quantiles=6)
    assert column(out, "CD8: Mean") == [0.0] * 6
    assert column(out, "CD3: Mean")[3:5] == [0.0, 0.0]


def test_quantile_transform_matches_both_sided_interpolation(spark):
    rng = np.random.default_rng(1)
    x = np.round(rng.gamma(2.0, 2.0, 500), 1)
    df = spark.createDataFrame(pd.DataFrame({"id": range(500), "v": x}))
    got = np.array(column(normalize.quantile(df, ["v"], n_quantiles=50), "v"))
    probs = np.linspace(0, 1, 50)
    refs = np.quantile(x, probs)
    want = 0.5 * (np.interp(x, refs, probs) - np.interp(-x, -refs[::-1], -probs[::-1]))
    want[x == refs[-1]] = 1
    want[x == refs[0]] = 0
    assert np.allclose(got, want)
    assert got.min() >= 0 and got.max() <= 1


@pytest.mark.parametrize("power", [-1.5, 0.0, 0.4, 3.0])
def test_boxcox_finds_the_maximum_of_the_likelihood(spark, power):
    rng = np.random.default_rng(7)
    z = rng.normal(4.0, 0.4, 2000)
    x = np.exp(z) if power == 0 else np.power(np.maximum(1 + abs(power) * z, 0.1), 1 / power)
    df = spark.createDataFrame(pd.DataFrame({"id": range(len(x)), "v": x - 1}))
    lam = normalize.boxcox_fit(df, ["v"]).first()["lambda"]

    def llf(v):
        y = np.log(x) if abs(v) < 1e-9 else (x**v - 1) / v
        return (v - 1) * np.log(x).sum() - len(x) / 2 * np.log(y.var())

    scan = np.linspace(lam - 0.5, lam + 0.5, 2001)
    assert abs(scan[np.argmax([llf(v) for v in scan])] - lam) <= 6e-4


def test_boxcox_failures_become_zero(odd):
    cols = ["CD3: Mean", "CD8: Mean", "CD31: Mean"]
    fitted = normalize.boxcox_fit(odd, cols)
    lam = {r["column"]: r["lambda"] for r in fitted.collect()}
    assert lam["CD8: Mean"] is None and lam["CD31: Mean"] is None and lam["CD3: Mean"] is not None
    out = normalize.boxcox(odd, cols, fitted=fitted)
    assert column(out, "CD8: Mean") == [0.0] * 6 and column(out, "CD31: Mean") == [0.0] * 6
    record = {r["feature"]: r["lambda"] for r in normalize.boxcox_record(odd, out, fitted, cols).collect()}
    assert record["CD8: Mean"] == "Failed" and float(record["CD3: Mean"]) == round(lam["CD3: Mean"], 3)


def test_method_names(odd):
    assert column(normalize.normalize(odd, "log", ["CD3: Mean"]), "CD3: Mean") == column(
        normalize.normalize(odd, "logscale", ["CD3: Mean"]), "CD3: Mean")
    with pytest.raises(ValueError):
        normalize.normalize(odd, "other")


def test_cv_is_null_unless_the_mean_is_positive(odd):
    cv = {(r["marker"], r["slide"]): r for r in dispersion.cv_metrics(
        odd, odd, "Batch", ["CD3: Mean", "CD31: Mean"]).collect()}
    assert cv["CD31", "a"]["cv_original"] is None
    assert math.isclose(cv["CD3", "a"]["cv_original"], np.std([1, 2, 4], ddof=1) / np.mean([1, 2, 4]))


def test_histogram_last_bin_is_closed(odd):
    got = {r["bin"]: r["count"] for r in dispersion.histogram(odd, ["CD3: Mean"], 7).collect()}
    assert got == {0: 1, 1: 1, 3: 1, 6: 1}
    flat = dispersion.histogram(odd, ["CD8: Mean"], 7).collect()
    assert [(r["bin"], r["count"]) for r in flat] == [(0, 6)]


# -- panel --------------------------------------------------------------------

def test_panel_from_headers(spark):
    headers = {"b1": ["CD3: Mean", "CD3: Max", "Image"], "b2": ["CD3: Mean", "CD8: Mean"]}
    markers = panel.batch_markers(spark, headers)
    design = {r["marker"]: (r["b1"], r["b2"]) for r in panel.panel_design(markers, ["b1", "b2"]).collect()}
    assert design == {"CD3": (1, 1), "CD8": (0, 1)}
    assert [tuple(r) for r in panel.missing_markers(markers).collect()] == [("CD8", "b1")]


def test_noise_is_repeatable_low_and_not_negative(spark):
    df = spark.range(3000).select("id", (F.col("id") % 100).cast("double").alias("A: Mean"), F.lit(0.5).alias("A: Max"))
    one = panel.fill_missing(df, ["B", "C"], ["id"], suffixes=[": Mean", ": Max"])
    two = panel.fill_missing(df.repartition(5), ["B", "C"], ["id"], suffixes=[": Mean", ": Max"])
    assert one.columns == ["id", "A: Mean", "A: Max", "B: Mean", "C: Mean", "B: Max", "C: Max"]
    assert column(one, "B: Mean") == column(two, "B: Mean")
    b = np.array(column(one, "B: Mean"))
    assert b.min() >= 0 and b.max() < 12 and len(set(b)) > 1000
    assert abs(np.corrcoef(b, column(one, "C: Mean"))[0, 1]) < 0.6


def test_normal_noise_has_unit_spread(spark):
    z = np.array([r[0] for r in spark.range(20_000).select(panel.normal_noise(["id"], "t")).collect()])
    assert abs(z.mean()) < 0.03 and abs(z.std() - 1) < 0.03


# -- gating -------------------------------------------------------------------

def two_groups(spark, n=4000):
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(2, 0.3, n), rng.normal(8, 1.0, n // 2)])
    return x, spark.createDataFrame(pd.DataFrame({"id": range(len(x)), "CD3: Mean": x}))


def test_mixture_finds_the_background(spark):
    x, df = two_groups(spark)
    fit = gating.thresholds(df, ["CD3: Mean"]).first()
    assert fit["components"] == 2
    assert abs(fit["bg_mean"] - 2) < 0.05 and abs(fit["bg_std"] - 0.3) < 0.05
    assert fit["threshold"] <= fit["bg_mean"] + 2 * fit["bg_std"] + 1e-9
    gated = column(gating.gate_background(df), "CD3: Mean")
    assert all(g >= v - 1e-12 for g, v in zip(gated, x)) and min(gated) == fit["threshold"]


def test_single_group_keeps_one_component(spark):
    x = np.random.default_rng(5).normal(5, 1, 3000)
    df = spark.createDataFrame(pd.DataFrame({"id": range(3000), "CD3: Mean": x}))
    fit = gating.thresholds(df, ["CD3: Mean"]).first()
    assert fit["components"] == 1 and math.isnan(fit["bic2"]) is False and fit["bic1"] < fit["bic2"]
    n = len(x)
    want = -2 * (-n / 2 * (np.log(2 * np.pi * x.var()) + 1)) + 2 * np.log(n)
    assert abs(fit["bic1"] - want) / want < 1e-3


def test_constant_column_has_no_valley(spark):
    df = spark.range(50).select("id", F.lit(3.0).alias("CD3: Mean"))
    fit = gating.thresholds(df, ["CD3: Mean"]).first()
    assert fit["components"] == 1 and abs(fit["threshold"] - 3.002) < 1e-6


def brute_gate(rows, order, fits, touches):
    rows = {k: np.array(v, dtype=float) for k, v in rows.items()}
    for c in order:
        t, mean, std = fits[c]
        before = rows[c].copy()
        rows[c] = np.where(rows[c] < t, t, rows[c])
        delta = rows[c] - before
        for o in rows:
            if o != c:
                adds, floors = touches(c, o)
                rows[o] = rows[o] + delta if adds else rows[o]
                if floors:
                    z = (rows[o] - mean) / std if std > 0 else rows[o] * 0
                    rows[o] = np.where(z < 2, mean + 2 * std, rows[o])
    return rows


@pytest.mark.parametrize("mode", ["exact", "startswith"])
def test_gate_equals_a_column_by_column_loop(spark, mode):
    rng = np.random.default_rng(11)
    cols = ["CD3: Cell: Mean", "CD3: Nucleus: Mean", "CD3: Cell: Max", "CD31: Cell: Mean", "CD31: Cell: Max", "CD8: Cell: Mean"]
    data = {c: np.round(rng.uniform(0, 10, 200), 3).tolist() for c in cols}
    df = spark.createDataFrame(pd.DataFrame({"id": range(200), **data})).withColumn("id", F.col("id").cast("string"))
    means = [c for c in cols if "Mean" in c]
    fits = {c: (3.0 + i, 1.0 + 0.2 * i, 0.5 * (i % 3)) for i, c in enumerate(means)}
    table = spark.createDataFrame([(c, *f) for c, f in fits.items()], "column string, threshold double, bg_mean double, bg_std double")
    out = gating.gate(df, means, table, prefix_match=mode).withColumn("id", F.col("id").cast("int"))
    want = brute_gate(data, means, fits, lambda a, b: gating._touches(a, b, mode))
    for c in cols:
        assert np.allclose(column(out, c), want[c]), c


def test_clashing_marker_names(spark):
    df = spark.createDataFrame([("1", 1.0, 9.0)], "id string, `CD3: Mean` double, `CD31: Mean` double")
    fit = spark.createDataFrame([("CD3: Mean", 4.0, 0.0, 1.0)], "column string, threshold double, bg_mean double, bg_std double")
    exact = gating.gate(df, ["CD3: Mean"], fit).first()
    loose = gating.gate(df, ["CD3: Mean"], fit, prefix_match="startswith").first()
    assert exact["CD31: Mean"] == 9.0 and loose["CD31: Mean"] == 12.0


def test_gating_summary_means(spark):
    _, df = two_groups(spark)
    fitted = gating.thresholds(df, ["CD3: Mean"])
    r = gating.gating_summary(df, ["CD3: Mean"], fitted).first()
    assert math.isclose(r["post_mean"] - r["pre_mean"], r["delta_mean"], rel_tol=1e-9)


def test_density_integrates_to_one(spark):
    _, df = two_groups(spark)
    curve = gating.density_curve(gating.thresholds(df, ["CD3: Mean"])).orderBy("i").toPandas()
    assert abs(np.trapezoid(curve["density"], curve["x"]) - 1) < 0.01
