"""Lasso solves, moments over all rows, elimination and feature choice."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from cytospark.functions import scalars
from cytospark.operators import lasso
from cytospark.operators.lasso_math import Moments, alpha_path, eliminate
from cytospark.operators.lasso_math import lasso as solve
from cytospark.operators.ranking import fold_ids

NAMES = ["a", "b", "c", "d", "e"]


@pytest.fixture(scope="module")
def cells(spark):
    """Three classes told apart by two of five columns; one class holds most rows."""
    rng = np.random.default_rng(2)
    cls = rng.choice(["x", "y", "z"], size=3000, p=[0.7, 0.2, 0.1])
    m = rng.normal(size=(3000, 5))
    m[:, 1] += 2.0 * (cls == "y")
    m[:, 3] += 3.0 * (cls == "z")
    m[:, 4] = m[:, 4] * 0.01
    return spark.createDataFrame(pd.DataFrame({"id": range(3000), "cls": cls, **dict(zip(NAMES, m.T))}))


def kkt(x, y, w, alpha):
    """Largest violation of the optimality conditions."""
    xc, yc = x - x.mean(axis=0), y - y.mean()
    grad = xc.T @ (yc - xc @ w) / len(y)
    active = w != 0
    return max(
        np.abs(grad[active] - alpha * np.sign(w[active])).max(initial=0.0),
        (np.abs(grad[~active]) - alpha).max(initial=0.0),
    )


@pytest.mark.parametrize("alpha", [0.0005, 0.01, 0.05, 0.3])
def test_solver_meets_the_optimality_conditions(alpha):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 12)) @ rng.normal(size=(12, 12))
    y = (x[:, 0] + rng.normal(size=400) > 0).astype(float)
    w = solve(*Moments.of(x, y).centred(), alpha)
    assert kkt(x, y, w, alpha) < 1e-5


def test_solver_equals_the_built_in_regression(spark, cells):
    rows = cells.select(
        (F.col("cls") == "y").cast("double").alias("label"),
        array_to_vector(F.array(*[F.col(c) for c in NAMES])).alias("features"))
    model = LinearRegression(elasticNetParam=1.0, standardization=False, regParam=0.02, tol=1e-10, maxIter=500).fit(rows)
    pdf = cells.toPandas()
    w = solve(*Moments.of(pdf[NAMES].to_numpy(), (pdf["cls"] == "y").to_numpy(float)).centred(), 0.02)
    assert np.allclose(w, model.coefficients.toArray(), atol=1e-4)


def test_moments_add_up():
    rng = np.random.default_rng(1)
    x, y = rng.normal(size=(50, 3)), rng.integers(0, 2, 50).astype(float)
    a, b, whole = Moments.of(x[:20], y[:20]), Moments.of(x[20:], y[20:]), Moments.of(x, y)
    assert np.allclose((a + b).sxx, whole.sxx) and np.allclose((whole - b).sxy, a.sxy)
    w = np.array([0.3, 0.0, -0.2])
    bias = y[:20].mean() - w @ x[:20].mean(axis=0)
    assert math.isclose(b.mse(w, a), np.mean((y[20:] - x[20:] @ w - bias) ** 2))


def test_path_scales_without_centring():
    rng = np.random.default_rng(4)
    x = rng.normal(3, [1, 10, 0.1], size=(300, 3))
    y = (x[:, 2] > 3).astype(float)
    tr, te = Moments.of(x[:200], y[:200]), Moments.of(x[200:], y[200:])
    got = alpha_path(tr, te, np.array([0.05]))[0]
    s = x[:200].std(axis=0)
    w = solve(*Moments.of(x[:200] / s, y[:200]).centred(), 0.05)
    b = y[:200].mean() - w @ (x[:200] / s).mean(axis=0)
    assert math.isclose(got, np.mean((y[200:] - (x[200:] / s) @ w - b) ** 2), rel_tol=1e-6)


def test_elimination_with_no_selected_feature_drops_from_the_front():
    x = np.random.default_rng(0).normal(size=(100, 5))
    sets = eliminate(Moments.of(x, (x[:, 0] > 0).astype(float)), [2, 3], selector_alpha=1.0)
    assert sets == {3: [2, 3, 4], 2: [3, 4]}


def test_elimination_keeps_what_matters():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(500, 5))
    y = (x[:, 1] - x[:, 3] > 0).astype(float)
    assert eliminate(Moments.of(x, y), [2], 0.001)[2] == [1, 3]


def test_one_pass_moments_equal_moments_of_the_rows(cells):
    got = lasso.all_moments(cells, "cls", NAMES, ["id"], folds=4)
    pdf = fold_ids(cells, ["cls"], ["id"], 4).toPandas()
    shift = pdf[NAMES].mean().to_numpy()
    assert set(got) == {"x", "y", "z"}
    for c, per in got.items():
        for f, m in per.items():
            part = pdf[pdf["fold"] == f]
            want = Moments.of(part[NAMES].to_numpy() - shift, (part["cls"] == c).to_numpy(float))
            assert m.n == want.n and m.sy == want.sy
            assert np.allclose(m.sxx, want.sxx) and np.allclose(m.sxy, want.sxy) and np.allclose(m.sx, want.sx, atol=1e-6)


def test_repeats_in_one_pass_equal_each_alone(cells):
    seeds = ["1.0", "1.1", 7]
    together = lasso.repeated_moments(cells, "cls", NAMES, ["id"], 2, seeds)
    for seed, got in zip(seeds, together):
        alone = lasso.all_moments(cells, "cls", NAMES, ["id"], 2, seed)
        assert set(got) == set(alone) == {"x", "y", "z"}
        for c in got:
            for f, m in got[c].items():
                want = alone[c][f]
                assert (m.n, m.sy) == (want.n, want.sy)
                assert np.allclose(m.sxx, want.sxx) and np.allclose(m.sxy, want.sxy) and np.allclose(m.sx, want.sx, atol=1e-6)
    assert not np.allclose(together[0]["x"][0].sxx, together[1]["x"][0].sxx)  # other folds


def test_full_search_and_importances(cells):
    scores = lasso.search_alphas_full(cells, "cls", NAMES, ["id"], [0.01, 0.1, 5.0])
    best = {r["celltype"]: r["best_alpha"] for r in lasso.best_alphas(scores).collect()}
    assert best == {"x": 0.01, "y": 0.01, "z": 0.01}
    table = lasso.best_alphas(scores)
    ranked = lasso.importances_full(cells, "cls", NAMES, ["id"], table).toPandas()
    top = ranked.sort_values("importance").groupby("celltype")["feature"].last()
    assert top["y"] == "b" and top["z"] == "d"


def test_capped_selection_end_to_end(cells):
    out = lasso.select_features(cells, "cls", NAMES, ["id"], limit=400, min_labels=20, alphas=[0.001, 0.01, 0.1])
    top = out["top_features"].toPandas()
    assert set(top["celltype"]) == {"x", "y", "z"}
    assert top[(top["celltype"] == "z") & (top["rank"] == 1)]["feature"].item() == "d"
    assert out["rfe_scores"].count() == 3 * 2 * 6
    assert [r[0] for r in out["features"].collect()] == sorted({*top["feature"]})


def test_alpha_grid_ends():
    grid = scalars.alpha_grid()
    assert len(grid) == 96 and round(grid[0], 6) == 0.006097 and round(grid[-1], 2) == 766.83


def test_best_alpha_takes_the_smaller_on_ties(spark):
    df = spark.createDataFrame([("a", 0.1, -1.0, 0.0), ("a", 0.5, -1.0, 0.0), ("a", 0.9, -2.0, 0.0)],
                               "celltype string, alpha double, mean_test_score double, std_test_score double")
    assert lasso.best_alphas(df).first()["best_alpha"] == 0.1


def test_optimal_count_tolerates_an_eighth_of_the_deviation(spark):
    rows = [("a", n, s) for n, ss in {2: [-0.50, -0.51], 3: [-0.48, -0.50], 4: [-0.40, -0.42]}.items() for s in ss]
    df = spark.createDataFrame(rows, "celltype string, n_features int, rfe_score double")
    values = [s for _, _, s in rows]
    floor = np.median(values) - np.std(values, ddof=1) / 8
    want = min(n for n in (2, 3, 4) if np.median([s for _, k, s in rows if k == n]) >= floor)
    assert lasso.optimal_counts(df).first()["optimal_n"] == want
