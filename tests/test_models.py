"""Evaluation, boosted models, components and neighbours."""

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from cytospark.operators import boosting, embed, evaluate, split
from cytospark.operators.abundance import PREDICTION


@pytest.fixture(scope="module")
def calls(spark):
    """Class d is only predicted, class c is never predicted."""
    rng = np.random.default_rng(0)
    actual = rng.choice(["a", "b", "c"], 600, p=[0.8, 0.15, 0.05])
    predicted = np.where(rng.uniform(size=600) < 0.3, rng.choice(["a", "b", "d"], 600), np.where(actual == "c", "a", actual))
    return spark.createDataFrame(pd.DataFrame({"actual": actual, "predicted": predicted}))


def test_scores_match_the_built_in_evaluator(spark, calls):
    code = F.array_position(F.array(*[F.lit(c) for c in "abcd"]), F.col("actual")) - 1
    called = F.array_position(F.array(*[F.lit(c) for c in "abcd"]), F.col("predicted")) - 1
    coded = calls.select(code.cast("double").alias("label"), called.cast("double").alias("prediction"))
    head = evaluate.overall(evaluate.confusion(calls, "actual", "predicted")).first()
    for metric, name in (("accuracy", "accuracy"), ("f1", "f1_score")):
        assert abs(MulticlassClassificationEvaluator(metricName=metric).evaluate(coded) - head[name]) < 1e-9


def test_auc_is_the_mean_of_both_rates(calls):
    pdf = calls.toPandas()
    for r in evaluate.class_scores(evaluate.confusion(calls, "actual", "predicted")).collect():
        is_class, called = pdf["actual"] == r["class"], pdf["predicted"] == r["class"]
        tpr, tnr = (called & is_class).sum() / is_class.sum(), (~called & ~is_class).sum() / (~is_class).sum()
        assert abs(r["auc"] - (tpr + tnr) / 2) < 1e-12
        assert r["tp"] + r["fp"] + r["fn"] + r["tn"] == len(pdf)


def test_absent_classes(calls):
    scores = {r["class"]: r for r in evaluate.class_scores(evaluate.confusion(calls, "actual", "predicted")).collect()}
    assert "d" not in scores and scores["c"]["f1"] == 0.0
    assert evaluate.overall(evaluate.confusion(calls, "actual", "predicted")).first()["class_imbalance_detected"]


def test_two_classes_work(spark):
    df = spark.createDataFrame([("a", "a"), ("b", "a"), ("b", "b"), ("b", "b")], "actual string, predicted string")
    scores = {r["class"]: r["auc"] for r in evaluate.class_scores(evaluate.confusion(df, "actual", "predicted")).collect()}
    assert abs(scores["a"] - (1 + 2 / 3) / 2) < 1e-12 and scores["a"] == scores["b"]


def test_first_model_wins_ties(spark):
    df = spark.createDataFrame([("First", 0, 0.8), ("Second", 1, 0.8)], "model string, position int, accuracy double")
    assert evaluate.best_model(df).first()["model"] == "First"


@pytest.fixture(scope="module")
def blobs(spark):
    rng = np.random.default_rng(1)
    cls = np.repeat(["a", "b", "c"], [300, 120, 30])
    centre = {"a": (0, 0), "b": (6, 0), "c": (0, 6)}
    xy = np.array([centre[c] for c in cls]) + rng.normal(size=(450, 2))
    return spark.createDataFrame(pd.DataFrame({"id": range(450), "cls": cls, "m.1: Mean": xy[:, 0], "m2": xy[:, 1]})).coalesce(2)


def test_grid_winners_and_predictions(spark, blobs, tmp_path):
    grid = boosting.parameter_grid(spark, 1, [2], [0.1, 1.0])
    results = boosting.grid_search(blobs, "cls", ["m.1: Mean", "m2"], ["id"], grid, rounds=2)
    assert results.count() == 2 and results.agg(F.min("testf")).first()[0] > 0.9
    best = boosting.top_two(boosting.grid_summary(results))
    models = boosting.train_winners(blobs, "cls", ["m.1: Mean", "m2"], best, rounds=2)
    assert list(models) == ["First", "Second"]
    models["First"].save(str(tmp_path / "m"))
    scored = boosting.CellModel.load(str(tmp_path / "m")).score(blobs)
    assert scored.columns == [*blobs.columns, PREDICTION]
    assert scored.filter(F.col("cls") == F.col(PREDICTION)).count() > 420


def test_a_grid_of_one_is_an_error(spark):
    one = spark.createDataFrame([(2, 0.1, 0.5)], "max_depth int, eta double, test_mean double")
    with pytest.raises(ValueError):
        boosting.top_two(one)


def test_class_thresholds_are_strict_for_models_only(spark):
    df = spark.range(20).select(F.lit("a").alias("cls"))
    assert split.classes_with(df, "cls", at_least=20).count() == 1
    assert split.classes_with(df, "cls", more_than=20).count() == 0


def test_components_for_a_share():
    assert embed.components_for([0.5, 0.3, 0.15, 0.05]) == 3
    assert embed.components_for([0.5, 0.2]) == 1  # never reached


def test_components_match_numpy(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 4)) @ rng.normal(size=(4, 4))
    df = spark.createDataFrame(pd.DataFrame({"id": range(400), **{f"f{i}": x[:, i] for i in range(4)}}))
    out, explained = embed.standard_components(df, ["f0", "f1", "f2", "f3"], ["id"])
    z = (x - x.mean(axis=0)) / x.std(axis=0, ddof=1)
    values = np.sort(np.linalg.eigvalsh(np.cov(z.T)))[::-1]
    assert np.allclose(explained, values / values.sum())
    assert len(out.first()["components"]) == embed.components_for(explained)


def test_neighbours_recall_and_exact_distances(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(1500, 4)) * [4, 2, 1, 1]
    x[:500] = x[0]  # a crowd of equal rows
    df = spark.createDataFrame(pd.DataFrame({"id": range(1500), "components": x.tolist()}))
    got = embed.nearest_neighbours(df, "id", k=5, dims=4, curves=6, window=60).toPandas()
    assert (got.groupby("id").size() == 5).all() and (got["id"] != got["neighbour"]).all()
    d = np.sqrt(((x[got["id"]] - x[got["neighbour"]]) ** 2).sum(axis=1))
    assert np.allclose(d, got["distance"])
    full = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    np.fill_diagonal(full, np.inf)
    kth = np.sort(full, axis=1)[:, 4]
    recall = (got["distance"].to_numpy() <= kth[got["id"]] + 1e-9).mean()
    assert recall > 0.85


def test_clusters_separate_blobs(spark):
    rng = np.random.default_rng(9)
    x = np.vstack([rng.normal(0, 1, (150, 3)), rng.normal(12, 1, (100, 3))])
    df = spark.createDataFrame(pd.DataFrame({"id": range(250), "components": x.tolist()}))
    got = embed.cluster_cells(df, "id", 2, k=8, dims=3).toPandas().set_index("id")["cluster"].reindex(range(250))
    assert got.notna().all()
    assert (got[:150] == got[:150].mode()[0]).mean() > 0.95 and (got[150:] == got[150:].mode()[0]).mean() > 0.95
    assert got[:150].mode()[0] != got[150:].mode()[0]
