"""Feature selection per class: penalty search, elimination, ranked features.

Two ways lead to the moment matrices that all solves need:

* capped (default): at most ``limit`` rows of a class and of the rest, so the
  rows of one class fit in a task and are solved there;
* full: one pass over all rows adds up the moments of all folds and classes in
  the tasks, and only moment matrices are shuffled. Their size depends on the
  number of features, not of rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cytospark.functions.names import col, cols, nan_to_null, per_column
from cytospark.functions.scalars import alpha_grid
from cytospark.operators.lasso_math import Moments, alpha_path, eliminate, lasso, rfe_score
from cytospark.operators.ranking import bounded_folds, bounded_repeats, bounded_train_test, class_caps, fold_ids
from cytospark.operators.sizing import join_summary, spread
from cytospark.session import durable

# Folds of the penalty search, folds and repeats of the
# elimination, selector penalty, variance threshold, share of a deviation that
# a smaller feature set may lose, features shown.
ALPHA_FOLDS = 10
RFE_SPLITS, RFE_REPEATS = 2, 3
SELECTOR_ALPHA = 1.0
VARIANCE_THRESHOLD = 0.01
TOLERATED_DEVIATION = 1 / 8
TOP_SHOWN = 35

ALPHA_SCHEMA = "celltype string, alpha double, mean_test_score double, std_test_score double"
RFE_SCHEMA = "celltype string, n_features int, repeat int, fold int, rfe_score double"
IMPORTANCE_SCHEMA = "celltype string, feature string, importance double, position int"


def feature_array(df: DataFrame, features: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """Keep some columns and pack the features into one array, missing values as 0."""
    packed = F.array(*[F.coalesce(nan_to_null(col(c).cast("double")), F.lit(0.0)) for c in features])
    return df.select(*cols(keep), packed.alias("features"))


def one_vs_rest(df: DataFrame, label: str, features: Sequence[str], keys: Sequence[str],
                limit: int = 3000, min_labels: int = 20, seed: int | str = 42) -> DataFrame:
    """Capped training sets of all classes: celltype, target, keys, features."""
    capped = class_caps(df.filter(col(label).isNotNull()), label, keys, limit, min_labels, seed)
    return feature_array(capped, features, ["celltype", "target", *keys])


def _matrix(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    return np.stack(pdf["features"].to_numpy()), pdf["target"].to_numpy(dtype=float)


def _fold_moments(pdf: pd.DataFrame, by: Sequence[str]) -> dict:
    """Moments per fold, columns shifted by the overall mean against cancellation."""
    x, y = _matrix(pdf)
    x = x - x.mean(axis=0)
    return {k: Moments.of(x[rows], y[rows]) for k, rows in pdf.groupby(list(by)).indices.items()}


def search_alphas(sets: DataFrame, keys: Sequence[str], alphas: Sequence[float] | None = None,
                  folds: int = ALPHA_FOLDS, test_size: float = 0.33) -> DataFrame:
    """Cross-validated negative MSE per class and penalty on the training share.

    Folds are contiguous blocks of the hash order within a class's rows.
    """
    grid = np.asarray(alphas if alphas is not None else alpha_grid())
    split = bounded_train_test(sets, ["celltype", "target"], keys, test_size)
    folded = bounded_folds(split.filter(~F.col("is_test")), ["celltype"], keys, folds)

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        parts = _fold_moments(pdf, ["fold"])
        return alpha_scores(pdf["celltype"].iloc[0], list(parts.values()), grid)

    rows = folded.select("celltype", "target", "fold", "features")
    return spread(rows, "celltype").groupBy("celltype").applyInPandas(solve, ALPHA_SCHEMA)


def alpha_scores(celltype: str, parts: list[Moments], grid: np.ndarray) -> pd.DataFrame:
    total = parts[0]
    for p in parts[1:]:
        total = total + p
    errors = np.array([alpha_path(total - p, p, grid) for p in parts])
    return pd.DataFrame({
        "celltype": celltype, "alpha": grid,
        "mean_test_score": -errors.mean(axis=0), "std_test_score": errors.std(axis=0),
    })


def best_alphas(scores: DataFrame) -> DataFrame:
    """Per class the penalty of the best score, the smaller one on ties."""
    return scores.groupBy("celltype").agg(
        F.max_by("alpha", F.struct("mean_test_score", -F.col("alpha"))).alias("best_alpha"),
        F.max("mean_test_score").alias("best_score"),
    )


def ranked_alphas(scores: DataFrame) -> DataFrame:
    return scores.orderBy("celltype", F.desc("mean_test_score"), "alpha")


def alpha_curve(scores: DataFrame, folds: int = ALPHA_FOLDS) -> DataFrame:
    """Score with its standard-error band, best penalty and best score per class."""
    error = F.col("std_test_score") / F.sqrt(F.lit(float(folds)))
    return scores.join(F.broadcast(best_alphas(scores)), "celltype").select(
        "celltype", "alpha", "mean_test_score",
        (F.col("mean_test_score") + error).alias("upper"),
        (F.col("mean_test_score") - error).alias("lower"),
        "best_alpha", "best_score",
    )


def rfe_scores(sets: DataFrame, best: DataFrame, keys: Sequence[str], counts: Sequence[int] = (2, 3),
               splits: int = RFE_SPLITS, repeats: int = RFE_REPEATS, selector_alpha: float = SELECTOR_ALPHA,
               max_iter: int = 1000) -> DataFrame:
    """Score of recursive elimination per class, number of features, repeat and fold."""
    counts = sorted(counts)
    folded = bounded_repeats(sets, ["celltype", "target"], keys, splits, repeats)
    tasks = join_summary(
        folded.select("celltype", "target", "repeat", "fold", "features"), best.select("celltype", "best_alpha"), ["celltype"])

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        alpha = float(pdf["best_alpha"].iloc[0])
        return elimination_scores(pdf["celltype"].iloc[0], int(pdf["repeat"].iloc[0]),
                                  _fold_moments(pdf, ["fold"]), alpha, counts, selector_alpha, max_iter)

    return spread(tasks, "celltype", "repeat").groupBy("celltype", "repeat").applyInPandas(solve, RFE_SCHEMA)


def elimination_scores(celltype: str, repeat: int, parts: dict, alpha: float, counts: Sequence[int],
                       selector_alpha: float, max_iter: int) -> pd.DataFrame:
    total = sum(list(parts.values())[1:], list(parts.values())[0])
    rows = []
    for fold, test in parts.items():
        fold = fold[0] if isinstance(fold, tuple) else fold
        train = total - test
        sets = eliminate(train, [c for c in counts if c <= len(total.sx)], selector_alpha)
        rows += [
            (celltype, n, repeat, int(fold), rfe_score(train, test, chosen, alpha, max_iter))
            for n, chosen in sets.items()
        ]
    return pd.DataFrame(rows, columns=["celltype", "n_features", "repeat", "fold", "rfe_score"])


def ranked_rfe(scores: DataFrame) -> DataFrame:
    """Elimination scores by class, best first; equal scores by fewer features."""
    order = W.partitionBy("celltype").orderBy(F.desc("rfe_score"), "n_features")  # one row per repeat, fold and count
    return scores.withColumn("rank", F.row_number().over(order))


def rfe_summary(scores: DataFrame, groups: Sequence[str] = ("celltype",)) -> DataFrame:
    """Mean, sample deviation and median of the score per number of features."""
    return scores.groupBy(*cols(groups), "n_features").agg(
        F.avg("rfe_score").alias("mean_score"),
        F.stddev_samp("rfe_score").alias("std_score"),
        F.median("rfe_score").alias("median_score"),
    )


def optimal_counts(scores: DataFrame, groups: Sequence[str] = ("celltype",)) -> DataFrame:
    """Smallest number of features whose median is within an eighth of the
    deviation of the overall median."""
    overall = scores.groupBy(*cols(groups)).agg(
        (F.median("rfe_score") - F.stddev_samp("rfe_score") * TOLERATED_DEVIATION).alias("_floor"))
    per_n = rfe_summary(scores, groups)
    both = join_summary(per_n, overall, groups) if groups else per_n.crossJoin(F.broadcast(overall))
    return both.filter(F.col("median_score") >= F.col("_floor")).groupBy(*cols(groups)).agg(
        F.min("n_features").alias("optimal_n"))


def importances(sets: DataFrame, best: DataFrame, features: Sequence[str]) -> DataFrame:
    """Absolute coefficients at the best penalty, features not scaled."""
    names = list(features)
    tasks = join_summary(sets.select("celltype", "target", "features"), best.select("celltype", "best_alpha"), ["celltype"])

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        x, y = _matrix(pdf)
        m = Moments.of(x - x.mean(axis=0), y)
        return coefficient_rows(pdf["celltype"].iloc[0], m, float(pdf["best_alpha"].iloc[0]), names)

    return spread(tasks, "celltype").groupBy("celltype").applyInPandas(solve, IMPORTANCE_SCHEMA)


def coefficient_rows(celltype: str, moments: Moments, alpha: float, names: Sequence[str]) -> pd.DataFrame:
    w = np.abs(lasso(*moments.centred(), alpha))
    return pd.DataFrame({
        "celltype": celltype, "feature": list(names), "importance": w, "position": np.arange(len(names)),
    })


def top_features(ranked: DataFrame, optimal: DataFrame) -> DataFrame:
    """The optimal number of features per class by importance."""
    order = W.partitionBy("celltype").orderBy(F.desc("importance"), "position")  # one row per feature
    return join_summary(ranked, optimal, ["celltype"]).withColumn("rank", F.row_number().over(order)).filter(
        F.col("rank") <= F.col("optimal_n")).select("celltype", "feature", "importance", "rank")


def selected_features(top: DataFrame) -> DataFrame:
    """Distinct features over all classes, in name order."""
    return top.select("feature").distinct().orderBy("feature")


def importance_levels(ranked: DataFrame, shown: int = TOP_SHOWN) -> DataFrame:
    """Best features per class with quartiles, mean, deviation and level of importance."""
    order = W.partitionBy("celltype").orderBy(F.desc("importance"), "position")
    top = ranked.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= shown)
    stats = top.groupBy("celltype").agg(
        F.percentile("importance", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias("_q"),
        F.avg("importance").alias("mean_importance"),
        F.stddev_samp("importance").alias("std_importance"),
    )
    v = F.col("importance")
    return join_summary(top, stats, ["celltype"]).select(
        "celltype", "feature", "importance", "rank",
        F.col("_q")[0].alias("p25"), F.col("_q")[1].alias("p50"), F.col("_q")[2].alias("p75"),
        "mean_importance", "std_importance",
        F.when(v >= F.col("_q")[2], "High").when(v >= F.col("_q")[1], "Med-High")
        .when(v >= F.col("_q")[0], "Med-Low").otherwise("Low").alias("level"),
    )


def column_variances(df: DataFrame, features: Sequence[str], groups: Sequence[str] = ()) -> DataFrame:
    return per_column(df, features, groups, F.var_pop("value").alias("variance"), fill=0.0)


def variance_summary(variances: DataFrame, groups: Sequence[str] = (),
                     threshold: float = VARIANCE_THRESHOLD) -> DataFrame:
    """Features, those at or below the threshold, and the rest. For the report only."""
    return variances.groupBy(*cols(groups)).agg(
        F.count(F.lit(1)).alias("original_features"),
        F.count_if(F.col("variance") <= threshold).alias("non_variant_removed"),
        F.count_if(F.col("variance") > threshold).alias("features_after_variance_filter"),
    )


def binary_counts(sets: DataFrame, batch: str = "Batch") -> DataFrame:
    """Rows per batch and target."""
    return sets.groupBy(col(batch), "target").agg(F.count(F.lit(1)).alias("count"))


# -- all rows -----------------------------------------------------------------

PART_SCHEMA = "repeat int, fold int, label string, row int, sums array<double>"


def _partition_moments(width: int, shift: np.ndarray, folds: Sequence[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Per task: for every repeat and fold the rows of xx' with the sum of x in front, and
    per (repeat, fold, class) the count and sum of x. Columns: features, label, a fold for each repeat."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram: dict[tuple[int, int], np.ndarray] = {}
        by_class: dict[tuple[int, int, str], np.ndarray] = {}
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            x = np.empty((n, width + 1))
            x[:, 0] = 1
            x[:, 1:] = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(n, width) - shift
            coded = batch.column(1).dictionary_encode()
            label, names = coded.indices.to_numpy().astype(np.int64), coded.dictionary.to_pylist()
            for r in range(len(folds)):
                fold = batch.column(2 + r).to_numpy().astype(np.int64)
                # Rows by fold and class: each is one run then.
                key = fold * len(names) + label
                order = np.argsort(key, kind="stable")
                key, sorted_x = key[order], x[order]
                starts = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
                for at, part in zip(key[starts].tolist(), np.add.reduceat(sorted_x, starts, axis=0)):
                    of = r, at // len(names), names[at % len(names)]
                    by_class[of] = by_class[of] + part if of in by_class else part
                fold = fold[order]
                starts = np.flatnonzero(np.concatenate(([True], fold[1:] != fold[:-1])))
                for low, high in zip(starts, np.append(starts[1:], n)):
                    part, of = sorted_x[low:high].T @ sorted_x[low:high], (r, int(fold[low]))
                    gram[of] = gram[of] + part if of in gram else part
        rows = [(r, fold, None, i, m[i]) for (r, fold), m in gram.items() for i in range(width + 1)]
        rows += [(r, fold, name, -1, s) for (r, fold, name), s in by_class.items()]
        step = max(1, 1_000_000 // (width + 1))
        for low in range(0, len(rows), step):
            kinds = pa.int32(), pa.int32(), pa.string(), pa.int32(), pa.list_(pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[low:low + step]), kinds)],
                                             names=["repeat", "fold", "label", "row", "sums"])
    return run


class ClassMoments(Mapping):
    """Moments per class and fold. The cross products are held once, not once for each class."""

    def __init__(self, gram: dict[int, np.ndarray], classes: dict[str, dict[int, np.ndarray]]):
        self.gram, self.classes = gram, classes

    def __iter__(self) -> Iterator[str]:
        return iter(self.classes)

    def __len__(self) -> int:
        return len(self.classes)

    def __getitem__(self, label: str) -> dict[int, Moments]:
        own = self.classes[label]
        out = {}
        for fold, g in self.gram.items():
            s = own.get(fold, np.zeros(len(g)))
            out[fold] = Moments(g[0, 0], g[0, 1:], g[1:, 1:], s[0], s[0], s[1:])
        return out


def all_moments(df: DataFrame, label: str, features: Sequence[str], keys: Sequence[str],
                folds: int = ALPHA_FOLDS, seed: int | str = 7) -> ClassMoments:
    """Moments of every class and fold over all rows."""
    return repeated_moments(df, label, features, keys, folds, [seed])[0]


def repeated_moments(df: DataFrame, label: str, features: Sequence[str], keys: Sequence[str],
                     folds: int, seeds: Sequence[int | str]) -> list[ClassMoments]:
    """``all_moments`` for each seed; the folds of all are dealt on rows that are stored once, and one pass adds them up.

    A task sends one matrix per repeat and fold, less than the rows it has read as soon as those
    outnumber the features, and each matrix row is added up in its own group. The
    driver gets folds x features^2 numbers, and folds x features for each class, of each repeat.
    """
    width = len(features)
    named = df.filter(col(label).isNotNull())
    packed = durable(feature_array(named.withColumn("label", col(label)), features, ["label", *[k for k in keys if k != "label"]]), "labelled_rows")
    names = [f"_fold{r}" for r in range(len(seeds))]
    folded = packed
    for name, seed in zip(names, seeds):
        folded = fold_ids(folded, ["label"], keys, folds, seed, name)
    means = per_column(named, features, [], F.avg("value").alias("m")).collect()
    shift = np.array([{r["column"]: r["m"] for r in means}.get(c, 0.0) for c in features])
    parts = folded.select("features", "label", *names).mapInArrow(_partition_moments(width, shift, names), PART_SCHEMA)

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        first = pdf.iloc[0]
        return pd.DataFrame({"repeat": [first["repeat"]], "fold": [first["fold"]], "label": [first["label"]], "row": [first["row"]],
                             "sums": [np.sum(np.stack(pdf["sums"].to_numpy()), axis=0)]})

    sums = parts.groupBy("repeat", "fold", "label", "row").applyInPandas(add, PART_SCHEMA)
    gram: list[dict[int, np.ndarray]] = [{} for _ in seeds]
    classes: list[dict[str, dict[int, np.ndarray]]] = [{} for _ in seeds]
    for r in sums.toLocalIterator():
        if r["row"] >= 0:
            gram[r["repeat"]].setdefault(r["fold"], np.zeros((width + 1, width + 1)))[r["row"]] = r["sums"]
        else:
            classes[r["repeat"]].setdefault(r["label"], {})[r["fold"]] = np.asarray(r["sums"])
    return [ClassMoments(g, c) for g, c in zip(gram, classes)]


def _by_class(df: DataFrame, classes: Sequence[str]) -> DataFrame:
    return spread(df.sparkSession.createDataFrame([(c,) for c in classes], "celltype string"), "celltype")


def search_alphas_full(df: DataFrame, label: str, features: Sequence[str], keys: Sequence[str],
                       alphas: Sequence[float] | None = None, folds: int = ALPHA_FOLDS,
                       min_labels: int = 20) -> DataFrame:
    """The penalty search on all rows instead of capped sets."""
    moments = all_moments(df, label, features, keys, folds)
    chosen = sorted(c for c, own in moments.classes.items() if sum(s[0] for s in own.values()) >= min_labels)
    grid = np.asarray(alphas if alphas is not None else alpha_grid())
    shared = df.sparkSession.sparkContext.broadcast(moments)

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        celltype = pdf["celltype"].iloc[0]
        return alpha_scores(celltype, list(shared.value[celltype].values()), grid)

    return _by_class(df, chosen).groupBy("celltype").applyInPandas(solve, ALPHA_SCHEMA)


def rfe_scores_full(df: DataFrame, label: str, features: Sequence[str], keys: Sequence[str],
                    best: DataFrame, counts: Sequence[int] = (2, 3), splits: int = RFE_SPLITS,
                    repeats: int = RFE_REPEATS, selector_alpha: float = SELECTOR_ALPHA,
                    max_iter: int = 1000) -> DataFrame:
    """Recursive elimination on all rows, which are read and stored once for all repeats.

    Folds are stratified by class, which stratifies every one-vs-rest target.
    """
    per_repeat = repeated_moments(df, label, features, keys, splits, [f"1.{r}" for r in range(repeats)])
    shared = df.sparkSession.sparkContext.broadcast(per_repeat)
    counts = sorted(counts)

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        celltype, alpha = pdf["celltype"].iloc[0], float(pdf["best_alpha"].iloc[0])
        return pd.concat([
            elimination_scores(celltype, r, moments[celltype], alpha, counts, selector_alpha, max_iter)
            for r, moments in enumerate(shared.value)
        ])

    classes = spread(best.select("celltype", "best_alpha"), "celltype")
    return classes.groupBy("celltype").applyInPandas(solve, RFE_SCHEMA)


def importances_full(df: DataFrame, label: str, features: Sequence[str], keys: Sequence[str],
                     best: DataFrame) -> DataFrame:
    """Absolute coefficients at the best penalty on all rows."""
    names = list(features)
    shared = df.sparkSession.sparkContext.broadcast(all_moments(df, label, names, keys, folds=1))

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        celltype = pdf["celltype"].iloc[0]
        return coefficient_rows(celltype, shared.value[celltype][0], float(pdf["best_alpha"].iloc[0]), names)

    return best.select("celltype", "best_alpha").groupBy("celltype").applyInPandas(solve, IMPORTANCE_SCHEMA)


#: Tables of a selection, in the order in which they are made.
SELECTION_PARTS = ["alpha_scores", "best_alphas", "rfe_scores", "rfe_summary", "optimal", "importances", "top_features", "features"]


def select_features(
    df: DataFrame, label: str, features: Sequence[str], keys: Sequence[str], limit: int = 3000,
    min_labels: int = 20, counts: Sequence[int] = (2, 3), alphas: Sequence[float] | None = None,
    rfe_pattern_drop: str = "Cytoplasm",
) -> dict[str, DataFrame]:
    """The whole selection: scores, best penalties, elimination, chosen features."""
    sets = durable(one_vs_rest(df, label, features, keys, limit, min_labels), "one_vs_rest")
    scores = durable(search_alphas(sets, keys, alphas), "alpha_scores")
    best = best_alphas(scores)
    narrow = [i for i, f in enumerate(features) if rfe_pattern_drop not in f]
    for_rfe = sets if len(narrow) == len(features) else sets.withColumn(
        "features", F.array(*[F.col("features")[i] for i in narrow]))
    rfe = durable(rfe_scores(for_rfe, best, keys, counts), "rfe_scores")
    optimal = optimal_counts(rfe)
    ranked = durable(importances(sets, best, features), "importances")
    top = top_features(ranked, optimal)
    return {
        "alpha_scores": scores, "best_alphas": best, "rfe_scores": rfe, "rfe_summary": rfe_summary(rfe),
        "optimal": optimal, "importances": ranked, "top_features": top, "features": selected_features(top),
    }
