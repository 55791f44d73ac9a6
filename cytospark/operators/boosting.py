"""Boosted-tree classifiers: parameter grid, winners, final models, scoring."""

from __future__ import annotations

import json
import pickle
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import StringIndexer, StringIndexerModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cytospark.functions.names import col, cols, nan_to_null
from cytospark.functions.scalars import percent_text
from cytospark.operators import softmax
from cytospark.operators.abundance import PREDICTION
from cytospark.operators.evaluate import confusion, holdout_performance
from cytospark.operators.ranking import bounded_train_test, train_test
from cytospark.operators.split import classes_with, rows_of_classes
from cytospark.session import durable

# Boosting rounds, repeats, depths, learning rates, test share,
# class size that a class must exceed, names of the two models.
ROUNDS = 200
REPEATS = 10
DEPTHS = range(2, 11, 3)
RATES = [0.1, 1.0]
TEST_SHARE = 0.33
MIN_LABELS = 20
MODEL_NAMES = ["First", "Second"]

FEATURES, LABEL_INDEX, PREDICTED_INDEX, VECTOR = "_features", "_label", "_predicted", "_vector"
#: Values (rows x features) of a table that one task trains on, with some 40 bytes each; larger ones are summed by Spark.
LOCAL_VALUES = 16_000_000


def parameter_grid(spark: SparkSession, repeats: int = REPEATS, depths: Sequence[int] = DEPTHS,
                   rates: Sequence[float] = RATES) -> DataFrame:
    """Every repeat, depth and rate; a few dozen rows."""
    def axis(name: str, kind: str, values) -> DataFrame:
        rows = [(v,) for v in values]
        return spark.createDataFrame(rows, f"{name} {kind}").coalesce(1)  # a cross join makes the product of the partitions

    return (
        axis("cv", "int", range(repeats))
        .crossJoin(axis("max_depth", "int", depths))
        .crossJoin(axis("eta", "double", rates))
        .orderBy("cv", "max_depth", "eta")
    )


def assemble(df: DataFrame, features: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """Kept columns and the array of features, missing values as 0, in list order."""
    packed = F.array(*[F.coalesce(nan_to_null(col(c).cast("double")), F.lit(0.0)) for c in features])
    return df.select(*cols(keep), packed.alias(FEATURES))


def large_classes(df: DataFrame, label: str, threshold: int = MIN_LABELS) -> DataFrame:
    """Rows of classes with more than ``threshold`` rows."""
    return rows_of_classes(df, classes_with(df, label, more_than=threshold), label)


def label_encoder(df: DataFrame, label: str) -> StringIndexerModel:
    """Class codes in alphabetical order of the class names."""
    return StringIndexer(
        inputCol=label, outputCol=LABEL_INDEX, stringOrderType="alphabetAsc", handleInvalid="skip"
    ).fit(df.select(col(label)))


@dataclass
class CellModel:
    """A fitted model: boosted trees or the stages of a forest, its features and class names, both in order."""

    features: list[str]
    labels: list[str]
    trees: softmax.SoftmaxTrees | None = None
    forest: PipelineModel | None = None

    def predict(self, prepared: DataFrame, prediction: str = PREDICTION) -> DataFrame:
        """Adds the class to rows that carry the feature array; map-only. Only that array goes to the trees."""
        kept = [c for c in prepared.columns if c != FEATURES]
        if self.forest is not None:
            out = self.forest.transform(prepared.withColumn(VECTOR, array_to_vector(FEATURES)))
            index = F.col(PREDICTED_INDEX).cast("int")
        else:
            shared, features = prepared.sparkSession.sparkContext.broadcast(self.trees), len(self.features)

            @F.arrow_udf("int")
            def best(column: pa.Array) -> pa.Array:
                return pa.array(shared.value.predict(softmax.values_of(column, features)), pa.int32())

            out, index = prepared, best(FEATURES)
        names = F.array(*[F.lit(x) for x in self.labels])
        return out.select(*cols(kept), F.element_at(names, index + 1).alias(prediction))

    def score(self, df: DataFrame, prediction: str = PREDICTION) -> DataFrame:
        """Adds the predicted class to a table with the feature columns; map-only."""
        return self.predict(assemble(df, self.features, df.columns), prediction)

    def save(self, path: str) -> None:
        spark = SparkSession.active()
        if self.forest is not None:
            self.forest.write().overwrite().save(f"{path}/stages")
        else:
            softmax.save(self.trees, spark, path)
        note = json.dumps({"features": self.features, "labels": self.labels, "kind": "rf" if self.forest is not None else "boosted"})
        spark.createDataFrame([(note,)], "note string").coalesce(1).write.mode("overwrite").text(f"{path}/note")

    @classmethod
    def load(cls, path: str) -> CellModel:
        spark = SparkSession.active()
        note = json.loads(spark.read.text(f"{path}/note").first()[0])
        if note["kind"] == "rf":
            return cls(note["features"], note["labels"], forest=PipelineModel.load(f"{path}/stages"))
        return cls(note["features"], note["labels"], trees=softmax.load(spark, path))


def coded_rows(df: DataFrame, label: str, features: Sequence[str], encoder: StringIndexerModel, keep: Sequence[str] = ()) -> DataFrame:
    """The class code, the feature array and ``keep``, stored; rows of classes that the encoder lacks go."""
    return durable(encoder.transform(assemble(df, features, [label, *keep])).withColumn(
        LABEL_INDEX, F.col(LABEL_INDEX).cast("int")), "coded_rows")


def fits_in_memory(rows: int, features: int) -> bool:
    return rows * features <= LOCAL_VALUES


def fit_forest(coded: DataFrame, depth: int, trees: int, seed: int = 42) -> PipelineModel:
    forest = RandomForestClassifier(
        labelCol=LABEL_INDEX, featuresCol=VECTOR, predictionCol=PREDICTED_INDEX, maxDepth=depth, numTrees=trees, seed=seed)
    return PipelineModel([forest.fit(coded.select(LABEL_INDEX, array_to_vector(FEATURES).alias(VECTOR)))])


def fit_coded(coded: DataFrame, features: Sequence[str], labels: Sequence[str], settings: Sequence[tuple[int, float]],
              rounds: int = ROUNDS, kind: str = "boosted") -> list[CellModel]:
    """A model for each (depth, rate). Tables whose counted values fit go to a task for each model, others are summed by Spark."""
    features, labels = list(features), list(labels)
    if kind == "rf":
        return [CellModel(features, labels, forest=fit_forest(coded, depth, rounds)) for depth, _ in settings]
    if not fits_in_memory(coded.count(), len(features)):
        edges = softmax.array_edges(coded, FEATURES, len(features))
        rows = coded.select(F.col(LABEL_INDEX).alias("y"), F.col(FEATURES).alias("x"))
        return [CellModel(features, labels, trees=softmax.train_spark(rows, edges, len(labels), depth, rate, rounds))
                for depth, rate in settings]
    shared = coded.sparkSession.sparkContext.broadcast(_values(coded.orderBy(FEATURES, LABEL_INDEX), len(features)))  # counted above
    classes = len(labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        y, x, _ = shared.value
        for batch in batches:
            for i, depth, rate in zip(*(c.to_pylist() for c in batch.columns)):
                model = softmax.train_local(x, y, classes, depth, rate, rounds)
                yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([pickle.dumps(model)], pa.binary())], names=["i", "model"])

    rows = _one_a_task(coded.sparkSession, [(i, d, float(r)) for i, (d, r) in enumerate(settings)], "i int, depth int, rate double")
    found = sorted(rows.mapInArrow(run, "i int, model binary").collect(), key=lambda r: r["i"])
    return [CellModel(features, labels, trees=pickle.loads(r["model"])) for r in found]


def _values(coded: DataFrame, features: int, marks: Sequence[str] = ()) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Class codes, feature values and marks of a table of counted size."""
    table = coded.select(LABEL_INDEX, FEATURES, *marks).toArrow().combine_chunks()
    x = table[FEATURES].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(table.num_rows, features)
    return table[LABEL_INDEX].to_numpy(), x, np.array([table[m].to_numpy() for m in marks], bool)


def _one_a_task(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    return spark.createDataFrame(spark.sparkContext.parallelize(rows, max(1, len(rows))), schema)


def fit_model(df: DataFrame, label: str, features: Sequence[str], depth: int, rate: float,
              rounds: int = ROUNDS, kind: str = "boosted", encoder: StringIndexerModel | None = None) -> CellModel:
    """Fit on all rows given; the codes follow the encoder or the rows."""
    encoder = encoder or label_encoder(df, label)
    return fit_coded(coded_rows(df, label, features, encoder), features, encoder.labels, [(depth, rate)], rounds, kind)[0]


def grid_search(df: DataFrame, label: str, features: Sequence[str], keys: Sequence[str], grid: DataFrame,
                rounds: int = ROUNDS, threshold: int = MIN_LABELS, test_size: float = TEST_SHARE,
                kind: str = "boosted", workers: int = 4) -> DataFrame:
    """Train and test accuracy of every grid row on a stratified split per repeat.

    A table whose counted values fit is trained on in a task for each grid row. Beyond, each model is summed by
    Spark, several side by side.
    """
    used = large_classes(df, label, threshold)
    encoder = label_encoder(used, label)
    used = durable(used.select(*cols(dict.fromkeys([*keys, label, *features]))), "grid_rows")
    rows = [tuple(r) for r in grid.select("cv", "max_depth", "eta").collect()]  # a few dozen
    repeats = sorted({r[0] for r in rows})
    schema = "cv int, max_depth int, eta double, train_accuracy double, testf double"
    if kind != "rf" and fits_in_memory(used.count(), len(features)):
        return _grid_in_tasks(used, label, features, keys, encoder, rows, repeats, rounds, test_size, schema)
    out = []
    for cv in repeats:
        split = train_test(used, [label], keys, test_size, cv)
        coded = coded_rows(split, label, features, encoder, ["is_test"])

        def one(row: tuple) -> tuple:
            model = fit_coded(coded.filter("not is_test"), features, encoder.labels, [row[1:]], rounds, kind)[0]
            hits = model.predict(coded).groupBy("is_test").agg(F.avg((col(label) == F.col(PREDICTION)).cast("double")).alias("acc"))
            acc = {r["is_test"]: r["acc"] for r in hits.collect()}
            return (*row, acc.get(False), acc.get(True))

        with ThreadPoolExecutor(workers) as pool:
            out += list(pool.map(one, [r for r in rows if r[0] == cv]))
    return df.sparkSession.createDataFrame(out, schema)


def _grid_in_tasks(used: DataFrame, label: str, features: Sequence[str], keys: Sequence[str], encoder: StringIndexerModel,
                   rows: list[tuple], repeats: list[int], rounds: int, test_size: float, schema: str) -> DataFrame:
    marked = used
    for cv in repeats:  # of a bounded table: a window each
        marked = bounded_train_test(marked, [label], keys, test_size, cv).withColumnRenamed("is_test", f"_test{cv}")
    marks = [f"_test{cv}" for cv in repeats]
    coded = coded_rows(marked, label, features, encoder, [*marks, *[k for k in keys if k != label]]).orderBy(*cols(keys))
    shared = used.sparkSession.sparkContext.broadcast(_values(coded, len(features), marks))
    classes = len(encoder.labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        y, x, tests = shared.value
        for batch in batches:
            out = []
            for cv, depth, eta in zip(*(c.to_pylist() for c in batch.columns)):
                test = tests[repeats.index(cv)]
                model, margins = softmax.train_local_margins(x[~test], y[~test], classes, depth, eta, rounds)
                hits = margins.argmax(axis=1) == y[~test], model.predict(x[test]) == y[test]
                out.append((cv, depth, eta, *(float(part.mean()) if len(part) else None for part in hits)))
            kinds = [pa.int32(), pa.int32(), pa.float64(), pa.float64(), pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)],
                                             names=["cv", "max_depth", "eta", "train_accuracy", "testf"])

    # Deep models take longest: they go first.
    order = sorted(rows, key=lambda r: (-r[1], r[2], r[0]))
    return durable(_one_a_task(used.sparkSession, order, "cv int, max_depth int, eta double").mapInArrow(run, schema), "grid_results")


def grid_table(results: DataFrame) -> DataFrame:
    """Grid results with the accuracies as percent text."""
    return results.select("cv", "max_depth", "eta", percent_text(F.col("train_accuracy")).alias("Training"),
                          percent_text(F.col("testf")).alias("Test"), "testf")


def grid_summary(results: DataFrame) -> DataFrame:
    """Per depth and rate: repeats, mean and deviation of both accuracies."""
    return results.groupBy("max_depth", "eta").agg(
        F.countDistinct("cv").alias("cv"),
        F.avg("train_accuracy").alias("training_mean"), F.stddev_samp("train_accuracy").alias("training_std"),
        F.avg("testf").alias("test_mean"), F.stddev_samp("testf").alias("test_std"),
    )


def combination_marks(results: DataFrame) -> DataFrame:
    """Mean per combination, the best and the second best marked."""
    mean = results.groupBy("max_depth", "eta").agg(F.avg("testf").alias("mean_accuracy"))
    rank = F.row_number().over(W.partitionBy(F.lit(1)).orderBy(F.desc("mean_accuracy"), "max_depth", "eta"))
    return mean.select(
        F.format_string("max_depth=%d, eta=%s", "max_depth", F.col("eta").cast("string")).alias("combination"),
        "mean_accuracy",
        F.when(rank == 1, "best").when(rank == 2, "second").otherwise("other").alias("mark"),
    )


def top_two(summary: DataFrame) -> DataFrame:
    """The two best parameter sets; an error if there are fewer."""
    best = summary.dropDuplicates(["max_depth", "eta"]).orderBy(
        F.desc("test_mean"), "max_depth", "eta").limit(2)
    found = best.count()
    if found < 2:
        raise ValueError(f"the grid gave {found} parameter set(s); two are needed to compare models")
    return best


def train_winners(df: DataFrame, label: str, features: Sequence[str], best: DataFrame, rounds: int = ROUNDS,
                  threshold: int = MIN_LABELS, kind: str = "boosted") -> dict[str, CellModel]:
    """The two best parameter sets fitted on all training rows."""
    used = large_classes(df, label, threshold)
    encoder = label_encoder(used, label)
    rows = best.orderBy(F.desc("test_mean"), "max_depth", "eta").collect()  # two rows
    settings = [(r["max_depth"], r["eta"]) for r in rows]
    return dict(zip(MODEL_NAMES, fit_coded(coded_rows(used, label, features, encoder), features, encoder.labels, settings, rounds, kind)))


def evaluate_models(models: dict[str, CellModel], holdout: DataFrame, label: str) -> DataFrame:
    """One performance row per model, with its position."""
    out = None
    for i, (name, model) in enumerate(models.items()):
        pairs = confusion(model.score(holdout), label, PREDICTION)
        row = holdout_performance(name, pairs).withColumn("position", F.lit(i))
        out = row if out is None else out.unionByName(row)
    return out


def decode_labels(df: DataFrame, code: str, encoder: StringIndexerModel, name: str = "class") -> DataFrame:
    """Class names from codes."""
    labels = F.array(*[F.lit(x) for x in encoder.labels])
    return df.withColumn(name, F.try_element_at(labels, col(code).cast("int") + 1))
