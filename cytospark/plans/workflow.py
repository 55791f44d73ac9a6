"""The whole run: files to predictions and report tables.

A thin chain of the operators. Results that several steps read are stored in
the shared folder, so a lost executor costs one step, not the run. With an output folder
they are stored there under a key of inputs and parameters, so that a rerun continues, and the run's files are written.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cytospark.config import RunConfig
from cytospark.functions.names import BOXCOX_PATTERN, col, cols, feature_columns, matching
from cytospark.operators import (
    abundance,
    boosting,
    dispersion,
    embed,
    evaluate,
    gating,
    lasso,
    normalize,
    panel,
    report,
    spatial,
    split,
)
from cytospark.functions.scalars import now_text
from cytospark.operators.sizing import join_summary
from cytospark.plans.ledger import Ledger, files_key
from cytospark.session import durable
from cytospark.sources import readers, writers

CELL_ID = "cell_id"


@dataclass
class RunResult:
    cells: DataFrame
    normalized: DataFrame
    tagged: DataFrame
    selection: dict[str, DataFrame]
    grid: DataFrame
    performance: DataFrame
    best_model: str
    predictions: DataFrame
    tables: dict[str, DataFrame] = field(default_factory=dict)


class Workflow:
    def __init__(self, spark: SparkSession, config: RunConfig):
        self.spark, self.config = spark, config
        self.ledger: Ledger | None = None
        if config.output:
            self.ledger = Ledger(spark, config.output, files_key(spark, config.folders, config.extension) if config.folders else "given")

    def stage(self, name: str, build: Callable[[], DataFrame], partition_by: Sequence[str] = (), uses: str = "") -> DataFrame:
        """A stored table; ``uses`` names the settings that it depends on beside the stages before it."""
        if self.ledger is None:
            return durable(build(), name, list(partition_by))
        settings = {f: getattr(self.config, f) for f in uses.split()}
        return self.ledger.table(name, settings, build, partition_by)

    # -- steps ----------------------------------------------------------------

    def merge(self) -> DataFrame:
        """All batches in one stored table, with a row id from position and origin."""
        c = self.config

        def build() -> DataFrame:
            merged = readers.scan_batches(
                self.spark, c.folders, c.extension, c.delimiter, c.exclude_markers, c.slide_by_prefix, c.folder_is_slide)
            return self.identified(readers.clean_images(readers.require_rows(merged, ", ".join(c.folders)), c.image))

        return self.stage("merged", build, [c.batch], "delimiter exclude_markers slide_by_prefix folder_is_slide batch image x y")

    def identified(self, df: DataFrame) -> DataFrame:
        """Row id, unique and never a feature: 128 bits of a hash of batch, image, position and all measures.

        Equal rows share a hash; those get a running number as well, which a stored table keeps.
        """
        c = self.config
        own = cols([c.batch, c.image, c.x, c.y, *matching(df, BOXCOX_PATTERN)])
        hashed = df.select("*", F.concat_ws("-", F.xxhash64(*own), F.xxhash64(F.lit(CELL_ID), *own)).alias(CELL_ID))
        twins = hashed.groupBy(CELL_ID).count().filter("count > 1").select(CELL_ID, F.lit(True).alias("_twin"))
        number = F.when(F.col("_twin"), F.monotonically_increasing_id())
        return join_summary(hashed, twins, [CELL_ID], "left").withColumn(
            CELL_ID, F.concat_ws("-", CELL_ID, number)).drop("_twin")

    def fill(self, df: DataFrame) -> DataFrame:
        """Give every batch all markers; absent ones get low noise."""
        c = self.config

        def build() -> DataFrame:
            means = [m for m in df.columns if "Mean" in m]
            seen = panel.present_columns(df, c.batch, means)
            absent = panel.missing_markers(panel.observed_markers(seen, "batch"))
            return panel.fill_batches(df, absent, c.batch, [CELL_ID], c.per_compartment)

        return self.stage("filled", build, [c.batch], "per_compartment")

    def normalized(self, df: DataFrame) -> tuple[DataFrame, str]:
        """Normalise per batch, then gate the background per batch."""
        c = self.config
        measures = matching(df, BOXCOX_PATTERN)
        method = normalize.METHOD_ALIASES.get(c.normalization, c.normalization)
        if method not in normalize.METHODS:
            def choose() -> DataFrame:
                means = [m for m in measures if "Mean" in m]
                tables = normalize.normalize_all(df, measures, [c.batch], c.quantile_references, c.exact_quantiles)
                best = normalize.pick_best(normalize.compare_methods(df, tables, c.slide, means))
                return self.spark.createDataFrame([(best,)], "method string")

            method = self.stage("method", choose, (), "slide quantile_references exact_quantiles").first()["method"]
        columns = None if method == "logscale" else measures
        out = self.stage("normalized", lambda: normalize.normalize(
            df, method, columns, [c.batch], c.quantile_references, c.exact_quantiles), [c.batch], "normalization quantile_references exact_quantiles")
        if c.gate:
            plain = out
            out = self.stage("gated", lambda: gating.gate_background(plain, groups=[c.batch], prefix_match=c.gate_prefix_match), [c.batch], "gate_prefix_match")
        if c.cluster:
            source = out
            out = self.stage("clustered", lambda: self.clustered(source), [c.batch], "nuclear_marker clusters")
        return out, method

    def clustered(self, df: DataFrame) -> DataFrame:
        """Adds a cluster of the neighbour graph to every cell."""
        c = self.config
        chosen = embed.median_columns(df, c.nuclear_marker) or [m for m in df.columns if "Median" in m and c.nuclear_marker not in m]
        keyed = df.withColumn("_key", col(CELL_ID))
        components, _ = embed.standard_components(keyed, chosen, ["_key"], k=embed.GRAPH_COMPONENTS)
        dims = min(embed.GRAPH_COMPONENTS, len(chosen))
        clusters = embed.cluster_cells(components, "_key", c.clusters, dims=dims)
        return keyed.join(clusters, "_key", "left").drop("_key").withColumnRenamed("cluster", "Cluster")

    # -- run ------------------------------------------------------------------

    def run(self) -> RunResult:
        return self.run_on(self.merge())

    def run_on(self, merged: DataFrame) -> RunResult:
        """All steps after the merge, on a table with a row id."""
        c = self.config
        filled = self.fill(merged)
        table, method = self.normalized(filled)
        labelled = split.annotated(table, c.label, c.negative_labels)
        tagged = self.stage("tagged", lambda: split.holdout_split(
            labelled, c.label, c.batch, [CELL_ID], c.holdout_fraction, c.minimum_labels), ["split"], "label negative_labels holdout_fraction minimum_labels")
        training, holdout = tagged.filter("split = 'training'"), tagged.filter("split = 'holdout'")

        features = feature_columns(table, exclude=["Cluster"])
        found: dict[str, DataFrame] = {}

        def select(part: str) -> DataFrame:
            if not found:
                found.update(lasso.select_features(
                    training, c.label, features, [CELL_ID], c.class_limit, c.minimum_labels, c.rfe_features))
            return found[part]

        selection = {part: self.stage(f"selection_{part}", lambda part=part: select(part), (), "class_limit minimum_labels rfe_features")
                     for part in lasso.SELECTION_PARTS}
        chosen = [r["feature"] for r in selection["features"].orderBy("feature").collect()]

        grid = boosting.parameter_grid(self.spark, c.repeats, c.depths, c.rates)
        results = self.stage("grid", lambda: boosting.grid_search(
            training, c.label, chosen, [CELL_ID], grid, c.rounds, c.minimum_labels, kind=c.model_kind), (), "repeats depths rates rounds model_kind")
        best = boosting.top_two(boosting.grid_summary(results))
        models = self.models(lambda: boosting.train_winners(training, c.label, chosen, best, c.rounds, c.minimum_labels, c.model_kind))
        performance = self.stage("performance", lambda: boosting.evaluate_models(models, holdout, c.label))
        winner = evaluate.best_model(performance).first()["model"]

        flagged = self.stage("predictions", lambda: spatial.bin_density(
            models[winner].score(table).select(cols(dict.fromkeys([*c.export_columns, c.slide, c.batch, c.image, c.x, c.y]))),
            c.image, c.x, c.y, c.bin_size, c.density_cutoff), [c.batch], "export_columns bin_size density_cutoff")
        tables = self.report_tables(merged, table, method, tagged, models, holdout, flagged)
        self.write_outputs(table, tagged, flagged, method, tables)
        return RunResult(merged, table, tagged, selection, results, performance, winner, flagged, tables)

    def models(self, train: Callable[[], dict[str, boosting.CellModel]]) -> dict[str, boosting.CellModel]:
        """The two winners; with an output folder they are saved there and read back on a rerun."""
        if self.ledger is None:
            return train()

        def save(path: str) -> None:
            for name, model in train().items():
                model.save(f"{path}/{name}")

        path = self.ledger.output("models", save)
        return {name: boosting.CellModel.load(f"{path}/{name}") for name in boosting.MODEL_NAMES}

    def write_outputs(self, table: DataFrame, tagged: DataFrame, flagged: DataFrame, method: str, tables: dict[str, DataFrame]) -> None:
        """The files of a run: predictions, their quality flags, normalised tables, class list, encoder, metrics."""
        if self.ledger is None:
            return
        c, out = self.config, self.ledger.output
        training = boosting.large_classes(tagged.filter("split = 'training'"), c.label, c.minimum_labels)
        out("predictions", lambda path: writers.write_predictions(flagged, path, list(c.export_columns), c.image))
        out("qc_predictions", lambda path: writers.write_qc_predictions(flagged, path, c.image))
        out("normalized", lambda path: writers.write_normalized(table.drop(CELL_ID), f"{path}/{method}", c.batch))
        out("class_list", lambda path: writers.write_class_list(training.select(c.label).distinct().orderBy(c.label), path))
        out("encoder", lambda path: writers.save_encoder(boosting.label_encoder(training, c.label), path))
        for name, df in tables.items():
            out(f"metrics/{name}", lambda path, df=df: writers.write_metrics(df, path))

    def report_tables(self, merged, table, method, tagged, models, holdout, flagged) -> dict[str, DataFrame]:
        c = self.config
        means = [m for m in merged.columns if "Mean" in m]
        cv = dispersion.cv_metrics(merged, table, c.slide, means)
        norm = merged.select(F.lit(method).alias("transformation_type"), col(c.batch).alias("batch_name")).distinct()
        split_table = split.split_report(merged, tagged, c.holdout_fraction, c.minimum_labels, c.negative_labels)
        evaluations = None
        for name, model in models.items():
            pairs = evaluate.confusion(model.score(holdout), c.label, abundance.PREDICTION)
            row = evaluate.overall(pairs).select(F.lit(name).alias("model_name"), "*")
            evaluations = row if evaluations is None else evaluations.unionByName(row)
        return {
            "cv": cv,
            "worst_markers": dispersion.worst_markers(cv),
            "split": split_table,
            "classes": split.class_table(tagged, c.label),
            "evaluations": report.ordered_models(evaluations),
            "summary": report.run_summary(
                split_table, report.normalization_rollup(norm), report.model_rollup(evaluations)).withColumn(
                    "generated", now_text()),
            **{f"abundance_{k}": v for k, v in abundance.abundance_summary(flagged, c.image).items()},
        }
