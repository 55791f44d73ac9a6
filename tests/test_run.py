"""Files, spatial figures and the whole run."""

import gzip

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cytospark.config import RunConfig
from cytospark.functions import names
from cytospark.operators import abundance, dispersion, embed, normalize, spatial
from cytospark.plans.workflow import Workflow
from cytospark.session import single_machine
from cytospark.sources import readers, writers

STATS = ["Min", "Max", "Median", "Mean", "Std.Dev.", "Variance"]


def batch_table(seed, n, markers):
    rng = np.random.default_rng(seed)
    cls = rng.choice(["T cell", " B cell", "Tumor", "??", ""], n, p=[0.4, 0.3, 0.2, 0.05, 0.05])
    data = {
        "Image": np.where(rng.uniform(size=n) < 0.8, "S1_roi.ome.tiff", "S2_roi.ome.tiff"),
        "Classification": cls,
        names.X_COLUMN: rng.uniform(0, 1000, n), names.Y_COLUMN: rng.uniform(0, 1000, n),
    }
    for i, m in enumerate(markers):
        level = 20 + 60 * (cls == ["T cell", " B cell", "Tumor"][i % 3])
        base = rng.gamma(4, level / 4)
        for s, f in zip(STATS, [0.2, 2.0, 0.9, 1.0, 0.3, 0.5]):
            data[f"{m}: {s}"] = base * f + rng.uniform(0, 1, n)
    return pd.DataFrame(data)


@pytest.fixture(scope="module")
def folders(tmp_path_factory):
    root = tmp_path_factory.mktemp("input")
    paths = []
    for i, (name, markers) in enumerate({"TMA1": ["CD3", "CD20", "PanCK", "DAPI"], "TMA2": ["CD3", "CD20", "DAPI"]}.items()):
        (root / name).mkdir()
        table = batch_table(i, 400, markers)
        table[:250].to_csv(root / name / "one.tsv", sep="\t", index=False)
        table[250:].assign(**{"Extra: Mean": 1.0}).to_csv(root / name / "two.tsv", sep="\t", index=False)
        (root / name / "notes.txt").write_text("not a table")
        paths.append(str(root / name))
    return paths


def test_scan_unites_headers_and_derives_names(spark, folders):
    df = readers.scan_batches(spark, folders, exclude="extra|dapi", folder_is_slide=True)
    assert df.count() == 800
    assert not [c for c in df.columns if "DAPI" in c or "Extra" in c]
    assert {r["Batch"] for r in df.select("Batch").distinct().collect()} == {"TMA1", "TMA2"}
    assert {r["Slide"] for r in df.select("Slide").distinct().collect()} == {"TMA1", "TMA2"}
    assert df.filter("Image NOT LIKE 'TMA_-S%'").count() == 0
    assert df.filter(names.col("PanCK: Mean").isNull()).select("Batch").distinct().collect()[0][0] == "TMA2"
    assert dict(df.dtypes)["CD3: Mean"] == "double"


def test_slide_rules(spark, folders):
    by_prefix = readers.scan_batches(spark, folders, slide_by_prefix=True)
    assert {r["Slide"] for r in by_prefix.select("Slide").distinct().collect()} == {"S1", "S2"}
    by_file = readers.scan_batches(spark, folders)
    assert {r["Slide"] for r in by_file.select("Slide").distinct().collect()} == {"one.tsv", "two.tsv"}
    assert by_file.filter("Image LIKE 'TMA%'").count() == 0


def test_missing_input_is_an_error(spark, folders):
    with pytest.raises(ValueError):
        readers.scan_batches(spark, folders, extension=".none")
    with pytest.raises(ValueError):
        readers.scan_batches(spark, [])
    with pytest.raises(ValueError):
        readers.require_rows(spark.range(0), "x")


def test_name_filter_matches_anywhere(spark):
    df = spark.range(1).select(F.lit(1).alias("CD3: Mean"), F.lit(1).alias("CD31: Mean"), F.lit(1).alias("CD8: Mean"))
    assert names.drop_matching(df, "cd3").columns == ["CD8: Mean"]
    assert names.drop_matching(df, "").columns == df.columns


def test_example_markers(spark):
    df = spark.range(1).select(*[F.lit(1).alias(f"m{i}: Mean") for i in range(11)], F.lit(1).alias("DAPI: Mean"))
    picked = [r["column"] for r in dispersion.example_markers(df, "DAPI").orderBy("place").collect()]
    assert picked == ["DAPI: Mean", "m2: Mean", "m4: Mean", "m6: Mean", "m8: Mean"]
    assert dispersion.example_markers(df.select(F.lit(1).alias("x")), "DAPI").count() == 0


def test_density_per_image_with_a_crowded_bin(spark):
    rows = [("i1", 10.0, 10.0)] * 500 + [("i1", 130.0, 10.0)] * 3 + [("i2", 10.0, 10.0)] * 4 + [("i1", -5.0, 0.0)]
    df = spark.createDataFrame(rows, f"Image string, `{names.X_COLUMN}` double, `{names.Y_COLUMN}` double")
    got = spatial.bin_density(df).groupBy("Image", "binX", "bin_density", "low_bin_density").count().collect()
    assert {tuple(r) for r in got} == {
        ("i1", 0, 500, False, 500), ("i1", 1, 3, True, 3), ("i2", 0, 4, False, 4), ("i1", -1, 1, True, 1)}


def test_density_is_the_same_without_broadcast(spark, monkeypatch):
    from cytospark.operators import sizing

    rows = [("i1", float(i % 700), float(i % 31)) for i in range(2000)]
    df = spark.createDataFrame(rows, f"Image string, `{names.X_COLUMN}` double, `{names.Y_COLUMN}` double")
    want = sorted(map(tuple, spatial.bin_density(df).collect()))
    monkeypatch.setattr(sizing.join_stored, "__defaults__", ("left", 1))
    assert sorted(map(tuple, spatial.bin_density(df).collect())) == want


def test_abundance_columns_follow_frequency(spark):
    rows = [("s1", "b")] * 5 + [("s1", "a")] * 3 + [("s2", "c")] * 2
    df = spark.createDataFrame(rows, "Sample string, CellTypePrediction string")
    matrix = abundance.abundance_matrix(abundance.class_counts(df, ["Sample"]), "Sample")
    assert matrix.columns == ["Sample", "b", "a", "c"]
    assert {r["Sample"]: (r["b"], r["a"], r["c"]) for r in matrix.collect()} == {"s1": (62.5, 37.5, 0.0), "s2": (0.0, 0.0, 100.0)}


def test_one_folder_per_image(spark, tmp_path):
    rows = [(f"i{i % 3}", float(i), 0.0, "a") for i in range(90)]
    df = spark.createDataFrame(rows, f"Image string, `{names.X_COLUMN}` double, `{names.Y_COLUMN}` double, CellTypePrediction string")
    writers.write_predictions(df, str(tmp_path / "p"))
    assert sorted(p.name for p in (tmp_path / "p").glob("Image_key=*")) == ["Image_key=i0", "Image_key=i1", "Image_key=i2"]
    with pytest.raises(Exception):
        readers.scan_predictions(spark, str(tmp_path / "p"), "*.none", df.schema)


@pytest.mark.parametrize("method,kind", [("boxcox", "boosted"), ("compare", "rf")])
def test_whole_run(spark, folders, method, kind):
    config = RunConfig(
        folders=folders, normalization=method, nuclear_marker="DAPI", quantile_references=50, minimum_labels=20,
        class_limit=200, repeats=1, depths=[2, 3], rates=[1.0], rounds=2 if kind == "boosted" else 10, model_kind=kind,
        exclude_markers="Extra")
    result = Workflow(spark, config).run()
    assert result.predictions.count() == 800
    assert result.predictions.filter(F.col("CellTypePrediction").isNull()).count() == 0
    assert result.normalized.filter(names.col("PanCK: Mean").isNull()).count() == 0
    splits = {r["split"]: r["count"] for r in result.tagged.groupBy("split").count().collect()}
    assert splits["holdout"] > 0 and splits["training"] > splits["holdout"] * 5
    assert result.best_model in ("First", "Second")
    assert result.tables["summary"].first()["total_cells"] == 800
    if method == "boxcox":
        assert result.performance.agg(F.max("accuracy")).first()[0] > 0.6
        assert result.tables["summary"].first()["normalization_method"] == "boxcox"


def test_run_without_input_is_an_error(spark):
    with pytest.raises(ValueError):
        Workflow(spark, RunConfig()).run()


def test_optional_clusters(spark):
    table = batch_table(5, 300, ["CD3", "CD20", "DAPI"]).rename(columns={})
    df = spark.createDataFrame(table).withColumn("cell_id", F.xxhash64(names.col(names.X_COLUMN)).cast("string"))
    out = Workflow(spark, RunConfig(clusters=3)).clustered(df)
    assert out.count() == 300 and out.filter("Cluster IS NULL").count() == 0


def test_missing_image_keeps_its_cells(spark):
    rows = [("i1", 10.0, 10.0)] * 4 + [(None, 10.0, 10.0)] * 3 + [("i1", None, 10.0)]
    df = spark.createDataFrame(rows, f"Image string, `{names.X_COLUMN}` double, `{names.Y_COLUMN}` double")
    assert {tuple(r) for r in spatial.sparse_bin_cells(df, ["Image"]).collect()} == {("i1", 5, 1, 0.2), (None, 3, 3, 1.0)}
    flagged = spatial.bin_density(df).groupBy("Image", "binX", "bin_density").count().collect()
    assert {tuple(r) for r in flagged} == {("i1", 0, 4, 4), (None, 0, 3, 3), ("i1", None, 1, 1)}


def test_null_batch_is_a_batch(spark):
    rng = np.random.default_rng(4)
    rows = [(b, float(v)) for b in ("a", None) for v in rng.lognormal(0, 1, 100)]
    df = spark.createDataFrame(rows, "Batch string, `m: Mean` double")
    fitted = {r["Batch"]: r["lambda"] for r in normalize.boxcox_fit(df, ["m: Mean"], ["Batch"]).collect()}
    assert set(fitted) == {"a", None} and all(v is not None for v in fitted.values())
    whole = normalize.quantile(df, ["m: Mean"], ["Batch"])
    parts = normalize.quantile(df, ["m: Mean"], ["Batch"], max_bytes=1)
    key = lambda r: (r["Batch"] is None, r["m: Mean"])
    assert sorted(whole.collect(), key=key) == sorted(parts.collect(), key=key)
    assert whole.filter("Batch is null and `m: Mean` > 0").count() == 99
    after = normalize.boxcox(df, ["m: Mean"], ["Batch"])
    record = normalize.boxcox_record(df, after, normalize.boxcox_fit(df, ["m: Mean"], ["Batch"]), ["m: Mean"], ["Batch"])
    assert {r["Batch"] for r in record.collect()} == {"a", None}


def test_neighbours_do_not_depend_on_partitions(spark):
    x = np.random.default_rng(9).normal(size=(400, 12))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id bigint, components array<double>")
    found = []
    for n in (4, 64):
        near = embed.nearest_neighbours(df.repartition(n), "id", k=5, dims=12, window=200)
        found.append({(r["id"], r["neighbour"], r["rank"]) for r in near.collect()})
    assert found[0] == found[1]
    d = ((x[:, None] - x[None]) ** 2).sum(-1)
    np.fill_diagonal(d, np.inf)
    true = {(i, int(j)) for i in range(400) for j in np.argsort(d[i])[:5]}
    assert len(true & {(i, j) for i, j, _ in found[0]}) >= 0.95 * len(true)


def test_twin_rows_get_different_ids(spark):
    rows = [("b", "i", 1.0, 1.0, 2.0)] * 3 + [("b", "i", 2.0, 1.0, 2.0)]
    schema = f"Batch string, Image string, `{names.X_COLUMN}` double, `{names.Y_COLUMN}` double, `m: Mean` double"
    got = Workflow(spark, RunConfig()).identified(spark.createDataFrame(rows, schema)).collect()
    assert len(got) == 4 == len({r["cell_id"] for r in got})


def test_scratch_needs_a_shared_folder_beyond_one_machine():
    assert single_machine("local") and single_machine("local[8]")
    assert not any(map(single_machine, ["local-cluster[2,1,1024]", "yarn", "spark://host:7077", "k8s://host"]))


def test_corrupt_prediction_files_are_reported(spark, tmp_path):
    with gzip.open(tmp_path / "good.tsv.gz", "wt") as f:
        f.write("Image\tCellTypePrediction\na.ome.tiff\tT\n")
    (tmp_path / "bad.tsv.gz").write_bytes(b"not a compressed file")
    schema = "Image string, CellTypePrediction string"
    with pytest.warns(UserWarning, match="1 file"):
        found = readers.scan_predictions(spark, str(tmp_path), "*.gz", schema, skip_corrupt=True)
    assert found.count() == 1
