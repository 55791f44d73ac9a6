"""A run that stops continues where it was, and leaves its files behind."""

import dataclasses
import os

import pytest
from test_run import folders  # noqa: F401

from cytospark.config import RunConfig
from cytospark.operators import boosting
from cytospark.plans.ledger import Ledger, files_key
from cytospark.plans.workflow import Workflow
from cytospark.sources import readers


def test_a_stage_is_made_once_for_its_settings(spark, tmp_path):
    calls = []

    def build():
        calls.append(1)
        return spark.createDataFrame([("01", 1), (None, 2)], "batch string, n int")

    def run(size):
        ledger = Ledger(spark, str(tmp_path), "files")
        first = ledger.table("first", {}, build, ["batch"])
        second = ledger.table("second", {"size": size}, lambda: first.limit(size))
        assert sorted(map(tuple, first.select("n", "batch").collect())) == [(1, "01"), (2, None)]
        return ledger.made, second.count()

    assert run(1) == (["first", "second"], 1)
    assert run(1) == ([], 1)
    assert run(2) == (["second"], 2)
    assert len(calls) == 1


def test_data_without_an_entry_are_replaced(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path), "files")

    def lost(path):
        spark.range(3).write.parquet(path)
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        ledger.output("rows", lost)
    again = Ledger(spark, str(tmp_path), "files")
    path = again.output("rows", lambda p: spark.range(5).write.parquet(p))
    assert spark.read.parquet(path).count() == 5 and again.made == ["output rows"]


def test_new_files_give_a_new_key(spark, tmp_path):
    (tmp_path / "a.tsv").write_text("x\n1\n")
    before = files_key(spark, [str(tmp_path)], ".tsv")
    assert before == files_key(spark, [str(tmp_path)], ".tsv")
    (tmp_path / "b.tsv").write_text("x\n1\n")
    assert before != files_key(spark, [str(tmp_path)], ".tsv")


def test_a_stopped_run_continues(spark, folders, tmp_path, monkeypatch):  # noqa: F811
    config = RunConfig(
        folders=folders, normalization="logscale", quantile_references=50, class_limit=200, repeats=1, depths=[2, 3], rates=[1.0], rounds=2,
        exclude_markers="Extra", output=str(tmp_path / "out"))
    with monkeypatch.context() as m:
        m.setattr(boosting, "grid_search", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            Workflow(spark, config).run()
    second = Workflow(spark, config)
    result = second.run()
    assert not {"merged", "filled", "normalized", "gated", "tagged", "selection_features"} & set(second.ledger.made)
    assert {"grid", "performance", "predictions"} <= set(second.ledger.made)
    out = config.output
    for name in ("models/First", "models/Second", "predictions", "qc_predictions", "normalized/logscale", "class_list", "encoder", "metrics/summary"):
        assert os.path.isdir(f"{out}/{name}"), name
    assert spark.read.json(f"{out}/metrics/summary").first()["total_cells"] == 800
    assert sorted(r[0] for r in readers.read_class_list(spark, f"{out}/class_list").collect()) == sorted(
        r[0] for r in result.tagged.filter("split = 'training'").select("Classification").distinct().collect())
    assert spark.read.options(header=True, sep="\t").csv(f"{out}/predictions").count() == 800
    third = Workflow(spark, config)
    assert third.run().best_model == result.best_model and third.ledger.made == []
    wider = Workflow(spark, dataclasses.replace(config, bin_size=300.0))
    wider.run()
    assert "predictions" in wider.ledger.made and "grid" not in wider.ledger.made
