"""The booster against a plain version, and its two ways of summing against each other."""

import math
import re

import numpy as np
import pandas as pd
import pytest

from cytospark.operators import boosting, softmax
from cytospark.session import scratch_path, without_shuffles


def plain_tree(rows, g, h, x, depth):
    """Nested (feature, value, low, high) or a leaf weight, by trying every value of every feature."""
    total_g, total_h = sum(g[i] for i in rows), sum(h[i] for i in rows)
    score = lambda a, b: a * a / (b + 1)
    best = (softmax.LEAST_GAIN, None)
    for f in range(len(x[0]) if depth else 0):
        for value in sorted({x[i][f] for i in rows})[:-1]:
            low = [i for i in rows if x[i][f] <= value]
            gl, hl = sum(g[i] for i in low), sum(h[i] for i in low)
            if hl >= 1 and total_h - hl >= 1:
                gain = score(gl, hl) + score(total_g - gl, total_h - hl) - score(total_g, total_h)
                if gain > best[0] + 1e-9:
                    best = (gain, (f, value, low))
    if best[1] is None:
        return -total_g / (total_h + 1)
    f, value, low = best[1]
    high = [i for i in rows if i not in set(low)]
    return f, value, plain_tree(low, g, h, x, depth - 1), plain_tree(high, g, h, x, depth - 1)


def plain_value(tree, row):
    while isinstance(tree, tuple):
        tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
    return tree


def plain_boost(x, y, classes, depth, rate, rounds):
    margins = [[0.0] * classes for _ in x]
    for _ in range(rounds):
        p = []
        for m in margins:
            e = [math.exp(v) for v in m]
            p.append([v / sum(e) for v in e])
        for k in range(classes):
            g = [q[k] - (c == k) for q, c in zip(p, y)]
            h = [max(2 * q[k] * (1 - q[k]), 1e-16) for q in p]
            tree = plain_tree(list(range(len(x))), g, h, x, depth)
            for m, row in zip(margins, x):
                m[k] += rate * plain_value(tree, row)
    return np.array(margins)


@pytest.fixture(scope="module")
def coarse():
    """Few values a feature, so that bins are values and sums have one order of size."""
    rng = np.random.default_rng(4)
    x = rng.integers(-3, 4, (160, 4)).astype(float)
    y = ((x[:, 0] > 0).astype(int) + (x[:, 1] * x[:, 2] > 1)).astype(int)
    return x, y


@pytest.mark.parametrize("depth, rate", [(1, 1.0), (3, 0.3)])
def test_trees_against_a_plain_version(coarse, depth, rate):
    x, y = coarse
    model = softmax.train_local(x, y, 3, depth, rate, 3)
    want = plain_boost(x.tolist(), y.tolist(), 3, depth, rate, 3)
    assert model.margins(model.bins(x), 3) == pytest.approx(want, abs=1e-9)


def test_sums_by_spark_give_the_same_trees(spark, coarse, monkeypatch):
    monkeypatch.setattr(softmax, "_STORE_EVERY", 2)  # margins are stored on the way
    x, y = coarse
    coded = spark.createDataFrame(pd.DataFrame({"y": y, "x": list(x)})).repartition(4)
    edges = softmax.array_edges(coded, "x", 4)
    assert all((a == b).all() for a, b in zip(edges, softmax.local_edges(x)))
    far = softmax.train_spark(coded, edges, 3, 3, 0.5, 3)
    near = softmax.train_local(x, y, 3, 3, 0.5, 3)
    assert far.margins(far.bins(x), 3) == pytest.approx(near.margins(near.bins(x), 3), abs=1e-8)
    again = softmax.SoftmaxTrees.of_table(edges, far.table())
    assert (again.margins(again.bins(x), 3) == far.margins(far.bins(x), 3)).all()


def test_both_ways_through_the_library(spark, coarse, monkeypatch):
    x, y = coarse
    frame = spark.createDataFrame(pd.DataFrame({"id": range(len(y)), "cls": [f"c{v}" for v in y], **{f"m{i}": x[:, i] for i in range(4)}}))
    names = [f"m{i}" for i in range(4)]
    grid = boosting.parameter_grid(spark, 1, [2], [0.5])
    near = [tuple(r) for r in boosting.grid_search(frame, "cls", names, ["id"], grid, rounds=2).collect()]
    monkeypatch.setattr(boosting, "LOCAL_VALUES", 0)
    far = [tuple(r) for r in boosting.grid_search(frame, "cls", names, ["id"], grid, rounds=2).collect()]
    assert near == far


def test_odd_tables():
    one = softmax.train_local(np.ones((5, 2)), np.zeros(5, int), 1, 3, 0.5, 2)  # one class, constant features
    assert one.predict(np.ones((2, 2))).tolist() == [0, 0]
    none = softmax.train_local(np.zeros((0, 2)), np.zeros(0, int), 2, 3, 0.5, 2)
    assert none.predict(np.ones((1, 2))).tolist() == [0]
    ties = softmax.train_local(np.array([[1.0, 1.0]] * 20 + [[2.0, 2.0]] * 20), np.repeat([0, 1], 20), 2, 1, 1.0, 1)
    assert ties.rounds[0][0].feature[0] == 0  # equal features: the first


def test_unseen_values_follow_the_edges():
    x = np.arange(1000, dtype=float)[:, None]
    model = softmax.train_local(x, (x[:, 0] >= 500).astype(int), 2, 2, 1.0, 5)
    assert len(model.edges[0]) == 255
    assert model.predict(np.array([[-1e9], [1e9], [10.5], [900.5]])).tolist() == [0, 1, 0, 1]


def test_cells_add_up_in_the_order_of_the_table():
    """Each cell once for both gradients, over blocks of features and nodes of any size."""
    rng = np.random.default_rng(6)
    bins, node = rng.integers(0, 9, (70, 5)), rng.integers(0, 3, (2, 70)).astype(np.int32)
    slopes = rng.normal(size=(2, 70)) + 1j * rng.uniform(0.1, 1, (2, 70))
    wanted = [(1, 2), (0, 0), (1, 0)]
    for cells in (1, 40, 1 << 17):
        softmax._CELLS, before = cells, softmax._CELLS
        try:
            got = np.zeros((3, 5, 9), complex)
            for nodes, first, sums in softmax.Histograms(bins.T.astype(np.uint8), 9).blocks(node, slopes, wanted):
                got[nodes, first:first + sums.shape[1]] = sums.transpose(2, 1, 0)
        finally:
            softmax._CELLS = before
        for s, (k, i) in enumerate(wanted):
            for f in range(5):
                cell = [0j] * 9
                for r in np.flatnonzero(node[k] == i):
                    cell[bins[r, f]] += slopes[k, r]
                assert got[s, f].tolist() == cell


def test_a_level_is_one_job(spark, coarse):
    """Two levels a round: two jobs, besides those that make the blocks."""
    x, y = coarse
    coded = spark.createDataFrame(pd.DataFrame({"y": y, "x": list(x)}))
    edges = softmax.local_edges(x)
    rows, model = softmax.SparkRows(coded, edges, 3), softmax.SoftmaxTrees(edges)
    spark.sparkContext.setJobGroup("levels", "levels of two rounds")
    try:
        softmax.boost(rows, model, 2, 0.5, 2)
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("levels")
    finally:
        spark.sparkContext._jsc.clearJobGroup()
    assert 0 < len(jobs) <= 2 * 2 * 2  # adaptive execution runs the two stages of a level as a job each
    near = softmax.train_local(x, y, 3, 2, 0.5, 2)
    assert rows.close().margins(near.bins(x), 3) == pytest.approx(near.margins(near.bins(x), 3), abs=1e-8)


def test_many_nodes_go_by_parts(spark, coarse, monkeypatch):
    monkeypatch.setattr(softmax, "_NODES", 2)
    x, y = coarse
    coded = spark.createDataFrame(pd.DataFrame({"y": y, "x": list(x)})).repartition(3)
    near = softmax.train_local(x, y, 3, 3, 0.5, 2)
    far = softmax.train_spark(coded, near.edges, 3, 3, 0.5, 2)
    assert far.margins(near.bins(x), 3) == pytest.approx(near.margins(near.bins(x), 3), abs=1e-8)


def all_cuts(rows, growing):
    """Every feature of every node summed in double precision."""
    found = softmax.BestCuts(np.array([growing.sums[n] for n in growing.open]).T, softmax.Memory())
    node = np.zeros(rows.slopes.shape, np.int32)
    for (k, i), at in rows.rows.items():
        node[k, at] = i
    for block in softmax.Histograms(rows.columns, rows.width).blocks(node, rows.slopes, growing.open):
        found.add(*block)
    return {n: c for n, c in zip(growing.open, found.cuts()) if c}


@pytest.mark.parametrize("cells, kept, twins", [(1 << 17, 1 << 27, False), (1, 1 << 27, True), (1 << 12, 40_000, False), (1 << 17, 0, True)])
def test_few_features_are_summed_and_no_cut_differs(monkeypatch, cells, kept, twins):
    """Equal features, any number of nodes at a time, sums of parents kept or not: the cuts are those of all the sums."""
    monkeypatch.setattr(softmax, "_CELLS", cells)
    monkeypatch.setattr(softmax, "_KEPT", kept)
    rng = np.random.default_rng(8)
    x = rng.normal(size=(900, 12))
    x[:, 6:9] = x[:, :3] if twins else np.round(x[:, :3])
    x = np.concatenate([x, x[:300]]) if twins else x
    y = rng.integers(0, 4, len(x))
    model = softmax.SoftmaxTrees(softmax.local_edges(x))
    rows, compared = softmax.LocalRows(model.bins(x), y, 4), []
    best, exact = rows.best, rows._exact

    def checked(growing, last=False):
        want, got = all_cuts(rows, growing), best(growing, last)
        assert got == want
        compared.append(len(growing.open) * len(rows.columns))
        return got

    def counted(wanted, growing):
        summed.append(len(wanted))
        return exact(wanted, growing)

    summed = []
    monkeypatch.setattr(rows, "best", checked)
    monkeypatch.setattr(rows, "_exact", counted)
    softmax.boost(rows, model, 6, 0.5, 6)
    assert len(compared) == 36 and sum(compared) > 1000
    assert sum(summed) < sum(compared) / (3 if twins else 5)
    assert (rows.margins == model.margins(model.bins(x), 4)).all()  # of the rows it learned from, as predicted


def test_the_grid_is_a_few_tasks(spark):
    context = spark.sparkContext
    context.setJobGroup("grid", "rows of the grid")
    try:
        rows = [tuple(r) for r in boosting.parameter_grid(spark, 3, [2, 5], [0.1, 1.0]).collect()]
        tracker = context.statusTracker()
        stages = {s for j in tracker.getJobIdsForGroup("grid") for s in tracker.getJobInfo(j).stageIds}
        tasks = [i.numTasks for s in stages if (i := tracker.getStageInfo(s)) is not None]
    finally:
        context._jsc.clearJobGroup()
    assert rows == [(cv, depth, rate) for cv in range(3) for depth in (2, 5) for rate in (0.1, 1.0)]
    assert tasks and sum(tasks) <= 12


@pytest.mark.parametrize("little", [0.0, softmax._LITTLE])
def test_few_features_are_summed_in_a_large_table_too(monkeypatch, little):
    """Rounding moves sums by more there; nodes of any size have the cuts of all the sums."""
    monkeypatch.setattr(softmax, "_LITTLE", little)
    rng = np.random.default_rng(9)
    x = rng.normal(size=(60_000, 12))
    x[:, 8:] = np.round(x[:, :4])
    y = rng.integers(0, 3, len(x))
    model = softmax.SoftmaxTrees(softmax.local_edges(x))
    rows, compared, summed = softmax.LocalRows(model.bins(x), y, 3), [], []
    best, exact = rows.best, rows._exact

    def checked(growing, last=False):
        want, got = all_cuts(rows, growing), best(growing, last)
        assert got == want
        compared.append(sum(len(rows.rows[n]) for n in growing.open) * len(rows.columns))
        return got

    def counted(wanted, growing):
        summed.append(sum(len(rows.rows[n]) for n, _ in wanted))
        return exact(wanted, growing)

    monkeypatch.setattr(rows, "best", checked)
    monkeypatch.setattr(rows, "_exact", counted)
    softmax.boost(rows, model, 4, 0.5, 2)
    assert len(compared) == 8 and sum(summed) < sum(compared) / 5
    assert min(len(r) for r in rows.rows.values()) < softmax._LARGE
    assert (rows.margins == model.margins(model.bins(x), 3)).all()


def test_a_hundred_thousand_vectors_are_a_task_for_each_model():
    """Beyond, a level of each of the 60 models is a shuffle. What a task holds grows by 10 bytes a value."""
    assert boosting.fits_in_memory(102_564, 64)
    bins = np.random.default_rng(2).integers(0, 256, (20_000, 8)).astype(np.uint8)
    rows = softmax.LocalRows(bins, np.zeros(len(bins), int), 2)
    held = [v for v in vars(rows).values() if isinstance(v, np.ndarray) and v.size >= bins.size]
    assert len(held) == 2 and sum(v.nbytes for v in held) <= 10 * bins.size


def test_levels_leave_no_shuffles(spark, coarse):
    """Four rounds of three levels; the one shuffle that may stay deals out the rows."""
    x, y = coarse
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    coded = spark.createDataFrame(pd.DataFrame({"y": y, "x": list(x)})).repartition(3)

    def shuffles():
        return {m[1] for m in re.finditer(r"shuffle_(\d+)_\d+_\d+\.data", disk.getAllFiles().toString())}

    near, before = softmax.train_local(x, y, 3, 3, 0.5, 4), shuffles()
    far = softmax.train_spark(coded, near.edges, 3, 3, 0.5, 4)
    assert len(shuffles() - before) <= 2
    assert far.margins(near.bins(x), 3) == pytest.approx(near.margins(near.bins(x), 3), abs=1e-8)
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_settings_of_the_session_hold_without_shuffles(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "5")
    try:
        tidy = without_shuffles(spark)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert tidy.conf.get("spark.sql.shuffle.partitions") == "5"
    assert tidy.conf.get("spark.sql.session.timeZone") == spark.conf.get("spark.sql.session.timeZone")
    assert scratch_path(tidy, "a").rpartition("/")[0] == scratch_path(spark, "a").rpartition("/")[0]


def test_equal_features_do_not_sum_all_rows_at_once(monkeypatch):
    """All features tie, so each is summed in double precision; few rows at a time, and the cuts stay."""
    monkeypatch.setattr(softmax, "_EXACT_ROWS", 700)
    rng = np.random.default_rng(3)
    x = np.repeat(rng.normal(size=(500, 1)), 20, axis=1)
    rows = softmax.LocalRows(softmax.SoftmaxTrees(softmax.local_edges(x)).bins(x), rng.integers(0, 2, 500), 2)
    growing, most, concatenate = softmax.Growing(rows.begin()), [], np.concatenate

    def joined(parts, *args, **kwargs):
        most.append(sum(map(len, parts)))
        return concatenate(parts, *args, **kwargs)

    monkeypatch.setattr(softmax.np, "concatenate", joined)
    assert rows.best(growing) == all_cuts(rows, growing)
    assert sum(most) >= 20 * 2 * 500 and max(most) <= 700 + 500
