"""Sampling and folds against window functions on whole groups, with a hot group."""

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cytospark.operators import ranking, split


@pytest.fixture(scope="module")
def skewed(spark):
    """One class holds two thirds of the rows; one has 4, one has 1."""
    cls = (
        F.when(F.col("id") % 3 != 0, "hot").when(F.col("id") < 9, "tiny")
        .when(F.col("id") == 9, "single").otherwise(F.concat(F.lit("c"), (F.col("id") % 7).cast("string")))
    )
    return spark.range(30_000).select("id", cls.alias("cls"), (F.col("id") % 2).alias("batch"))


def ranked(df, groups, seed):
    part = W.partitionBy(*groups) if groups else W.partitionBy(F.lit(1))
    return df.select(
        "*", F.row_number().over(part.orderBy(ranking.order_hash(["id"], seed))).alias("rn"),
        F.count(F.lit(1)).over(part).alias("n"))


def ids(df):
    return {r["id"] for r in df.select("id").collect()}


def test_stratified_sample_takes_the_first_of_every_group(skewed):
    got = ids(ranking.stratified_sample(skewed, ["batch", "cls"], ["id"], 0.1, 3))
    want = ids(ranked(skewed, ["batch", "cls"], 42).filter("n >= 3 and rn <= bround(n * 0.1, 0)"))
    assert got == want


def test_half_even_rounding_of_the_share(spark):
    df = spark.range(25).select("id", F.lit("a").alias("g"))
    assert ranking.stratified_sample(df, ["g"], ["id"], 0.1).count() == 2  # 2.5 -> 2
    df = spark.range(35).select("id", F.lit("a").alias("g"))
    assert ranking.stratified_sample(df, ["g"], ["id"], 0.1).count() == 4  # 3.5 -> 4


def test_groups_below_the_minimum_give_nothing(spark):
    df = spark.range(19).select("id", F.lit("a").alias("g"))
    assert ranking.stratified_sample(df, ["g"], ["id"], 0.5, min_count=20).count() == 0


@pytest.mark.parametrize("groups", [[], ["cls"]])
def test_folds_are_contiguous_blocks_of_the_order(skewed, groups):
    got = ranking.fold_ids(skewed, groups, ["id"], 10)
    sizes = got.groupBy(*groups, "fold").count()
    spread = sizes.groupBy(*groups).agg((F.max("count") - F.min("count")).alias("d"), F.count(F.lit(1)).alias("k"))
    for r in spread.collect():
        assert r["d"] <= 1
        assert r["k"] == 10 or r["cls"] in ("tiny", "single")
    joined = ranked(skewed, groups, 7).join(got.select("id", "fold"), "id")
    order = W.partitionBy(*groups) if groups else W.partitionBy(F.lit(1))
    falls = joined.withColumn("prev", F.lag("fold").over(order.orderBy("rn"))).filter("prev > fold")
    assert falls.count() == 0


def test_repeats_differ_and_each_covers_all_rows(skewed):
    out = ranking.repeated_folds(skewed, ["cls"], ["id"], 2, 3)
    assert out.groupBy("repeat").count().filter(f"count <> {30_000}").count() == 0
    same = out.filter("repeat = 0").alias("a").join(out.filter("repeat = 1").alias("b"), "id").filter("a.fold = b.fold")
    assert 0.4 < same.count() / 30_000 < 0.6


def test_class_caps_equal_a_window_over_all_pairs(skewed):
    got = ranking.class_caps(skewed, "cls", ["id"], limit=50, min_labels=5)
    names = [r["cls"] for r in skewed.groupBy("cls").count().filter("count >= 5").collect()]
    pairs = skewed.withColumn("celltype", F.explode(F.array(*[F.lit(n) for n in names]))).withColumn(
        "target", (F.col("cls") == F.col("celltype")).cast("int"))
    want = pairs.withColumn("rn", F.row_number().over(
        W.partitionBy("celltype", "target").orderBy(ranking.order_hash(["id"], 42)))).filter("rn <= 50")
    key = ["celltype", "target", "id"]
    assert set(map(tuple, got.select(key).collect())) == set(map(tuple, want.select(key).collect()))


def test_caps_of_classes_below_the_minimum_are_left_out(skewed):
    got = ranking.class_caps(skewed, "cls", ["id"], limit=10, min_labels=4)
    assert {"tiny", "single"} & {r["celltype"] for r in got.select("celltype").distinct().collect()} == set()


def test_preview_sample_sizes(spark):
    def size(n):
        return ranking.sample_groups(spark.range(n), [], ["id"], ranking.preview_quota()).count()

    assert size(1000) == 1000
    assert size(1001) == 100
    assert size(20_000) == 1000


def test_holdout_and_training_are_disjoint_and_cover_the_kept_classes(skewed):
    tagged = split.holdout_split(skewed, "cls", "batch", ["id"], 0.1, 20)
    assert tagged.count() == skewed.count()
    per_class = {r["cls"]: r for r in tagged.groupBy("cls").agg(
        F.count_if(F.col("split") == "holdout").alias("h"), F.count_if(F.col("split") == "training").alias("t"),
        F.count_if(F.col("split") == "unused").alias("u")).collect()}
    for name, r in per_class.items():
        if name in ("tiny", "single"):
            assert r["h"] == 0 and r["t"] == 0
        else:
            assert r["h"] > 0 and r["t"] > 0 and r["u"] == 0


def test_applying_cutoffs_does_not_shuffle_the_rows(skewed):
    plan = ranking.stratified_sample(skewed, ["cls"], ["id"], 0.1)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    assert "hashpartitioning" not in plan and "SortMergeJoin" not in plan


def test_large_summaries_take_the_shuffle_path(skewed, monkeypatch, spark, tmp_path):
    from cytospark.operators import sizing

    want = ids(ranking.stratified_sample(skewed, ["batch", "cls"], ["id"], 0.1))
    monkeypatch.setattr(sizing.small_or_none, "__defaults__", (3, sizing.MAX_BROADCAST_BYTES))
    monkeypatch.setattr(sizing.join_summary, "__defaults__", ("inner", 3))
    monkeypatch.setattr(sizing.settle, "__defaults__", (3,))
    assert ids(ranking.stratified_sample(skewed, ["batch", "cls"], ["id"], 0.1)) == want


def test_annotation_cleaning(spark):
    rows = [(" T cell ",), ("Ignore*",), ("Ignored",), ("",), ("  ",), (None,), ("??",), ("0",), ("B cell",)]
    df = spark.createDataFrame(rows, "label string")
    kept = sorted(r["label"] for r in split.annotated(df, "label").collect())
    assert kept == ["B cell", "Ignored", "T cell"]


def test_class_table_keeps_classes_without_holdout(skewed):
    table = split.class_table(split.holdout_split(skewed, "cls", "batch", ["id"], 0.1, 20), "cls")
    rows = {r["cls"]: r for r in table.collect()}
    assert rows["single"]["holdout"] is None and rows["single"]["counts"] == 1
    assert "single" not in {r["cls"] for r in split.kept_classes(table, "cls").collect()}
    assert abs(sum(r["percent"] for r in rows.values()) - 100) < 0.1


def test_bounded_variants_give_the_same_split(skewed):
    def same(a, b, *names):
        key = ["id", *names]
        assert sorted(map(tuple, a.select(key).collect())) == sorted(map(tuple, b.select(key).collect()))

    same(ranking.train_test(skewed, ["cls"], ["id"]), ranking.bounded_train_test(skewed, ["cls"], ["id"]), "is_test")
    same(ranking.fold_ids(skewed, ["cls"], ["id"], 10), ranking.bounded_folds(skewed, ["cls"], ["id"], 10), "fold")
    same(ranking.repeated_folds(skewed, ["cls"], ["id"]), ranking.bounded_repeats(skewed, ["cls"], ["id"]), "repeat", "fold")


def test_a_null_group_is_a_group(spark):
    df = spark.range(200).select("id", F.when(F.col("id") % 2 == 0, "a").alias("g"))
    assert ranking.fold_ids(df, ["g"], ["id"], 4).groupBy("g", "fold").count().filter("count <> 25").count() == 0
    got = ranking.stratified_sample(df, ["g"], ["id"], 0.1).groupBy("g").count().collect()
    assert sorted(r["count"] for r in got) == [10, 10]


@pytest.mark.parametrize("digits, leaf", [(3, 16_384), (1, 40), (5, 1)])
def test_cutoffs_follow_the_trie(spark, digits, leaf):
    """Groups of any size, a null one, and many rows of one hash: the k-th smallest hash whatever the shape of the trie."""
    rows = spark.range(30_000).select(
        F.when(F.col("id") % 10 < 7, "hot").when(F.col("id") % 10 == 8, "same").when(F.col("id") < 50, "few").alias("g"),
        F.when(F.col("id") % 10 == 8, 1).otherwise(F.col("id")).alias("k"))
    quotas = [lambda n: F.lit(0), lambda n: F.lit(1), lambda n: F.floor(n / 3), lambda n: n]
    got = {r["g"]: r for r in ranking.cutoffs(rows, ["g"], ["k"], quotas, 42, digits, leaf).collect()}
    hashes = {}
    for g, h in rows.select("g", ranking.order_hash(["k"], 42)).collect():
        hashes.setdefault(g, []).append(h)
    assert set(got) == set(hashes)
    for g, mine in hashes.items():
        mine.sort()
        n = len(mine)
        assert got[g]["n"] == n
        assert got[g]["cutoffs"] == ["", mine[0], mine[n // 3 - 1] if n >= 3 else "", mine[-1]]


def test_one_group_of_ten_million_rows(spark):
    """No ordered prefix is large: the most that a task orders is a leaf."""
    rows = spark.range(10_000_000, numPartitions=8)
    quotas = [lambda n: F.floor(n / 10), lambda n: F.lit(5_000_000)]
    cut = ranking.cutoffs(rows, [], ["id"], quotas).first()
    assert cut["n"] == 10_000_000
    hashed = rows.select(ranking.order_hash(["id"]).alias("h"))
    got = hashed.agg(*[F.count_if(F.col("h") <= c) for c in cut["cutoffs"]],
                     *[F.count_if(F.substring("h", 1, ranking.PREFIX_DIGITS) == c[:ranking.PREFIX_DIGITS]) for c in cut["cutoffs"]]).first()
    assert tuple(got)[:2] == (1_000_000, 5_000_000)
    assert max(tuple(got)[2:]) <= ranking.LEAF_ROWS
