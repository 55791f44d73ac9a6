"""Boosted models, components, neighbours and clusters."""

from pyspark.sql import functions as F

from cytospark.functions.names import col, melt
from cytospark.operators import boosting, embed, evaluate, quantiles
from cytospark.operators.abundance import PREDICTION
from cytospark.operators.split import holdout_split
from cytospark.plans.catalog import query
from cytospark.plans.tables import CELLS, LONG, MEANS, cells, embedded, round_columns, rounded, table
from cytospark.session import scratch_path

GRID = """g AS (SELECT CAST(l_suppkey % 5 AS INTEGER) AS cv, l_linenumber AS max_depth, CASE WHEN l_linestatus = 'F' THEN 0.1 ELSE 1.0 END AS eta,
  round(avg(l_discount) * 10, 9) AS tr, round(avg(l_tax) * 10, 9) AS te FROM lineitem GROUP BY ALL)"""


def grid_rows(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").groupBy(
        (F.col("l_suppkey") % 5).cast("int").alias("cv"), F.col("l_linenumber").alias("max_depth"),
        F.when(F.col("l_linestatus") == "F", 0.1).otherwise(1.0).alias("eta"),
    ).agg(F.round(F.avg("l_discount") * 10, 9).alias("train_accuracy"), F.round(F.avg("l_tax") * 10, 9).alias("testf"))


@query("grid_summary", f"""WITH {GRID} SELECT CAST(max_depth AS BIGINT) AS max_depth, CAST(eta AS DOUBLE) AS eta, count(DISTINCT cv) AS cv, round(avg(tr), 6) AS training_mean, round(stddev_samp(tr), 6) AS training_std,
round(avg(te), 6) AS test_mean, round(stddev_samp(te), 6) AS test_std FROM g GROUP BY ALL""")
def grid_summary(spark, sf_dir):
    return round_columns(boosting.grid_summary(grid_rows(spark, sf_dir)))


@query("grid_table", f"""WITH {GRID} SELECT CAST(cv AS BIGINT) AS cv, CAST(max_depth AS BIGINT) AS max_depth, CAST(eta AS DOUBLE) AS eta,
printf('%.2f%%', tr * 100.0) AS "Training", printf('%.2f%%', te * 100.0) AS "Test", round(te, 6) AS testf FROM g""")
def grid_table(spark, sf_dir):
    return round_columns(boosting.grid_table(grid_rows(spark, sf_dir)))


@query("combination_marks", f"""WITH {GRID}, m AS (SELECT max_depth, eta, avg(te) AS a FROM g GROUP BY ALL),
r AS (SELECT *, row_number() OVER (ORDER BY a DESC, max_depth, eta) AS k FROM m)
SELECT 'max_depth=' || max_depth || ', eta=' || CAST(CAST(eta AS DOUBLE) AS VARCHAR) AS combination, round(a, 6) AS mean_accuracy,
CASE k WHEN 1 THEN 'best' WHEN 2 THEN 'second' ELSE 'other' END AS mark FROM r""")
def combination_marks(spark, sf_dir):
    return round_columns(boosting.combination_marks(grid_rows(spark, sf_dir)))


@query("top_two_parameters", f"""WITH {GRID} SELECT CAST(max_depth AS BIGINT) AS max_depth, CAST(eta AS DOUBLE) AS eta, round(avg(te), 6) AS test_mean
FROM g GROUP BY ALL ORDER BY avg(te) DESC, max_depth, eta LIMIT 2""")
def top_two_parameters(spark, sf_dir):
    best = boosting.top_two(boosting.grid_summary(grid_rows(spark, sf_dir)))
    return round_columns(best.select("max_depth", "eta", "test_mean"))


@query("accuracy_boxes", f"""WITH {GRID}, q AS (SELECT max_depth AS qd, count(*) AS n, quantile_cont(te, 0.25) AS q1, quantile_cont(te, 0.5) AS median, quantile_cont(te, 0.75) AS q3 FROM g GROUP BY max_depth)
SELECT CAST(max_depth AS BIGINT) AS max_depth, any_value(n) AS n, round(any_value(q1), 6) AS q1, round(any_value(median), 6) AS median, round(any_value(q3), 6) AS q3,
 round(min(te) FILTER (te BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)), 6) AS whisker_low,
 round(max(te) FILTER (te BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)), 6) AS whisker_high FROM g JOIN q ON qd = max_depth GROUP BY max_depth""")
def accuracy_boxes(spark, sf_dir):
    return round_columns(quantiles.box_statistics(grid_rows(spark, sf_dir), "testf", ["max_depth"]))


def vector_split(spark, sf_dir):
    """The vectors as cells, a holdout set aside, and their measures."""
    wide, names = embedded(spark, sf_dir)
    return holdout_split(wide, "Classification", "Batch", ["vec_id"], 0.1, 5), names


def full_grid(spark, tagged, names):
    """All repeats, depths and rates on the training rows."""
    return boosting.grid_search(tagged.filter("split = 'training'"), "Classification", names, ["vec_id"], boosting.parameter_grid(spark))


@query("boosted_grid")
def boosted_grid(spark, sf_dir):
    return round_columns(full_grid(spark, *vector_split(spark, sf_dir)))


@query("winner_performance")
def winner_performance(spark, sf_dir):
    """The two best settings of the whole grid, fitted on all training rows and compared on the holdout."""
    tagged, names = vector_split(spark, sf_dir)
    best = boosting.top_two(boosting.grid_summary(full_grid(spark, tagged, names)))
    models = boosting.train_winners(tagged.filter("split = 'training'"), "Classification", names, best)
    return round_columns(boosting.evaluate_models(models, tagged.filter("split = 'holdout'"), "Classification"))


@query("boosted_predictions")
def boosted_predictions(spark, sf_dir):
    """Train, store, load, predict every vector, compare classes."""
    wide, _ = embedded(spark, sf_dir)
    tagged, names = vector_split(spark, sf_dir)
    model = boosting.fit_model(tagged.filter("split = 'training'"), "Classification", names, 2, 0.1)
    path = scratch_path(spark, "boosted")
    model.save(path)
    scored = boosting.CellModel.load(path).score(wide)
    return round_columns(evaluate.class_scores(evaluate.confusion(scored, "Classification", PREDICTION)))


@query("boosted_first_round", """WITH v AS (SELECT vec_id, label, round(16 * CAST(unnest(embedding) AS DOUBLE)) AS x, unnest(range(64)) AS f FROM embeddings),
c AS (SELECT DISTINCT label AS k FROM embeddings), n AS (SELECT count(*) AS n, count(DISTINCT label) AS nk FROM embeddings),
own AS (SELECT label AS k, count(*) AS nk FROM embeddings GROUP BY label),
tot AS (SELECT f, x, count(*) AS m FROM v GROUP BY f, x), tot_class AS (SELECT f, x, label AS k, count(*) AS m FROM v GROUP BY ALL),
upto AS (SELECT f, x, k, sum(tot.m) OVER w AS ml, coalesce(sum(tot_class.m) OVER w, 0) AS kl FROM tot CROSS JOIN c LEFT JOIN tot_class USING (f, x, k) WINDOW w AS (PARTITION BY f, k ORDER BY x)),
sums AS (SELECT k, f, x, ml, kl, n.n, own.nk, ml / n.nk - kl AS gl, n.n / n.nk - own.nk AS g, 2 / n.nk * (1 - 1 / n.nk) * ml AS hl, 2 / n.nk * (1 - 1 / n.nk) * n.n AS h FROM upto JOIN own USING (k), n WHERE ml < n.n),
gains AS (SELECT *, gl * gl / (hl + 1) + (g - gl) * (g - gl) / (h - hl + 1) - g * g / (h + 1) AS gain, -gl / (hl + 1) AS wl, -(g - gl) / (h - hl + 1) AS wr FROM sums WHERE hl >= 1 AND h - hl >= 1)
SELECT 'type_' || k AS "class", round(max(gain), 6) AS gain, round(max_by(least(wl, wr), gain), 6) AS low, round(max_by(greatest(wl, wr), gain), 6) AS high FROM gains GROUP BY k""")
def boosted_first_round(spark, sf_dir):
    """The first cut of every class on rounded vectors: gain, from the rows on both sides of it, and the two weights."""
    wide, names = embedded(spark, sf_dir)
    coarse = wide.select("Classification", *[F.round(col(n) * 16).alias(n) for n in names])
    model = boosting.fit_model(coarse, "Classification", names, 1, 1.0, 1)
    nodes = spark.createDataFrame(model.trees.table())
    cuts = nodes.filter("node = 0").select(F.element_at(F.array(*map(F.lit, names)), F.col("feature") + 1).alias("column"), "threshold", "class")
    weights = nodes.filter("node > 0").groupBy("class").agg(F.min("weight").alias("low"), F.max("weight").alias("high"))
    of_class = F.element_at(F.array(*map(F.lit, model.labels)), F.col("class") + 1)
    long = melt(coarse, names, ["Classification"]).join(F.broadcast(cuts), "column")  # a row a class
    n, k = F.count(F.lit(1)), F.count_if(F.col("Classification") == of_class)
    left, share = F.col("value") <= F.col("threshold"), 1 / len(model.labels)
    counts = long.groupBy("class").agg(n.alias("n"), k.alias("k"), F.count_if(left).alias("ml"), F.count_if(left & (F.col("Classification") == of_class)).alias("kl"))
    g, gl = share * F.col("n") - F.col("k"), share * F.col("ml") - F.col("kl")
    h, hl = 2 * share * (1 - share) * F.col("n"), 2 * share * (1 - share) * F.col("ml")
    gain = gl * gl / (hl + 1) + (g - gl) * (g - gl) / (h - hl + 1) - g * g / (h + 1)
    return round_columns(counts.join(weights, "class").select(of_class.alias("class"), gain.alias("gain"), "low", "high"))


@query("forest_predictions")
def forest_predictions(spark, sf_dir):
    wide, names = embedded(spark, sf_dir)
    model = boosting.fit_model(wide, "Classification", names, 5, 1.0, 10, kind="rf")
    return model.score(wide).select("vec_id", "Classification", PREDICTION)


@query("explained_variance")
def explained_variance(spark, sf_dir):
    """Variance shares of the standardised measures with their running sum."""
    c = cells(spark, sf_dir)
    _, explained = embed.standard_components(c, [*MEANS, "p_size"], ["l_orderkey"])
    rows = spark.createDataFrame(list(enumerate(explained)), "component int, explained double")
    return round_columns(embed.running_variance(rows))


@query("running_variance", """WITH n AS (SELECT l_linenumber AS component, count(*) / (SELECT count(*) FROM lineitem) AS explained FROM lineitem GROUP BY l_linenumber)
SELECT CAST(component AS BIGINT) AS component, round(explained, 6) AS explained, round(sum(explained) OVER (ORDER BY component), 6) AS running,
  sum(explained) OVER (ORDER BY component) >= 0.9 AS reached FROM n""")
def running_variance(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    total = li.agg(F.count(F.lit(1)).alias("t"))
    shares = li.groupBy(F.col("l_linenumber").alias("component")).agg(F.count(F.lit(1)).alias("n")).crossJoin(
        F.broadcast(total)).select("component", (F.col("n") / F.col("t")).alias("explained"))
    return round_columns(embed.running_variance(shares))


@query("two_component_variance", f"""WITH {CELLS}, c AS (SELECT corr(m1, m2) AS r FROM cells)
SELECT CAST(0 AS BIGINT) AS component, round((1 + abs(r)) / 2, 6) AS explained FROM c UNION ALL SELECT 1, round((1 - abs(r)) / 2, 6) FROM c""")
def two_component_variance(spark, sf_dir):
    """Of two standardised columns the components explain (1 +- |correlation|) / 2."""
    _, explained = embed.standard_components(cells(spark, sf_dir), MEANS[:2], ["l_orderkey"])
    return round_columns(spark.createDataFrame(list(enumerate(explained)), "component int, explained double"))


def vector_components(spark, sf_dir):
    wide, names = embedded(spark, sf_dir)
    out, _ = embed.standard_components(wide, names, ["vec_id"], k=embed.GRAPH_COMPONENTS)
    return out, wide, names


@query("nearest_neighbours")
def nearest_neighbours(spark, sf_dir):
    out, _, _ = vector_components(spark, sf_dir)
    return round_columns(embed.nearest_neighbours(out, "vec_id", k=30), 4)


@query("cell_clusters")
def cell_clusters(spark, sf_dir):
    """Graph clusters of the vectors and the scaled mean of each dimension."""
    out, wide, names = vector_components(spark, sf_dir)
    clusters = embed.cluster_cells(out, "vec_id", 5, k=30)
    return round_columns(embed.cluster_matrix(wide.join(clusters, "vec_id"), "cluster", names), 4)


@query("cluster_matrix", f"""WITH {CELLS}, {LONG}, m AS (SELECT slide, col, avg(v) AS m FROM long GROUP BY slide, col),
w AS (SELECT *, min(m) OVER (PARTITION BY col) AS lo, max(m) OVER (PARTITION BY col) AS hi FROM m)
SELECT slide AS "Slide", col AS "column", round(m, 4) AS mean, round(CASE WHEN hi > lo THEN (m - lo) / (hi - lo) ELSE 0 END + 0.0, 4) AS scaled FROM w""")
def cluster_matrix(spark, sf_dir):
    return round_columns(embed.cluster_matrix(cells(spark, sf_dir, classes=False), "Slide", MEANS), 4)


@query("vector_means", " UNION ALL ".join(
    f"""SELECT 'M{i:02d}: Mean' AS "column", round(avg(embedding[{i + 1}]), 6) AS mean FROM embeddings""" for i in range(64)))
def vector_means(spark, sf_dir):
    wide, names = embedded(spark, sf_dir)
    return melt(wide, names).groupBy("column").agg(rounded(F.avg("value")).alias("mean"))
