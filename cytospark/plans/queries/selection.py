"""Penalty search, elimination and ranked features."""


from pyspark.sql import functions as F

from cytospark.functions import scalars as S
from cytospark.operators import lasso
from cytospark.plans.catalog import query
from cytospark.plans.tables import CELLS, KEYS, LONG, MEANS, cells, embedded, round_columns, rounded, table

# Score rows from line items: slide as class, line number as feature count,
# one score per (slide, line number, batch, ship year parity).
SCORES = """sc AS (SELECT l_returnflag AS celltype, l_linenumber AS n_features, l_linestatus, l_suppkey % 3 AS part,
  round(avg(l_discount), 9) AS rfe_score FROM lineitem GROUP BY ALL)"""


def scores(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").groupBy(
        F.col("l_returnflag").alias("celltype"), F.col("l_linenumber").alias("n_features"),
        "l_linestatus", (F.col("l_suppkey") % 3).alias("part"),
    ).agg(F.round(F.avg("l_discount"), 9).alias("rfe_score"))


ALPHAS = """al AS (SELECT l_returnflag AS celltype, l_linenumber / 10.0 AS alpha, round(-avg(l_discount), 9) AS m, round(stddev_samp(l_discount), 9) AS s
  FROM lineitem GROUP BY l_returnflag, l_linenumber)"""


def alpha_rows(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").groupBy(
        F.col("l_returnflag").alias("celltype"), (F.col("l_linenumber") / 10).alias("alpha"),
    ).agg(F.round(-F.avg("l_discount"), 9).alias("mean_test_score"),
          F.round(F.stddev_samp("l_discount"), 9).alias("std_test_score"))


IMPORTANCE = """im AS (SELECT p_type AS celltype, p_brand AS feature, round(avg(l_tax), 9) AS importance FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL),
rk AS (SELECT *, row_number() OVER (PARTITION BY celltype ORDER BY importance DESC, feature) AS rank FROM im)"""


def importance_rows(spark, sf_dir):
    rows = cells(spark, sf_dir).groupBy(F.col("Classification").alias("celltype"), F.col("p_brand").alias("feature")).agg(
        F.round(F.avg("`Tax: Mean`"), 9).alias("importance"))
    return rows.withColumn("position", F.col("feature"))


@query("penalty_grid", f"""WITH {CELLS} SELECT class AS celltype, i AS step,
round(exp(-5.1 + i * (ln(10) * 5.0996 / 95)) + 0.0, 6) AS alpha FROM (SELECT DISTINCT class FROM cells), (SELECT unnest(range(96)) AS i)""")
def penalty_grid(spark, sf_dir):
    """Every class with every penalty of the search."""
    classes = cells(spark, sf_dir).select(F.col("Classification").alias("celltype")).distinct()
    return round_columns(classes.select("celltype", F.posexplode(S.alpha_grid_column()).alias("step", "alpha")))


@query("best_penalties", f"""WITH {ALPHAS} SELECT celltype, round(arg_max(alpha, m), 6) AS best_alpha, round(max(m) + 0.0, 6) AS best_score FROM al GROUP BY celltype""")
def best_penalties(spark, sf_dir):
    return round_columns(lasso.best_alphas(alpha_rows(spark, sf_dir)))


@query("ranked_penalties", f"""WITH {ALPHAS} SELECT celltype, round(alpha, 6) AS alpha, round(m + 0.0, 6) AS mean_test_score, round(s + 0.0, 6) AS std_test_score FROM al""")
def ranked_penalties(spark, sf_dir):
    return round_columns(lasso.ranked_alphas(alpha_rows(spark, sf_dir)))


@query("penalty_curve", f"""WITH {ALPHAS}, b AS (SELECT celltype AS bc, arg_max(alpha, m) AS ba, max(m) AS bs FROM al GROUP BY celltype)
SELECT celltype, round(alpha, 6) AS alpha, round(m + 0.0, 6) AS mean_test_score, round(m + s / sqrt(10) + 0.0, 6) AS upper, round(m - s / sqrt(10) + 0.0, 6) AS lower,
round(ba, 6) AS best_alpha, round(bs + 0.0, 6) AS best_score FROM al JOIN b ON bc = celltype""")
def penalty_curve(spark, sf_dir):
    return round_columns(lasso.alpha_curve(alpha_rows(spark, sf_dir)))


@query("ranked_eliminations", f"""WITH {SCORES} SELECT celltype, CAST(n_features AS BIGINT) AS n_features, round(rfe_score + 0.0, 6) AS rfe_score,
CAST(row_number() OVER (PARTITION BY celltype ORDER BY rfe_score DESC, n_features) AS BIGINT) AS rank FROM sc""")
def ranked_eliminations(spark, sf_dir):
    ranked = lasso.ranked_rfe(scores(spark, sf_dir)).select("celltype", F.col("n_features").cast("bigint").alias("n_features"), "rfe_score", F.col("rank").cast("bigint").alias("rank"))
    return round_columns(ranked)


@query("elimination_summary", f"""WITH {SCORES} SELECT celltype, CAST(n_features AS BIGINT) AS n_features, round(avg(rfe_score), 6) AS mean_score,
round(stddev_samp(rfe_score), 6) AS std_score, round(median(rfe_score), 6) AS median_score FROM sc GROUP BY celltype, n_features""")
def elimination_summary(spark, sf_dir):
    return round_columns(lasso.rfe_summary(scores(spark, sf_dir)))


@query("optimal_feature_counts", f"""WITH {SCORES}, g AS (SELECT celltype AS gc, median(rfe_score) - stddev_samp(rfe_score) / 8 AS f FROM sc GROUP BY celltype),
m AS (SELECT celltype, n_features, median(rfe_score) AS md FROM sc GROUP BY celltype, n_features)
SELECT celltype, CAST(min(n_features) AS BIGINT) AS optimal_n FROM m JOIN g ON gc = celltype WHERE md >= f GROUP BY celltype""")
def optimal_feature_counts(spark, sf_dir):
    return round_columns(lasso.optimal_counts(scores(spark, sf_dir)))


@query("importance_levels", f"""WITH {IMPORTANCE}, t AS (SELECT * FROM rk WHERE rank <= 35),
q AS (SELECT celltype AS qc, quantile_cont(importance, 0.25) AS p25, quantile_cont(importance, 0.5) AS p50, quantile_cont(importance, 0.75) AS p75, avg(importance) AS mi, stddev_samp(importance) AS si FROM t GROUP BY celltype)
SELECT celltype, feature, round(importance, 6) AS importance, rank, round(p25, 6) AS p25, round(p50, 6) AS p50, round(p75, 6) AS p75,
 round(mi, 6) AS mean_importance, round(si, 6) AS std_importance,
 CASE WHEN importance >= p75 THEN 'High' WHEN importance >= p50 THEN 'Med-High' WHEN importance >= p25 THEN 'Med-Low' ELSE 'Low' END AS level
FROM t JOIN q ON qc = celltype""")
def importance_levels(spark, sf_dir):
    return round_columns(lasso.importance_levels(importance_rows(spark, sf_dir), 35))


TOP = f"""{IMPORTANCE}, o AS (SELECT p_type AS oc, 2 + count(*) % 3 AS k FROM part GROUP BY p_type),
tf AS (SELECT celltype, feature, importance, rank FROM rk JOIN o ON oc = celltype WHERE rank <= k)"""


def tops(spark, sf_dir):
    optimal = table(spark, sf_dir, "part").groupBy(F.col("p_type").alias("celltype")).agg(
        (2 + F.count(F.lit(1)) % 3).alias("optimal_n"))
    return lasso.top_features(importance_rows(spark, sf_dir), optimal)


@query("top_features", f"WITH {TOP} SELECT celltype, feature, round(importance, 6) AS importance, rank FROM tf")
def top_features(spark, sf_dir):
    return round_columns(tops(spark, sf_dir))


@query("selected_features", f"WITH {TOP} SELECT DISTINCT feature FROM tf")
def selected_features(spark, sf_dir):
    return lasso.selected_features(tops(spark, sf_dir))


@query("variance_summary", f"""WITH {CELLS}, {LONG}, v AS (SELECT batch, col, var_pop(v) AS s FROM long GROUP BY batch, col)
SELECT batch AS "Batch", count(*) AS original_features, count(*) FILTER (s <= 0.01) AS non_variant_removed,
       count(*) FILTER (s > 0.01) AS features_after_variance_filter FROM v GROUP BY batch""")
def variance_summary(spark, sf_dir):
    variances = lasso.column_variances(cells(spark, sf_dir, classes=False), MEANS, ["Batch"])
    return lasso.variance_summary(variances, ["Batch"])


def hash_sql(seed):
    return f"md5(concat_ws('|', '{seed}', l_orderkey, l_linenumber, l_partkey, l_suppkey))"


def tagged_targets():
    return f"""k AS (SELECT class AS celltype FROM cells GROUP BY class HAVING count(*) >= 20),
p AS (SELECT celltype, CASE WHEN class = celltype THEN 1 ELSE 0 END AS target, m1, m2, m3, m4, {hash_sql(42)} AS h,
      {hash_sql(101)} AS h101, {hash_sql(7)} AS h7 FROM cells, k),
c AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY celltype, target ORDER BY h) AS rn FROM p) WHERE rn <= 3000)"""


# With one feature the solution is closed: w = soft(cov(x, y), alpha * sd) / var.
@query("single_feature_importance", f"""WITH {CELLS}, {tagged_targets()},
s AS (SELECT celltype, covar_pop(m1, target) AS c, var_pop(m1) AS v FROM c GROUP BY celltype)
SELECT celltype, 'Quantity: Mean' AS feature, round(abs(sign(c) * greatest(abs(c) - 0.0001, 0) / v) + 0.0, 8) AS importance FROM s""")
def single_feature_importance(spark, sf_dir):
    sets = lasso.one_vs_rest(cells(spark, sf_dir), "Classification", MEANS[:1], KEYS, limit=3000)
    best = sets.select("celltype").distinct().withColumn("best_alpha", F.lit(0.0001))
    return lasso.importances(sets, best, MEANS[:1]).select(
        "celltype", "feature", rounded("importance", 8).alias("importance"))


def closed_form(alphas):
    tests = " UNION ALL ".join(f"SELECT CAST({a} AS DOUBLE) AS alpha" for a in alphas)
    return f"""WITH {CELLS}, {tagged_targets()},
n AS (SELECT *, count(*) OVER (PARTITION BY celltype, target) AS cn, row_number() OVER (PARTITION BY celltype, target ORDER BY h101) AS r FROM c),
tr AS (SELECT * FROM n WHERE r > CAST(round_even(cn * 0.33, 0) AS BIGINT)),
f0 AS (SELECT *, row_number() OVER (PARTITION BY celltype ORDER BY h7) AS rn2, count(*) OVER (PARTITION BY celltype) AS m FROM tr),
f AS (SELECT celltype, target, m1 AS x, CASE WHEN rn2 <= (m // 10 + 1) * (m % 10) THEN (rn2 - 1) // (m // 10 + 1) ELSE (rn2 - 1 - m % 10) // (m // 10) END AS fold FROM f0),
a AS ({tests}), folds AS (SELECT DISTINCT celltype AS fc, fold AS ff FROM f),
fit AS (SELECT fc, ff, avg(x) AS mx, avg(target) AS my, var_pop(x) AS v, covar_pop(x, target) AS cv FROM folds JOIN f ON celltype = fc AND fold <> ff GROUP BY fc, ff),
w AS (SELECT fc, ff, alpha, mx, my, sign(cv) * greatest(abs(cv) / sqrt(v) - alpha, 0) / sqrt(v) AS w FROM fit, a),
e AS (SELECT fc, ff, alpha, avg(pow(target - my - w * (x - mx), 2)) AS mse FROM w JOIN f ON celltype = fc AND fold = ff GROUP BY fc, ff, alpha)
SELECT fc AS celltype, round(alpha, 6) AS alpha, round(-avg(mse) + 0.0, 6) AS mean_test_score, round(stddev_pop(mse) + 0.0, 6) AS std_test_score FROM e GROUP BY fc, alpha"""


@query("single_feature_penalty_scores", closed_form([0.001, 0.01, 0.02, 0.5]))
def single_feature_penalty_scores(spark, sf_dir):
    sets = lasso.one_vs_rest(cells(spark, sf_dir), "Classification", MEANS[:1], KEYS, limit=3000)
    return round_columns(lasso.search_alphas(sets, KEYS, [0.001, 0.01, 0.02, 0.5]))


EMBEDDING_KEYS = ["vec_id"]


def vector_sets(spark, sf_dir):
    wide, names = embedded(spark, sf_dir)
    return lasso.one_vs_rest(wide, "Classification", names, EMBEDDING_KEYS), names


@query("penalty_scores")
def penalty_scores(spark, sf_dir):
    sets, _ = vector_sets(spark, sf_dir)
    return round_columns(lasso.search_alphas(sets, EMBEDDING_KEYS))


@query("penalty_scores_on_all_rows")
def penalty_scores_on_all_rows(spark, sf_dir):
    return round_columns(lasso.search_alphas_full(cells(spark, sf_dir), "Classification", MEANS, KEYS))


@query("elimination_scores")
def elimination_scores(spark, sf_dir):
    sets, _ = vector_sets(spark, sf_dir)
    best = sets.select("celltype").distinct().withColumn("best_alpha", F.lit(0.01))
    return round_columns(lasso.rfe_scores(sets, best, EMBEDDING_KEYS, (2, 3), selector_alpha=0.005))


@query("elimination_scores_on_all_rows")
def elimination_scores_on_all_rows(spark, sf_dir):
    c = cells(spark, sf_dir)
    best = c.select(F.col("Classification").alias("celltype")).distinct().withColumn("best_alpha", F.lit(0.001))
    return round_columns(lasso.rfe_scores_full(c, "Classification", MEANS, KEYS, best, (2, 3)))


@query("feature_importances")
def feature_importances(spark, sf_dir):
    sets, names = vector_sets(spark, sf_dir)
    best = sets.select("celltype").distinct().withColumn("best_alpha", F.lit(0.002))
    return round_columns(lasso.importances(sets, best, names))


@query("feature_selection")
def feature_selection(spark, sf_dir):
    """The whole selection on the vectors: chosen features per class."""
    wide, names = embedded(spark, sf_dir)
    out = lasso.select_features(wide, "Classification", names, EMBEDDING_KEYS)
    return round_columns(out["top_features"])


@query("moment_sums", f"""WITH {CELLS}, r AS (SELECT *, row_number() OVER (PARTITION BY class ORDER BY {hash_sql(7)}) AS rn, count(*) OVER (PARTITION BY class) AS n FROM cells),
f AS (SELECT *, CASE WHEN rn <= (n // 5 + 1) * (n % 5) THEN (rn - 1) // (n // 5 + 1) ELSE (rn - 1 - n % 5) // (n // 5) END AS fold FROM r)
SELECT class AS celltype, CAST(fold AS BIGINT) AS fold, CAST(count(*) AS DOUBLE) AS sy,
  round(avg(m1) - (SELECT avg(m1) FROM cells) + 0.0, 6) AS mean_x, round(any_value(g), 4) AS xx
FROM f JOIN (SELECT fold AS gf, avg(pow(m1 - (SELECT avg(m1) FROM cells), 2)) AS g FROM f GROUP BY fold) ON gf = fold GROUP BY class, fold""")
def moment_sums(spark, sf_dir):
    """Per class and fold: rows, centred mean and shared second moment, from the one-pass matrices."""
    moments = lasso.all_moments(cells(spark, sf_dir), "Classification", MEANS, KEYS, 5)
    rows = [
        (c, f, float(m.sy), float(m.sxy[0] / m.sy), float(m.sxx[0, 0] / m.n))
        for c, per in moments.items() for f, m in per.items()
    ]
    out = spark.createDataFrame(rows, "celltype string, fold bigint, sy double, mean_x double, xx double")
    return out.select("celltype", "fold", "sy", rounded("mean_x").alias("mean_x"), rounded("xx", 4).alias("xx"))


