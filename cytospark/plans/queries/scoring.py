"""Evaluation of predictions and report roll-ups."""

from pyspark.sql import functions as F

from cytospark.functions.names import rename
from cytospark.operators import evaluate, report, split
from cytospark.plans.catalog import query
from cytospark.plans.tables import CELLS, KEYS, cells, round_columns, table

# Line numbers 1..7 as classes, one row in seven called as the next class.
PAIRS = """p AS (SELECT 'c' || l_linenumber AS actual,
  'c' || (CASE WHEN l_orderkey % 7 = 0 THEN l_linenumber % 7 + 1 ELSE l_linenumber END) AS predicted FROM lineitem),
k AS (SELECT DISTINCT actual AS class FROM p), tot AS (SELECT count(*) AS t FROM p),
s AS (SELECT class, count(*) FILTER (actual = class) AS support, count(*) FILTER (actual = class AND predicted = class) AS tp,
   count(*) FILTER (actual <> class AND predicted = class) AS fp, count(*) FILTER (actual = class AND predicted <> class) AS fn,
   count(*) FILTER (actual <> class AND predicted <> class) AS tn FROM k, p GROUP BY class),
sc AS (SELECT *, tp / (tp + fp) AS prec, tp / (tp + fn) AS rec, 2 * tp / (2 * tp + fp + fn) AS f1, fp / (fp + tn) AS fpr,
   (tp / (tp + fn) + tn / (tn + fp)) / 2 AS auc FROM s)"""
CLASSES = [f"c{i}" for i in range(1, 8)]


def pairs(spark, sf_dir, shift=7):
    n = F.col("l_linenumber")
    li = table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("c"), n.cast("string")).alias("actual"),
        F.concat(F.lit("c"), F.when(F.col("l_orderkey") % shift == 0, n % 7 + 1).otherwise(n).cast("string")).alias("predicted"))
    return evaluate.confusion(li, "actual", "predicted")


# The 10 classes of the vectors; class 3 is called as 4 for one vector in seven.
EMB = """p AS (SELECT CAST(label AS VARCHAR) AS actual, CAST((label + CASE WHEN vec_id % 7 = 0 THEN 1 ELSE 0 END) % 10 AS VARCHAR) AS predicted FROM embeddings),
k AS (SELECT DISTINCT actual AS class FROM p),
s AS (SELECT class, count(*) FILTER (actual = class) AS support, count(*) FILTER (actual = class AND predicted = class) AS tp,
   count(*) FILTER (actual <> class AND predicted = class) AS fp, count(*) FILTER (actual = class AND predicted <> class) AS fn,
   count(*) FILTER (actual <> class AND predicted <> class) AS tn FROM k, p GROUP BY class)"""


def embedding_pairs(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    moved = (F.col("label") + F.when(F.col("vec_id") % 7 == 0, 1).otherwise(0)) % 10
    return evaluate.confusion(e.withColumn("called", moved), "label", "called")


@query("confusion_pairs", f"WITH {PAIRS} SELECT actual, predicted, count(*) AS n FROM p GROUP BY ALL")
def confusion_pairs(spark, sf_dir):
    return pairs(spark, sf_dir)


@query("confusion_matrix", f"WITH {PAIRS} SELECT actual, " + ", ".join(
    f"count(*) FILTER (predicted = '{c}') AS {c}" for c in CLASSES) + " FROM p GROUP BY actual")
def confusion_matrix(spark, sf_dir):
    return evaluate.confusion_matrix(pairs(spark, sf_dir), CLASSES)


@query("accuracy", f"WITH {PAIRS} SELECT round(avg(CASE WHEN actual = predicted THEN 1.0 ELSE 0.0 END), 6) AS accuracy FROM p")
def accuracy(spark, sf_dir):
    p = pairs(spark, sf_dir)
    return round_columns(p.agg(evaluate.accuracy(p).alias("accuracy")))


@query("class_scores", f"""WITH {PAIRS} SELECT class, support, tp, fp, fn, tn, round(prec, 6) AS "precision", round(rec, 6) AS recall,
round(f1, 6) AS f1, round(fpr + 0.0, 6) AS fpr, round(auc, 6) AS auc FROM sc""")
def class_scores(spark, sf_dir):
    return round_columns(evaluate.class_scores(pairs(spark, sf_dir)))


@query("vector_class_auc", f"""WITH {EMB} SELECT class, support, round((tp / (tp + fn) + tn / (tn + fp)) / 2, 6) AS auc FROM s""")
def vector_class_auc(spark, sf_dir):
    return round_columns(evaluate.class_scores(embedding_pairs(spark, sf_dir)).select("class", "support", "auc"))


@query("overall_scores", f"""WITH {PAIRS} SELECT round(sum(tp) / sum(support), 6) AS accuracy, round(sum(f1 * support) / sum(support), 6) AS f1_score,
  round(max(auc), 6) AS max_auc, (SELECT class FROM sc ORDER BY auc DESC, class LIMIT 1) AS best_class, round(min(auc), 6) AS min_auc,
  (SELECT class FROM sc ORDER BY auc, class DESC LIMIT 1) AS worst_class, count(*) AS n_classes, CAST(sum(support) AS BIGINT) AS total_samples,
  min(support) / sum(support) < 0.1 OR max(support) / min(support) > 10 AS class_imbalance_detected FROM sc""")
def overall_scores(spark, sf_dir):
    return round_columns(evaluate.overall(pairs(spark, sf_dir)))


@query("roc_points", f"""WITH {PAIRS} SELECT class, CAST(0 AS BIGINT) AS point, 0.0::DOUBLE AS fpr, 0.0::DOUBLE AS tpr FROM sc
UNION ALL SELECT class, 1, round(fpr + 0.0, 6), round(rec, 6) FROM sc UNION ALL SELECT class, 2, 1.0, 1.0 FROM sc""")
def roc_points(spark, sf_dir):
    return round_columns(evaluate.roc_points(evaluate.class_scores(pairs(spark, sf_dir))))


@query("class_imbalance", """WITH n AS (SELECT p_type, count(*) AS n FROM part GROUP BY p_type)
SELECT round(min(n) / sum(n), 6) AS min_share, round(max(n) / sum(n), 6) AS max_share,
       min(n) / sum(n) < 0.1 OR (max(n) / sum(n)) / (min(n) / sum(n)) > 10 AS imbalanced FROM n""")
def class_imbalance(spark, sf_dir):
    counts = split.label_counts(table(spark, sf_dir, "part"), "p_type")
    return round_columns(evaluate.imbalance(counts, "counts"))


@query("auc_ranking", f"""WITH {PAIRS} SELECT row_number() OVER (ORDER BY auc DESC, class) AS rank, class, round(auc, 3) AS auc_score,
CASE WHEN auc >= 0.9 THEN 'Excellent' WHEN auc >= 0.8 THEN 'Good' WHEN auc >= 0.7 THEN 'Fair' ELSE 'Poor' END AS performance FROM sc""")
def auc_ranking(spark, sf_dir):
    return round_columns(evaluate.auc_ranking(evaluate.class_scores(pairs(spark, sf_dir))), 3)


@query("class_report", f"""WITH {PAIRS}, j AS (SELECT class, support, CASE WHEN class <> 'c4' THEN auc END AS auc FROM sc),
w AS (SELECT *, support * 100.0 / sum(support) OVER () AS percentage, coalesce(auc, -1) AS sort_value FROM j)
SELECT class, support, round(percentage + 0.0, 6) AS percentage, round(auc, 6) AS auc, round(sort_value, 6) AS sort_value,
  row_number() OVER (ORDER BY sort_value DESC, class) AS position,
  CASE WHEN percentage < 5 THEN 'Severely Under.' WHEN percentage < 10 THEN 'Underrepresented' WHEN percentage > 40 THEN 'Dominant' ELSE 'Balanced' END AS class_balance,
  CASE WHEN auc IS NULL THEN 'N/A' WHEN auc >= 0.9 THEN 'Excellent' WHEN auc >= 0.8 THEN 'Good' WHEN auc >= 0.7 THEN 'Moderate' WHEN auc >= 0.6 THEN 'Poor' ELSE 'Very Poor' END AS performance_level
FROM w""")
def class_report(spark, sf_dir):
    scores = evaluate.class_scores(pairs(spark, sf_dir))
    return round_columns(evaluate.class_report(scores, scores.filter("class <> 'c4'")))


@query("evaluation_document", f"""WITH {PAIRS} SELECT round(sum(tp) / sum(support), 6) AS accuracy, count(*) AS n_classes,
(SELECT class FROM sc ORDER BY auc DESC, class LIMIT 1) AS best_class, count(*) AS listed FROM sc""")
def evaluation_document(spark, sf_dir):
    doc = evaluate.evaluation_document(pairs(spark, sf_dir))
    parsed = doc.select(F.from_json(
        "document", "accuracy double, n_classes bigint, max_auc struct<class_name string, auc double>, "
        "auc_scores array<struct<class_name string, auc double, count bigint>>").alias("d"))
    return round_columns(parsed.select(
        "d.accuracy", "d.n_classes", F.col("d.max_auc.class_name").alias("best_class"),
        F.size("d.auc_scores").cast("bigint").alias("listed")))


# -- report -------------------------------------------------------------------

EVALS = """e AS (SELECT 'First' AS m, avg(CASE WHEN l_orderkey % 7 = 0 THEN 0.0 ELSE 1.0 END) AS a FROM lineitem
 UNION ALL SELECT 'Second', avg(CASE WHEN l_orderkey % 5 = 0 THEN 0.0 ELSE 1.0 END) FROM lineitem
 UNION ALL SELECT 'Another', avg(CASE WHEN l_orderkey % 11 = 0 THEN 0.0 ELSE 1.0 END) FROM lineitem)"""


def evaluations(spark, sf_dir):
    out = None
    for i, (name, shift) in enumerate([("First", 7), ("Second", 5), ("Another", 11)]):
        row = evaluate.overall(pairs(spark, sf_dir, shift)).select(F.lit(name).alias("model_name"), F.lit(i).alias("position"), "*")
        out = row if out is None else out.unionByName(row)
    return out


@query("best_model", f"WITH {EVALS} SELECT m AS model, round(a, 6) AS accuracy FROM e ORDER BY a DESC LIMIT 1")
def best_model(spark, sf_dir):
    return round_columns(evaluate.best_model(rename(evaluations(spark, sf_dir), {"model_name": "model"})))


@query("ordered_models", f"""WITH {EVALS} SELECT m AS model_name, CAST(CASE m WHEN 'First' THEN 0 WHEN 'Second' THEN 1 ELSE 2 END AS BIGINT) AS model_order,
round(a, 6) AS accuracy FROM e""")
def ordered_models(spark, sf_dir):
    return round_columns(report.ordered_models(evaluations(spark, sf_dir)).select("model_name", "model_order", "accuracy"))


@query("model_rollup", f"""WITH {PAIRS} SELECT count(*) AS training_classes, round(sum(tp) / sum(support), 6) AS holdout_accuracy,
 round(sum(f1 * support) / sum(support), 6) AS f1_score, min(support) / sum(support) < 0.1 OR max(support) / min(support) > 10 AS class_imbalance,
 (SELECT class FROM sc ORDER BY auc DESC, class LIMIT 1) AS best_class, (SELECT class FROM sc ORDER BY auc, class DESC LIMIT 1) AS worst_class FROM sc""")
def model_rollup(spark, sf_dir):
    return round_columns(report.model_rollup(evaluations(spark, sf_dir)))


def norm_metrics(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        F.lit("boxcox").alias("transformation_type"), F.col("l_linestatus").alias("batch_name")).distinct()


@query("run_summary", f"""WITH {PAIRS} SELECT '' AS pipeline_version, (SELECT count(*) FROM lineitem) AS total_cells,
 (SELECT count(DISTINCT l_linestatus) FROM lineitem) AS total_batches, (SELECT count(*) FROM lineitem WHERE l_returnflag <> 'A') AS total_labels,
 count(*) AS training_classes, 'boxcox' AS normalization_method, round(sum(tp) / sum(support), 6) AS holdout_accuracy,
 round(sum(f1 * support) / sum(support), 6) AS f1_score FROM sc""")
def run_summary(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    totals = li.agg(F.count(F.lit(1)).alias("total_cells"),
                    F.count_if(F.col("l_returnflag") != "A").alias("total_annotated_cells"))
    out = report.run_summary(totals, report.normalization_rollup(norm_metrics(spark, sf_dir)),
                             report.model_rollup(evaluations(spark, sf_dir)))
    return round_columns(out.drop("generation_date"))


@query("selection_rollup", f"""WITH {CELLS} SELECT count(DISTINCT class) AS total_cell_types, string_agg(DISTINCT class, ',' ORDER BY class) AS names FROM cells""")
def selection_rollup(spark, sf_dir):
    metrics = cells(spark, sf_dir).select(F.col("Classification").alias("celltype")).distinct()
    out = report.selection_rollup(metrics)
    return out.select("total_cell_types", F.array_join("cell_types_processed", ",").alias("names"))


@query("merged_documents", """SELECT (SELECT count(*) FROM lineitem) AS cells, (SELECT count(*) FROM orders) AS orders,
(SELECT round(max(o_totalprice), 2) FROM orders) AS top""")
def merged_documents(spark, sf_dir):
    a = table(spark, sf_dir, "lineitem").agg(F.count(F.lit(1)).alias("cells"), F.lit(0.0).alias("top"))
    b = table(spark, sf_dir, "orders").agg(F.count(F.lit(1)).alias("orders"), F.max("o_totalprice").alias("top"))
    return round_columns(report.merged_documents([a, b]), 2)


@query("decoded_codes", """SELECT p_type AS "class", count(*) AS n FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_type""")
def decoded_codes(spark, sf_dir):
    from cytospark.operators import boosting

    c = cells(spark, sf_dir).select(*KEYS, "Classification")
    encoder = boosting.label_encoder(c, "Classification")
    coded = encoder.transform(c).drop("Classification")
    return boosting.decode_labels(coded, boosting.LABEL_INDEX, encoder).groupBy("class").agg(F.count(F.lit(1)).alias("n"))
