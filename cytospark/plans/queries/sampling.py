"""Splits, samples and folds."""

from pyspark.sql import functions as F

from cytospark.functions.names import col, cols
from cytospark.operators import lasso, ranking, split
from cytospark.plans.catalog import query
from cytospark.plans.tables import CELLS, KEYS, cells, round_columns, rounded, table

KEYLIST = "l_orderkey, l_linenumber, l_partkey, l_suppkey"


def h(seed):
    return f"md5(concat_ws('|', '{seed}', l_orderkey, l_linenumber, l_partkey, l_suppkey))"


def half_even(x):
    """Rounding to even for non-negative x."""
    return f"(CASE WHEN {x} - floor({x}) = 0.5 AND CAST(floor({x}) AS BIGINT) % 2 = 0 THEN CAST(floor({x}) AS BIGINT) ELSE CAST(floor({x} + 0.5) AS BIGINT) END)"


def brand_cells(spark, sf_dir):
    return cells(spark, sf_dir).select(*KEYS, "Batch", "Slide", col("p_brand").alias("Classification"))


# Brands with at least 1,200 rows per batch take part at scale 0.01.
MIN_COUNT = 1200
TAGGED = f"""{CELLS}, r AS (SELECT *, row_number() OVER (PARTITION BY batch, p_brand ORDER BY {h(42)}) AS rn,
   count(*) OVER (PARTITION BY batch, p_brand) AS n FROM cells),
k AS (SELECT *, CASE WHEN n < {MIN_COUNT} THEN 0 ELSE {half_even("n * 0.1")} END AS quota FROM r),
t AS (SELECT *, CASE WHEN rn <= quota THEN 'holdout' WHEN max(quota) OVER (PARTITION BY p_brand) > 0 THEN 'training' ELSE 'unused' END AS split FROM k)"""


def tagged(spark, sf_dir):
    return split.holdout_split(brand_cells(spark, sf_dir), "Classification", "Batch", KEYS, 0.1, MIN_COUNT)


@query("stratified_holdout", f"""WITH {TAGGED}
SELECT {KEYLIST}, batch AS "Batch", p_brand AS "Classification", split FROM t""")
def stratified_holdout(spark, sf_dir):
    return tagged(spark, sf_dir).drop("Slide")


@query("stratified_sample", f"""WITH {TAGGED} SELECT {KEYLIST} FROM t WHERE split = 'holdout'""")
def stratified_sample(spark, sf_dir):
    return ranking.stratified_sample(
        brand_cells(spark, sf_dir), ["Batch", "Classification"], KEYS, 0.1, MIN_COUNT).select(*KEYS)


@query("class_table", f"""WITH {TAGGED}
SELECT p_brand AS "Classification", count(*) AS counts, round(count(*) * 100.0 / sum(count(*)) OVER () + 0.0, 2) AS percent,
       CASE WHEN count(*) FILTER (split = 'holdout') > 0 THEN count(*) FILTER (split = 'holdout') END AS holdout
FROM t GROUP BY p_brand""")
def class_table(spark, sf_dir):
    return round_columns(split.class_table(tagged(spark, sf_dir), "Classification"), 2)


@query("kept_training_rows", f"""WITH {TAGGED}
SELECT batch AS "Batch", count(*) AS n FROM t WHERE split = 'training' GROUP BY batch""")
def kept_training_rows(spark, sf_dir):
    rows = tagged(spark, sf_dir)
    kept = split.kept_classes(split.class_table(rows, "Classification"), "Classification")
    training = split.rows_of_classes(rows.filter("split <> 'holdout'"), kept, "Classification")
    return training.groupBy("Batch").agg(F.count(F.lit(1)).alias("n"))


@query("split_report", f"""WITH {TAGGED}
SELECT CAST(0.1 AS DOUBLE) AS holdout_fraction, '??, ?, 0, Negative, Ignore*, ' AS negative_classes, CAST({MIN_COUNT} AS BIGINT) AS min_holdout_thresh,
  (SELECT count(*) FROM lineitem) AS total_cells, count(*) AS total_annotated_cells,
  count(*) FILTER (split = 'holdout') AS total_holdout, count(*) FILTER (split = 'training') AS total_training FROM t""")
def split_report(spark, sf_dir):
    return round_columns(split.split_report(
        table(spark, sf_dir, "lineitem"), tagged(spark, sf_dir), 0.1, MIN_COUNT))


@query("class_size_filters", f"""WITH {CELLS}, n AS (SELECT p_brand, count(*) AS n FROM cells GROUP BY p_brand)
SELECT p_brand AS "Classification", n >= 2400 AS at_least, n > 2400 AS more_than FROM n""")
def class_size_filters(spark, sf_dir):
    c = brand_cells(spark, sf_dir)
    at_least = split.classes_with(c, "Classification", at_least=2400).withColumn("at_least", F.lit(True))
    more = split.classes_with(c, "Classification", more_than=2400).withColumn("more_than", F.lit(True))
    every = c.select("Classification").distinct()
    return every.join(at_least, "Classification", "left").join(more, "Classification", "left").na.fill(False)


@query("training_summary", f"""WITH {CELLS} SELECT p_brand AS cell_type, count(*) AS annotations, count(*) > 2400 AS included
FROM cells GROUP BY p_brand""")
def training_summary(spark, sf_dir):
    return split.training_summary(brand_cells(spark, sf_dir), "Classification", 2400)


@query("binarised_class", f"""WITH {CELLS} SELECT batch AS "Batch", CAST(CASE WHEN class = 'PROMO' THEN 1 ELSE 0 END AS BIGINT) AS target, count(*) AS "count"
FROM cells GROUP BY ALL""")
def binarised_class(spark, sf_dir):
    c = split.binarise(cells(spark, sf_dir), "Classification", "PROMO")
    return round_columns(lasso.binary_counts(c))


@query("class_caps", f"""WITH {CELLS}, k AS (SELECT class AS celltype FROM cells GROUP BY class HAVING count(*) >= 20),
p AS (SELECT celltype, CASE WHEN class = celltype THEN 1 ELSE 0 END AS target, {KEYLIST}, {h(42)} AS hh FROM cells, k),
r AS (SELECT *, row_number() OVER (PARTITION BY celltype, target ORDER BY hh) AS rn FROM p)
SELECT celltype, CAST(target AS BIGINT) AS target, {KEYLIST} FROM r WHERE rn <= 3000""")
def class_caps(spark, sf_dir):
    caps = ranking.class_caps(cells(spark, sf_dir), "Classification", KEYS, limit=3000)
    return caps.select("celltype", F.col("target").cast("bigint").alias("target"), *KEYS)


@query("sample_per_slide", f"""WITH r AS (SELECT *, row_number() OVER (PARTITION BY l_returnflag ORDER BY {h(42)}) AS rn,
  count(*) OVER (PARTITION BY l_returnflag) AS n FROM lineitem)
SELECT {KEYLIST}, l_returnflag FROM r WHERE rn <= {half_even("n * 0.25")}""")
def sample_per_slide(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select(*KEYS, "l_returnflag")
    return ranking.sample_groups(li, ["l_returnflag"], KEYS, ranking.fraction_quota(0.25))


@query("sample_of_table", f"""WITH r AS (SELECT *, row_number() OVER (ORDER BY {h(42)}) AS rn, count(*) OVER () AS n FROM lineitem)
SELECT {KEYLIST} FROM r WHERE rn <= {half_even("n * 0.5")}""")
def sample_of_table(spark, sf_dir):
    return ranking.sample_groups(table(spark, sf_dir, "lineitem").select(*KEYS), [], KEYS, ranking.fraction_quota(0.5))


@query("preview_sample", f"""WITH r AS (SELECT *, row_number() OVER (ORDER BY {h(42)}) AS rn, count(*) OVER () AS n FROM lineitem)
SELECT {KEYLIST} FROM r WHERE rn <= CASE WHEN n > 1000 THEN least(1000, floor(n * 0.1)) ELSE n END""")
def preview_sample(spark, sf_dir):
    return ranking.sample_groups(table(spark, sf_dir, "lineitem").select(*KEYS), [], KEYS, ranking.preview_quota())


@query("train_test_split", f"""WITH {CELLS}, r AS (SELECT *, row_number() OVER (PARTITION BY class ORDER BY {h(101)}) AS rn,
  count(*) OVER (PARTITION BY class) AS n FROM cells)
SELECT {KEYLIST}, rn <= {half_even("n * 0.33")} AS is_test FROM r""")
def train_test_split(spark, sf_dir):
    return ranking.train_test(cells(spark, sf_dir), ["Classification"], KEYS).select(*KEYS, "is_test")


def block(folds):
    return f"""CASE WHEN rn <= (n // {folds} + 1) * (n % {folds}) THEN (rn - 1) // (n // {folds} + 1)
      ELSE (rn - 1 - n % {folds}) // greatest(n // {folds}, 1) END"""


@query("fold_ids", f"""WITH r AS (SELECT *, row_number() OVER (PARTITION BY l_returnflag ORDER BY {h(7)}) AS rn,
  count(*) OVER (PARTITION BY l_returnflag) AS n FROM lineitem)
SELECT {KEYLIST}, CAST({block(10)} AS BIGINT) AS fold FROM r""")
def fold_ids(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select(*KEYS, "l_returnflag")
    return ranking.fold_ids(li, ["l_returnflag"], KEYS, 10).select(*KEYS, F.col("fold").cast("bigint").alias("fold"))


@query("repeated_folds", " UNION ALL ".join(f"""
SELECT {KEYLIST}, CAST({r} AS BIGINT) AS "repeat", CAST({block(2)} AS BIGINT) AS fold FROM (
  SELECT *, row_number() OVER (PARTITION BY l_returnflag ORDER BY {h(f"1.{r}")}) AS rn,
         count(*) OVER (PARTITION BY l_returnflag) AS n FROM lineitem)""" for r in range(3)))
def repeated_folds(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select(*KEYS, "l_returnflag")
    out = ranking.repeated_folds(li, ["l_returnflag"], KEYS)
    return out.select(*KEYS, F.col("repeat").cast("bigint").alias("repeat"), F.col("fold").cast("bigint").alias("fold"))


@query("class_counts_with_share", f"""WITH {CELLS}
SELECT class AS "Classification", count(*) AS counts, round(count(*) * 100.0 / sum(count(*)) OVER () + 0.0, 2) AS percent
FROM cells GROUP BY class""")
def class_counts_with_share(spark, sf_dir):
    out = split.label_counts(cells(spark, sf_dir), "Classification")
    return out.select(*cols(["Classification", "counts"]), rounded("percent", 2).alias("percent"))
