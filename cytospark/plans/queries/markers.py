"""Panels, normalisation, variation figures and gating."""

from pyspark.sql import functions as F

from cytospark.functions.names import (
    col,
    cols,
    drop_matching,
    feature_columns,
    melt,
    not_matching,
    without_nuclear,
)
from cytospark.operators import dispersion, gating, normalize, panel, quantiles
from cytospark.plans.catalog import query
from cytospark.plans.tables import CELLS, KEYS, LONG, MEANS, cells, round_columns, rounded, table


def narrow(spark, sf_dir, classes=False):
    return cells(spark, sf_dir, classes)


def partial_panel(spark, sf_dir):
    """Batch F lacks the tax marker."""
    c = cells(spark, sf_dir, classes=False)
    return c.withColumn("Tax: Mean", F.when(F.col("Batch") != "F", col("Tax: Mean")))


MARKERS = """m AS (
  SELECT DISTINCT l_linestatus AS batch, unnest(['Quantity', 'Price', 'Discount']) AS marker FROM lineitem
  UNION SELECT DISTINCT l_linestatus, 'Tax' FROM lineitem WHERE l_linestatus <> 'F')"""


def present(spark, sf_dir):
    seen = panel.present_columns(partial_panel(spark, sf_dir), "Batch", MEANS)
    return panel.observed_markers(seen, "batch")


@query("panel_presence", f"""
WITH {MARKERS}
SELECT marker, CAST(max(CASE WHEN batch = 'F' THEN 1 ELSE 0 END) AS BIGINT) AS "F",
       CAST(max(CASE WHEN batch = 'O' THEN 1 ELSE 0 END) AS BIGINT) AS "O" FROM m GROUP BY marker""")
def panel_presence(spark, sf_dir):
    return round_columns(panel.panel_design(present(spark, sf_dir), ["F", "O"]))


@query("panel_across_tables", """
SELECT marker, CAST(max(CASE WHEN batch = 'items' THEN 1 ELSE 0 END) AS BIGINT) AS items,
       CAST(max(CASE WHEN batch = 'events' THEN 1 ELSE 0 END) AS BIGINT) AS events
FROM (SELECT DISTINCT 'items' AS batch, l_shipmode AS marker FROM (SELECT 'Flag ' || l_returnflag AS l_shipmode FROM lineitem)
      UNION SELECT DISTINCT 'events', 'Type ' || event_type FROM events
      UNION SELECT DISTINCT 'events', 'Flag A' FROM events)
GROUP BY marker""")
def panel_across_tables(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("Flag "), "l_returnflag", F.lit(": Mean")).alias("column"), F.lit("items").alias("b"))
    events = table(spark, sf_dir, "events").select(
        F.explode(F.array(F.concat(F.lit("Type "), "event_type", F.lit(": Mean")), F.lit("Flag A: Mean"))).alias("column"),
        F.lit("events").alias("b"))
    markers = panel.observed_markers(items.unionByName(events), "b")
    union = panel.union_markers([markers.filter("batch = 'items'"), markers.filter("batch = 'events'")])
    design = panel.panel_design(markers, ["items", "events"])
    return round_columns(union.join(design, "marker"))


@query("missing_markers", f"""
WITH {MARKERS}
SELECT a.marker, b.batch FROM (SELECT DISTINCT marker FROM m) a, (SELECT DISTINCT batch FROM m) b
WHERE NOT EXISTS (SELECT 1 FROM m WHERE m.marker = a.marker AND m.batch = b.batch)""")
def missing_markers(spark, sf_dir):
    return panel.missing_markers(present(spark, sf_dir))


STATS = f"""WITH {CELLS}, {LONG}, s AS (
  SELECT batch, col, count(v) AS "count", avg(v) AS mean, stddev_samp(v) AS std, min(v) AS min,
         quantile_cont(v, 0.01) AS p1, quantile_cont(v, 0.02) AS p2, quantile_cont(v, 0.05) AS p5,
         quantile_cont(v, 0.5) AS p50, quantile_cont(v, 0.9) AS p90, max(v) AS max
  FROM long GROUP BY batch, col)"""
STAT_NAMES = ["mean", "std", "min", "p1", "p2", "p5", "p50", "p90", "max"]
ROUNDED_STATS = ", ".join(f'round({c} + 0.0, 6) AS "{c}"' for c in STAT_NAMES)


@query("column_summary", f"""{STATS} SELECT batch AS "Batch", col AS "column", "count", {ROUNDED_STATS} FROM s""")
def column_summary(spark, sf_dir):
    return round_columns(panel.column_summary(narrow(spark, sf_dir), MEANS, ["Batch"]))


@query("average_column_summary", f"""{STATS}
SELECT batch AS "Batch", avg("count") AS "count", {", ".join(f'round(avg({c}) + 0.0, 6) AS "{c}"' for c in STAT_NAMES)}
FROM s GROUP BY batch""")
def average_column_summary(spark, sf_dir):
    summary = panel.column_summary(narrow(spark, sf_dir), MEANS, ["Batch"])
    return round_columns(panel.average_summary(summary, ["Batch"]))


@query("fill_bounds", f"""WITH {CELLS}, {LONG}, s AS (
  SELECT batch, col, min(v) AS mn, quantile_cont(v, 0.05) AS q FROM long GROUP BY batch, col)
SELECT batch AS "Batch", ': Mean' AS suffix, round(avg(mn) + 0.0, 6) AS low, round(avg(q) + 0.0, 6) AS high,
       ceil((avg(q) - avg(mn)) / 6) + 0.0 AS spread FROM s GROUP BY batch""")
def fill_bounds(spark, sf_dir):
    return round_columns(panel.fill_bounds(narrow(spark, sf_dir), [": Mean"], ["Batch"]))


@query("filled_markers", f"""WITH {CELLS}
SELECT batch AS "Batch", count(*) AS cells, count(*) AS filled, CAST(0 AS BIGINT) AS negative, CAST(0 AS BIGINT) AS out_of_reach,
  CAST(0 AS BIGINT) AS changed FROM cells GROUP BY batch""")
def filled_markers(spark, sf_dir):
    """Fill what a batch lacks: values within reach there, nothing changed elsewhere."""
    c = partial_panel(spark, sf_dir)
    high = {r["Batch"]: r["high"] + 9 * r["spread"] for r in panel.fill_bounds(c, [": Mean"], ["Batch"]).collect()}
    filled = panel.fill_batches(
        c.withColumn("own", col("Tax: Mean")), panel.missing_markers(present(spark, sf_dir)), "Batch", KEYS, suffixes=[": Mean"])
    v = col("Tax: Mean")
    return filled.groupBy("Batch").agg(
        F.count(F.lit(1)).alias("cells"), F.count(v).alias("filled"), F.count_if(v < 0).alias("negative"),
        F.count_if((F.col("Batch") == "F") & (v > high["F"])).alias("out_of_reach"),
        F.count_if((F.col("Batch") != "F") & (v != F.col("own"))).alias("changed"))


@query("filled_single_batch", f"""WITH {CELLS}
SELECT batch AS "Batch", count(*) AS cells, count(*) AS filled, CAST(0 AS BIGINT) AS negative FROM cells WHERE batch = 'F' GROUP BY batch""")
def filled_single_batch(spark, sf_dir):
    """One batch on its own, without the column it lacks."""
    f = partial_panel(spark, sf_dir).filter("Batch = 'F'").drop("Tax: Mean")
    lacks = [r["marker"] for r in panel.missing_markers(present(spark, sf_dir)).filter("batch = 'F'").collect()]
    filled = panel.fill_missing(f, lacks, KEYS, suffixes=[": Mean"])
    v = col("Tax: Mean")
    return filled.groupBy("Batch").agg(
        F.count(F.lit(1)).alias("cells"), F.count(v).alias("filled"), F.count_if(v < 0).alias("negative"))


@query("fill_report", f"""WITH {MARKERS}, f AS (SELECT count(*) AS have FROM m WHERE batch = 'F'),
t AS (SELECT count(DISTINCT marker) AS every FROM m)
SELECT 'F' AS batch_id, every = have AS skipped, have AS original_features,
       every - have AS synthetic_features_added, every AS final_features,
       round((every - have) * 100.0 / every + 0.0, 6) AS percent_synthetic FROM f, t""")
def fill_report(spark, sf_dir):
    seen = [r["column"] for r in panel.present_columns(partial_panel(spark, sf_dir), "Batch", MEANS)
            .filter("batch = 'F'").collect()]
    lacks = [r["marker"] for r in panel.missing_markers(present(spark, sf_dir)).filter("batch = 'F'").collect()]
    after = seen + [f"{m}: Mean" for m in lacks]
    return round_columns(panel.fill_report(spark, "F", seen, after, lacks).drop("missing_markers"))


@query("feature_projection", """
SELECT 'l_quantity' AS "column", round(sum(l_quantity), 2) AS total FROM lineitem
UNION ALL SELECT 'l_tax', round(sum(l_tax), 2) FROM lineitem
UNION ALL SELECT 'l_extendedprice', round(sum(l_extendedprice), 2) FROM lineitem""")
def feature_projection(spark, sf_dir):
    """Numeric columns left after name filters; only these reach the scan."""
    li = drop_matching(table(spark, sf_dir, "lineitem"), "DISC")
    keep = feature_columns(li, "(key|number)")
    return melt(li.select(cols(keep)), keep).groupBy("column").agg(rounded(F.sum("value"), 2).alias("total"))


# -- normalisation ------------------------------------------------------------

def by_cell(df, digits=6):
    """Every cell's four measures, with its keys."""
    return df.select(*KEYS, *[rounded(col(m), digits).alias(f"m{i}") for i, m in enumerate(MEANS, 1)])


def by_cell_sql(expressions, source="cells", digits=6):
    measures = ", ".join(f"round({e} + 0.0, {digits}) AS m{i}" for i, e in enumerate(expressions, 1))
    return f"SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {measures} FROM {source}"


@query("log_normalized", f"WITH {CELLS} " + by_cell_sql([f"ln(m{i} + 1)" for i in range(1, 5)]))
def log_normalized(spark, sf_dir):
    return by_cell(normalize.normalize(narrow(spark, sf_dir), "log", MEANS))


MINMAX = """b AS (SELECT batch AS bb, col AS bc, min(v) AS lo, max(v) AS hi FROM long GROUP BY batch, col),
sc AS (SELECT long.*, CASE WHEN hi > lo THEN (v - lo) / (hi - lo) * 4 - 2 ELSE -2 END AS s
       FROM long JOIN b ON bb = batch AND bc = col)"""


def scaled_sql(m):
    low, high = (f"{f}({m}) OVER (PARTITION BY batch)" for f in ("min", "max"))
    return f"CASE WHEN {high} > {low} THEN ({m} - {low}) / ({high} - {low}) * 4 - 2 ELSE -2 END"


@query("minmax_normalized", f"WITH {CELLS} " + by_cell_sql([scaled_sql(f"m{i}") for i in range(1, 5)]))
def minmax_normalized(spark, sf_dir):
    return by_cell(normalize.minmax(narrow(spark, sf_dir), groups=["Batch"]))


@query("scaling_summary", f"""WITH {CELLS}, {LONG}, {MINMAX},
r AS (SELECT col, min(s) AS lo, max(s) AS hi FROM sc GROUP BY col)
SELECT count(*) AS total_features_transformed, round(avg(hi - lo), 6) AS mean_scale_factor,
       round(min(lo), 6) AS min_transformed_value, round(max(hi), 6) AS max_transformed_value FROM r""")
def scaling_summary(spark, sf_dir):
    return round_columns(normalize.scaling_summary(normalize.minmax(narrow(spark, sf_dir), groups=["Batch"]), MEANS))


N_REFERENCES = normalize.QUANTILE_REFERENCES
QUANTS = f"""q AS (SELECT batch AS qb, col AS qc,
  quantile_cont(v, [{", ".join(f"{i}/{N_REFERENCES - 1}.0" for i in range(N_REFERENCES))}]) AS refs
  FROM long GROUP BY batch, col)"""


@query("quantile_references", f"""WITH {CELLS}, {LONG}, {QUANTS}
SELECT qb AS "Batch", qc AS "column", i AS position, round(refs[i + 1] + 0.0, 4) AS reference
FROM q, (SELECT unnest(range({N_REFERENCES})) AS i)""")
def quantile_references(spark, sf_dir):
    fitted = normalize.quantile_fit(narrow(spark, sf_dir), MEANS, ["Batch"], N_REFERENCES)
    return round_columns(fitted.select("Batch", "column", F.posexplode("quantiles").alias("position", "reference")), 4)


@query("quantile_references_bucketed", f"""WITH {CELLS}, {LONG}, {QUANTS}
SELECT qb AS "Batch", qc AS "column", i AS position, round(refs[i + 1] + 0.0, 4) AS reference
FROM q, (SELECT unnest(range({N_REFERENCES})) AS i)""")
def quantile_references_bucketed(spark, sf_dir):
    """The same references by the selection passes used beyond the size limit."""
    fitted = normalize.quantile_fit(narrow(spark, sf_dir), MEANS, ["Batch"], N_REFERENCES, exact_rows=0)
    return round_columns(fitted.select("Batch", "column", F.posexplode("quantiles").alias("position", "reference")), 4)


@query("quantile_normalized", f"""WITH {CELLS}, {LONG}, {QUANTS}, u AS (
  SELECT DISTINCT batch, col, v FROM long),
p AS (SELECT batch, col, v, refs, len(list_filter(refs, lambda r: r <= v)) AS a, len(list_filter(refs, lambda r: r < v)) + 1 AS b
  FROM u JOIN q ON qb = batch AND qc = col),
s AS (SELECT batch AS sb, col AS sc, v AS sv, CASE WHEN v = refs[1] THEN 0.0 WHEN v = refs[{N_REFERENCES}] THEN 1.0
  WHEN refs[a] = v THEN (a - 1 + b - 1) / 2.0 / {N_REFERENCES - 1}
  ELSE ((a - 1) + (v - refs[a]) / (refs[a + 1] - refs[a])) / {N_REFERENCES - 1} END AS t FROM p),
j AS (SELECT cells.*, s1.t AS t1, s2.t AS t2, s3.t AS t3, s4.t AS t4 FROM cells
  JOIN s s1 ON s1.sb = batch AND s1.sc = 'Quantity: Mean' AND s1.sv = m1 JOIN s s2 ON s2.sb = batch AND s2.sc = 'Price: Mean' AND s2.sv = m2
  JOIN s s3 ON s3.sb = batch AND s3.sc = 'Discount: Mean' AND s3.sv = m3 JOIN s s4 ON s4.sb = batch AND s4.sc = 'Tax: Mean' AND s4.sv = m4)
""" + by_cell_sql(["t1", "t2", "t3", "t4"], "j"))
def quantile_normalized(spark, sf_dir):
    return by_cell(normalize.quantile(narrow(spark, sf_dir), MEANS, ["Batch"], N_REFERENCES))


LAMBDAS = [-1.0, -0.5, 0.0, 0.5, 1.0, 2.0]


def llf_sql(lam):
    y = f"CASE WHEN {lam} = 0 THEN ln(v + 1) ELSE (pow(v + 1, {lam}) - 1) / {lam} END"
    if lam == 0:
        y = "ln(v + 1)"
    return f"""SELECT batch AS "Batch", col AS "column", CAST({lam} AS DOUBLE) AS "lambda",
      round((({lam} - 1) * sum(ln(v + 1)) - count(*) / 2.0 * ln(var_pop({y}))) / count(*) + 0.0, 6) AS llf
      FROM long GROUP BY batch, col"""


@query("boxcox_likelihood", f"WITH {CELLS}, {LONG} " + " UNION ALL ".join(llf_sql(x) for x in LAMBDAS))
def boxcox_likelihood(spark, sf_dir):
    c = narrow(spark, sf_dir)
    llf = normalize.log_likelihood(c, MEANS, ["Batch"], LAMBDAS)
    sizes = c.groupBy("Batch").agg(F.count(F.lit(1)).alias("n"))
    return llf.join(sizes, "Batch").select("Batch", "column", "lambda", rounded(F.col("llf") / F.col("n")).alias("llf"))


# A three-step scan of the likelihood, down to a lambda step of 0.0001.
def scan_step(name, source, centre, half, steps):
    return f"""{name}a AS (SELECT batch, col, lm, ln1, CASE WHEN abs(lm) < 1e-9 THEN ln1 ELSE (exp(lm * ln1) - 1) / lm END AS y
  FROM lx JOIN (SELECT batch AS sb, col AS sc, {centre} + (i - {steps}) * {half} / {steps} AS lm
                FROM {source}, (SELECT unnest(range({2 * steps + 1})) AS i)) ON sb = batch AND sc = col),
{name} AS (SELECT batch, col, arg_max(lm, llf) AS best FROM (
  SELECT batch, col, lm, (lm - 1) * sum(ln1) - count(*) / 2.0 * ln(var_pop(y)) AS llf FROM {name}a GROUP BY batch, col, lm)
  GROUP BY batch, col)"""


BOXCOX = f"""WITH {CELLS}, {LONG}, lx AS (SELECT batch, col, ln(v + 1) AS ln1 FROM long),
g AS (SELECT DISTINCT batch, col FROM long), {scan_step("s1", "g", "0.0", 3.0, 15)},
{scan_step("s2", "s1", "best", 0.2, 20)}, {scan_step("s3", "s2", "best", 0.01, 20)},
{scan_step("s4", "s3", "best", 0.0005, 10)}"""


@query("boxcox_lambdas", f"""{BOXCOX}
SELECT batch AS "Batch", col AS "column", count(*) AS n, round(any_value(best) + 0.0, 3) AS "lambda"
FROM s4 JOIN long USING (batch, col) GROUP BY batch, col""")
def boxcox_lambdas(spark, sf_dir):
    return round_columns(normalize.boxcox_fit(narrow(spark, sf_dir), MEANS, ["Batch"]), 3)


@query("boxcox_record")
def boxcox_record(spark, sf_dir):
    c = narrow(spark, sf_dir)
    fitted = normalize.boxcox_fit(c, MEANS, ["Batch"])
    after = normalize.boxcox(c, MEANS, ["Batch"], fitted=fitted)
    return round_columns(normalize.boxcox_record(c, after, fitted, MEANS, ["Batch"]), 4)


@query("lambda_summary", f"""{BOXCOX}
SELECT CAST(count(*) + 2 AS BIGINT) AS total_features, count(*) AS successful_transforms, CAST(2 AS BIGINT) AS failed_transforms,
       round(avg(round(best, 3)), 3) AS mean_lambda, round(median(round(best, 3)), 3) AS median_lambda FROM s4""")
def lambda_summary(spark, sf_dir):
    """Per batch the four measures and a constant one, which cannot be fitted."""
    c = narrow(spark, sf_dir).withColumn("Flat: Mean", F.lit(5.0))
    names = [*MEANS, "Flat: Mean"]
    fitted = normalize.boxcox_fit(c, names, ["Batch"])
    record = normalize.boxcox_record(c, c, fitted, names, ["Batch"])
    return round_columns(normalize.lambda_summary(record), 3)


# -- variation ----------------------------------------------------------------

CV = f"""WITH {CELLS}, {LONG}, {MINMAX},
a AS (SELECT slide, col, CASE WHEN avg(v) > 0 THEN stddev_samp(v) / avg(v) END AS o,
             CASE WHEN avg(s) > 0 THEN stddev_samp(s) / avg(s) END AS mm,
             CASE WHEN avg(ln(v + 1)) > 0 THEN stddev_samp(ln(v + 1)) / avg(ln(v + 1)) END AS lg FROM sc GROUP BY slide, col),
cv AS (SELECT replace(col, ': Mean', '') AS marker, slide, o, lg, o - lg AS d, mm, o - mm AS dm FROM a)"""


def cv_of_log(spark, sf_dir):
    c = narrow(spark, sf_dir)
    return dispersion.cv_metrics(c, normalize.logscale(c, MEANS), "Slide", MEANS)


@query("cv_metrics", f"""{CV} SELECT marker, slide, round(o, 6) AS cv_original, round(lg, 6) AS cv_transformed,
round(d + 0.0, 6) AS cv_improvement FROM cv""")
def cv_metrics(spark, sf_dir):
    return round_columns(cv_of_log(spark, sf_dir))


@query("cv_summary", f"""{CV} SELECT round(avg(d), 6) AS mean_cv_improvement, round(median(d), 6) AS median_cv_improvement,
count(*) FILTER (d > 0) AS markers_improved, count(*) FILTER (d < 0) AS markers_worsened FROM cv""")
def cv_summary(spark, sf_dir):
    return round_columns(dispersion.cv_summary(cv_of_log(spark, sf_dir)))


@query("cv_matrix", f"""{CV} SELECT marker, round(max(d) FILTER (slide = 'A') + 0.0, 6) AS "A",
round(max(d) FILTER (slide = 'N') + 0.0, 6) AS "N", round(max(d) FILTER (slide = 'R') + 0.0, 6) AS "R" FROM cv GROUP BY marker""")
def cv_matrix(spark, sf_dir):
    return round_columns(dispersion.cv_matrix(cv_of_log(spark, sf_dir), ["A", "N", "R"]))


@query("worst_markers", f"""{CV} SELECT marker, round(avg(d), 6) AS cv_improvement, round(avg(lg), 6) AS cv_transformed
FROM cv GROUP BY marker ORDER BY avg(d), marker LIMIT 3""")
def worst_markers(spark, sf_dir):
    return round_columns(dispersion.worst_markers(cv_of_log(spark, sf_dir), 3))


@query("method_table", f"""{CV} SELECT 'logscale' AS method, round(avg(d), 6) AS mean_cv_improvement,
 round(median(d), 6) AS median_cv_improvement, count(*) FILTER (d > 0) AS markers_improved, count(*) FILTER (d < 0) AS markers_worsened FROM cv
UNION ALL SELECT 'minmax', round(avg(dm), 6), round(median(dm), 6), count(*) FILTER (dm > 0), count(*) FILTER (dm < 0) FROM cv""")
def method_table(spark, sf_dir):
    c = narrow(spark, sf_dir)
    tables = {"logscale": normalize.logscale(c, MEANS), "minmax": normalize.minmax(c, MEANS, ["Batch"])}
    return round_columns(normalize.compare_methods(c, tables, "Slide", MEANS))


@query("method_choice")
def method_choice(spark, sf_dir):
    """All four methods compared; the best one marked."""
    c = narrow(spark, sf_dir)
    table_ = normalize.compare_methods(c, normalize.normalize_all(c, MEANS, ["Batch"]), "Slide", MEANS)
    best = normalize.pick_best(table_)
    return round_columns(table_).withColumn("chosen", F.col("method") == best)


@query("distinct_counts", """
SELECT count(DISTINCT l_returnflag) AS total_slides, CAST(4 AS BIGINT) AS total_markers, count(*) AS total_cells FROM lineitem""")
def distinct_counts(spark, sf_dir):
    return dispersion.distinct_counts(narrow(spark, sf_dir), "Slide", len(MEANS))


@query("marker_extremes", """
SELECT 'Tax: Mean' AS darkest, round(avg(l_tax), 6) AS darkest_mean, 'Price: Mean' AS brightest,
       round(avg(l_extendedprice), 4) AS brightest_mean FROM lineitem""")
def marker_extremes(spark, sf_dir):
    return round_columns(dispersion.marker_extremes(narrow(spark, sf_dir), MEANS), brightest_mean=4)


def hist_sql(v, lo, hi, bins, where=""):
    return f"least(CAST(floor(({v} - {lo}) / (({hi} - {lo}) / {bins})) AS BIGINT), {bins - 1})"


@query("marker_histograms", f"""WITH {CELLS}, {LONG}, b AS (SELECT slide AS bs, col AS bc, min(v) AS lo, max(v) AS hi, count(*) AS n FROM long GROUP BY slide, col),
h AS (SELECT slide, col, {hist_sql("v", "lo", "hi", 16)} AS bin, lo, hi, n FROM long JOIN b ON bs = slide AND bc = col)
SELECT slide AS "Slide", col AS "column", bin, count(*) AS "count", round(count(*) / any_value(n) / ((any_value(hi) - any_value(lo)) / 16), 8) AS density,
       round(any_value(lo) + bin * ((any_value(hi) - any_value(lo)) / 16) + 0.0, 6) AS bin_low
FROM h GROUP BY slide, col, bin""")
def marker_histograms(spark, sf_dir):
    return round_columns(dispersion.histogram(narrow(spark, sf_dir), MEANS, 16, ["Slide"]), density=8)


BOX = """f AS (SELECT v, {g} AS g FROM {src}), q AS (SELECT g AS qg, count(*) AS n, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median, quantile_cont(v, 0.75) AS q3
 FROM f GROUP BY g) SELECT g AS "{name}", any_value(n) AS n, round(any_value(q1) + 0.0, 4) AS q1, round(any_value(median) + 0.0, 4) AS median, round(any_value(q3) + 0.0, 4) AS q3,
 round(min(v) FILTER (v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) + 0.0, 4) AS whisker_low,
 round(max(v) FILTER (v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) + 0.0, 4) AS whisker_high
FROM f JOIN q ON qg = g GROUP BY g"""


@query("slide_boxes", f"WITH {CELLS}, {LONG}, " + BOX.format(g="slide", src="long", name="Slide"))
def slide_boxes(spark, sf_dir):
    return round_columns(dispersion.slide_boxes(narrow(spark, sf_dir), "Slide", MEANS), 4)


@query("event_boxes", "WITH " + BOX.format(g="event_type", src="(SELECT event_type, value AS v FROM events)", name="event_type"))
def event_boxes(spark, sf_dir):
    return round_columns(quantiles.box_statistics(table(spark, sf_dir, "events"), "value", ["event_type"]), 4)


@query("finite_maximum", "SELECT round(max(l_extendedprice), 2) AS max_value FROM lineitem")
def finite_maximum(spark, sf_dir):
    c = narrow(spark, sf_dir).withColumn("Price: Mean", F.when(
        F.col("l_orderkey") % 11 == 0, F.lit(float("inf"))).otherwise(col("Price: Mean")))
    return round_columns(normalize.finite_max(c.unionByName(narrow(spark, sf_dir)), MEANS), 2)


@query("scatter_reference", """
SELECT 'Discount' AS marker, round(max(l_discount), 6) AS max_original, round(max(ln(l_discount + 1)), 6) AS max_transformed FROM lineitem
UNION ALL SELECT 'Tax', round(max(l_tax), 6), round(max(ln(l_tax + 1)), 6) FROM lineitem""")
def scatter_reference(spark, sf_dir):
    c = narrow(spark, sf_dir)
    # Of four markers the first and third; the stain, the fourth, takes the place of the first.
    return round_columns(dispersion.scatter_reference(c, normalize.logscale(c, MEANS), "Tax", n_examples=2))


@query("example_markers", "SELECT 0 AS place, 'Tax: Mean' AS \"column\" UNION ALL SELECT 1, 'Discount: Mean'")
def example_markers(spark, sf_dir):
    return dispersion.example_markers(narrow(spark, sf_dir), "Tax", n_examples=2)


@query("method_histograms", f"""WITH {CELLS}, {LONG},
o AS (SELECT 'nuclear' AS panel, 'Quantity: Mean' AS col, v FROM long WHERE col = 'Quantity: Mean'
  UNION ALL SELECT 'others', 'all others', v FROM long WHERE col <> 'Quantity: Mean'
  UNION ALL SELECT 'darkest', col, v FROM long WHERE col = 'Tax: Mean'
  UNION ALL SELECT 'brightest', col, v FROM long WHERE col = 'Price: Mean'),
b AS (SELECT panel AS bp, min(v) AS lo, max(v) AS hi FROM o GROUP BY panel)
SELECT panel, col AS "column", {hist_sql("v", "lo", "hi", 16)} AS bin, count(*) AS "count",
       round(any_value(lo) + {hist_sql("v", "lo", "hi", 16)} * ((any_value(hi) - any_value(lo)) / 16) + 0.0, 6) AS bin_low
FROM o JOIN b ON bp = panel GROUP BY panel, col, {hist_sql("v", "lo", "hi", 16)}""")
def method_histograms(spark, sf_dir):
    return round_columns(dispersion.method_comparison(narrow(spark, sf_dir), "Quantity", MEANS, 16))


# -- gating -------------------------------------------------------------------

@query("gating_histogram", f"""WITH {CELLS}, {LONG}, b AS (SELECT batch AS bb, col AS bc, min(v) AS lo, max(v) AS hi FROM long GROUP BY batch, col)
SELECT batch AS "Batch", col AS "column", {hist_sql("v", "lo", "hi", 2048)} AS bin, CAST(count(*) AS DOUBLE) AS weight, round(sum(v) + 0.0, 2) AS total,
       round(any_value(lo) + 0.0, 4) AS low, round(any_value(hi) + 0.0, 4) AS high
FROM long JOIN b ON bb = batch AND bc = col GROUP BY batch, col, {hist_sql("v", "lo", "hi", 2048)}""")
def gating_histogram(spark, sf_dir):
    hist = gating.fine_histogram(narrow(spark, sf_dir), MEANS, ["Batch"], 2048)
    return round_columns(hist.withColumn("total", rounded(F.col("centre") * F.col("weight"), 2)).drop("centre"), 4)


@query("background_thresholds")
def background_thresholds(spark, sf_dir):
    fitted = gating.thresholds(narrow(spark, sf_dir), MEANS, ["Batch"])
    return round_columns(fitted.drop("means", "stds", "weights"), 4)


def two_compartments(spark, sf_dir):
    """One marker measured in two compartments, and one whose name begins alike."""
    return table(spark, sf_dir, "lineitem").select(
        *KEYS, F.col("l_linestatus").alias("Batch"),
        F.col("l_quantity").alias("CD3: Cell: Mean"),
        (F.col("l_quantity") + 5).alias("CD3: Cell: Max"),
        (F.col("l_discount") * 100).alias("CD3: Nucleus: Mean"),
        (F.col("l_tax") * 100).alias("CD31: Cell: Mean"),
    )


GATED = """t AS (SELECT l_linestatus AS tb, avg(l_quantity) AS t1, avg(l_quantity) - stddev_samp(l_quantity) AS b1, 0.25 * stddev_samp(l_quantity) AS s1,
    avg(l_discount * 100) AS t2, avg(l_discount * 100) - stddev_samp(l_discount * 100) AS b2, 0.25 * stddev_samp(l_discount * 100) AS s2 FROM lineitem GROUP BY l_linestatus),
l0 AS (SELECT *, l_quantity AS c, l_quantity + 5 AS x, l_discount * 100 AS n FROM lineitem JOIN t ON tb = l_linestatus),
l1 AS (SELECT *, greatest(c, t1) AS c1, x + greatest(t1 - c, 0) AS x0, n + greatest(t1 - c, 0) AS n1 FROM l0),
l2 AS (SELECT *, CASE WHEN (x0 - b1) / s1 < 2 THEN b1 + 2 * s1 ELSE x0 END AS x1 FROM l1),
l3 AS (SELECT *, greatest(n1, t2) AS n2, c1 + greatest(t2 - n1, 0) AS c2, x1 + greatest(t2 - n1, 0) AS x2 FROM l2)"""


@query("gated_cells", f"""WITH {GATED}
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(c2 + 0.0, 4) AS cell_mean, round(x2 + 0.0, 4) AS cell_max,
       round(n2 + 0.0, 4) AS nucleus_mean, round(l_tax * 100 + 0.0, 4) AS other_mean FROM l3""")
def gated_cells(spark, sf_dir):
    """Thresholds from plain statistics, applied in order through the compartments."""
    c = two_compartments(spark, sf_dir)
    names = ["CD3: Cell: Mean", "CD3: Nucleus: Mean"]
    fitted = melt(c, names, ["Batch"]).groupBy("Batch", "column").agg(
        F.avg("value").alias("threshold"),
        (F.avg("value") - F.stddev_samp("value")).alias("bg_mean"),
        (0.25 * F.stddev_samp("value")).alias("bg_std"))
    out = gating.gate(c, names, fitted, ["Batch"])
    return out.select(
        *KEYS, rounded("CD3: Cell: Mean", 4).alias("cell_mean"), rounded("CD3: Cell: Max", 4).alias("cell_max"),
        rounded("CD3: Nucleus: Mean", 4).alias("nucleus_mean"), rounded("CD31: Cell: Mean", 4).alias("other_mean"))


@query("gating_summary")
def gating_summary(spark, sf_dir):
    c = narrow(spark, sf_dir)
    fitted = gating.thresholds(c, MEANS, ["Batch"])
    return round_columns(gating.gating_summary(c, MEANS, fitted, ["Batch"]).drop("means", "stds"), 4)


@query("density_curve", f"""WITH {CELLS}, {LONG}, f AS (SELECT col, min(v) AS lo, max(v) AS hi, avg(v) AS m, stddev_samp(v) AS s FROM long GROUP BY col),
g AS (SELECT col, i, lo + (hi - lo) * i / 999.0 AS x, m, s FROM f, (SELECT unnest(range(1000)) AS i))
SELECT col AS "column", i, round(x + 0.0, 4) AS x,
  round((0.25 / (s * sqrt(2 * pi())) * exp(-0.5 * pow((x - m) / s, 2)) + 0.75 / (2 * s * sqrt(2 * pi())) * exp(-0.5 * pow((x - m) / (2 * s), 2))) * s + 0.0, 6) AS density
FROM g""")
def density_curve(spark, sf_dir):
    fitted = melt(narrow(spark, sf_dir), MEANS).groupBy("column").agg(
        F.min("value").alias("low"), F.max("value").alias("high"),
        F.array(F.avg("value"), F.avg("value")).alias("means"),
        F.array(F.stddev_samp("value"), 2 * F.stddev_samp("value")).alias("stds"),
        F.array(F.lit(0.25), F.lit(0.75)).alias("weights"))
    curve = gating.density_curve(fitted, points=1000).join(
        F.broadcast(fitted.select("column", F.col("stds")[0].alias("s"))), "column")
    return curve.select("column", F.col("i").cast("bigint").alias("i"), rounded("x", 4).alias("x"),
                        rounded(F.col("density") * F.col("s")).alias("density"))


@query("nuclear_columns", """
SELECT 'Quantity: Mean' AS "column", false AS nuclear, count(l_quantity) AS n FROM lineitem
UNION ALL SELECT 'Price: Mean', false, count(l_extendedprice) FROM lineitem
UNION ALL SELECT 'Discount: Mean', false, count(l_discount) FROM lineitem
UNION ALL SELECT 'Tax: Mean', true, count(l_tax) FROM lineitem""")
def nuclear_columns(spark, sf_dir):
    c = narrow(spark, sf_dir).select(cols(MEANS))
    others = without_nuclear(c, "Tax")
    assert not_matching(c, "Tax") == others
    return melt(c, MEANS).groupBy("column").agg(F.count("value").alias("n")).withColumn(
        "nuclear", ~F.col("column").isin(others))
