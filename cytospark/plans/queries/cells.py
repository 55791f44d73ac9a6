"""Spatial density, class abundance and scalar expressions."""

from pyspark.sql import functions as F

from cytospark.functions import scalars as S
from cytospark.functions.names import col
from cytospark.operators import abundance, spatial, split
from cytospark.plans.catalog import query
from cytospark.plans.tables import CELLS, KEYS, cells, round_columns, rounded, table
from cytospark.sources import readers

BINS = """bins AS (SELECT *, CAST(floor(x / 120.0) AS BIGINT) AS bx, CAST(floor(y / 120.0) AS BIGINT) AS "by" FROM cells),
dens AS (SELECT *, count(*) OVER (PARTITION BY image, bx, "by") AS d FROM bins)"""


def flagged_cells(spark, sf_dir):
    return spatial.bin_density(cells(spark, sf_dir)).withColumnRenamed("Classification", abundance.PREDICTION)


@query("sparse_bins_by_slide_and_class", f"""
WITH {CELLS}, {BINS}
SELECT slide AS "Slide", class AS "Classification", count(*) AS cells,
       CAST(sum(CASE WHEN d <= 3 THEN 1 ELSE 0 END) AS BIGINT) AS low_density_cells,
       round(sum(CASE WHEN d <= 3 THEN 1 ELSE 0 END) / count(*) + 0.0, 6) AS low_density_share
FROM dens GROUP BY slide, class""")
def sparse_bins_by_slide_and_class(spark, sf_dir):
    return round_columns(spatial.sparse_bin_cells(cells(spark, sf_dir), ["Slide", "Classification"]))


@query("bin_density", f"""
WITH {CELLS}, {BINS}
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, image AS "Image", bx AS "binX", "by" AS "binY",
       d AS bin_density, d <= 3 AS low_bin_density FROM dens""")
def bin_density(spark, sf_dir):
    out = spatial.bin_density(cells(spark, sf_dir, classes=False).select(
        *KEYS, "Image", spatial.X_COLUMN, spatial.Y_COLUMN))
    return round_columns(out.drop(spatial.X_COLUMN, spatial.Y_COLUMN).withColumn(
        "l_linenumber", F.col("l_linenumber").cast("int"))).withColumn("l_linenumber", F.col("l_linenumber").cast("int"))


@query("low_density_by_image", f"""
WITH {CELLS}, {BINS}
SELECT image AS "Image", count(*) AS cells, CAST(count(*) FILTER (d <= 3) AS BIGINT) AS low_density_cells,
       round(count(*) FILTER (d <= 3) / count(*) + 0.0, 6) AS low_density_share
FROM dens GROUP BY image""")
def low_density_by_image(spark, sf_dir):
    return round_columns(spatial.low_density_summary(spatial.bin_density(cells(spark, sf_dir, classes=False)), ["Image"]))


@query("flipped_y", f"""
WITH {CELLS}
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, slide AS "Slide",
       round(max(y) OVER (PARTITION BY slide) + 1 - y + 0.0, 6) AS "invertY" FROM cells""")
def flipped_y(spark, sf_dir):
    out = spatial.flip_y(cells(spark, sf_dir, classes=False), "Slide")
    return out.select(*KEYS, "Slide", rounded("invertY").alias("invertY"))


@query("class_share_by_slide", f"""
WITH {CELLS}
SELECT slide AS "Slide", class, count(*) AS n,
       round(count(*) * 100.0 / sum(count(*)) OVER (PARTITION BY slide) + 0.0, 6) AS percentage
FROM cells GROUP BY slide, class""")
def class_share_by_slide(spark, sf_dir):
    counts = abundance.class_counts(cells(spark, sf_dir), ["Slide"], "Classification")
    return round_columns(abundance.class_shares(counts, ["Slide"]))


@query("abundance_matrix", f"""
WITH {CELLS}, n AS (SELECT image, class, count(*) AS n FROM cells GROUP BY image, class),
s AS (SELECT image, class, n * 100.0 / sum(n) OVER (PARTITION BY image) AS p FROM n)
SELECT image AS "Image",
  round(coalesce(sum(p) FILTER (class = 'ECONOMY'), 0) + 0.0, 6) AS "ECONOMY",
  round(coalesce(sum(p) FILTER (class = 'STANDARD'), 0) + 0.0, 6) AS "STANDARD",
  round(coalesce(sum(p) FILTER (class = 'PROMO'), 0) + 0.0, 6) AS "PROMO",
  round(coalesce(sum(p) FILTER (class = 'SMALL'), 0) + 0.0, 6) AS "SMALL",
  round(coalesce(sum(p) FILTER (class = 'MEDIUM'), 0) + 0.0, 6) AS "MEDIUM",
  round(coalesce(sum(p) FILTER (class = 'LARGE'), 0) + 0.0, 6) AS "LARGE"
FROM s GROUP BY image""")
def abundance_matrix(spark, sf_dir):
    counts = abundance.class_counts(cells(spark, sf_dir), ["Image"], "Classification")
    return round_columns(abundance.abundance_matrix(counts, "Image"))


@query("abundance_totals", f"""
WITH {CELLS}, {BINS}, n AS (SELECT class, count(*) AS n FROM cells GROUP BY class)
SELECT (SELECT count(*) FROM cells) AS total_predicted_cells,
       (SELECT class FROM n ORDER BY n DESC, class LIMIT 1) AS most_common_prediction,
       (SELECT class FROM n ORDER BY n, class DESC LIMIT 1) AS most_rare_prediction,
       (SELECT count(*) FROM dens WHERE d <= 3) AS total_low_density_cells""")
def abundance_totals(spark, sf_dir):
    return abundance.abundance_totals(flagged_cells(spark, sf_dir))


@query("cells_per_sample", f"""
WITH {CELLS} SELECT image AS "Image", count(*) AS cells FROM cells GROUP BY image""")
def cells_per_sample(spark, sf_dir):
    return abundance.cells_per_sample(
        abundance.class_counts(cells(spark, sf_dir), ["Image"], "Classification"), "Image")


@query("cohort_size", f"""
WITH {CELLS} SELECT count(DISTINCT image) AS samples, count(DISTINCT class) AS classes FROM cells""")
def cohort_size(spark, sf_dir):
    return abundance.cohort_size(
        abundance.class_counts(cells(spark, sf_dir), ["Image"], "Classification"), "Image")


@query("annotated_cells", """
SELECT trim(label) AS label, count(*) AS n FROM (
  SELECT CASE WHEN p_size % 10 = 0 THEN '  ' || p_type || ' ' WHEN p_size % 10 = 1 THEN '??'
              WHEN p_size % 10 = 2 THEN ' ' WHEN p_size % 10 = 3 THEN 'Ignore*' WHEN p_size % 10 = 4 THEN 'Ignored'
              WHEN p_size % 10 = 5 THEN NULL ELSE p_type END AS label
  FROM lineitem JOIN part ON l_partkey = p_partkey)
WHERE label IS NOT NULL AND trim(label) NOT IN ('??', '?', '0', 'Negative', 'Ignore*', '')
GROUP BY trim(label)""")
def annotated_cells(spark, sf_dir):
    size = F.col("p_size") % 10
    label = (
        F.when(size == 0, F.concat(F.lit("  "), F.col("Classification"), F.lit(" ")))
        .when(size == 1, "??").when(size == 2, " ").when(size == 3, "Ignore*").when(size == 4, "Ignored")
        .when(size == 5, F.lit(None)).otherwise(F.col("Classification"))
    )
    kept = split.annotated(cells(spark, sf_dir).withColumn("label", label), "label")
    return kept.groupBy("label").agg(F.count(F.lit(1)).alias("n"))


@query("image_names", """
SELECT l_returnflag AS slide, l_returnflag || '_' || l_linestatus AS image,
       'S-' || l_returnflag || '_' || l_linestatus AS prefixed, count(*) AS n
FROM lineitem GROUP BY ALL""")
def image_names(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select(
        F.concat(F.col("l_returnflag"), F.lit("_"), F.col("l_linestatus"), F.lit(".ome.tiff")).alias("Image"))
    named = readers.clean_images(li)
    return named.select(
        S.name_part(F.col("Image"), "_", 1).alias("slide"), F.col("Image").alias("image"),
        F.concat(F.lit("S-"), F.col("Image")).alias("prefixed"),
    ).groupBy("slide", "image", "prefixed").agg(F.count(F.lit(1)).alias("n"))


@query("scalar_expressions", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  round(ln(l_quantity + 1) + 0.0, 6) AS log_value,
  CAST(floor(l_extendedprice / 120.0) AS BIGINT) AS bin_value,
  split_part(p_brand, '#', 2) AS brand_part,
  regexp_replace(p_brand || ' [x]', '[^a-zA-Z0-9]', '', 'g') AS alnum_name,
  replace(replace(replace(p_name || ' |a/b', ' ', '_'), '|', '_'), '/', '') AS safe_name,
  replace(replace('[' || p_type || ']', '[', ''), ']', '') AS bare_name,
  printf('%.2f%%', l_discount * 100.0 + 0.0) AS percent_name,
  round(greatest(l_quantity - 25.0, 0.0) + 0.0, 6) AS clipped,
  round(CASE WHEN l_tax > 0 THEN l_discount / l_tax END + 0.0, 6) AS ratio,
  round((pow(l_quantity + 1, 0.5) - 1) / 0.5 + 0.0, 6) AS power_half,
  round(ln(l_quantity + 1) + 0.0, 6) AS power_zero,
  round((l_quantity - 25.0) / 14.0 + 0.0, 6) AS z_value,
  format('{:,}', CAST(l_extendedprice * 100 AS BIGINT)) AS grouped,
  round(l_quantity / 50.0 * 100.0 + 0.0, 6) AS kept_percent,
  CASE WHEN l_discount * 10 >= 0.9 THEN 'Excellent' WHEN l_discount * 10 >= 0.8 THEN 'Good' WHEN l_discount * 10 >= 0.7 THEN 'Fair' ELSE 'Poor' END AS band
FROM lineitem JOIN part ON l_partkey = p_partkey""")
def scalar_expressions(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    part = table(spark, sf_dir, "part")
    rows = li.join(part, li["l_partkey"] == part["p_partkey"])
    q, disc, tax = F.col("l_quantity"), F.col("l_discount"), F.col("l_tax")
    return rows.select(
        *KEYS,
        rounded(S.log_plus_one(q)).alias("log_value"),
        S.bin_index(F.col("l_extendedprice"), 120).cast("bigint").alias("bin_value"),
        S.name_part(F.col("p_brand"), "#", 2).alias("brand_part"),
        S.alnum_only(F.concat("p_brand", F.lit(" [x]"))).alias("alnum_name"),
        S.underscored(F.concat("p_name", F.lit(" |a/b"))).alias("safe_name"),
        S.without_brackets(F.concat(F.lit("["), "p_type", F.lit("]"))).alias("bare_name"),
        S.percent_text(disc + 0.0).alias("percent_name"),
        rounded(S.at_least(q - 25.0, 0.0)).alias("clipped"),
        rounded(S.guarded_ratio(disc, tax)).alias("ratio"),
        rounded(S.power_transform(q + 1, 0.5)).alias("power_half"),
        rounded(S.power_transform(q + 1, 0.0)).alias("power_zero"),
        rounded(S.z_score(q, F.lit(25.0), F.lit(14.0))).alias("z_value"),
        S.thousands(F.round(F.col("l_extendedprice") * 100, 0).cast("bigint")).alias("grouped"),
        rounded(S.kept_share(q, F.lit(50.0))).alias("kept_percent"),
        S.holdout_band(disc * 10).alias("band"),
    )


@query("percent_and_range_parsing", """
SELECT l_returnflag, count(*) AS n, round(avg(round(l_discount * 100, 2) / 100) + 0.0, 6) AS mean_share,
       round(avg(round(l_quantity, 4)) + 0.0, 6) AS mean_start
FROM lineitem GROUP BY l_returnflag""")
def percent_and_range_parsing(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    parsed = li.select(
        "l_returnflag",
        S.percent_value(S.percent_text(F.col("l_discount"))).alias("share"),
        S.range_start(S.range_text(F.col("l_quantity"), F.col("l_extendedprice"))).alias("start"),
    )
    return round_columns(parsed.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n"), F.avg("share").alias("mean_share"), F.avg("start").alias("mean_start")))


@query("without_artifacts", """
SELECT l_returnflag, count(*) AS n FROM lineitem
WHERE l_linenumber % 3 <> 0 OR l_linenumber % 2 = 0 GROUP BY l_returnflag""")
def without_artifacts(spark, sf_dir):
    from cytospark.operators.embed import without_artifacts as keep

    li = table(spark, sf_dir, "lineitem")
    three, two = F.col("l_linenumber") % 3 == 0, F.col("l_linenumber") % 2 == 0
    flagged = li.withColumn("qc", F.when(three & ~two, "Artifact: fold").when(three, "ok"))
    return keep(flagged).groupBy(col("l_returnflag")).agg(F.count(F.lit(1)).alias("n"))
