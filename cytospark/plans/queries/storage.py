"""Sources and sinks: every query writes rows of the tables and reads them back."""

from pyspark.sql import functions as F

from cytospark.functions.names import X_COLUMN, Y_COLUMN, col, matching
from cytospark.operators import boosting, report, spatial
from cytospark.operators.abundance import PREDICTION
from cytospark.plans.catalog import query
from cytospark.plans.tables import CELLS, KEYS, MEANS, cells, round_columns, rounded, table
from cytospark.session import scratch_path
from cytospark.sources import readers, writers


@query("delimited_batches", """
SELECT l_linestatus AS "Batch", l_returnflag AS "Slide", l_linestatus || '-' || l_returnflag || '_1' AS "Image", count(*) AS cells,
  round(avg(l_quantity) + 0.0, 6) AS quantity, round(avg(l_extendedprice) + 0.0, 4) AS price, round(avg(CASE WHEN l_linestatus <> 'F' THEN l_tax END) + 0.0, 6) AS tax
FROM lineitem GROUP BY ALL""")
def delimited_batches(spark, sf_dir):
    """Two folders of tab text with different headers, read as one table."""
    root = scratch_path(spark, "batches")
    li = table(spark, sf_dir, "lineitem").select(
        F.concat("l_returnflag", F.lit("_1")).alias("Image"), "l_linestatus",
        (F.col("l_extendedprice") / 10).alias(X_COLUMN), F.col("l_quantity").alias("Quantity: Mean"),
        F.col("l_extendedprice").alias("Price: Mean"), F.col("l_discount").alias("Discount: Mean"),
        F.when(F.col("l_tax") > 0.01, F.col("l_tax")).otherwise(F.col("l_tax")).alias("Tax: Mean"))
    for batch, drop in (("F", ["Tax: Mean"]), ("O", [])):
        (li.filter(F.col("l_linestatus") == batch).drop("l_linestatus", *drop)
         .write.options(header=True, sep="\t").csv(f"{root}/{batch}"))
    merged = readers.scan_batches(spark, [f"{root}/F", f"{root}/O"], ".csv", "\\t", exclude="discount",
                                  folder_is_slide=True)
    merged = readers.require_rows(merged, root)
    if matching(merged, "Discount"):
        raise ValueError("an excluded column was read")
    named = merged.withColumn("Slide", F.split_part(F.split_part("Image", F.lit("-"), F.lit(2)), F.lit("_"), F.lit(1)))
    return named.groupBy("Batch", "Slide", "Image").agg(
        F.count(F.lit(1)).alias("cells"), rounded(F.avg(col("Quantity: Mean"))).alias("quantity"),
        rounded(F.avg(col("Price: Mean")), 4).alias("price"), rounded(F.avg(col("Tax: Mean"))).alias("tax"))


@query("prefixed_slides", """SELECT l_linestatus AS "Batch", l_returnflag AS "Slide", count(*) AS cells, round(avg(l_extendedprice), 4) AS price FROM lineitem GROUP BY ALL""")
def prefixed_slides(spark, sf_dir):
    """Comma text, slide from the image prefix."""
    root = scratch_path(spark, "prefixed")
    li = table(spark, sf_dir, "lineitem").select(
        F.concat("l_returnflag", F.lit("_"), "l_linenumber").alias("Image"), F.col("l_extendedprice").alias("Price: Mean"), "l_linestatus")
    for batch in ("F", "O"):
        li.filter(F.col("l_linestatus") == batch).drop("l_linestatus").write.option("header", True).csv(f"{root}/{batch}")
    merged = readers.scan_batches(spark, [f"{root}/F", f"{root}/O"], ".csv", ",", slide_by_prefix=True)
    return merged.groupBy("Batch", "Slide").agg(
        F.count(F.lit(1)).alias("cells"), rounded(F.avg(col("Price: Mean")), 4).alias("price"))


@query("stage_tables", f"""WITH {CELLS} SELECT name, batch AS "Batch", n, total FROM (
 SELECT 'original' AS name, batch, count(*) AS n, round(sum(m2), 2) AS total FROM cells GROUP BY batch
 UNION ALL SELECT 'boxcox', batch, count(*), round(sum(m2), 2) FROM cells GROUP BY batch)""")
def stage_tables(spark, sf_dir):
    """A stage as Parquet by batch and as tab text by batch, read by table name."""
    root = scratch_path(spark, "stages")
    c = cells(spark, sf_dir).select("Batch", "Slide", *[col(m) for m in MEANS])
    writers.write_stage(c, f"{root}/merged_dataframe")
    writers.write_normalized(c, f"{root}/boxcox_transformed.tsv")
    named = readers.read_tables(spark, [f"{root}/merged_dataframe", f"{root}/boxcox_transformed.tsv"])
    out = readers.merge_fragments([
        df.groupBy("Batch").agg(F.count(F.lit(1)).alias("n"), rounded(F.sum(col("Price: Mean")), 2).alias("total"))
        .select(F.lit(name).alias("name"), F.col("Batch").cast("string").alias("Batch"), "n", "total")
        for name, df in named.items()])
    return out


@query("prediction_files", f"""WITH {CELLS}, d AS (SELECT *, count(*) OVER (PARTITION BY image, CAST(floor(x / 120.0) AS BIGINT), CAST(floor(y / 120.0) AS BIGINT)) AS d FROM cells)
SELECT image AS "Sample", class AS "CellTypePrediction", count(*) AS cells, count(*) FILTER (d <= 3) AS low FROM d GROUP BY ALL""")
def prediction_files(spark, sf_dir):
    """Predictions per image, then with density columns, then scanned again."""
    root = scratch_path(spark, "predictions")
    scored = cells(spark, sf_dir).withColumnRenamed("Classification", PREDICTION).withColumn(
        "Image", F.concat("Image", F.lit(".ome.tif")))
    writers.write_predictions(scored, f"{root}/pred")
    plain = readers.scan_predictions(
        spark, f"{root}/pred", "*.csv", f"`{X_COLUMN}` double, `{Y_COLUMN}` double, Image string, {PREDICTION} string, Image_key string")
    flagged = spatial.bin_density(plain.drop("Sample", "Image_key"))
    writers.write_qc_predictions(flagged, f"{root}/qpred")
    again = readers.scan_predictions(
        spark, f"{root}/qpred", "*.csv",
        f"`{X_COLUMN}` double, `{Y_COLUMN}` double, Image string, {PREDICTION} string, binX int, binY int, bin_density bigint, low_bin_density boolean, Image_key string")
    return again.groupBy("Sample", PREDICTION).agg(
        F.count(F.lit(1)).alias("cells"), F.count_if("low_bin_density").alias("low"))


@query("class_list", "SELECT DISTINCT p_brand AS celltype FROM lineitem JOIN part ON l_partkey = p_partkey")
def class_list(spark, sf_dir):
    path = scratch_path(spark, "celltypes")
    writers.write_class_list(cells(spark, sf_dir).select("p_brand").distinct(), path)
    return readers.read_class_list(spark, path)


@query("metric_files", """
SELECT 'quantile' AS primary_method, count(DISTINCT l_linestatus) AS total_batches, string_agg(DISTINCT l_linestatus, ',' ORDER BY l_linestatus) AS batches,
       count(*) AS cells FROM lineitem""")
def metric_files(spark, sf_dir):
    """Metric rows per batch as JSON, scanned and rolled up."""
    root = scratch_path(spark, "metrics")
    li = table(spark, sf_dir, "lineitem")
    rows = li.groupBy(F.col("l_linestatus").alias("batch_name")).agg(
        F.count(F.lit(1)).alias("total_cells"), F.max("l_shipdate").alias("latest")).withColumn(
        "transformation_type", F.lit("quantile"))
    for batch in ("F", "O"):
        writers.write_metrics(rows.filter(F.col("batch_name") == batch), f"{root}/{batch}")
    metrics = readers.merge_fragments([readers.read_metrics(spark, f"{root}/{b}") for b in ("F", "O")])
    total = metrics.agg(F.sum("total_cells").alias("cells"))
    return report.normalization_rollup(metrics).crossJoin(total).select(
        "primary_method", "total_batches", F.array_join("batch_names", ",").alias("batches"), "cells")


@query("metrics_document", """SELECT (SELECT count(*) FROM lineitem) AS cells, count(*) AS classes, CAST(max(n) AS BIGINT) AS largest
FROM (SELECT p_type, count(*) AS n FROM part GROUP BY p_type)""")
def metrics_document(spark, sf_dir):
    """All sections in one JSON document, parsed back."""
    general = table(spark, sf_dir, "lineitem").agg(F.count(F.lit(1)).alias("total_cells"))
    classes = table(spark, sf_dir, "part").groupBy("p_type").agg(F.count(F.lit(1)).alias("n"))
    doc = writers.metrics_document({"general": general, "classes": classes})
    parsed = doc.select(F.from_json("document", "general array<struct<total_cells bigint>>, classes array<struct<p_type string, n bigint>>").alias("d"))
    return parsed.select(
        F.col("d.general")[0]["total_cells"].alias("cells"), F.size("d.classes").cast("bigint").alias("classes"),
        F.array_max(F.transform("d.classes", lambda c: c["n"])).alias("largest"))


@query("score_fragments", """SELECT l_linestatus AS source, l_linenumber AS n_features, round(avg(l_discount), 6) AS rfe_score,
round(CASE WHEN l_linestatus = 'O' THEN max(l_tax) END, 6) AS extra FROM lineitem GROUP BY l_linestatus, l_linenumber""")
def score_fragments(spark, sf_dir):
    """Fragments with different columns, stored as CSV with header and united by name."""
    root = scratch_path(spark, "fragments")
    li = table(spark, sf_dir, "lineitem")
    parts = []
    for batch in ("F", "O"):
        extra = [F.round(F.max("l_tax"), 6).alias("extra")] if batch == "O" else []
        rows = li.filter(F.col("l_linestatus") == batch).groupBy("l_linenumber").agg(
            F.round(F.avg("l_discount"), 6).alias("rfe_score"), *extra)
        writers.write_result(rows, f"{root}/{batch}")
        parts.append(readers.read_rows(spark, f"{root}/{batch}").withColumn("source", F.lit(batch)))
    merged = readers.merge_fragments(parts)
    return merged.select("source", F.col("l_linenumber").cast("int").alias("n_features"),
                         rounded("rfe_score").alias("rfe_score"), rounded("extra").alias("extra"))


@query("batch_union", """SELECT 'items' AS "Batch", count(*) AS n, round(sum(l_quantity), 2) AS quantity, CAST(NULL AS DOUBLE) AS price FROM lineitem
UNION ALL SELECT 'orders', count(*), NULL, round(sum(o_totalprice), 2) FROM orders""")
def batch_union(spark, sf_dir):
    """Batches with different measures under each other, aligned by name."""
    merged = readers.union_tables({
        "items": table(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity"),
        "orders": table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_totalprice"),
    })
    return merged.groupBy("Batch").agg(
        F.count(F.lit(1)).alias("n"), rounded(F.sum("l_quantity"), 2).alias("quantity"), rounded(F.sum("o_totalprice"), 2).alias("price"))


@query("stored_encoder", """WITH c AS (SELECT p_type, dense_rank() OVER (ORDER BY p_type) - 1 AS code FROM lineitem JOIN part ON l_partkey = p_partkey)
SELECT p_type AS "Classification", CAST(code AS DOUBLE) AS code, count(*) AS n FROM c GROUP BY ALL""")
def stored_encoder(spark, sf_dir):
    c = cells(spark, sf_dir).select(*KEYS, "Classification")
    path = scratch_path(spark, "encoder")
    writers.save_encoder(boosting.label_encoder(c, "Classification"), path)
    coded = writers.load_encoder(path).transform(c)
    return round_columns(coded.groupBy("Classification", F.col(boosting.LABEL_INDEX).alias("code")).agg(F.count(F.lit(1)).alias("n")))
