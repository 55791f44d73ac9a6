"""The test tables seen as cell tables.

A line item stands for a cell: batch, slide and image from the status flags,
class from the part type, position from price and part number, and four
measures as marker means.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cytospark.functions.names import X_COLUMN, Y_COLUMN, col

KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
MEANS = ["Quantity: Mean", "Price: Mean", "Discount: Mean", "Tax: Mean"]
EMBEDDING_WIDTH = 64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cells(spark: SparkSession, sf_dir: str, classes: bool = True) -> DataFrame:
    """Line items as cells; with ``classes`` joined to their part type."""
    li = table(spark, sf_dir, "lineitem")
    if classes:
        part = table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_brand", "p_size")
        li = li.join(part, li["l_partkey"] == part["p_partkey"])
    named = [] if not classes else [F.col("p_type").alias("Classification"), "p_brand", "p_size"]
    return li.select(
        *KEYS,
        F.col("l_linestatus").alias("Batch"),
        F.col("l_returnflag").alias("Slide"),
        F.concat_ws("-", "l_returnflag", "l_linestatus").alias("Image"),
        *named,
        (F.col("l_extendedprice") / 10).alias(X_COLUMN),
        F.col("l_partkey").cast("double").alias(Y_COLUMN),
        F.col("l_quantity").alias("Quantity: Mean"),
        F.col("l_extendedprice").alias("Price: Mean"),
        F.col("l_discount").alias("Discount: Mean"),
        F.col("l_tax").alias("Tax: Mean"),
    )


# The same table for the SQL side.
CELLS = """cells AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_linestatus AS batch, l_returnflag AS slide,
         l_returnflag || '-' || l_linestatus AS image, p_type AS class, p_brand, p_size,
         l_extendedprice / 10 AS x, CAST(l_partkey AS DOUBLE) AS y,
         l_quantity AS m1, l_extendedprice AS m2, l_discount AS m3, l_tax AS m4
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""

# Long form of the four measures.
LONG = """long AS (
  SELECT batch, slide, 'Quantity: Mean' AS col, m1 AS v FROM cells
  UNION ALL SELECT batch, slide, 'Price: Mean', m2 FROM cells
  UNION ALL SELECT batch, slide, 'Discount: Mean', m3 FROM cells
  UNION ALL SELECT batch, slide, 'Tax: Mean', m4 FROM cells)"""


def embedded(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, list[str]]:
    """Vectors as a cell table: vec_id, class, batch and one column per dimension."""
    e = table(spark, sf_dir, "embeddings")
    names = [f"M{i:02d}: Mean" for i in range(EMBEDDING_WIDTH)]
    wide = e.select(
        "vec_id",
        F.concat(F.lit("type_"), F.col("label").cast("string")).alias("Classification"),
        F.when(F.col("vec_id") % 2 == 0, "even").otherwise("odd").alias("Batch"),
        *[F.col("embedding")[i].cast("double").alias(n) for i, n in enumerate(names)],
    )
    return wide, names


def rounded(c: Column | str, digits: int = 6) -> Column:
    """Rounded double without negative zero, for comparison with SQL."""
    return F.round((col(c) if isinstance(c, str) else c).cast("double"), digits) + F.lit(0.0)


def round_columns(df: DataFrame, digits: int = 6, **special: int) -> DataFrame:
    """Every double column rounded; ``special`` overrides digits by column."""
    return df.select(*[
        rounded(n, special.get(n, digits)).alias(n) if t in ("double", "float") else
        (col(n).cast("bigint").alias(n) if t in ("int", "smallint") else col(n))
        for n, t in df.dtypes
    ])
