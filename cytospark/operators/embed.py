"""Principal components and clusters of cells."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import PCA, StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cytospark.functions.names import col, cols, melt, nan_to_null
from cytospark.operators.sizing import join_summary
from cytospark.session import durable

# Share of variance to keep, most components, neighbours and
# components of the graph.
VARIANCE_KEPT = 0.9
MAX_COMPONENTS = 30
NEIGHBOURS = 30
GRAPH_COMPONENTS = 10

ORDER_BITS = 6  # bits per dimension of the space-filling order
BATCH_WINDOW = 60  # rows on each side that are compared
BLOCK_ROWS = 4096  # rows of the order that a task compares at once


def components_for(explained: Sequence[float], share: float = VARIANCE_KEPT) -> int:
    """First number of components whose running variance reaches the share, 1 if none does."""
    running = np.cumsum(explained)
    return int(np.argmax(running >= share)) + 1


def running_variance(df: DataFrame) -> DataFrame:
    """Running sum over (component, explained) rows, and the first that reaches the share."""
    order = W.partitionBy(F.lit(1)).orderBy("component").rowsBetween(W.unboundedPreceding, 0)
    return df.withColumn("running", F.sum("explained").over(order)).withColumn(
        "reached", F.col("running") >= VARIANCE_KEPT)


def standard_components(df: DataFrame, features: Sequence[str], keep: Sequence[str],
                        k: int | None = None, share: float = VARIANCE_KEPT) -> tuple[DataFrame, list[float]]:
    """Standardise, rotate to principal components, keep a share of the variance.

    Returns kept columns with ``components`` (array), and the explained shares.
    The covariance is added up in the tasks; the driver sees features^2 numbers.
    """
    packed = F.array(*[F.coalesce(nan_to_null(col(c).cast("double")), F.lit(0.0)) for c in features])
    rows = df.select(*cols(keep), array_to_vector(packed).alias("_raw"))
    scaler = StandardScaler(inputCol="_raw", outputCol="_scaled", withMean=True, withStd=True).fit(rows)
    top = min(MAX_COMPONENTS, len(features)) if k is None else min(k, len(features))
    scaled = scaler.transform(rows)
    model = PCA(k=top, inputCol="_scaled", outputCol="_pc").fit(scaled)
    explained = [float(v) for v in model.explainedVariance]
    size = components_for(explained, share) if k is None else top
    out = model.transform(scaled).select(
        *cols(keep), F.slice(vector_to_array("_pc"), 1, size).alias("components"))
    return out, explained


def _ordered(df: DataFrame, vector: str, dims: int, curves: int, seed: int) -> DataFrame:
    """One copy of each row per curve, with its place on a shifted Z-order curve."""
    spans = df.agg(*[
        f(F.col(vector)[d]).alias(f"{n}{d}") for d in range(dims) for f, n in ((F.min, "lo"), (F.max, "hi"))
    ])
    rng = np.random.default_rng(seed)
    shifts = [[0.0] * dims, *rng.uniform(0, 1, size=(curves - 1, dims)).tolist()]
    bits = min(ORDER_BITS, 62 // dims)  # a place has 64 bits
    cells = 2**bits - 1
    rows = df.crossJoin(F.broadcast(spans))  # one row of bounds
    curve = F.explode(F.array(*[
        F.struct(F.lit(i).alias("curve"), F.array(*[F.lit(v) for v in s]).alias("shift"))
        for i, s in enumerate(shifts)
    ]))
    rows = rows.withColumn("_c", curve)
    place = F.lit(0).cast("long")
    spots = []
    for d in range(dims):
        width = F.col(f"hi{d}") - F.col(f"lo{d}")
        unit = F.when(width > 0, (F.col(vector)[d] - F.col(f"lo{d}")) / F.when(width > 0, width)).otherwise(0.0)
        spots.append(F.floor((unit + F.col("_c.shift")[d]) / 2 * cells).cast("long").alias(f"_s{d}"))
    rows = rows.select(*cols(df.columns), F.col("_c.curve").alias("_curve"), *spots)
    for bit in reversed(range(bits)):
        for d in range(dims):
            place = place * 2 + F.shiftright(F.col(f"_s{d}"), bit).bitwiseAND(F.lit(1).cast("long"))
    return rows.select(*cols(df.columns), "_curve", place.alias("_place"))


def _numbered(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Running number of each row in its partition."""
    part, at = TaskContext.get().partitionId(), 0
    for pdf in batches:
        yield pdf.assign(_part=part, _at=np.arange(at, at + len(pdf)))
        at += len(pdf)


def _in_order(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """Adds ``_row``, the place of each row in the whole order, from sorted partitions and their sizes."""
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    schema = T.StructType([*ranged.schema.fields, T.StructField("_part", T.LongType()), T.StructField("_at", T.LongType())])
    numbered = durable(ranged.mapInPandas(_numbered, schema), "ordered")  # one partitioning, kept
    sizes = numbered.groupBy("_part").count()  # a row for each partition
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_start"))
    return join_summary(numbered, starts, ["_part"]).withColumn("_row", F.col("_start") + F.col("_at")).drop("_part", "_at", "_start")


def _window_neighbours(k: int, window: int):
    """Nearest rows within a window of the order, for one block with the border rows behind it.

    A pair belongs to the block of its first row, so no pair is lost or seen twice.
    """
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_row", ignore_index=True)
        ids, x, curve = pdf["id"].to_numpy(), np.stack(pdf["v"].to_numpy()), pdf["_curve"].to_numpy()
        own = int((~pdf["_border"].to_numpy()).sum())
        n = len(ids)
        reach = min(window, n - 1)
        if reach < 1:
            return pd.DataFrame({"id": ids[:0], "neighbour": ids[:0], "distance": np.zeros(0)})
        dist = np.full((n, 2 * reach), np.inf)
        for off in range(1, reach + 1):
            first = min(own, n - off)
            d = np.sqrt(((x[off:off + first] - x[:first]) ** 2).sum(axis=1))
            d[curve[off:off + first] != curve[:first]] = np.inf
            dist[:first, 2 * off - 2] = d
            dist[off:off + first, 2 * off - 1] = d
        take = min(k, 2 * reach)
        best = np.argpartition(dist, take - 1, axis=1)[:, :take]
        rows = np.repeat(np.arange(n), take)
        pick = best.ravel()
        d = dist[rows, pick]
        step = pick // 2 + 1
        other = rows + np.where(pick % 2 == 0, step, -step)
        ok = np.isfinite(d)
        return pd.DataFrame({"id": ids[rows[ok]], "neighbour": ids[other[ok]], "distance": d[ok]})
    return run


def nearest_neighbours(df: DataFrame, key: str, vector: str = "components", k: int = NEIGHBOURS,
                       dims: int = GRAPH_COMPONENTS, curves: int = 4, window: int = BATCH_WINDOW,
                       seed: int = 42) -> DataFrame:
    """Approximate k nearest rows: key, neighbour, distance, rank.

    Rows are numbered along several shifted Z-order curves; candidates are the
    rows within a window of each order, compared by exact distance. The order is
    cut in blocks, each with the next block's first rows as a border, so the
    result does not depend on how the table is partitioned. Ties of place are
    broken by a hash, and the work per row is curves x window whatever the
    distribution. More curves or a wider window raise the recall.
    """
    used = df.select(col(key).alias("id"), F.slice(col(vector), 1, dims).alias("v"))
    ordered = _ordered(used, "v", dims, curves, seed).withColumn("_tie", F.xxhash64("id"))
    placed = _in_order(ordered, ["_curve", "_place", "_tie"])
    block = F.floor(F.col("_row") / BLOCK_ROWS)
    border = (F.col("_row") % BLOCK_ROWS < window) & (block > 0)
    copies = F.array_compact(F.array(
        F.struct(block.alias("b"), F.lit(False).alias("border")),
        F.when(border, F.struct((block - 1).alias("b"), F.lit(True).alias("border")))))
    blocks = placed.select("id", "v", "_curve", "_row", F.explode(copies).alias("_c")).select(
        "id", "v", "_curve", "_row", F.col("_c.b").alias("_block"), F.col("_c.border").alias("_border"))
    kind = dict(used.dtypes)["id"]
    pairs = blocks.groupBy("_block").applyInPandas(_window_neighbours(k, window), f"id {kind}, neighbour {kind}, distance double")
    best = pairs.groupBy("id", "neighbour").agg(F.min("distance").alias("distance"))
    order = W.partitionBy("id").orderBy("distance", "neighbour")  # at most 2 * curves * k rows
    return best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def smoothed(df: DataFrame, near: DataFrame, key: str, vector: str, dims: int) -> DataFrame:
    """Each row's vector averaged half and half with the mean of its neighbours: key, vector.

    A row is the neighbour of at most 2 * curves * window others, so no join key
    is hot.
    """
    own = df.select(col(key).alias("id"), F.slice(col(vector), 1, dims).alias("_own"))
    around = near.select("id", "neighbour").join(
        own.select(F.col("id").alias("neighbour"), F.col("_own").alias("_v")), "neighbour")
    means = around.groupBy("id").agg(F.array(*[F.avg(F.col("_v")[d]) for d in range(dims)]).alias("_mean"))
    both = F.zip_with("_own", F.coalesce("_mean", F.col("_own")), lambda a, b: (a + b) / 2)
    return own.join(means, "id", "left").select(col("id").alias(key), both.alias(vector))


def cluster_cells(df: DataFrame, key: str, n_clusters: int, vector: str = "components",
                  k: int = NEIGHBOURS, dims: int = GRAPH_COMPONENTS, seed: int = 42) -> DataFrame:
    """Clusters of cells on the neighbour graph: key, cluster.

    Vectors are smoothed over the graph, then grouped by k-means. Both steps
    are plain distributed passes; power iteration on the same graph converged
    differently from one partitioning to the next and its lineage only grows.
    """
    near = durable(nearest_neighbours(df, key, vector, k, dims), "neighbours")
    rows = durable(smoothed(df, near, key, vector, dims), "smoothed")
    prepared = rows.select(col(key), array_to_vector(vector).alias("_vector"))
    model = KMeans(k=n_clusters, seed=seed, featuresCol="_vector", predictionCol="cluster").fit(prepared)
    return model.transform(prepared).select(col(key), "cluster")


def without_artifacts(df: DataFrame, qc: str = "qc") -> DataFrame:
    """Drop rows flagged as artifact; rows without a flag stay."""
    return df.filter(~F.coalesce(col(qc).contains("Artifact"), F.lit(False)))


def median_columns(df: DataFrame, nuclear: str, suffix: str = ": Cell: Median") -> list[str]:
    """Median columns of all markers but the nuclear stain."""
    return [c for c in df.columns if suffix in c and nuclear not in c]


def cluster_matrix(df: DataFrame, cluster: str, columns: Sequence[str]) -> DataFrame:
    """Mean per cluster and column, scaled to [0, 1] per column; 0 where all are equal."""
    means = melt(df, columns, [cluster]).groupBy(col(cluster), "column").agg(F.avg("value").alias("mean"))
    over = W.partitionBy("column")  # one row per cluster
    low, high = F.min("mean").over(over), F.max("mean").over(over)
    return means.select(
        col(cluster), "column", "mean",
        F.when(high > low, (F.col("mean") - low) / F.when(high > low, high - low)).otherwise(0.0).alias("scaled"))
