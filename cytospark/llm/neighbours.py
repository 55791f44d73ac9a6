"""Approximate nearest neighbours by a forest of random-projection trees.

Each tree splits space by hyperplanes between two random vectors of a bounded
sample; every vector is then put into its leaf of each tree. A query walks all
trees through one priority queue, the part of space it is deepest in first, until
enough vectors are in reach. The vectors of the leaves found are
ranked by their exact distance.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cytospark.llm.tables import col, kept, shuffle_partitions


@dataclass
class Tree:
    """Inner node i splits at ``normals[i] . x = offsets[i]``; children below 0 are leaves -1, -2, ..."""

    normals: np.ndarray
    offsets: np.ndarray
    children: np.ndarray

    def leaves(self, x: np.ndarray) -> np.ndarray:
        at = np.zeros(len(x), np.int64) if len(self.offsets) else np.full(len(x), -1)
        while (inner := np.flatnonzero(at >= 0)).size:
            node = at[inner]
            side = np.einsum("ij,ij->i", x[inner], self.normals[node]) > self.offsets[node]
            at[inner] = self.children[node, side.astype(int)]
        return -at - 1


def grow(x: np.ndarray, leaf: int, rng: np.random.Generator) -> Tree:
    """A tree whose leaves hold about ``leaf`` sample rows or fewer."""
    normals, offsets, children, leaves = [], [], [], 0
    stack = [(np.arange(len(x)), None)]
    while stack:
        rows, parent = stack.pop()
        split = None
        if len(rows) > leaf:
            for _ in range(5):
                a, b = x[rng.choice(rows, 2, replace=False)]
                w = a - b
                size = np.linalg.norm(w)
                if size < 1e-12:
                    continue
                w = w / size
                s = x[rows] @ w
                cut = float(w @ (a + b) / 2)
                share = (s > cut).mean()
                if not 0.1 < share < 0.9:
                    cut = float(np.median(s))
                right = s > cut
                if 0 < right.sum() < len(rows):
                    split = w, cut, rows[~right], rows[right]
                    break
        if split is None:
            leaves += 1
            place = -leaves
        else:
            place = len(normals)
            normals.append(split[0])
            offsets.append(split[1])
            children.append([0, 0])
        if parent is not None:
            children[parent[0]][parent[1]] = place
        if split is not None:
            stack += [(split[2], (place, 0)), (split[3], (place, 1))]
    return Tree(np.array(normals).reshape(-1, x.shape[1]), np.array(offsets, float), np.array(children, np.int64).reshape(-1, 2))


@dataclass
class Forest:
    trees: list[Tree]

    def visits(self, q: np.ndarray, counts: list[np.ndarray], enough: float) -> list[tuple[int, int]]:
        """(tree, leaf) in the order of the shared queue, until ``enough`` vectors are in reach."""
        margins = [t.normals @ q - t.offsets for t in self.trees]
        queue = [(-np.inf, i, 0 if len(t.offsets) else -1) for i, t in enumerate(self.trees)]
        heapq.heapify(queue)
        out, reached = [], 0
        while queue and reached < enough:
            priority, i, node = heapq.heappop(queue)
            if node < 0:
                out.append((i, -node - 1))
                reached += int(counts[i][-node - 1])
                continue
            margin = margins[i][node]
            left, right = self.trees[i].children[node].tolist()
            heapq.heappush(queue, (max(priority, -margin), i, right))
            heapq.heappush(queue, (max(priority, margin), i, left))
        return out

    def leaf_counts(self, x: np.ndarray) -> list[np.ndarray]:
        return [np.bincount(t.leaves(x), minlength=len(t.offsets) + 1) for t in self.trees]


def build(sample: np.ndarray, trees: int, leaf: int, seed: int = 7) -> Forest:
    rng = np.random.default_rng(seed)
    return Forest([grow(sample, leaf, rng) for _ in range(trees)])


def calibrate(forest: Forest, sample: np.ndarray, k: int, aim: float, probes: int = 200, seed: int = 11) -> float:
    """Vectors in reach, as a multiple of the table, at which ``aim`` of the true neighbours are found.

    Measured against brute force for ``probes`` rows of the sample. More trees than one see the same
    vector again, so the multiple may exceed 1. A denser table only brings neighbours closer.
    """
    n = len(sample)
    if n <= k + 1:
        return float(len(forest.trees)) + 1
    rng = np.random.default_rng(seed)
    chosen = rng.choice(n, min(probes, n), replace=False)
    counts = forest.leaf_counts(sample)
    of = np.stack([t.leaves(sample) for t in forest.trees])
    square = (sample ** 2).sum(1)
    needed = []
    for c in chosen:
        d = square - 2 * sample @ sample[c]
        d[c] = np.inf
        near = np.argpartition(d, k)[:k]
        reached, first = 0, {}
        for tree, leaf in forest.visits(sample[c], counts, np.inf):
            reached += int(counts[tree][leaf])
            first[tree, leaf] = reached
        needed += [min(first[t, int(of[t, x])] for t in range(len(forest.trees))) for x in near]
    return float(np.quantile(needed, aim)) / n


def _matrix(column: pa.Array) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def usable(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """(id, vec) of the vectors that can take part: of the commonest dimension, finite, not zero."""
    v = col(embedding)
    rows = vectors.where(v.isNotNull() & col(vec_id).isNotNull()).select(col(vec_id).cast("bigint").alias("id"), v.cast("array<double>").alias("vec"))
    fine = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("vec", lambda x: x != 0)
    rows = rows.where(fine)
    dimension = rows.groupBy(F.size("vec").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return rows.where(F.size("vec") == (dimension["d"] if dimension else 0))


def search(vectors: DataFrame, queries: DataFrame | None = None, k: int = 10, vec_id: str = "vec_id",
           embedding: str = "embedding", every: int = 100, trees: int = 8, leaf_rows: int = 500,
           sample_rows: int = 20_000, aim: float = 0.97, chunk_rows: int = 20_000) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's ``k`` nearest vectors found, by Euclidean distance.

    Queries are the rows whose id is divisible by ``every``, or those of ``queries`` (same columns).
    A query's own id is no candidate. Ties go to the smaller id. If there are fewer candidates than
    ``k``, all are returned.

    The trees are fitted on about ``sample_rows`` rows chosen by a hash of the id; all rows are indexed.
    How far a query reads is calibrated on the sample so that a share ``aim`` of true neighbours is found.
    Equal vectors are indexed once with their k + 1 smallest ids, which is all that a result can need. A
    leaf is searched in chunks of about ``chunk_rows``, so its size doesn't matter to a task.

    Vectors that are null, zero, not of the commonest dimension or hold null or non-finite
    components take no part, nor do null ids. Repeated rows count once. No vectors: no rows.
    """
    spark = vectors.sparkSession
    rows = usable(vectors, vec_id, embedding)
    order = Window.partitionBy("vec").orderBy("id")
    distinct = rows.withColumn("n", F.dense_rank().over(order)).where(F.col("n") <= k + 1)  # limited before the shuffle
    classes = kept(distinct.groupBy("vec").agg(F.sort_array(F.collect_set("id")).alias("ids")), "vectors")
    total = classes.count()
    asked = usable(queries, vec_id, embedding) if queries is not None else rows.where(F.col("id") % every == 0)
    asked = kept(asked.distinct(), "queries")
    schema = "query_id bigint, rank int, vec_id bigint, score double"
    if not total:
        return spark.createDataFrame([], schema)
    share = min(1.0, sample_rows / total)
    part = classes.where(F.pmod(F.xxhash64(F.lit("sample"), F.col("ids")[0]), F.lit(1_000_000)) < int(share * 1_000_000) + 1)
    table = part.select("vec", F.col("ids")[0].alias("id")).limit(
        2 * sample_rows).toArrow().sort_by("id")
    sample = _matrix(table["vec"].combine_chunks())
    forest = build(sample, trees, max(8, round(leaf_rows * len(sample) / total)))
    reach = calibrate(forest, sample, k, aim)
    shared = spark.sparkContext.broadcast(forest)  # trees x leaves x dimension, bounded by the sample

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(0))
            for i, tree in enumerate(shared.value.trees):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), i), pa.int32()), pa.array(tree.leaves(x), pa.int32()),
                                                  *batch.columns], names=["tree", "leaf", "vec", "ids"])

    indexed = classes.select("vec", "ids").mapInArrow(index, "tree int, leaf int, vec array<double>, ids array<bigint>")
    counts = [np.zeros(len(t.offsets) + 1, np.int64) for t in forest.trees]
    for r in indexed.groupBy("tree", "leaf").count().collect():  # at most trees x leaves rows
        counts[r["tree"]][r["leaf"]] = r["count"]
    enough = reach * total
    chunks = [np.maximum(1, -(-c // chunk_rows)) for c in counts]

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(1))
            for i in range(len(x)):
                visits = [(t, leaf, c) for t, leaf in shared.value.visits(x[i], counts, enough) for c in range(chunks[t][leaf])]
                t, leaf, c = (pa.array(v, pa.int32()) for v in zip(*visits))
                row = np.full(len(visits), i)
                yield pa.RecordBatch.from_arrays([t, leaf, c, batch.column(0).take(pa.array(row)), batch.column(1).take(pa.array(row))],
                                                 names=["tree", "leaf", "chunk", "id", "vec"])

    probes = asked.repartition(shuffle_partitions(spark)).select("id", "vec").mapInArrow(
        probe, "tree int, leaf int, chunk int, id bigint, vec array<double>")
    sizes = F.broadcast(spark.createDataFrame([(t, i, int(n)) for t, c in enumerate(chunks) for i, n in enumerate(c)],
                                              "tree int, leaf int, chunks int"))
    filled = indexed.join(sizes, ["tree", "leaf"]).withColumn("chunk", F.pmod(F.xxhash64(F.col("ids")[0]), F.col("chunks")).cast("int"))
    keys = ["tree", "leaf", "chunk"]

    def rank(left: pa.Table, right: pa.Table) -> pa.Table:
        x, q = _matrix(left["vec"].combine_chunks()), _matrix(right["vec"].combine_chunks())
        names = ["id", "found"]
        kind = pa.list_(pa.struct([("score", pa.float64()), ("ids", pa.list_(pa.int64()))]))
        if not len(x) or not len(q):
            return pa.Table.from_arrays([pa.array([], pa.int64()), pa.array([], kind)], names=names)
        ids, square, out = left["ids"].to_pylist(), (x ** 2).sum(1), []
        most = min(k + 1, len(x))
        for low in range(0, len(q), 256):
            block = q[low:low + 256]
            rough = square - 2 * block @ x.T
            limit = np.partition(rough, most - 1, axis=1)[:, most - 1]
            slack = 1e-9 * (1 + np.abs(limit) + (block ** 2).sum(1))
            for i in range(len(block)):
                near = np.flatnonzero(rough[i] <= limit[i] + slack[i])
                exact = np.sqrt(((x[near] - block[i]) ** 2).sum(1))
                best = sorted(zip(exact.tolist(), (ids[j] for j in near)))[:most]
                out.append([{"score": s, "ids": v} for s, v in best])
        return pa.Table.from_arrays([right["id"].combine_chunks(), pa.array(out, kind)], names=names)

    found = filled.select(*keys, "vec", "ids").groupBy(*keys).cogroup(probes.groupBy(*keys)).applyInArrow(
        rank, "id bigint, found array<struct<score:double,ids:array<bigint>>>")
    flat = found.select(F.col("id").alias("query_id"), F.explode("found").alias("f")).select(
        "query_id", F.col("f.score").alias("score"), F.explode("f.ids").alias("vec_id"))
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    flat = flat.where(F.col("query_id") != F.col("vec_id"))
    # The same neighbour may come from several trees: equal rows share a dense rank.
    ranked = flat.withColumn("rank", F.dense_rank().over(best)).where(F.col("rank") <= k)
    return ranked.groupBy("query_id", "rank", "vec_id").agg(F.first("score").alias("score")).select(
        "query_id", "rank", "vec_id", "score")
