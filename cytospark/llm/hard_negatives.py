"""Hard negatives by slot-decomposed selection.

Each positive of an anchor asks for the best negatives whose score lies in a window
below its own. The windows of one anchor overlap; their upper limits cut the
scores into disjoint slots. Tasks keep the best few of each slot, so a window's
answer is the merge of its own slot and those below, whatever the number of windows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cytospark.llm.tables import col, kept
from cytospark.session import scratch_path

#: Scores saturate here, so that ten times one is still a long.
_MOST = 1 << 58
_NONE = np.iinfo(np.int64).min
#: Scores that are held at once by a task.
_CELLS = 1 << 21


def participants(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label",
                 shifted: int = 7, classes: int = 10) -> DataFrame:
    """(id, label, vec) of the rows that take part; the labels of every ``shifted``-th id are moved by one."""
    rows = vectors.select(col(vec_id).cast("long").alias("id"), col(label).cast("long").alias("label"),
                          col(embedding).cast("array<double>").alias("vec"))
    bad = F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    moved = F.when(F.col("id") % shifted == 0, (F.col("label") + 1) % classes).otherwise(F.col("label"))
    return rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vec").isNotNull() & ~bad).select(
        "id", moved.alias("label"), "vec")


def _whole(column: pa.Array) -> np.ndarray:
    """Rows of floor(256 x); vectors that are shorter than the longest end in zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = np.diff(column.offsets.to_numpy())
    values = np.floor(256 * column.flatten().to_numpy(zero_copy_only=False))
    width = int(sizes.max(initial=0))
    if (sizes == width).all():
        return values.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width))
    out[np.arange(width) < sizes[:, None]] = values
    return out


def inner_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products of all rows of both; longs."""
    width = min(a.shape[1], b.shape[1])
    a, b = a[:, :width], b[:, :width]
    if np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * max(width, 1) < 2.0 ** 53:
        return (a @ b.T).astype(np.int64)
    exact = np.frompyfunc(int, 1, 1)
    products = np.dot(exact(a), exact(b).T)
    return np.frompyfunc(lambda x: max(-_MOST, min(_MOST, x)), 1, 1)(products).astype(np.int64)


class Best:
    """The ``k`` best (score, id) of each of ``keys`` keys: high scores first, then small ids; equal ones once."""

    def __init__(self, keys: int, k: int):
        self.k = k
        self.least = np.full(keys, _NONE)  # what a score must reach to matter
        self.rows = [np.zeros(0, np.int64)] * 3
        self.waiting: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.count = 0

    def add(self, key: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        self.waiting.append((key, score, ids))
        self.count += len(key)
        if self.count > max(1 << 16, 2 * len(self.rows[0])):
            self.compact()

    def compact(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        key, score, ids = (np.concatenate(parts) for parts in zip(self.rows, *self.waiting))
        order = np.lexsort((ids, -score, key))
        key, score, ids = key[order], score[order], ids[order]
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (score[1:] != score[:-1]) | (ids[1:] != ids[:-1])
        key, score, ids = key[new], score[new], ids[new]
        first = np.searchsorted(key, key)
        place = np.arange(len(key)) - first
        full = place == self.k - 1
        self.least[key[full]] = score[full]
        some = place < self.k
        self.rows, self.waiting, self.count = [key[some], score[some], ids[some]], [], 0
        return self.rows


_FOUND = "aid bigint, slot int, id bigint, score bigint"


def _found(base: int, slots: int, best: Best) -> pa.RecordBatch:
    key, score, ids = best.compact()
    return pa.RecordBatch.from_arrays(
        [pa.array(base + key // slots), pa.array((key % slots).astype(np.int32)), pa.array(ids), pa.array(score)],
        names=["aid", "slot", "id", "score"])


def _parts(batches: Iterator[pa.RecordBatch], anchors: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Ids, labels and vectors of so many rows at a time that their scores with all anchors are few."""
    step = max(16, _CELLS // max(anchors, 1))
    for batch in batches:
        for low in range(0, batch.num_rows, step):
            part = batch.slice(low, step)
            yield part.column(0).to_numpy(), part.column(1).to_numpy(), _whole(part.column(2))


def _nearest_alike(rows: DataFrame, anchors, base: int, k: int) -> DataFrame:
    """Of each anchor the ``k`` best of its label in each task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, labels, x = anchors.value
        best = Best(len(ids), k)
        for some, kind, y in _parts(batches, len(ids)):
            score = inner_products(x, y)
            fits = (labels[:, None] == kind) & (ids[:, None] != some) & (score >= best.least[:, None])
            a, b = np.nonzero(fits)
            best.add(a, score[a, b], some[b])
        yield _found(base, 1, best)

    return rows.mapInArrow(run, _FOUND)


def _nearest_unlike(rows: DataFrame, anchors, limits, base: int, k: int) -> DataFrame:
    """Of each anchor and slot the ``k`` best of other labels in each task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, labels, x = anchors.value
        upper, lowest = limits.value
        slots = upper.shape[1]
        best = Best(len(ids) * slots, k)
        for some, kind, y in _parts(batches, len(ids)):
            score = inner_products(x, y)
            fits = (labels[:, None] != kind) & (score <= upper[:, :1]) & (score >= lowest[:, None])
            a, b = np.nonzero(fits)
            s = score[a, b]
            key = a * slots + (s[:, None] <= upper[a]).sum(axis=1) - 1
            some_left = s >= best.least[key]
            best.add(key[some_left], s[some_left], some[b[some_left]])
        yield _found(base, slots, best)

    return rows.mapInArrow(run, _FOUND)


def _first(found: DataFrame, keys: list[str], k: int, name: str) -> DataFrame:
    """The ``k`` best of each key over all tasks, numbered from 1; the same row from two tasks counts once."""
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "id")
    return found.withColumn(name, F.dense_rank().over(order)).where(F.col(name) <= k).dropDuplicates([*keys, name])


def mine(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label", every: int = 100,
         positives: int = 5, negatives: int = 10, low: int = 3, high: int = 9, chunk_anchors: int = 4096) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Anchors are the rows whose id is divisible by ``every``; a score is the inner product of floor(256 x).
    For each anchor and each of its ``positives`` best rows of the same label, the ``negatives`` best rows of
    other labels between ``low`` and ``high`` tenths of the positive's score, both included; fewer if there are
    fewer. Ties go to the smaller id. Ids divisible by 7 have their label moved by one.

    The table is scanned twice for every ``chunk_anchors`` anchors, of which a broadcast holds the vectors and
    limits; tasks send on ``positives`` or ``positives * negatives`` rows an anchor. Rows
    with a null id, label or vector, or a null or non-finite component, take no part. Shorter vectors count as ending
    in zeros. Rows of one id that tie in score count once, so repeated rows do; an anchor's own id is no positive
    of it. Scores saturate at 2**58. A positive of negative score has an empty window. No anchors: no rows.
    """
    spark = vectors.sparkSession
    rows = participants(vectors, vec_id, embedding, label)
    asked = kept(rows.where(F.col("id") % every == 0).distinct(), "anchors")
    chunks = -(-asked.count() // chunk_anchors)
    schema = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
    if not chunks:
        return spark.createDataFrame([], schema)
    path = scratch_path(spark, "hard_negatives")
    chunk_of = F.pmod(F.xxhash64("id", "label", "vec"), F.lit(chunks))
    for chunk in range(chunks):
        part = asked.where(chunk_of == chunk).orderBy("id", "label", "vec").toArrow()
        if not part.num_rows:
            continue
        out = _mine_chunk(rows, part, chunk << 32, positives, negatives, low, high)
        out.write.mode("overwrite").parquet(f"{path}/chunk={chunk}")  # one folder a chunk: a repeated one replaces it
    return spark.read.parquet(path).select(*[F.col(c.split()[0]) for c in schema.split(", ")])


def _mine_chunk(rows: DataFrame, part: pa.Table, base: int, positives: int, negatives: int, low: int, high: int) -> DataFrame:
    spark = rows.sparkSession
    ids = part["id"].to_numpy()
    anchors = spark.sparkContext.broadcast((ids, part["label"].to_numpy(), _whole(part["vec"])))
    alike = _first(_nearest_alike(rows, anchors, base, positives), ["aid"], positives, "place")
    chosen = alike.select("aid", "place", "id", "score").toArrow().sort_by([("aid", "ascending"), ("place", "ascending")])
    at, place = chosen["aid"].to_numpy() - base, chosen["place"].to_numpy() - 1
    score = chosen["score"].to_numpy()
    least, most = -(-low * score // 10), high * score // 10
    some = score >= 0  # below 0 the window is empty
    upper, lowest = np.full((len(ids), positives), _NONE), np.full(len(ids), np.iinfo(np.int64).max)
    upper[at[some], place[some]] = most[some]
    np.minimum.at(lowest, at[some], least[some])
    limits = spark.sparkContext.broadcast((upper, lowest))
    best = _first(_nearest_unlike(rows, anchors, limits, base, negatives), ["aid", "slot"], negatives, "_n")
    windows = spark.createDataFrame(pa.table({
        "aid": pa.array(at[some] + base), "anchor_id": pa.array(ids[at[some]]), "place": pa.array(place[some].astype(np.int32)),
        "positive_id": chosen["id"].filter(pa.array(some)), "positive_score": pa.array(score[some]), "least": pa.array(least[some])}))
    # A window takes its own slot and those below: at most positives x negatives rows an anchor.
    merged = best.join(windows, "aid").where((F.col("slot") >= F.col("place")) & (F.col("score") >= F.col("least")))
    ranked = _first(merged, ["aid", "place"], negatives, "rank")
    return ranked.select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score",
                         F.col("score").alias("negative_score"))
