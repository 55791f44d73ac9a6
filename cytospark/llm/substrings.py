"""Substring dedup: repeated windows of words are removed but for their first occurrence.

Every window gets a rolling Rabin-Karp hash. Windows are counted by hash in
Spark: a map task keeps the first occurrence of each hash in its block and
sends it, packed with its place, to the task of that hash; there every
occurrence but the first becomes a removal. Removals of a document merge into
maximal intervals.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cytospark.llm.tables import col, kept, shuffle_partitions, small_join
from cytospark.llm.texts import WordHasher, gram_hashes, mix, planes, ragged, unplanes, word_powers

#: Windows that a task holds before it sends their first occurrences on.
BLOCK_WINDOWS = 1_000_000

_PACKED = "bucket int, removal boolean, ids binary, ties binary, counts binary, places binary, codes binary"
_NAMES = ["bucket", "removal", "ids", "ties", "counts", "places", "codes"]
#: A null id orders after all others.
_NULL_ID = np.iinfo(np.int64).max


def _ids(column: pa.Array) -> np.ndarray:
    return column.cast(pa.int64()).fill_null(int(_NULL_ID)).to_numpy(zero_copy_only=False)


def _pack(rows: list, bucket: int, removal: bool, ids, ties, docs, places, codes=None) -> None:
    """One row for the occurrences of one bucket; ``docs`` is ascending."""
    used, counts = np.unique(docs, return_counts=True)
    rows.append((bucket, removal, planes(ids[used]), planes(ties[used]), planes(counts.astype(np.uint32)),
                 planes(places.astype(np.uint32)), b"" if codes is None else codes.tobytes()))


def _batch(rows: list) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.bool_(), *[pa.binary()] * 5]
    return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows), kinds)], names=_NAMES)


def _occurrences(size: int, buckets: int, block_windows: int):
    """Map side: hashes of all windows; repeats inside a block become removals at once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, powers = WordHasher(), word_powers()
        held: list[tuple] = []
        windows = 0
        for batch in batches:
            ids, ties = _ids(batch.column(0)), batch.column(1).to_numpy(zero_copy_only=False)
            for block in hasher.blocks(batch.column(2)):
                counts = np.maximum(np.diff(block.offsets) - size + 1, 0)
                if not counts.sum():
                    continue
                hashes = gram_hashes(block.words, size, powers)
                hashes = hashes[ragged(block.offsets[:-1], counts)]
                rows = slice(block.first, block.first + block.rows)
                held.append((ids[rows], ties[rows], counts, hashes))
                windows += len(hashes)
                if windows >= block_windows:
                    yield from _first(held, buckets)
                    held, windows = [], 0
        if held:
            yield from _first(held, buckets)
    return run


def _ranks(ids: np.ndarray, ties: np.ndarray) -> np.ndarray:
    """Order of each row by id, then text; equal rows share a rank."""
    order = np.lexsort((ties, ids))
    new = np.ones(len(ids), bool)
    new[1:] = (ids[order][1:] != ids[order][:-1]) | (ties[order][1:] != ties[order][:-1])
    rank = np.empty(len(ids), np.int64)
    rank[order] = np.cumsum(new) - 1
    return rank


def _first(held: list[tuple], buckets: int) -> Iterator[pa.RecordBatch]:
    ids, ties, counts, codes = (np.concatenate(x) for x in zip(*held))
    doc = np.repeat(np.arange(len(ids), dtype=np.int32), counts)
    place = ragged(np.zeros(len(counts), np.int64), counts).astype(np.uint32)
    rank = _ranks(ids, ties)
    first, later = _split(codes, lambda x: rank[doc[x]], lambda x: place[x])
    rows: list = []
    if len(later):
        later = np.sort(later)
        _pack(rows, int(codes[later[0]] % np.uint64(buckets)), True, ids, ties, doc[later], place[later])
    first.sort()
    first = first[np.argsort((codes[first] % np.uint64(buckets)).astype(np.int32), kind="stable")]
    bucket = (codes[first] % np.uint64(buckets)).astype(np.int32)
    cuts = np.flatnonzero(np.diff(bucket)) + 1
    for part in np.split(first, cuts):
        _pack(rows, int(codes[part[0]] % np.uint64(buckets)), False, ids, ties, doc[part], place[part], codes[part])
    yield _batch(rows)


def _split(codes: np.ndarray, rank, place) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the first occurrence of each code, and of those that have an earlier one.

    ``rank`` and ``place`` give the order of the positions asked for. An occurrence as early as
    the first (an equal row) is in neither.
    """
    order = np.argsort(codes, kind="stable")
    ordered = codes[order]
    same = ordered[1:] == ordered[:-1]
    member = np.zeros(len(codes), bool)
    member[1:] |= same
    member[:-1] |= same
    single, shared, ordered = order[~member], order[member], ordered[member]
    del order
    if not len(shared):
        return single, shared
    ranks, places = rank(shared), place(shared)
    inner = np.lexsort((places, ranks, ordered))
    shared, ranks, places, ordered = shared[inner], ranks[inner], places[inner], ordered[inner]
    head = np.ones(len(shared), bool)
    head[1:] = ordered[1:] != ordered[:-1]
    lead = np.maximum.accumulate(np.where(head, np.arange(len(shared)), 0))
    later = (ranks != ranks[lead]) | (places != places[lead])
    return np.concatenate((single, shared[head])), shared[later]


_GROUPED = "group int, ids binary, ties binary, counts binary, places binary"


def _later(groups: int):
    """Reduce side: removals of this task's hashes, packed by group of documents."""
    def packed(ids, ties, counts, places) -> Iterator[pa.RecordBatch]:
        group = (mix(ids.view(np.uint64) ^ ties.view(np.uint64)) % np.uint64(groups)).astype(np.int32)
        order = np.argsort(group, kind="stable")
        starts = np.cumsum(counts) - counts
        rows = []
        for part in np.split(order, np.flatnonzero(np.diff(group[order])) + 1):
            if len(part):
                rows.append((int(group[part[0]]), planes(ids[part]), planes(ties[part]), planes(counts[part].astype(np.uint32)),
                             planes(places[ragged(starts[part], counts[part])].astype(np.uint32))))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows), [pa.int32(), *[pa.binary()] * 4])],
                                             names=["group", "ids", "ties", "counts", "places"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gone: list[tuple] = []
        ids, ties, counts, places, codes = [], [], [], [], []
        for batch in batches:
            for k in range(batch.num_rows):
                r = batch.slice(k, 1).to_pylist()[0]
                row = (unplanes(r["ids"], np.int64), unplanes(r["ties"], np.int64),
                       unplanes(r["counts"], np.uint32).astype(np.int64), unplanes(r["places"], np.uint32))
                if r["removal"]:
                    gone.append(row)
                else:
                    for x, v in zip((ids, ties, counts, places, codes), (*row, np.frombuffer(r["codes"], np.uint64))):
                        x.append(v)
        if gone:
            yield from packed(*(np.concatenate(x) for x in zip(*gone)))
            gone.clear()
        if not codes:
            return
        ids, ties, counts = (np.concatenate(x) for x in (ids, ties, counts))
        codes, places = np.concatenate(codes), np.concatenate(places)
        rank = _ranks(ids, ties)
        ends = np.cumsum(counts)
        document = lambda x: np.searchsorted(ends, x, "right")
        later = _split(codes, lambda x: rank[document(x)], lambda x: places[x])[1]
        del codes
        if not len(later):
            return
        later.sort()
        doc, n = np.unique(document(later), return_counts=True)
        yield from packed(ids[doc], ties[doc], n, places[later])
    return run


def _intervals(size: int):
    """Removals of a group of documents, from all hashes: maximal intervals of each document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for batch in batches:
            for i, t, n, p in zip(*(batch.column(k) for k in range(1, 5))):
                held.append((unplanes(i.as_py(), np.int64), unplanes(t.as_py(), np.int64),
                             unplanes(n.as_py(), np.uint32), unplanes(p.as_py(), np.uint32)))
        if not held:
            return
        ids, ties, counts, places = (np.concatenate(x) for x in zip(*held))
        held.clear()
        doc = np.repeat(_ranks(ids, ties), counts)
        key = np.sort(doc.astype(np.uint64) << np.uint64(32) | places)
        doc, place = (key >> np.uint64(32)).astype(np.int64), (key & np.uint64(0xFFFFFFFF)).astype(np.int64)
        new = np.ones(len(key), bool)
        new[1:] = (doc[1:] != doc[:-1]) | (place[1:] > place[:-1] + size)
        starts = np.flatnonzero(new)
        stops = np.append(starts[1:], len(key)) - 1
        spans = np.stack([place[starts], place[stops] + size], 1).astype(np.uint32)
        of = doc[starts]
        cuts = np.flatnonzero(np.diff(of)) + 1
        first = np.concatenate(([0], cuts))
        order = np.lexsort((ties, ids))
        head = order[np.unique(_ranks(ids, ties)[order], return_index=True)[1]]
        ids, ties = ids[head][of[first]], ties[head][of[first]]
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64(), mask=ids == _NULL_ID), pa.array(ties),
                                          pa.array([x.tobytes() for x in np.split(spans, cuts)], pa.binary())],
                                         names=["doc_id", "tie", "spans"])
    return run


def repeated_windows(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = 20,
                     block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """Removal intervals: (doc_id, tie, spans), spans being packed pairs [from, to) of word positions.

    Ids are integers; a null id orders last. Rows of one id are told apart, and ordered, by
    ``tie``, a hash of their text; equal rows are one document and remove nothing from each other.
    Hashes have 64 bits: two windows are taken for the same by chance once in 2**64 pairs.
    """
    buckets = shuffle_partitions(docs.sparkSession)
    rows = docs.select(col(doc_id).cast("bigint").alias("id"), F.coalesce(F.xxhash64(col(text)), F.lit(0)).alias("tie"),
                       col(text).alias("text"))
    packed = rows.mapInArrow(_occurrences(size, buckets, block_windows), _PACKED)
    removals = packed.repartition(buckets, "bucket").mapInArrow(_later(buckets), _GROUPED)
    return removals.repartition(buckets, "group").mapInArrow(_intervals(size), "doc_id bigint, tie bigint, spans binary")


def _apply(digest: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            total, removed, kept_texts = [], [], []
            for text, spans in zip(texts, batch.column(2)):
                words = (text.as_py() or b"").split()
                drop, keep = 0, words
                if spans.is_valid:
                    flags = np.ones(len(words), bool)
                    for a, b in np.frombuffer(spans.as_py(), np.uint32).reshape(-1, 2).tolist():
                        flags[a:b] = False
                    drop = len(words) - int(flags.sum())
                    keep = compress(words, flags.tolist())
                total.append(len(words))
                removed.append(drop)
                joined = b" ".join(keep)
                kept_texts.append(hashlib.sha256(joined).hexdigest() if digest else joined.decode())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(total, pa.int64()), pa.array(removed, pa.int64()),
                 pa.array(kept_texts, pa.string())],
                names=["doc_id", "n_words", "n_removed", "kept"])
    return run


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = 20,
                   digest: bool = False, block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """Per row: (doc_id, n_words, n_removed, kept): the words left, joined by one space, or their SHA-256.

    A word goes if a window of ``size`` words that covers it starts earlier elsewhere: in a row of
    smaller id, or earlier in the same row. Null, empty and shorter texts lose nothing; an empty
    table gives none. Other columns are not read, so their names don't matter.
    """
    source = docs.select(col(doc_id).cast("bigint").alias("doc_id"), col(text).alias("text"),
                         F.coalesce(F.xxhash64(col(text)), F.lit(0)).alias("tie"))
    removals = kept(repeated_windows(docs, doc_id, text, size, block_windows), "removals")
    held = removals.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.length("spans")), F.lit(0))).first()
    key = F.struct(F.coalesce("doc_id", F.lit(int(_NULL_ID))).alias("d"), F.col("tie").alias("t"))
    side = removals.select(key.alias("key"), "spans")
    joined = small_join(source.withColumn("key", key), side, "key", width=64 + held[1] // max(1, held[0]))
    return joined.select("doc_id", "text", "spans").mapInArrow(
        _apply(digest), "doc_id bigint, n_words bigint, n_removed bigint, kept string")
