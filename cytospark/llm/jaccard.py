"""N-gram Jaccard join in the metric space of word-shingle sets.

Unrelated texts share no shingle, so their Jaccard distance is exactly 1 and a
few pivots could not tell them apart. The space is therefore opened
up first: shingles are put in one order, rare ones first, and two sets
within the distance share one of the first few shingles of each. The
documents that have such a shingle in common form a ball of the space.

A small ball is joined exactly. In a dense one, pivots are drawn and the distance
of every document to them is worked out; each document falls into the
Voronoi region of its nearest pivot, links to pivots join up components, and
a document is compared further only with documents of other components whose region the
triangle inequality leaves open. The first turn has one pivot a ball, the next sixteen; from there
pivots grow sixteenfold with each turn of this recursion until no pair in doubt is left, so the result is exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cytospark.llm import components
from cytospark.llm.tables import col, kept, shuffle_partitions, small_batches, small_join
from cytospark.llm.texts import WordHasher, fresh, gram_hashes, mix, planes, ragged, released, sliced, unplanes, word_powers

#: Shingles in more documents than this count as frequent and come late in the order.
FREQUENT = 32
#: Frequent shingles that are told to all tasks (16 MB); the order of the rest is by hash.
MOST_FREQUENT = 1_000_000
#: Bytes of text hashed at once; each takes some 50 bytes of a worker while it lasts.
HASHED_BYTES = 1 << 18
#: Pairs for each member up to which a ball is joined at once.
PAIRS_EACH = 24


class Shingles:
    """Distinct shingle hashes of each text: ``values[offsets[i]:offsets[i + 1]]``, ascending."""

    def __init__(self, column: pa.Array, size: int, hasher: WordHasher, powers):
        counts, values = [], []
        for block in hasher.blocks(column):
            words = np.diff(block.offsets)
            full = np.maximum(words - size + 1, 0)
            grams = gram_hashes(block.words, size, powers)
            doc = [np.repeat(np.arange(block.rows), full)]
            parts = [grams[ragged(block.offsets[:-1], full)]]
            for n in range(1, size):  # a short text is one shingle
                short = np.flatnonzero(words == n)
                if len(short):
                    start = block.offsets[short]
                    code = np.full(len(short), n, np.uint64)
                    for i in range(n):
                        code = mix(code * np.uint64(31) + block.words[start + i])
                    doc.append(short)
                    parts.append(code)
            doc, codes = np.concatenate(doc), np.concatenate(parts)
            order = np.lexsort((codes, doc)) if len(doc) else np.zeros(0, int)
            doc, codes = doc[order], codes[order]
            new = np.ones(len(doc), bool)
            new[1:] = (doc[1:] != doc[:-1]) | (codes[1:] != codes[:-1])
            counts.append(np.bincount(doc[new], minlength=block.rows))
            values.append(codes[new])
        self.counts = np.concatenate(counts) if counts else np.zeros(0, int)
        self.values = np.concatenate(values) if values else np.zeros(0, np.uint64)
        self.offsets = np.concatenate(([0], np.cumsum(self.counts)))

    def keys(self) -> np.ndarray:
        """A hash of each whole set; 0 for the empty one."""
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(self.values))))
        sums = sums[self.offsets[1:]] - sums[self.offsets[:-1]]
        keys = mix(sums + self.counts.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)).view(np.int64)
        return np.where(self.counts > 0, keys, 0)


def _codes(values: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    return (values % np.uint64(buckets)).astype(np.int32), (values >> np.uint64(32)).astype(np.uint32)


def _by_bucket(bucket: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    order = np.argsort(bucket, kind="stable")
    for part in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1):
        if len(part):
            yield int(bucket[part[0]]), part


def _measure(docs: DataFrame, size: int, buckets: int) -> tuple[DataFrame, DataFrame]:
    """One pass over all texts: (doc_id, tie, n, key) of each row, and the frequent shingles (bucket, code, df)."""
    schema = "bucket int, doc_id bigint, tie bigint, n bigint, key bigint, codes binary, counts binary"

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, powers = WordHasher(lower=True, slice_bytes=HASHED_BYTES), word_powers()
        for batch in sliced(batches, 2):
            sets = Shingles(batch.column(2), size, hasher, powers)
            n = batch.num_rows
            spread = pa.array((np.arange(n) % buckets).astype(np.int32))
            none = pa.nulls(n, pa.binary())
            yield pa.RecordBatch.from_arrays([spread, batch.column(0), batch.column(1), pa.array(sets.counts.astype(np.int64)),
                                              pa.array(sets.keys()), none, none], schema=kinds)
            values, counts = np.unique(sets.values, return_counts=True)
            bucket, code = _codes(values, buckets)
            rows = [(b, code[part].tobytes(), planes(counts[part].astype(np.uint32))) for b, part in _by_bucket(bucket)]
            if rows:
                b, c, m = zip(*rows)
                empty = pa.nulls(len(b), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(b, pa.int32()), *[empty] * 4, pa.array(c, pa.binary()), pa.array(m, pa.binary())],
                                                 schema=kinds)

    kinds = pa.schema([("bucket", pa.int32()), *[(x, pa.int64()) for x in ("doc_id", "tie", "n", "key")],
                       ("codes", pa.binary()), ("counts", pa.binary())])
    out = pa.schema([("bucket", pa.int32()), *[(x, pa.int64()) for x in ("doc_id", "tie", "n", "key", "code", "df")]])

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[np.ndarray]] = {}
        for batch in batches:
            rows = batch.column(3).is_valid().to_numpy(zero_copy_only=False)
            docs_part = batch.filter(pa.array(rows))
            if docs_part.num_rows:
                none = pa.nulls(docs_part.num_rows, pa.int64())
                yield pa.RecordBatch.from_arrays([*docs_part.columns[:5], none, none], schema=out)
            for b, c, m in zip(*(batch.filter(pa.array(~rows)).column(i) for i in (0, 5, 6))):
                # Code and count in one number: sorting brings equal codes together.
                both = np.frombuffer(c.as_py(), np.uint32).astype(np.uint64) << np.uint64(32)
                held.setdefault(b.as_py(), []).append(both | unplanes(m.as_py(), np.uint32))
        while held:
            bucket, parts = held.popitem()
            both = np.concatenate(parts)
            parts.clear()
            both.sort()
            codes = (both >> np.uint64(32)).astype(np.uint32)
            starts = np.flatnonzero(np.concatenate(([True], codes[1:] != codes[:-1])))
            df = np.add.reduceat(both & np.uint64(0xFFFFFFFF), starts).astype(np.int64)
            often = df > FREQUENT
            n = int(often.sum())
            none = pa.nulls(n, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, bucket, np.int32)), none, none, none, none, pa.array(codes[starts][often].astype(np.int64)),
                 pa.array(df[often])], schema=out)

    both = docs.mapInArrow(released(measure), schema).repartition(buckets, "bucket").mapInArrow(
        released(total), "bucket int, doc_id bigint, tie bigint, n bigint, key bigint, code bigint, df bigint")
    with small_batches(docs.sparkSession, 2000):
        both = kept(both, "shingle_counts")
    return both.where("df is null").select("doc_id", "tie", "n", "key"), both.where("df is not null").select("bucket", "code", "df")


def _prefixes(docs: DataFrame, size: int, share: tuple[int, int], frequent: tuple[np.ndarray, np.ndarray], df_buckets: int,
              buckets: int) -> DataFrame:
    """The first shingles of each set, packed: shingle, set key, set size, overlap that is still possible."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent)
    low, high = share  # similarity low / high

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, powers = WordHasher(lower=True, slice_bytes=HASHED_BYTES), word_powers()
        known, level = shared.value
        for batch in sliced(batches, 0):
            sets = Shingles(batch.column(0), size, hasher, powers)
            keys = sets.keys()
            _, first = np.unique(keys, return_index=True)  # copies in the batch count once
            first = first[sets.counts[first] > 0]
            count = sets.counts[first]
            at = ragged(sets.offsets[first], count)
            values, doc = sets.values[at], np.repeat(np.arange(len(first)), count)
            rank = np.zeros(len(values), np.int64)
            if len(known):
                bucket, code = _codes(values, df_buckets)
                value = bucket.astype(np.uint64) << np.uint64(32) | code
                place = np.minimum(np.searchsorted(known, value), len(known) - 1)
                rank = np.where(known[place] == value, level[place], 0)
            values = values[np.argsort(doc * 64 + rank, kind="stable")]
            length = count - (count * low + high - 1) // high + 1
            starts = np.cumsum(count) - count
            at = ragged(starts, length)
            values, doc = values[at], np.repeat(np.arange(len(first)), length)
            left = (count[doc] - ragged(np.zeros(len(length), int), length)).astype(np.uint32)
            rows = []
            for b, part in _by_bucket((values % np.uint64(buckets)).astype(np.int32)):
                d = doc[part]
                rows.append((b, values[part].tobytes(), keys[first][d].tobytes(), planes(count[d].astype(np.uint32)), planes(left[part])))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows), [pa.int32(), *[pa.binary()] * 4])],
                                                 names=["bucket", "codes", "keys", "sizes", "left"])

    return docs.select("text").mapInArrow(released(run), "bucket int, codes binary, keys binary, sizes binary, left binary")


def _balls(share: tuple[int, int]):
    """Reduce side: pairs of small balls (a, b), and the members of dense ones (ball, a, n, left)."""
    low, high = share

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            for c, k, n, s in zip(*(batch.column(i) for i in range(1, 5))):
                held.append((np.frombuffer(c.as_py(), np.uint64), np.frombuffer(k.as_py(), np.int64),
                             unplanes(n.as_py(), np.uint32), unplanes(s.as_py(), np.uint32)))
        if not held:
            return
        code, key, n, left = (np.concatenate(x) for x in zip(*held))
        held.clear()
        order = np.argsort(code, kind="stable")
        same = code[order][1:] == code[order][:-1]
        member = np.zeros(len(code), bool)
        member[1:] |= same
        member[:-1] |= same
        at = order[member]
        at = at[np.lexsort((key[at], n[at], code[at]))]
        code, key, n, left = code[at], key[at], n[at].astype(np.int64), left[at].astype(np.int64)
        new = np.ones(len(code), bool)
        new[1:] = (code[1:] != code[:-1]) | (key[1:] != key[:-1])
        code, key, n, left = code[new], key[new], n[new], left[new]
        if not len(code):
            return
        begin = np.flatnonzero(np.concatenate(([True], code[1:] != code[:-1])))
        size = np.diff(np.append(begin, len(code)))
        ball = np.repeat(np.arange(len(begin)), size)
        # Partners of a member are the smaller ones (by place in n order) of at least low/high its size.
        least = (n * low + high - 1) // high
        base = np.int64(n.max() + 1)
        place = np.searchsorted(ball * base + n, ball * base + least)
        partners = np.arange(len(n)) - place
        dense = (np.add.reduceat(partners, begin) > PAIRS_EACH * size)[ball]
        few = np.where(dense, 0, partners)
        pairs = []
        for part in np.array_split(np.arange(len(n)), max(1, int(few.sum()) // 2_000_000)):
            x = np.repeat(part, few[part])
            y = ragged(place[part], few[part])
            ok = _possible(n[x], left[x], n[y], left[y], low, high)
            pairs.append(np.unique(np.stack([np.minimum(key[x[ok]], key[y[ok]]), np.maximum(key[x[ok]], key[y[ok]])], 1), axis=0))
        found = np.unique(np.concatenate(pairs), axis=0) if pairs else np.zeros((0, 2), np.int64)
        if len(found):
            none = pa.nulls(len(found), pa.int64())
            yield pa.RecordBatch.from_arrays([none, pa.array(found[:, 0]), pa.array(found[:, 1]), none, none],
                                             names=["ball", "a", "b", "n", "left"])
        if dense.any():
            rows = np.flatnonzero(dense)
            yield pa.RecordBatch.from_arrays([pa.array(code[rows].view(np.int64)), pa.array(key[rows]), pa.nulls(len(rows), pa.int64()),
                                              pa.array(n[rows]), pa.array(left[rows])], names=["ball", "a", "b", "n", "left"])
    return run


def _possible(n, left, m, rest, low: int, high: int):
    """Whether sets of sizes n and m with so many shingles left can be similar enough."""
    overlap = np.minimum(left, rest) if isinstance(n, np.ndarray) else F.least(left, rest)
    return overlap * (low + high) >= (n + m) * low


def _verify(pairs: DataFrame, sets: DataFrame, share: tuple[int, int]) -> DataFrame:
    """(a, b, distance, linked) of pairs, from the whole sets."""
    low, high = share

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            inter, n, m = [], [], []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                both = np.concatenate((x, y))
                both.sort(kind="stable")
                inter.append(int((both[1:] == both[:-1]).sum()))
                n.append(len(x))
                m.append(len(y))
            inter, union = np.array(inter, np.int64), np.array(n, np.int64) + np.array(m, np.int64)
            union -= inter
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(1 - inter / np.maximum(union, 1)),
                                              pa.array(inter * high >= union * low)], names=["a", "b", "distance", "linked"])

    ends = pairs.select(F.col("a").alias("key")).unionByName(pairs.select(F.col("b").alias("key"))).distinct()
    ends = kept(ends.withColumn("asked", F.lit(True)), "pair_ends")
    sets = small_join(sets, ends, "key", width=24).where("asked").select("key", "codes")
    # A pivot meets many documents: the join splits such keys while it runs.
    left = pairs.join(sets.select(F.col("key").alias("a"), F.col("codes").alias("x")), "a")
    both = left.join(sets.select(F.col("key").alias("b"), F.col("codes").alias("y")), "b")
    measured = both.select("a", "b", "x", "y").mapInArrow(released(run), "a bigint, b bigint, distance double, linked boolean")
    with small_batches(pairs.sparkSession):
        return kept(measured, "measured_pairs")


def _sets(docs: DataFrame, rows: DataFrame, keys: DataFrame, size: int) -> DataFrame:
    """(key, codes): the whole shingle set of each wanted key, from one of its documents."""
    one = rows.where("n > 0").groupBy("key").agg(F.min(F.struct("tie", "doc_id")).alias("row"))
    one = kept(one.join(keys, "key").select(_row("row.doc_id", "row.tie").alias("row"), F.lit(True).alias("wanted")), "set_rows")
    texts = small_join(docs.withColumn("row", _row("doc_id", "tie")), one, "row", width=48).where("wanted").select("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, powers = WordHasher(lower=True, slice_bytes=HASHED_BYTES), word_powers()
        for batch in sliced(batches, 0):
            sets = Shingles(batch.column(0), size, hasher, powers)
            codes = [sets.values[a:b].tobytes() for a, b in zip(sets.offsets[:-1].tolist(), sets.offsets[1:].tolist())]
            yield pa.RecordBatch.from_arrays([pa.array(sets.keys()), pa.array(codes, pa.binary())], names=["key", "codes"])

    # Equal rows give a set twice; distances and links of a pair stay the same.
    with small_batches(docs.sparkSession, 2000):
        return kept(texts.mapInArrow(released(run), "key bigint, codes binary"), "sets")


def _row(doc_id: str, tie: str) -> Column:
    """Tells rows apart, null ids included."""
    return F.struct(F.col(doc_id).isNull().alias("none"), F.coalesce(F.col(doc_id), F.lit(0)).alias("id"), F.col(tie).alias("tie"))


def _dense(members: DataFrame, found: DataFrame, sets: DataFrame, share: tuple[int, int]) -> DataFrame:
    """Components (key, label) after the dense balls, pivot turn by pivot turn. ``found``: pairs measured so far."""
    low, high = share
    radius = 1 - low / high
    spot = (F.shiftrightunsigned(F.xxhash64("a"), 11).cast("double") / float(1 << 53))  # of a key, in every ball the same
    members = members.withColumn("spot", spot)
    sizes = kept(members.groupBy("ball").agg(F.count(F.lit(1)).alias("size")), "balls")
    # First one pivot a ball, with the fewest shingles that come before the ball's: what near copies were made from has
    # few rare ones of its own. Most copies link to it, so that the many pivots later meet few documents of other components.
    first = members.groupBy("ball").agg(F.max(F.struct("left", "spot")).alias("first"))
    members = members.join(kept(first, "first_pivots"), "ball").withColumn("first", F.col("first") == F.struct("left", "spot"))
    done, pivots, most = 0, 0, sizes.agg(F.max("size")).first()[0] or 0
    labels = kept(components.label(found.where("linked")), "labels")
    while done < most:
        state = members.join(labels.select(F.col("key").alias("a"), "label"), "a", "left").withColumn("label", F.coalesce("label", "a"))
        open_balls = state.groupBy("ball").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count(F.lit(1)).alias("size"))
        state = kept(state.join(open_balls.where("lo != hi").select("ball", "size"), "ball"), "open_balls")
        if state.isEmpty():
            break
        members = state.drop("label", "size")  # a closed ball stays closed
        if pivots:
            chosen = state.where((F.col("spot") < F.lit(float(pivots)) / F.col("size")) & (F.col("spot") >= F.lit(float(done)) / F.col("size")))
        else:
            chosen = state.where("first")
        chosen = chosen.select("ball", F.col("a").alias("p"), F.col("n").alias("pn"), F.col("left").alias("pleft"), F.col("label").alias("plabel"))
        pair = state.join(chosen, "ball").where(
            (F.col("label") != F.col("plabel")) & (F.least("n", "pn") * high >= F.greatest("n", "pn") * low)
            & _possible(F.col("n"), F.col("left"), F.col("pn"), F.col("pleft"), low, high))
        pair = pair.select(F.least("a", "p").alias("a"), F.greatest("a", "p").alias("b")).distinct()
        pair = pair.join(found.select("a", "b"), ["a", "b"], "left_anti")
        # Voronoi regions: each document's nearest pivot so far, and how far that is.
        ends = found.select("a", "b", "distance").unionByName(found.select(F.col("b").alias("a"), F.col("a").alias("b"), "distance"))
        region = ends.groupBy("a").agg(F.min(F.struct("distance", "b")).alias("r")).select(
            "a", F.col("r.b").alias("centre"), F.col("r.distance").alias("near"))
        reach = ends.select(F.col("a").alias("centre"), "b", F.col("distance").alias("far"))
        window = pair.join(region, "a", "left").join(reach, ["centre", "b"], "left")
        # d(a, b) >= d(centre, b) - d(a, centre)
        pair = kept(window.where(F.coalesce(F.col("far") - F.col("near"), F.lit(0.0)) <= radius + 1e-9).select("a", "b"), "pairs")
        more = _verify(pair, sets, share)
        labels = kept(components.relabel(labels, more.where("linked")), "labels")
        found = found.unionByName(more)
        done, pivots = pivots, pivots * 16 or 16
    return labels


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = 5,
                    similarity: tuple[int, int] = (80, 100)) -> DataFrame:
    """(doc_id, tie, n_shingles, component_id) of each row, exactly.

    Two documents are linked if the Jaccard similarity of their shingle sets (runs of ``size``
    words) is at least ``similarity`` (a ratio). ``component_id`` is the smallest id in reach by links.
    ``tie`` is a hash of the text, to tell rows of one id apart. Shingles and sets are known by 64-bit hashes.

    Fewer words than ``size``: the whole sequence is one shingle. Null, empty and blank texts have
    no shingle and are linked with nothing, not even each other. Copies are one set with many
    documents. A null id takes part; the id of its component is the smallest known one. Other columns are not read.
    """
    spark = docs.sparkSession
    buckets = shuffle_partitions(spark)
    source = docs.select(col(doc_id).cast("bigint").alias("doc_id"), F.coalesce(F.xxhash64(col(text)), F.lit(0)).alias("tie"),
                         col(text).alias("text"))
    rows, often = _measure(source, size, buckets)
    top = often.orderBy(F.desc("df"), "bucket", "code").limit(MOST_FREQUENT).toArrow()
    value = top["bucket"].to_numpy().astype(np.uint64) << np.uint64(32) | top["code"].to_numpy().astype(np.uint64)
    order = np.argsort(value)
    frequent = value[order], np.log2(top["df"].to_numpy()[order]).astype(np.int64) + 1
    packed = _prefixes(source, size, similarity, frequent, buckets, buckets)
    with small_batches(spark, 2000):
        balls = kept(packed.repartition(buckets, "bucket").mapInArrow(
            released(_balls(similarity)), "ball bigint, a bigint, b bigint, n bigint, left bigint"), "balls")
    pairs = kept(balls.where("b is not null").select("a", "b").distinct(), "pairs")
    members = balls.where("b is null").select("ball", "a", "n", "left")
    keys = balls.select(F.col("a").alias("key")).unionByName(balls.where("b is not null").select(F.col("b").alias("key"))).distinct()
    sets = _sets(source, rows, keys, size)
    found = _verify(pairs, sets, similarity)
    labels = _dense(members, found, sets, similarity)
    classes = rows.where("n > 0").groupBy("key").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("copies"))
    classes = classes.join(labels, "key", "left").withColumn("group", F.coalesce("label", "key"))
    classes = kept(classes.where("copies > 1 or label is not null"), "classes")
    groups = classes.groupBy("group").agg(F.min("least").alias("component"))
    members = kept(classes.join(groups, "group").select("key", "group", "component"), "groups")
    joined = small_join(rows, members, "key", width=32)
    return joined.select("doc_id", "tie", F.col("n").alias("n_shingles"),
                         F.when(F.col("n") > 0, F.coalesce("component", "doc_id")).otherwise(F.col("doc_id")).alias("component_id"),
                         F.when(F.col("n") > 0, F.col("key")).alias("key"),
                         F.when(F.col("n") > 0, F.coalesce("group", "key")).alias("group"))


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One document of each component: the smallest id (null last), then the smallest text hash.

    Columns are unchanged. Documents without shingles all stay. Of equal rows in a component one stays.
    """
    found = kept(near_duplicates(docs, doc_id, text, **options), "near_duplicates")
    # Classes of a component: its least class stays, all others go.
    place = F.struct(F.col("doc_id").isNull().alias("none"), F.coalesce("doc_id", F.lit(0)).alias("id"), F.col("tie").alias("tie"))
    rows = found.where("key is not null").select("group", place.alias("place"))
    grouped = rows.groupBy("group").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    chosen = kept(grouped.select("group", "first"), "first_documents")
    gone = small_join(rows, chosen, "group", width=48).where("first is not null and first != place")
    gone = kept(gone.select("place").distinct().withColumn("gone", F.lit(True)), "later_documents")
    twice = rows.groupBy("place").count().where("count > 1")
    mark, again = fresh(docs.columns, "place"), fresh(docs.columns, "gone")
    tie = F.coalesce(F.xxhash64(col(text)), F.lit(0))
    own = F.struct(col(doc_id).isNull().alias("none"), F.coalesce(col(doc_id).cast("bigint"), F.lit(0)).alias("id"), tie.alias("tie"))
    side = gone.select(F.col("place").alias(mark), F.col("gone").alias(again))
    left = small_join(docs.withColumn(mark, own), side, mark, width=48).where(F.col(again).isNull()).drop(again)
    if not twice.isEmpty():  # the same row more than once: one of them stays
        shingled = F.size(F.filter(F.split(F.coalesce(col(text), F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")) > 0
        only = F.when(shingled, F.lit(0)).otherwise(F.monotonically_increasing_id())
        number = fresh([*docs.columns, mark], "number")
        left = left.withColumn(number, only).dropDuplicates([mark, number]).drop(number)
    return left.drop(mark)


def report(docs: DataFrame) -> DataFrame:
    """The rows of ``op5_jaccard_join``."""
    return near_duplicates(docs).select("doc_id", "n_shingles", "component_id")
