"""A Merkle manifest of a dataset, its leaves placed by bitmap ranks.

A leaf's place in its group is the rank of its id. Ids are or-ed into 64-bit words of one
bitmap a group; each non-empty word of the merged bitmap carries how many
ids come before it. A rank is then that number plus the bits below the id in its word: no group
is sorted. Ranks key the slots of fixed-size blocks; a block is reduced by several levels at once,
and the digests of blocks are the nodes of the next pass.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cytospark.llm.tables import col, kept, small_join

ARITY = 3
#: Levels that one pass reduces; a block has ARITY ** LEVELS slots.
LEVELS = 7
SLOTS = ARITY ** LEVELS
#: Words of the bitmap that share an entry of the upper directory.
_SUPER_BITS = 12


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def _hash(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def leaves(docs: DataFrame, doc_id: str = "doc_id", group: str = "source", others: tuple[str, ...] = ("lang", "n_chars"),
           text: str = "text") -> DataFrame:
    """(group, id, leaf, tampered) of every row. ``tampered`` is null where the tampered row gives the same leaf."""
    before = [_field(col(c)) for c in (doc_id, group, *others)]
    cut = F.regexp_replace(col(text), "\n", "")
    chosen = F.crc32(F.coalesce(col(doc_id).cast("string"), F.lit("")).cast("binary")) % 2 == 0
    changed = chosen & F.coalesce(col(text).contains("\n"), F.lit(False))
    return docs.select(
        col(group).cast("string").alias("group"), col(doc_id).cast("long").alias("id"),
        _hash(*before, _field(col(text))).alias("leaf"),
        F.when(changed, _hash(*before, _field(cut))).alias("tampered"))


def directory(rows: DataFrame) -> DataFrame:
    """(group, word, bits, count, base, size) of every non-empty word of the groups' bitmaps.

    ``bits`` are the ids 64 * word to 64 * word + 63 that occur, ``count`` the rows of the word (more than its
    bits if ids repeat), ``base`` the rows of the group before it, ``size`` those of the group. Rows without an id are
    a word of their own, the first.
    """
    bit = F.expr("shiftleft(1L, cast(id & 63 as int))")
    words = kept(rows.groupBy("group", F.shiftright("id", 6).alias("word")).agg(
        F.coalesce(F.bit_or(bit), F.lit(0).cast("long")).alias("bits"), F.count(F.lit(1)).alias("count")), "bitmap_words")
    upper = F.shiftright("word", _SUPER_BITS).alias("super")
    sums = words.groupBy("group", upper).agg(F.sum("count").alias("n"))
    before = lambda w: F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ordered = Window.partitionBy("group").orderBy(F.asc_nulls_first("super"))
    sums = sums.select("group", "super", before(ordered).alias("above"), F.sum("n").over(Window.partitionBy("group")).alias("size"))
    inside = Window.partitionBy("group", "super").orderBy(F.asc_nulls_first("word"))
    words = words.select("*", upper, F.col("count").alias("n")).withColumn("inner", before(inside))
    return words.alias("w").join(sums.alias("s"), F.col("w.group").eqNullSafe(F.col("s.group")) & F.col("w.super").eqNullSafe(F.col("s.super"))).select(
        "w.group", "w.word", "w.bits", "w.count", (F.col("s.above") + F.col("w.inner")).alias("base"), "s.size")


def ranked(rows: DataFrame, words: DataFrame) -> DataFrame:
    """Rows with ``rank`` (from 0) in their group and the group's ``size``."""
    word = F.shiftright("id", 6)
    joined = rows.alias("r").join(words.alias("w"), F.col("r.group").eqNullSafe(F.col("w.group")) & word.eqNullSafe(F.col("w.word")))
    joined = joined.select("r.*", "w.word", "w.bits", "w.count", "w.base", "w.size")
    below = F.expr("bit_count(bits & ~shiftleft(-1L, cast(id & 63 as int)))")
    single = F.col("count") == F.bit_count("bits")
    out = joined.where(single).select(*rows.columns, (F.col("base") + below).alias("rank"), "size")
    if words.where(~single).isEmpty():
        return out
    # Ids that repeat, or rows without one, share a bit: only such words are ordered row by row.
    order = Window.partitionBy("group", "word").orderBy(F.asc_nulls_first("id"), "leaf")
    rest = joined.where(~single).withColumn("rank", F.col("base") + F.row_number().over(order) - 1)
    return out.unionByName(rest.select(*out.columns))


def _node(level: int, at: str) -> str:
    return f"coalesce(get(n{level}, cast({at} as int)), '')"


def _with_levels(blocks: DataFrame) -> DataFrame:
    """Adds the nodes of every level inside the block, ``n0`` (the slots) to ``n7`` (one node).

    The one node of a group that is in one block stays as it is.
    """
    # Not items.node: the optimiser would copy that into every use.
    out = blocks.selectExpr("*", "transform(items, x -> x.node) as n0")
    for level in range(LEVELS):
        run = ", ".join(_node(level, f"{ARITY} * i + {j}") for j in range(ARITY))
        out = out.selectExpr("*", f"""
            if(size <= {SLOTS} and size(n{level}) = 1, n{level},
               transform(sequence(0, cast((size(n{level}) - 1) div {ARITY} as int)), i -> sha2(concat({run}), 256))) as n{level + 1}""")
    return out


def _path(slot: str) -> str:
    """The steps of a slot to the top of its block: the siblings left and right of its node at each level that is hashed."""
    steps = []
    for level in range(LEVELS):
        at = f"{slot} div {ARITY ** level}"
        a, b, c = (_node(level, f"{slot} div {ARITY ** (level + 1)} * {ARITY} + {j}") for j in range(ARITY))
        steps.append(f"""case when size > {SLOTS} or size(n{level}) > 1 then named_struct(
            'left', case {at} % {ARITY} when 0 then '' when 1 then {a} else concat({a}, {b}) end,
            'right', case {at} % {ARITY} when 0 then concat({b}, {c}) when 1 then {c} else '' end) end""")
    return f"filter(array({', '.join(steps)}), s -> s is not null)"


def _blocks(nodes: DataFrame, name: str) -> DataFrame:
    """(key, size, items, digest) a block, stored: the slot array of its nodes and what it reduces to.

    ``nodes``: group, size (of the group), rank, node and further columns, which the items keep.
    """
    more = [c for c in nodes.columns if c not in ("group", "size", "rank", "node")]
    item = F.struct((F.col("rank") % SLOTS).cast("int").alias("slot"), "node", *more)
    key = F.struct("group", F.floor(F.col("rank") / SLOTS).cast("long").alias("block")).alias("key")
    grouped = nodes.groupBy(key).agg(F.first("size").alias("size"), F.sort_array(F.collect_list(item)).alias("items"))
    return kept(_with_levels(grouped).select("key", "size", "items", F.col(f"n{LEVELS}")[0].alias("digest")), name)


def _upper(blocks: DataFrame, depth: int) -> DataFrame:
    """(key, path, top): the steps from each block's digest to the top of its group, and that top."""
    if not blocks.where(F.col("size") > SLOTS).isEmpty():
        parents = _blocks(blocks.select(
            F.col("key.group").alias("group"), F.ceil(F.col("size") / SLOTS).cast("long").alias("size"),
            F.col("key.block").alias("rank"), F.col("digest").alias("node")), f"merkle_blocks_{depth}")
        return kept(_climbed(parents, _upper(parents, depth + 1)).select(
            F.struct(F.col("key.group").alias("group"), F.col("item.rank").alias("block")).alias("key"), "path", "top"),
            f"merkle_paths_{depth}")
    none = F.array().cast("array<struct<left:string,right:string>>")
    return blocks.select("key", none.alias("path"), F.col("digest").alias("top"))


def _climbed(blocks: DataFrame, upper: DataFrame) -> DataFrame:
    """(key, item, path, top) of every slot; ``item.rank`` is its rank in the group."""
    # Blocks hold up to SLOTS nodes each, so there are few; beyond a counted bound the join is a shuffle.
    joined = small_join(blocks, upper, "key", max_bytes=64 << 20, width=4096)
    flat = _with_levels(joined).selectExpr("key", "top", f"""explode(transform(items, x -> named_struct(
        'item', x, 'rank', key.block * {SLOTS} + x.slot, 'path', concat({_path("x.slot")}, path)))) as x""")
    return flat.select("key", F.struct("x.rank", "x.item.*").alias("item"), "x.path", "top")


def _numbered(groups: DataFrame, stored: str) -> DataFrame:
    """(group, rank): groups in the bytewise order of their names, null first, numbered over sorted partitions."""
    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([part] * n, pa.int32()), pa.array(range(seen, seen + n), pa.int64())],
                names=["group", "part", "place"])
            seen += n

    ordered = F.asc_nulls_first("group")
    placed = kept(groups.select("group").repartitionByRange(ordered).sortWithinPartitions(ordered).mapInArrow(
        number, "group string, part int, place bigint"), stored)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a partition
    sums = placed.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    sums = sums.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return placed.join(sums, "part").select("group", (F.col("base") + F.col("place")).alias("rank"))


def build(docs: DataFrame, doc_id: str = "doc_id", group: str = "source", others: tuple[str, ...] = ("lang", "n_chars"),
          text: str = "text") -> DataFrame:
    """(doc_id, leaf, tampered, subroot, root, path) of every row: ``path`` lists the steps from leaf to root.

    A step holds the digests left and right of the node; their hash with the node between is the next one.
    Rows of equal id in a group are placed by their leaf; rows without an id come first, and equal
    rows take consecutive places. A group of any size is split into blocks of 3**7 leaves; bitmaps and blocks are
    all that is grouped. Null values count as ``-`` and a null group is one of its own. Other columns are not
    read. An empty table gives no rows.
    """
    rows = kept(leaves(docs, doc_id, group, others, text), "leaves")
    words = kept(directory(rows), "bitmap_directory")
    blocks = _blocks(ranked(rows, words).withColumnRenamed("leaf", "node"), "merkle_blocks")
    upper = _upper(blocks, 1)
    tops = kept(upper.where(F.col("key.block") == 0).select(F.col("key.group").alias("group"), F.col("top").alias("node")), "subroots")
    named = _numbered(tops, "group_order").alias("n").join(tops.alias("t"), F.col("n.group").eqNullSafe(F.col("t.group")))
    top = _blocks(named.select(F.lit(None).cast("string").alias("group"), F.lit(tops.count()).alias("size"), "n.rank", "t.node",
                               F.col("n.group").alias("name")), "merkle_top")
    roots = _climbed(top, _upper(top, 101)).select(F.struct(F.col("item.name").alias("group")).alias("at"),
                                                    F.col("path").alias("rest"), F.col("top").alias("root"))
    flat = _climbed(blocks, upper).withColumn("at", F.struct("key.group"))
    joined = small_join(flat, kept(roots, "roots"), "at", width=4096)
    return joined.select(
        F.col("item.id").alias("doc_id"), F.col("item.node").alias("leaf"), F.col("item.tampered").alias("tampered"),
        F.col("top").alias("subroot"), "root", F.concat("path", "rest").alias("path"))


def fold(node: Column, path: Column) -> Column:
    """The root that a leaf and the siblings on its path give."""
    return F.aggregate(path, node, lambda at, s: _hash(s["left"], at, s["right"]))


def proof(path: Column) -> Column:
    """Digest of all siblings on a path, in order."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def report(docs: DataFrame, **columns) -> DataFrame:
    """The rows of ``op12_merkle_manifest``: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified."""
    made = build(docs, **columns)
    out = made.select("doc_id", "leaf", "subroot", "root", proof(F.col("path")).alias("proof_sha256"),
                      fold(F.coalesce("tampered", "leaf"), F.col("path")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
