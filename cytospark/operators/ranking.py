"""Exact, repeatable sampling and folds without sorting whole groups.

Rows are ordered by a hash of their keys. A draw of k rows from a group is
then "hash <= cutoff", where the cutoff is the k-th smallest hash of the group.
The cutoffs are found in a trie of hash prefixes that grows only where a cutoff lies:

1. rows are counted by (group, short prefix), which pre-aggregates on the map side;
2. the hashes under the prefixes in which a k-th hash lies are stored, a small share of them all;
3. a prefix with many rows is counted again by longer prefixes, until it holds few, and those are ordered.

No task ever orders more than ``LEAF_ROWS`` rows of a group, however large that is; the table is read twice, and
applying a cutoff is a map-only filter. Keys should identify a row; rows with equal keys fall on the same side.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cytospark.functions.names import col, cols
from cytospark.operators.sizing import join_summary, null_safe_join, settle
from cytospark.session import durable

PREFIX_DIGITS = 3  # digits that a prefix grows by: 16**3 children
#: A prefix with more rows is refined before they are ordered.
LEAF_ROWS = 16_384
HASH_DIGITS = 32

Quota = Callable[[Column], Column]


def order_hash(keys: Sequence[str], seed: Column | int | str = 42) -> Column:
    """Hash text that orders rows; the same text in any SQL engine."""
    first = seed if isinstance(seed, Column) else F.lit(str(seed))
    return F.md5(F.concat_ws("|", first, *[col(k).cast("string") for k in keys]))


def cutoffs(
    df: DataFrame,
    groups: Sequence[str],
    keys: Sequence[str],
    quotas: Sequence[Quota],
    seed: int | str = 42,
    prefix_digits: int = PREFIX_DIGITS,
    leaf_rows: int = LEAF_ROWS,
) -> DataFrame:
    """Hash cutoffs per group: groups, n, cutoffs (array aligned to quotas).

    ``quotas[i]`` maps the group size to a row count; a count of 0 gives an
    empty-text cutoff, which no hash reaches.
    """
    g = list(groups) or ["_all"]
    rows = df.select(*(cols(groups) if groups else [F.lit(1).alias("_all")]),
                     order_hash(keys, seed).alias("_hash"))
    length = prefix_digits
    counts = rows.groupBy(*cols(g), F.substring("_hash", 1, length).alias("_prefix")).agg(F.count(F.lit(1)).alias("_c"))
    counts = settle(counts, "prefix_counts").withColumn("_parent", F.lit(""))
    sizes = counts.groupBy(*cols(g)).agg(F.sum("_c").alias("n"))
    each = F.array(*[F.struct(F.lit(i).alias("q"), quota(F.col("n")).cast("long").alias("k")) for i, quota in enumerate(quotas)])
    wanted = sizes.select(*cols(g), F.lit("").alias("_parent"), F.inline(each))
    hits = None
    while True:
        spots = settle(_spots(counts, wanted, g), "cutoff_spots")
        # Equal hashes need no order: the whole hash is the cutoff.
        leaf = F.lit(length >= HASH_DIGITS) | (F.col("_c") <= leaf_rows)
        rows = null_safe_join(rows.withColumn("_prefix", F.substring("_hash", 1, length)), spots.select(*cols(g), "_prefix").distinct(), [*g, "_prefix"])
        rows = durable(rows, "prefix_rows")
        found = _ordered(rows, spots.filter(leaf), g) if length < HASH_DIGITS else spots.select(*cols(g), "q", F.col("_prefix").alias("_hash"))
        hits = found if hits is None else hits.unionByName(found)
        deep = spots.filter(~leaf)
        if deep.isEmpty():
            break
        wanted = deep.select(*cols(g), F.col("_prefix").alias("_parent"), "q", F.col("_r").alias("k"))
        rows = rows.drop("_prefix")
        parent = F.substring("_hash", 1, length).alias("_parent")
        length = min(length + prefix_digits, HASH_DIGITS)
        below = null_safe_join(rows.withColumn("_parent", parent), wanted.select(*cols(g), "_parent").distinct(), [*g, "_parent"])
        counts = settle(below.groupBy(*cols(g), "_parent", F.substring("_hash", 1, length).alias("_prefix")).agg(
            F.count(F.lit(1)).alias("_c")), "prefix_counts")
    found = hits.groupBy(*cols(g)).agg(
        F.map_from_entries(F.collect_list(F.struct("q", "_hash"))).alias("_m")
    )
    # A quota of 0 has no cutoff row.
    out = null_safe_join(sizes, found, g, "left").select(
        *cols(g),
        "n",
        F.array(*[
            F.coalesce(F.try_element_at("_m", F.lit(i)), F.lit("")) for i in range(len(quotas))
        ]).alias("cutoffs"),
    )
    return out if groups else out.drop("_all")


def _spots(counts: DataFrame, wanted: DataFrame, g: Sequence[str]) -> DataFrame:
    """The prefix that holds each wanted row, its count, and which of its rows that is."""
    running = W.partitionBy(*cols(g), "_parent").orderBy("_prefix").rowsBetween(W.unboundedPreceding, W.currentRow)
    upto = counts.withColumn("_upto", F.sum("_c").over(running))
    inside = (F.col("k") > F.col("_upto") - F.col("_c")) & (F.col("k") <= F.col("_upto"))
    return null_safe_join(upto, wanted, [*g, "_parent"]).filter(inside).select(
        *cols(g), "q", "_prefix", "_c", (F.col("k") - F.col("_upto") + F.col("_c")).alias("_r"))


def _ordered(rows: DataFrame, spots: DataFrame, g: Sequence[str]) -> DataFrame:
    """The hash of each wanted row of a small prefix."""
    place = F.row_number().over(W.partitionBy(*cols(g), "_prefix").orderBy("_hash")).cast("long")
    few = null_safe_join(rows, spots.select(*cols(g), "_prefix").distinct(), [*g, "_prefix"])
    return null_safe_join(few.withColumn("_r", place), spots.drop("_c"), [*g, "_prefix", "_r"]).select(*cols(g), "q", "_hash")


def with_cutoffs(df: DataFrame, groups: Sequence[str], keys: Sequence[str],
                 quotas: Sequence[Quota], seed: int | str = 42) -> DataFrame:
    """Rows with their hash, group size and the group's cutoffs."""
    cut = cutoffs(df, groups, keys, quotas, seed)
    hashed = df.withColumn("_hash", order_hash(keys, seed))
    if groups:
        return join_summary(hashed, cut, groups)
    return hashed.crossJoin(F.broadcast(cut))  # one row


def sample_groups(df: DataFrame, groups: Sequence[str], keys: Sequence[str],
                  quota: Quota, seed: int | str = 42) -> DataFrame:
    """Exactly ``quota(n)`` rows of every group, without replacement."""
    cut = with_cutoffs(df, groups, keys, [quota], seed)
    return cut.filter(F.col("_hash") <= F.col("cutoffs")[0]).select(cols(df.columns))


def fraction_quota(frac: float, min_count: int = 0) -> Quota:
    """Half-even rounded share of a group; nothing from groups below the minimum."""
    def quota(n: Column) -> Column:
        return F.when(n < min_count, F.lit(0)).otherwise(F.bround(n * F.lit(float(frac)), 0)).cast("long")
    return quota


def capped_quota(limit: int) -> Quota:
    return lambda n: F.least(n, F.lit(limit).cast("long"))


def preview_quota(limit: int = 1000, frac: float = 0.1, above: int = 1000) -> Quota:
    """min(limit, frac * n) rows of a table with more than ``above`` rows, else all."""
    return lambda n: F.when(
        n > above, F.least(F.lit(limit).cast("long"), F.floor(n * F.lit(frac)))
    ).otherwise(n)


def stratified_sample(df: DataFrame, groups: Sequence[str], keys: Sequence[str],
                      frac: float, min_count: int = 3, seed: int | str = 42) -> DataFrame:
    return sample_groups(df, groups, keys, fraction_quota(frac, min_count), seed)


def train_test(df: DataFrame, groups: Sequence[str], keys: Sequence[str],
               test_size: float = 0.33, seed: int | str = 101) -> DataFrame:
    """Adds ``is_test``: the rounded share of every class, by hash order."""
    cut = with_cutoffs(df, groups, keys, [fraction_quota(test_size)], seed)
    return cut.withColumn("is_test", F.col("_hash") <= F.col("cutoffs")[0]).drop("_hash", "n", "cutoffs")


def _block_ends(folds: int) -> list[Quota]:
    """Ends of the first folds - 1 of contiguous blocks; sizes differ by one at most."""
    def end(i: int) -> Quota:
        return lambda n: F.floor(n / folds) * i + F.least(F.lit(i).cast("long"), n % folds)
    return [end(i) for i in range(1, folds)]


def fold_ids(df: DataFrame, groups: Sequence[str], keys: Sequence[str], folds: int = 10,
             seed: int | str = 7, name: str = "fold") -> DataFrame:
    """Adds a fold id: contiguous blocks of the hash order within each group."""
    if folds < 2:
        return df.withColumn(name, F.lit(0))
    cut = with_cutoffs(df, groups, keys, _block_ends(folds), seed)
    fold = F.size(F.filter("cutoffs", lambda c: c < F.col("_hash")))
    return cut.withColumn(name, fold).drop("_hash", "n", "cutoffs")


def repeated_folds(df: DataFrame, groups: Sequence[str], keys: Sequence[str], folds: int = 2,
                   repeats: int = 3, seed: int = 1) -> DataFrame:
    """Every row once per repeat, with columns ``repeat`` and ``fold``.

    Stratified by the groups. The repeats differ only in the seed.
    """
    out = df
    for r in range(repeats):
        out = fold_ids(out, groups, keys, folds, f"{seed}.{r}", f"_fold{r}")
    packed = F.explode(F.array(*[
        F.struct(F.lit(r).alias("repeat"), F.col(f"_fold{r}").alias("fold")) for r in range(repeats)
    ]))
    return out.withColumn("_rf", packed).select(*cols(df.columns), "_rf.repeat", "_rf.fold")


def bounded_train_test(df: DataFrame, groups: Sequence[str], keys: Sequence[str],
                       test_size: float = 0.33, seed: int | str = 101) -> DataFrame:
    """``train_test`` by window ranks, in one shuffle.

    Only for groups of bounded size, such as capped training sets.
    """
    part = W.partitionBy(*cols(groups))
    rank = F.row_number().over(part.orderBy(order_hash(keys, seed)))
    size = F.count(F.lit(1)).over(part)
    return df.withColumn("is_test", rank <= fraction_quota(test_size)(size))


def bounded_folds(df: DataFrame, groups: Sequence[str], keys: Sequence[str], folds: int,
                  seed: Column | int | str = 7, name: str = "fold") -> DataFrame:
    """``fold_ids`` by window ranks, in one shuffle; only for groups of bounded size."""
    part = W.partitionBy(*cols(groups))
    order = order_hash(keys, seed)
    ranked = df.select("*", F.row_number().over(part.orderBy(order)).alias("_rn"),
                       F.count(F.lit(1)).over(part).alias("_n"))
    size, longer = F.floor(F.col("_n") / folds), F.col("_n") % folds
    fold = F.when(
        F.col("_rn") <= (size + 1) * longer, F.floor((F.col("_rn") - 1) / (size + 1))
    ).otherwise(F.floor((F.col("_rn") - 1 - longer) / F.greatest(size, F.lit(1))))
    return ranked.withColumn(name, fold.cast("int")).drop("_rn", "_n")


def bounded_repeats(df: DataFrame, groups: Sequence[str], keys: Sequence[str], folds: int = 2,
                    repeats: int = 3, seed: int = 1) -> DataFrame:
    """``repeated_folds`` by window ranks; only for groups of bounded size."""
    copies = df.withColumn("repeat", F.explode(F.array(*[F.lit(r) for r in range(repeats)])))
    text = F.concat(F.lit(f"{seed}."), F.col("repeat").cast("string"))
    return bounded_folds(copies, [*groups, "repeat"], keys, folds, text)


def class_caps(df: DataFrame, label: str, keys: Sequence[str], limit: int = 3000,
               min_labels: int = 20, seed: int | str = 42) -> DataFrame:
    """One-vs-rest training sets for every class with enough labels.

    Per class at most ``limit`` rows of the class and ``limit`` of the rest, as
    columns ``celltype`` and ``target`` beside the row. No class has more than
    ``limit`` of the candidates, so the ``limit`` smallest hashes of "all
    rows but class k" lie among the 2 * ``limit`` smallest of all candidates: as
    many rows as the result has are made, whatever the number of classes.
    """
    top = sample_groups(df, [label], keys, capped_quota(limit), seed).withColumn(
        "_hash", order_hash(keys, seed)
    )
    sizes = df.groupBy(col(label).alias("celltype")).agg(F.count(F.lit(1)).alias("_labels"))
    classes = sizes.filter(F.col("_labels") >= min_labels).select("celltype")
    own = top.join(classes.withColumn("_own", F.col("celltype")), col(label) == F.col("_own")).drop("_own").withColumn("target", F.lit(1))
    smallest = F.broadcast(top.filter(col(label).isNotNull()).orderBy("_hash", *cols(keys)).limit(2 * limit))  # bounded by the limit
    rest = classes.crossJoin(smallest).filter(~col(label).eqNullSafe(F.col("celltype"))).withColumn("target", F.lit(0))
    pairs = own.unionByName(rest)
    order = W.partitionBy("celltype", "target").orderBy("_hash", *cols(keys))
    return pairs.withColumn("_rn", F.row_number().over(order)).filter(
        F.col("_rn") <= limit
    ).drop("_rn", "_hash")
