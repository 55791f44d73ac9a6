"""Line dedup by exact text and by a log-template tree; DataFrame functions only.

A line is parsed at fixed depth: its number of tokens, then its leading tokens;
a token with a digit is a variable field and stands for any value. A leaf keeps several
templates: its commonest line is a model, lines that agree with it in most tokens have
its template, the differing tokens being variable too; the commonest line left is the next
model, and so on. A line recurs if its exact tokens stand in two documents or its template in
several; it is then dropped everywhere but in the first of them. A document is a row: copies
of a text count one by one, and only one of them can be the first.

Only hashes of lines are shuffled. The tokens of a line are looked up again where a leaf
holds several different lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cytospark.llm.tables import col, kept, small_join
from cytospark.llm.texts import fresh

#: What a variable field looks like in a template.
FIELD = "<*>"


#: A token that can hold a template together; the others are fields, numbers, marks.
LETTER = r"\p{L}"
#: Lines without any of these have no token but such.
ODD = r"[0-9]|(?<!\S)[^\s\p{L}]+(?!\S)"
#: Models tried in one turn over the leaves: the first turn, and later ones at most.
FIRST_MODELS, MOST_MODELS = 16, 256


def words_of(line: Column) -> Column:
    """Tokens of a line as they are."""
    return F.filter(F.split(line, r"\s+"), lambda t: t != "")


def _fields(line: Column, words: Column) -> Column:
    masked = F.transform(words, lambda t: F.when(t.rlike("[0-9]"), F.lit(FIELD)).otherwise(t))
    return F.when(line.rlike("[0-9]"), masked).otherwise(words)


def tokens_of(line: Column) -> Column:
    """Tokens of a line, those with a digit replaced by a field."""
    return _fields(line, words_of(line))


def _constants(tokens: Column) -> Column:
    return F.size(F.filter(tokens, lambda t: (t != FIELD) & t.rlike(LETTER)))


def parse(docs: DataFrame, depth: int = 3, min_tokens: int = 3) -> DataFrame:
    """Of (doc, rank, text): (doc, rank, line, leaf, shape, exact) for each line of ``min_tokens`` tokens or more.

    ``leaf`` hashes the path through the tree, ``shape`` the tokens with fields, ``exact`` the tokens as
    they are. A line of which less than half the tokens are constant words has no template but its exact tokens.
    """
    rows = docs.select("doc", "rank", F.posexplode(F.split("text", "\n", -1)).alias("line", "t"))
    rows = rows.select("doc", "rank", "line", "t", words_of(F.col("t")).alias("words")).where(F.size("words") >= min_tokens)
    rows = rows.withColumn("tokens", _fields(F.col("t"), F.col("words")))
    enough = F.when(F.col("t").rlike(ODD), 2 * _constants(F.col("tokens")) >= F.size("tokens")).otherwise(True)
    exact = F.xxhash64("words")
    return rows.select(
        "doc", "rank", "line",
        F.when(enough, F.xxhash64(F.size("tokens"), F.slice("tokens", 1, depth))).otherwise(exact).alias("leaf"),
        F.when(enough, F.xxhash64("tokens")).otherwise(exact).alias("shape"), exact.alias("exact"))


def _alike(a: Column, b: Column, similarity: float) -> Column:
    """Most tokens agree, and half of them are constant words that agree."""
    same = F.filter(F.zip_with(a, b, lambda x, y: F.when(x == y, x)), lambda x: x.isNotNull())
    return (F.size(same) >= similarity * F.size(a)) & (2 * _constants(same) >= F.size(a))


def _with_partners(rest: DataFrame, similarity: float, depth: int) -> DataFrame:
    """The shapes that some other shape of their leaf can be like.

    Tokens after the path are cut into one block more than may differ, so alike shapes agree in a block.
    """
    size, after = F.size("tokens"), F.greatest(F.size("tokens") - depth, F.lit(0))
    n = F.least(size - F.ceil(similarity * size).cast("int") + 1, F.greatest(after, F.lit(1)))
    n = F.when(size - F.ceil(similarity * size).cast("int") >= after, 1).otherwise(n)
    start = lambda i: F.lit(depth + 1) + F.floor(i * after / n).cast("int")
    part = lambda i: F.when(n > 1, F.slice("tokens", start(i), start(i + 1) - start(i)))
    blocks = rest.select("leaf", "shape", F.explode(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.xxhash64(
        "leaf", i, part(i)))).alias("block"))
    shared = blocks.groupBy("block").count().where(F.col("count") > 1)
    return rest.join(blocks.join(shared, "block", "left_semi").select("shape").distinct(), "shape", "left_semi")


def _models(rest: DataFrame, most: int, similarity: float) -> DataFrame:
    """(leaf, models): of the commonest ``most`` shapes of each leaf those that are like none before them."""
    place = F.row_number().over(Window.partitionBy("leaf").orderBy(F.desc("docs"), F.desc("shape")))
    top = rest.select("leaf", "shape", "tokens", place.alias("n")).where(F.col("n") <= most)
    lists = top.groupBy("leaf").agg(F.sort_array(F.collect_list(F.struct("n", "shape", "tokens"))).alias("top"))
    start = F.slice("top", 1, 0)
    step = lambda acc, x: F.when(F.exists(acc, lambda m: _alike(x["tokens"], m["tokens"], similarity)), acc).otherwise(
        F.concat(acc, F.array(x)))
    return lists.select("leaf", F.aggregate("top", start, step).alias("models"))


def _generalised(found: DataFrame, similarity: float, min_docs: int, depth: int) -> DataFrame:
    """Of (leaf, shape, docs, tokens): (shape, template), a template being the model that the shape has.

    Each shape has the first model it is like, models in the order of their documents; the turns go on
    until no leaf has shapes of ``min_docs`` documents left. They give what one model a turn would give.
    """
    rest, out, most = found, None, FIRST_MODELS
    while True:
        models = _models(rest, most, similarity)
        hit = F.get(F.filter("models", lambda m: _alike(F.col("tokens"), m["tokens"], similarity)), F.lit(0))["shape"]
        turn = kept(rest.join(models, "leaf").select("leaf", "shape", "docs", "tokens", hit.alias("template")), "templates_turn")
        named = turn.where(F.col("template").isNotNull()).select("shape", "template")
        out = named if out is None else out.unionByName(named)
        left = turn.where(F.col("template").isNull()).drop("template")
        leaves = left.groupBy("leaf").agg(F.sum("docs").alias("all")).where(F.col("all") >= min_docs)
        left = kept(left.join(leaves, "leaf", "left_semi"), "shapes_left")
        if left.isEmpty():
            return out
        # A shape that nothing is like is a template of its own, and is no one's model.
        rest = kept(_with_partners(left, similarity, depth), "shapes_with_partners")
        alone = left.where(F.col("docs") >= min_docs).join(rest.select("shape"), "shape", "left_anti")
        out = out.unionByName(alone.select("shape", F.col("shape").alias("template")))
        if rest.isEmpty():
            return out
        most = min(4 * most, MOST_MODELS)


def _template_of(docs: DataFrame, shapes: DataFrame, similarity: float, min_docs: int, depth: int) -> DataFrame:
    """(shape, template) of the shapes in leaves that ``min_docs`` documents or more reach."""
    leaves = shapes.groupBy("leaf").agg(F.sum("docs").alias("all"), F.count(F.lit(1)).alias("kinds"))
    busy = kept(shapes.join(leaves.where(F.col("all") >= min_docs), "leaf")
                .select("leaf", "shape", "docs", "kinds", "at_doc", "at_line"), "busy_shapes")
    several = busy.where(F.col("kinds") > 1)
    # One place of each shape gives its tokens back.
    places = kept(several.groupBy(F.col("at_doc").alias("doc")).agg(
        F.collect_list(F.struct("leaf", "shape", "docs", "at_line")).alias("wanted")), "shape_places")
    texts = small_join(docs.select("doc", "text"), places, "doc", width=512).where(F.col("wanted").isNotNull())
    found = texts.select(F.split("text", "\n", -1).alias("lines"), F.explode("wanted").alias("w")).select(
        "w.leaf", "w.shape", "w.docs", tokens_of(F.element_at("lines", F.col("w.at_line") + 1)).alias("tokens"))
    found = kept(found.groupBy("leaf", "shape", "docs").agg(F.first("tokens").alias("tokens")), "shape_tokens")
    alike = _generalised(found, similarity, min_docs, depth)
    return busy.where(F.col("kinds") == 1).select("shape", F.col("shape").alias("template")).unionByName(alike)


def _rank(doc_id: str) -> Column:
    return F.struct(col(doc_id).isNull().alias("last"), col(doc_id).alias("id"))


def copies_of(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, rows, first, tied) of each text in several rows: their number, the least rank, and how many have it."""
    rows = docs.where(col(text).isNotNull()).select(F.xxhash64(col(text)).alias("doc"), _rank(doc_id).alias("rank"))
    rows = rows.groupBy("doc", "rank").agg(F.count(F.lit(1)).alias("n"))
    return rows.groupBy("doc").agg(F.sum("n").alias("rows"), F.min("rank").alias("first"),
                                   F.min_by("n", "rank").alias("tied")).where(F.col("rows") > 1)


def recurring_lines(docs: DataFrame, copies: DataFrame, doc_id: str = "doc_id", text: str = "text", depth: int = 3,
                    min_tokens: int = 3, similarity: float = 0.7, min_docs: int = 5, min_copies: int = 2) -> DataFrame:
    """(doc, gone, again): for each text (by hash) the lines that are dropped from its first row, and from its other rows.

    Exact lines recur in ``min_copies`` documents, templates in ``min_docs``.
    """
    source = docs.where(col(text).isNotNull()).select(
        F.xxhash64(col(text)).alias("doc"), _rank(doc_id).alias("rank"), col(text).alias("text"))
    lines = kept(parse(source, depth, min_tokens), "lines")
    once = lines.groupBy("leaf", "shape", "exact", "doc").agg(F.min("rank").alias("rank"), F.min("line").alias("line"))
    once = small_join(once, copies.select("doc", "rows"), "doc", width=32).withColumn("rows", F.coalesce("rows", F.lit(1)))
    once = kept(once, "lines_by_text")
    first = F.min_by("doc", F.struct("rank", "doc")).alias("first")
    # A text counts once for a shape, however many of its lines have it.
    by_text = once.groupBy("leaf", "shape", "doc").agg(
        F.min("rank").alias("rank"), F.min("line").alias("line"), F.first("rows").alias("rows"),
        F.max(F.col("exact") == F.col("shape")).alias("plain"))
    by_text = kept(by_text, "shapes_by_text")
    shapes = by_text.groupBy("leaf", "shape").agg(
        F.sum("rows").alias("docs"), F.min_by(F.struct("doc", "line"), F.struct("rank", "doc")).alias("at"),
        F.max("plain").alias("plain"))
    shapes = kept(shapes.select("leaf", "shape", "docs", "plain", F.col("at.doc").alias("at_doc"), F.col("at.line").alias("at_line")),
                  "shapes")
    template = kept(_template_of(source, shapes, similarity, min_docs, depth), "templates")
    of = small_join(by_text, template, "shape", width=48).where(F.col("template").isNotNull())
    found = of.groupBy("template", "doc").agg(F.min("rank").alias("rank"), F.first("rows").alias("rows")).groupBy("template").agg(
        F.sum("rows").alias("docs"), first)
    general = template.join(found.where(F.col("docs") >= min_docs), "template").select("shape", "first")
    # Without a digit the shape is the exact line; the lines with one are counted by themselves.
    plain = shapes.where(F.col("plain") & (F.col("docs") >= min_copies)).select("shape", F.col("at_doc").alias("first"))
    chosen = kept(general.unionByName(plain).groupBy("shape").agg(F.collect_set("first").alias("firsts")), "recurring")
    valued = F.col("exact") != F.col("shape")
    same = once.where(valued).groupBy("exact").agg(F.sum("rows").alias("docs"), first)
    same = kept(same.where(F.col("docs") >= min_copies).select("exact", F.array("first").alias("firsts")), "recurring_exact")
    drop = small_join(lines.select("shape", "doc", "line"), chosen, "shape", width=64).unionByName(
        small_join(lines.where(valued).select("exact", "doc", "line"), same, "exact", width=48).withColumnRenamed("exact", "shape"))
    drop = drop.where(F.col("firsts").isNotNull())
    gone = F.when(F.size(F.array_remove("firsts", F.col("doc"))) > 0, F.col("line"))
    return drop.groupBy("doc").agg(F.sort_array(F.collect_set(gone)).alias("gone"),
                                   F.sort_array(F.collect_set("line")).alias("again"))


def drop_recurring_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", into: str = "dropped",
                         **options) -> tuple[DataFrame, str]:
    """All rows and columns, recurring lines cut from the text, and a column with their number.

    Returns the frame and that column's name (``into``, with underscores in front if taken).
    An exact line recurs in ``min_copies`` documents (2), a template in ``min_docs`` (5); documents are rows, and
    copies of a text count one by one. The first document (smallest id, null last, then text hash, then any
    one of equal rows) keeps its lines, and no other does. Lines of fewer than ``min_tokens`` tokens are kept.
    Null stays null; a text may become empty.
    """
    into = fresh(docs.columns, into)
    taken, names = [*docs.columns, into], []
    for name in ("text_key", "gone_lines", "lines_again", "first_rank", "first_row", "row_number"):
        names.append(fresh([*taken, *names], name))
    key, gone, again, rank, row, number = names
    columns = docs.columns
    copies = kept(copies_of(docs, doc_id, text), "copies").withColumn("row", F.lit(0).cast("bigint"))
    if copies.where(F.col("tied") > 1).isEmpty():
        docs = docs.withColumn(number, F.lit(0).cast("bigint"))
    else:
        # Rows equal in text and id: their numbers must not change between the jobs.
        docs = kept(docs.withColumn(number, F.monotonically_increasing_id()), "numbered")
        rows = docs.select(F.xxhash64(col(text)).alias("doc"), _rank(doc_id).alias("rank"), F.col(number).alias("row"))
        rows = small_join(rows, copies.select("doc", "first"), "doc").where(F.col("rank") == F.col("first"))
        heads = kept(rows.groupBy("doc").agg(F.min("row").alias("row")), "first_rows")
        copies = kept(copies.drop("row").join(heads, "doc"), "copies_numbered")
    drops = recurring_lines(docs, copies, doc_id, text, **options)
    drops = small_join(drops, copies.select("doc", "first", "row"), "doc").withColumn(
        "again", F.when(F.col("first").isNotNull(), F.col("again")))
    drops = kept(drops.where((F.size("gone") > 0) | F.col("first").isNotNull()), "dropped_lines")
    size = drops.agg(F.sum(F.size("gone") + F.coalesce(F.size("again"), F.lit(0)))).first()[0] or 0
    side = drops.select(F.col("doc").alias(key), F.col("gone").alias(gone), F.col("again").alias(again),
                        F.col("first").alias(rank), F.col("row").alias(row))
    marked = small_join(docs.withColumn(key, F.xxhash64(col(text))), side, key,
                        width=128 + 8 * (size // max(1, drops.count())))
    other = F.col(rank).isNotNull() & ((_rank(doc_id) != F.col(rank)) | (F.col(number) != F.col(row)))
    cut = F.when(other, F.col(again)).otherwise(F.col(gone))
    marked = marked.withColumn(gone, F.when(col(text).isNotNull() & (F.size(cut) > 0), cut))
    left = F.filter(F.split(col(text), "\n", -1), lambda _, i: ~F.array_contains(gone, i))
    new = [F.when(F.col(gone).isNull(), col(c)).otherwise(F.array_join(left, "\n")).alias(c) if c == text else col(c) for c in columns]
    return marked.select(*new, F.when(F.col(gone).isNull(), 0).otherwise(F.size(gone)).alias(into)), into


def dedup_lines(docs: DataFrame, **options) -> DataFrame:
    """The documents without recurring lines; columns unchanged."""
    out, into = drop_recurring_lines(docs, **options)
    return out.drop(into)


def report(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``op8_line_dedup``: doc_id, lines dropped, and the SHA-256 of the text left."""
    out, into = drop_recurring_lines(docs.select("doc_id", "text"), **options)
    return out.select("doc_id", F.col(into).cast("long").alias("n_dropped"),
                      F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))
