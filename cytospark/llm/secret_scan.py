"""Secret scan with a trigram inverted index; DataFrame functions only.

Each rule's expression yields a Boolean query over trigrams. The index holds, for
every trigram that some query names, the texts it occurs in. Postings are
intersected to find each rule's candidates, and only those are read with its
expression. Rules without a mandatory trigram read all texts.

Texts are known in the index by a hash: copies share their postings, and a
chance collision only adds a candidate, which the expression then refuses.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cytospark.llm.grams import trigram_query
from cytospark.llm.tables import col, kept, small_join


@dataclass(frozen=True)
class Rule:
    """A kind of secret: matches of ``pattern`` whose ``group`` has ``least`` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


#: Fixed values of the task for the first three. A class repeated to its end can carry the least
#: length itself: shorter runs fail either way, and none holds a longer one.
RULES = [
    Rule("assign", r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
    Rule("private_key", r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
    Rule("access_token", r"(?:ghp|gho|ghu|ghs|ghr)_[A-Za-z0-9]{36}"),
    Rule("chat_token", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
]


def build_index(docs: DataFrame, rules: Sequence[Rule], text: str = "text") -> DataFrame:
    """Postings (gram, key) of the trigrams that the rules' queries name, stored once.

    ``key`` is a hash of the text. A trigram that every text holds costs a row for each distinct text.
    """
    grams = sorted({g for r in rules for clause in trigram_query(r.pattern) or () for g in clause})
    low = F.lower(col(text))
    present = F.array_compact(F.array(*[F.when(low.contains(g), F.lit(g)) for g in grams])) if grams \
        else F.array().cast("array<string>")
    rows = docs.where(col(text).isNotNull()).select(F.xxhash64(col(text)).alias("key"), F.explode(present).alias("gram"))
    return kept(rows.distinct(), "postings")


def candidates(index: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(key, kinds): the rules whose query a text's trigrams satisfy, for rules that have one."""
    spark = index.sparkSession
    needs = [(g, r.kind, n, len(clause)) for r in rules
             for n, clause in enumerate(sorted(map(sorted, trigram_query(r.pattern) or ()))) for g in clause]
    schema = "gram string, kind string, clause int, size int"
    clauses = F.broadcast(spark.createDataFrame(needs, schema))  # fixed by the rules
    whole = index.join(clauses, "gram").groupBy("key", "kind", "clause", "size").count().where(F.col("count") == F.col("size"))
    return whole.groupBy("key").agg(F.array_sort(F.collect_set("kind")).alias("kinds"))  # as many as rules, at most


def spans_of(text: Column, rule: Rule) -> Column:
    """Array of (start, end, kind order aside) of a rule's matches, in code points, end exclusive.

    The texts between the matches give the places: both come from the same search.
    """
    between = F.transform(F.split(text, rule.pattern, -1), lambda t: F.char_length(t))
    found = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group))
    # Running end of each match: the gaps and matches so far.
    rows = F.arrays_zip(F.slice(between, 1, F.size(found)).alias("gap"), found.alias("found"), value.alias("value"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def step(acc: Column, row: Column) -> Column:
        begin = acc["at"] + row["gap"]
        end = begin + F.char_length(row["found"])
        span = F.struct(begin.alias("start"), end.alias("end"))
        spans = F.when(F.char_length(row["value"]) >= rule.least, F.array_append(acc["spans"], span)).otherwise(acc["spans"])
        return F.struct(end.alias("at"), spans.alias("spans"))

    return F.aggregate(rows, start, step, lambda acc: acc["spans"])


def _named(order: int, kind: str):
    return lambda s: F.struct(s["start"].alias("start"), F.lit(order).alias("order"), F.lit(kind).alias("kind"),
                              s["end"].alias("end"))


def _of_kind(kind: str):
    return lambda s: s["kind"] == kind


def scan(docs: DataFrame, rules: Sequence[Rule] = tuple(RULES), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, spans): all spans (start, order, kind, end) of each row, by start, then rule order.

    One row for each row of ``docs``. Null and empty texts have no spans. Other columns are not read.
    """
    source = docs.select(col(doc_id).alias("doc_id"), F.coalesce(col(text), F.lit("")).alias("text"))
    found = kept(candidates(build_index(source, rules), rules), "candidates")
    # A posting's key and the names of some kinds: under 256 bytes a row.
    marked = small_join(source.withColumn("key", F.xxhash64("text")), found, "key", width=256)
    parts = []
    for order, rule in enumerate(rules):
        full = trigram_query(rule.pattern) is None
        likely = F.col("text").rlike(rule.pattern)
        if not full:
            likely = F.array_contains(F.coalesce("kinds", F.array().cast("array<string>")), rule.kind) & likely
        spans = F.when(likely, spans_of(F.col("text"), rule))
        parts.append(F.coalesce(F.transform(spans, _named(order, rule.kind)),
                                F.array().cast("array<struct<start:int,order:int,kind:string,end:int>>")))
    return marked.select("doc_id", F.array_sort(F.concat(*parts)).alias("spans"))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def report(docs: DataFrame) -> DataFrame:
    """The rows of ``op1_secret_scan``."""
    base = [r.kind for r in RULES[:3]]
    found = scan(docs)
    counts = [F.size(F.filter("spans", _of_kind(k))).cast("long").alias(f"n_{k}") for k in base]
    kept_spans = F.filter("spans", lambda s: s["order"] < len(base))
    return found.select("doc_id", *counts, F.sha2(_joined(kept_spans), 256).alias("base_sha256"),
                        _joined(F.col("spans")).alias("spans"))


def _masked(rule: Rule, mask: str):
    return lambda found, value: F.when(F.char_length(value) >= rule.least, F.lit(mask)).otherwise(found)


def redact(docs: DataFrame, rules: Sequence[Rule] = tuple(RULES), text: str = "text", mask: str = "[SECRET]") -> DataFrame:
    """The documents with every match of a rule replaced; columns unchanged, null stays null."""
    out = col(text)
    for rule in rules:
        pieces = F.split(out, rule.pattern, -1)
        found = F.regexp_extract_all(out, F.lit(rule.pattern), F.lit(0))
        value = F.regexp_extract_all(out, F.lit(rule.pattern), F.lit(rule.group))
        new = F.zip_with(found, value, _masked(rule, mask))
        whole = F.array_join(F.zip_with(pieces, F.array_append(new, F.lit("")), lambda a, b: F.concat(a, b)), "")
        out = F.when(out.rlike(rule.pattern), whole).otherwise(out)
    return docs.withColumn(text, out)
