"""The registered queries of this package, with SQL where SQL can express them."""

from __future__ import annotations

import re

from cytospark.llm import (
    decontaminate, hard_negatives, jaccard, language, line_templates, manifest, neighbours, packing, pseudonyms, quality, secret_scan,
    substrings, toxicity,
)
from cytospark.llm.tables import QUERIES, SQL, query, table

__all__ = ["QUERIES", "SQL"]

OP4_SQL = r"""
with items as (
    select distinct coalesce(cast(item_id as varchar), '') as item_id,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
    from benchmark),
docs as (
    select doc_id,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
    from documents),
windows as (
    select distinct item_id, least(13, len(w)) as size, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') as words
    from (select item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) as i from items where len(w) > 0)),
places as (
    select doc_id, size, i, array_to_string(w[i:i + size - 1], ' ') as words
    from (select doc_id, w, size, unnest(range(1, len(w) - size + 2)) as i
          from docs, (select distinct size from windows) where len(w) >= size)),
found as (select doc_id, item_id, p.size, i from places p join windows using (size, words)),
hits as (select doc_id, count(distinct pos) as n_hit
         from (select doc_id, unnest(range(i, i + size)) as pos from found) group by doc_id),
lists as (select doc_id, count(*) as n_items, string_agg(item_id, ',' order by item_id) as ids
          from (select distinct doc_id, item_id from found) group by doc_id)
select d.doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
       sha256(coalesce(ids, '')) as items_sha256,
       coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
from docs d left join hits using (doc_id) left join lists using (doc_id)
"""


@query("op4_decontamination", OP4_SQL)
def op4(spark, sf_dir):
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP6_SQL = r"""
with docs as (
    select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
places as (
    select doc_id, i, array_to_string(w[i:i + 19], ' ') as words
    from (select doc_id, w, unnest(range(1, len(w) - 18)) as i from docs where len(w) >= 20)),
ranked as (select doc_id, i, row_number() over (partition by words order by doc_id, i) as k from places),
gone as (select distinct doc_id, unnest(range(i, i + 20)) as pos from ranked where k > 1),
words as (select doc_id, unnest(w) as word, unnest(range(1, len(w) + 1)) as pos from docs),
left_over as (select doc_id, string_agg(word, ' ' order by pos) as kept, count(*) as n
              from words anti join gone using (doc_id, pos) group by doc_id)
select d.doc_id, cast(len(w) as bigint) as n_words, len(w) - coalesce(n, 0) as n_removed,
       sha256(coalesce(kept, '')) as kept_sha256
from docs d left join left_over using (doc_id)
"""


@query("op6_substring_dedup", OP6_SQL)
def op6(spark, sf_dir):
    out = substrings.remove_repeats(table(spark, sf_dir, "documents"), digest=True)
    return out.withColumnRenamed("kept", "kept_sha256")


@query("op2_language_id")
def op2(spark, sf_dir):
    return language.report(table(spark, sf_dir, "documents"))


@query("op9_quality")
def op9(spark, sf_dir):
    return quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op10_packing")
def op10(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"))


OP1_SQL = r"""
with docs as (select doc_id, coalesce(text, '') as t from documents),
rules(ord, kind, pattern, grp, least) as (values
    (0, 'assign', '((?i:password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 2, 6),
    (1, 'access', 'AKIA[A-Z0-9]+', 0, 20),
    (2, 'hex', '[0-9a-f]+', 0, 24),
    (3, 'private_key', '-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----', 0, 1),
    (4, 'web_token', 'eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+', 0, 1),
    (5, 'access_token', '(?:ghp|gho|ghu|ghs|ghr)_[A-Za-z0-9]{36}', 0, 1),
    (6, 'chat_token', 'xox[abprs]-[A-Za-z0-9-]{10,}', 0, 1)),
parts as (
    {parts}),
rows as (select doc_id, ord, kind, least, unnest(range(1, len(m) + 1)) as i, unnest(m) as m, unnest(v) as v,
                unnest(s[1:len(m)]) as s from parts where len(m) > 0),
places as (
    select doc_id, ord, kind, least, length(v) as size, length(m) as width,
           sum(length(s) + length(m)) over (partition by doc_id, ord order by i) as stop
    from rows),
spans as (
    select doc_id, ord, kind, stop - width as start, kind || ':' || cast(stop - width as bigint) || ':' || cast(stop as bigint) as span
    from places where size >= least),
lists as (
    select doc_id, count(*) filter (where ord = 0) as n_assign, count(*) filter (where ord = 1) as n_access,
           count(*) filter (where ord = 2) as n_hex, string_agg(span, ',' order by start, ord) filter (where ord < 3) as base,
           string_agg(span, ',' order by start, ord) as spans
    from spans group by doc_id)
select d.doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access, coalesce(n_hex, 0) as n_hex,
       sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
from docs d left join lists using (doc_id)
"""
_PART = """select doc_id, ord, kind, least, regexp_extract_all(t, {p}) as m, regexp_extract_all(t, {p}, {g}) as v,
           regexp_split_to_array(t, {p}) as s from docs, rules where ord = {i}"""


def _op1_sql() -> str:
    patterns = re.findall(r"^    \((\d), '\w+', ('(?:[^']|'')+'), (\d), \d+\)", OP1_SQL, re.M)
    parts = "\n    union all ".join(_PART.format(p=p, g=g, i=i) for i, p, g in patterns)
    return OP1_SQL.replace("{parts}", parts)


@query("op1_secret_scan", _op1_sql())
def op1(spark, sf_dir):
    return secret_scan.report(table(spark, sf_dir, "documents"))


@query("op7_pii")
def op7(spark, sf_dir):
    return pseudonyms.report(table(spark, sf_dir, "documents"))


@query("op8_line_dedup")
def op8(spark, sf_dir):
    return line_templates.report(table(spark, sf_dir, "documents"))


@query("op3_nearest_neighbours")
def op3(spark, sf_dir):
    return neighbours.search(table(spark, sf_dir, "embeddings"))


@query("op5_jaccard_join")
def op5(spark, sf_dir):
    return jaccard.report(table(spark, sf_dir, "documents"))


OP13_SQL = r"""
with rows as (
    select vec_id as id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
           list_transform(embedding, lambda x: floor(256 * cast(x as double))) as v
    from embeddings
    where vec_id is not null and label is not null and embedding is not null
      and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
pairs as (
    select a.id as anchor_id, b.id, a.label = b.label as alike, cast(list_inner_product(a.v, b.v) as bigint) as score
    from rows a, rows b where a.id % 100 = 0 and a.id <> b.id),
positives as (
    select anchor_id, id as positive_id, score as positive_score
    from pairs where alike
    qualify row_number() over (partition by anchor_id order by score desc, id) <= 5)
select anchor_id, positive_id,
       cast(row_number() over (partition by anchor_id, positive_id order by score desc, id) as int) as rank,
       id as negative_id, positive_score, score as negative_score
from pairs join positives using (anchor_id)
where not alike and 30 * positive_score <= 100 * score and 100 * score <= 90 * positive_score
qualify row_number() over (partition by anchor_id, positive_id order by score desc, id) <= 10
"""


@query("op13_hard_negatives", OP13_SQL)
def op13(spark, sf_dir):
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"))


OP12_SQL = r"""
with recursive docs as (
    select row_number() over () as k, doc_id, source, text, crc32_even, n_chars, lang from (
        select *, list_reduce(
            [cast(4294967295 as bigint)] || list_transform(regexp_extract_all(cast(doc_id as varchar), '.'), lambda c: cast(ord(c) as bigint)),
            lambda crc, c: {step}) as state, xor(state, 4294967295) % 2 = 0 as crc32_even from documents)),
forms as (
    select k, doc_id, source,
           coalesce(strlen(cast(doc_id as varchar)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
           || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(cast(n_chars as varchar)) || ':' || n_chars, '-') as head,
           text, case when crc32_even then replace(text, chr(10), '') else text end as other
    from docs),
leaves as (
    select k, doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) as leaf,
           sha256(head || coalesce(strlen(other) || ':' || other, '-')) as tampered,
           row_number() over (partition by source order by doc_id) - 1 as place, count(*) over (partition by source) as n
    from forms),
tree as (
    select source, 0 as level, place, leaf as node, n from leaves
    union all
    select source, level + 1, place // 3, sha256(string_agg(node, '' order by place)), (n + 2) // 3
    from tree where n > 1 group by source, level, place // 3, n),
subroots as (
    select source, node, row_number() over (order by source nulls first) - 1 as place, count(*) over () as n from tree where n = 1),
top as (
    select 0 as level, place, node, n from subroots
    union all
    select level + 1, place // 3, sha256(string_agg(node, '' order by place)), (n + 2) // 3 from top where n > 1 group by level, place // 3, n),
walk as (
    select k, source, 0 as part, 0 as level, place, n, tampered as folded, '' as proof from leaves
    union all
    select w.k, w.source, w.part, w.level + 1, w.place // 3, (w.n + 2) // 3,
           sha256(coalesce(string_agg(t.node, '' order by t.place) filter (where t.place < w.place), '') || w.folded
                  || coalesce(string_agg(t.node, '' order by t.place) filter (where t.place > w.place), '')),
           w.proof || coalesce(string_agg(t.node, '' order by t.place) filter (where t.place <> w.place), '')
    from walk w join tree t on t.source is not distinct from w.source and t.level = w.level and t.place // 3 = w.place // 3
    where w.n > 1 group by w.k, w.source, w.part, w.level, w.place, w.n, w.folded, w.proof),
climb as (
    select k, 0 as level, s.place, s.n, w.folded, w.proof
    from walk w join subroots s on s.source is not distinct from w.source where w.n = 1
    union all
    select w.k, w.level + 1, w.place // 3, (w.n + 2) // 3,
           sha256(coalesce(string_agg(t.node, '' order by t.place) filter (where t.place < w.place), '') || w.folded
                  || coalesce(string_agg(t.node, '' order by t.place) filter (where t.place > w.place), '')),
           w.proof || coalesce(string_agg(t.node, '' order by t.place) filter (where t.place <> w.place), '')
    from climb w join top t on t.level = w.level and t.place // 3 = w.place // 3
    where w.n > 1 group by w.k, w.level, w.place, w.n, w.folded, w.proof)
select l.doc_id, l.leaf, s.node as subroot, r.node as root, sha256(c.proof) as proof_sha256, c.folded as folded_root,
       c.folded = r.node as verified
from leaves l join subroots s on s.source is not distinct from l.source
     join climb c on c.k = l.k and c.n = 1, (select node from top where n = 1) r
"""
# One byte of the checksum, eight bits of the reflected polynomial.
_CRC_STEP = "xor(crc, c)"
for _ in range(8):
    _CRC_STEP = f"list_transform([{_CRC_STEP}], lambda z: xor(z >> 1, (z & 1) * 3988292384))[1]"


@query("op12_merkle_manifest", OP12_SQL.replace("{step}", _CRC_STEP))
def op12(spark, sf_dir):
    return manifest.report(table(spark, sf_dir, "documents"))


@query("op11_toxicity")
def op11(spark, sf_dir):
    return toxicity.toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
