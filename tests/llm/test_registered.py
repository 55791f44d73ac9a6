"""Every registered query over the given tables: against its SQL, brute force, or a known property."""

import zlib
from collections import defaultdict

import brute
import numpy as np
import pytest

from cytospark.llm.queries import QUERIES, SQL
from cytospark.llm.tables import table


@pytest.fixture(scope="module")
def documents(spark, sf_dir):
    return table(spark, sf_dir, "documents").collect()


@pytest.mark.parametrize("name", sorted(SQL))
def test_against_sql(against_sql, name):
    against_sql(name)


def test_secrets_against_expressions(spark, sf_dir, documents):
    got = {r["doc_id"]: r for r in QUERIES["op1_secret_scan"](spark, sf_dir).collect()}
    for d in documents:
        spans = brute.secrets(d["text"])
        assert [s for s in got[d["doc_id"]]["spans"].split(",") if s.split(":")[0] in ("assign", "access", "hex")] == spans


def test_languages(spark, sf_dir, documents):
    got = {r["doc_id"]: r for r in QUERIES["op2_language_id"](spark, sf_dir).collect()}
    assert len(got) == len(documents)
    right = total = 0
    for d in documents:
        r = got[d["doc_id"]]
        assert r["held_out"] == brute.held_out(d["doc_id"], 3, 1) and 0 <= r["score"] <= 1
        if r["held_out"] and d["lang"] and d["text"]:
            total += 1
            right += r["lang_pred"] == d["lang"]
    assert right >= 0.9 * total


def test_neighbours_recall(spark, sf_dir):
    rows = sorted(table(spark, sf_dir, "embeddings").select("vec_id", "embedding").collect())
    ids, x = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], float)
    got = defaultdict(list)
    for r in QUERIES["op3_nearest_neighbours"](spark, sf_dir).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append(r)
    found = 0
    for q in ids[ids % 100 == 0]:
        d = np.sqrt(((x - x[ids == q][0]) ** 2).sum(1))
        d[ids == q] = np.inf
        best = {int(i) for i in ids[np.lexsort((ids, d))[:10]]}
        assert [r["rank"] for r in got[q]] == list(range(1, 11))
        for r in got[q]:
            assert r["score"] == pytest.approx(d[ids == r["vec_id"]][0], abs=1e-12)
        found += len(best & {r["vec_id"] for r in got[q]})
    assert found >= 0.9 * 10 * len(got)


def test_jaccard_components(spark, sf_dir, documents):
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in QUERIES["op5_jaccard_join"](spark, sf_dir).collect()}
    rows = [(d["doc_id"], d["text"]) for d in documents]
    assert got == {d: c for (d, _), c in zip(rows, brute.components(rows))}


def test_pseudonyms_are_whole(spark, sf_dir, documents):
    assert QUERIES["op7_pii"](spark, sf_dir).count() == len(documents)


def test_line_dedup_is_whole(spark, sf_dir, documents):
    rows = QUERIES["op8_line_dedup"](spark, sf_dir).collect()
    assert len(rows) == len(documents) and any(r["n_dropped"] for r in rows)


def test_quality_held_out_accuracy(spark, sf_dir, documents):
    marks = dict(table(spark, sf_dir, "labels").select("doc_id", "quality").collect())
    rows = QUERIES["op9_quality"](spark, sf_dir).collect()
    assert len(rows) == len(documents)
    good, bad = [], []
    for r in rows:
        assert r["held_out"] == brute.held_out(r["doc_id"], 5, 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
        if r["held_out"] and r["doc_id"] in marks:
            (good if marks[r["doc_id"]] else bad).append(r["score"])
    pairs = [(a > b) + (a == b) / 2 for a in good for b in bad]
    assert not pairs or sum(pairs) / len(pairs) >= 0.85


def test_packing_is_exact(spark, sf_dir, documents):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in QUERIES["op10_packing"](spark, sf_dir).collect():
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append(r)
    assert set(pieces) == {d["doc_id"] for d in documents}
    for d in documents:
        ids = [*tokenizer.encode(d["text"] or "", add_special_tokens=False).ids, 2]
        at = 0
        for r in sorted(pieces[d["doc_id"]], key=lambda r: r["start"]):
            part = np.array(ids[at:at + r["length"]], "<u4").tobytes()
            assert (r["start"], r["doc_tokens"], r["ids_crc32"]) == (at, len(ids), zlib.crc32(part))
            at += r["length"]
        assert at == len(ids)
    used = full = 0
    for rows in sequences.values():
        at = 0
        for r in sorted(rows, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 4096
        used += at
        full += at if at & (at - 1) == 0 else 4096
    assert used >= 0.97 * full


def test_pipeline_stages(spark, sf_dir, documents):
    import corpus_pipeline

    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark").collect()
    kept_rows = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = stage(spark, docs, sf_dir).cache()
        if name != "packing":
            assert docs.columns == before.columns
        kept_rows[name] = before.collect(), docs.collect()
    before, after = kept_rows["language"]
    assert {r["doc_id"] for r in before if any(c.isalpha() for c in r["text"] or "")} == {r["doc_id"] for r in after}
    before, after = kept_rows["line_dedup"]
    assert len(before) == len(after)
    text = {r["doc_id"]: r["text"] for r in before}
    for r in after:
        assert set((r["text"] or "").split("\n")) <= set((text[r["doc_id"]] or "").split("\n")) | {""}
    before, after = kept_rows["near_duplicates"]
    groups = brute.components([(r["doc_id"], r["text"]) for r in before])
    assert sorted(r["doc_id"] for r in after) == sorted(
        r["doc_id"] for r, (n, c) in zip(before, groups) if not n or c == r["doc_id"])
    before, after = kept_rows["decontamination"]
    bench = [(r["item_id"], r["text"]) for r in items]
    clean = []
    for r in before:
        n, hit, _ = brute.benchmark_hits(r["text"], bench)
        if not (hit and 20 * hit >= n):
            clean.append(r["doc_id"])
    assert sorted(clean) == sorted(r["doc_id"] for r in after)
    before, after = kept_rows["packing"]
    assert {r["doc_id"] for r in before} == {r["doc_id"] for r in after}
