"""Toxicity: held-out accuracy, sentences against a plain version, odd input."""

import re
import zlib

import brute
import numpy as np
import pyarrow as pa
import pytest

from cytospark.llm import toxicity
from cytospark.llm.queries import QUERIES
from cytospark.llm.tables import table

WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def plain_sentences(text):
    """Byte ranges and lower-cased words of the sentences with a word."""
    raw = (text or "").encode()
    out, at = [], 0
    for part in re.findall(rb"[^.!?\n]*[.!?\n]|[^.!?\n]+", raw):
        words = [bytes(b + 32 if 65 <= b <= 90 else b for b in w) for w in WORD.findall(part)]
        if words:
            out.append((at, at + len(part), words))
        at += len(part)
    return out


def plain_grams(words):
    out = [("whole", w) for w in words]
    out += [("pair", *p) for p in zip(words, words[1:])]
    out += [("begin", w[:n]) for w in words for n in toxicity.PREFIXES if len(w) > n]
    return out


TEXTS = ["One two. Three?four\n\n!!!", None, "", "...", "no stop at the end", "next Text", "é한국어 mots. İ", "a\x00b c.d", "x " * 3000 + "y.",
         "Idiot IDIOT idiots idiotically."]


@pytest.mark.parametrize("slice_bytes", [1, 64, 1 << 20])
def test_sentences_and_features(slice_bytes):
    got = {i: [] for i in range(len(TEXTS))}
    ids = {}
    for part in toxicity.Reader(slice_bytes).slices(pa.array(TEXTS)):
        for s, row in enumerate(part.row.tolist()):
            at = part.bounds[row]
            got[part.first + row].append((int(part.begin[s] - at), int(part.end[s] - at), sorted(part.grams[part.of == s].tolist())))
    for i, text in enumerate(TEXTS):
        want = plain_sentences(text)
        assert [g[:2] for g in got[i]] == [w[:2] for w in want]
        for (_, _, grams), (_, _, words) in zip(got[i], want):
            assert len(grams) == len(plain_grams(words))
            ids.setdefault(tuple(grams), set()).add(tuple(sorted(plain_grams(words))))
    assert all(len(v) == 1 for v in ids.values())
    assert len({next(iter(v)) for v in ids.values()}) == len(ids)  # the same features, the same numbers


def test_noisy_or():
    column = pa.array(TEXTS)
    reader = toxicity.Reader()
    parts = list(reader.slices(column))
    grams = np.unique(np.concatenate([p.grams for p in parts]))[::3]
    model = toxicity.BagModel(grams, np.random.default_rng(3).normal(size=len(grams)), -2.0)
    got = model.score(column, reader)
    weight = dict(zip(grams.tolist(), model.weights.tolist()))
    (part,) = parts
    harmless = np.ones(len(TEXTS))
    for s, row in enumerate(part.row.tolist()):
        z = -2.0 + sum(weight.get(g, 0.0) for g in set(part.grams[part.of == s].tolist()))
        harmless[row] *= 1 - 1 / (1 + np.exp(-z))
    assert got == pytest.approx(1 - harmless, abs=1e-12)
    assert got[1] == got[2] == got[3] == 0


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    marks = dict(table(spark, folder, "labels").select("doc_id", "toxic").collect())
    rows = QUERIES["op11_toxicity"](spark, folder).collect()
    assert len(rows) == table(spark, folder, "documents").count()
    bad, good = [], []
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
        if r["held_out"] and r["doc_id"] in marks:
            (bad if marks[r["doc_id"]] else good).append(r["score"])
    pairs = [(a > b) + (a == b) / 2 for a in bad for b in good]
    assert sum(pairs) / len(pairs) >= 0.9
    assert np.mean([s >= 0.5 for s in bad]) >= 0.8 and np.mean([s < 0.5 for s in good]) >= 0.98


def corpus(spark, n=400):
    rows = []
    for i in range(n):
        clean = ". ".join(" ".join(f"w{(i * 31 + k * 7 + j) % 97}" for j in range(6)) for k in range(5)) + "."
        rows.append((i, clean + (" Süß. You vile creature!" if i % 5 == 1 else "")))
    return (spark.createDataFrame([(*r, "x", "y") for r in rows], "doc_id bigint, text string, score string, y string"),
            spark.createDataFrame([(i, int(i % 5 == 1), 1) for i in range(n)], "doc_id bigint, toxic int, quality int"))


def test_offending_sentences_are_found(spark):
    docs, labels = corpus(spark)
    model = toxicity.train(toxicity.labelled(docs, labels))
    found = toxicity.offending(docs, model).collect()
    texts = dict(docs.select("doc_id", "text").collect())
    assert {r["doc_id"] for r in found} == {i for i in texts if i % 5 == 1}
    for r in found:
        assert texts[r["doc_id"]][r["start"]:r["end"]] == r["sentence"] == " You vile creature!"


def test_odd_input(spark):
    docs, labels = corpus(spark, 120)
    odd = spark.createDataFrame([(None, "vile creature", "", ""), (None, None, None, None), (3, "w1 w2", "", ""), (3, "w1 w2", "", ""),
                                 (900, "", "", ""), (901, "vile " * 50_000, "", "")], docs.schema)
    twice = labels.unionByName(spark.createDataFrame([(None, 1, 1), (3, None, 1), (3, 0, 0)], labels.schema))
    got = toxicity.toxicity_scores(docs.unionByName(odd), twice).collect()
    assert len(got) == 126
    assert all(r["score"] == 0 for r in got if r["doc_id"] == 900)
    assert all(r["held_out"] == brute.held_out(r["doc_id"], 5, 0) for r in got)
    assert toxicity.toxicity_scores(docs.limit(0), labels).count() == 0
    unlabelled = toxicity.toxicity_scores(docs, labels.limit(0)).collect()
    assert len(unlabelled) == 120 and all(0.5 <= r["score"] <= 1 for r in unlabelled)
    assert toxicity.toxicity_scores(docs, labels.where("toxic = 0")).where("predicted = 1").count() == 0
