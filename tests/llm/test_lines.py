"""Line dedup against the plain version, and the cases a template tree gets wrong."""

import hashlib
import random

import brute
import pytest

from cytospark.llm import line_templates
from cytospark.llm.queries import QUERIES
from cytospark.llm.tables import table


def dedup(spark, rows, **options):
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    out, into = line_templates.drop_recurring_lines(frame, **options)
    return sorted((r["doc_id"], r["text"], r[into]) for r in out.collect())


def test_lines_in_two_documents_and_copies(spark):
    long = " ".join(f"word{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10]}" for i in range(60))
    rows = [(1, f"{long}\nfirst of all texts"), (2, f"second of all texts\n{long}"), (3, "item 12 was sold today"), (4, "item 12 was sold today"),
            (5, "item 13 was sold today"), (7, "whole text\nthat stands in copies"), (8, "whole text\nthat stands in copies"),
            (6, "whole text\nthat stands in copies"), (9, "equal rows stay once"), (9, "equal rows stay once")]
    got = dedup(spark, rows)
    assert got == sorted([
        (1, rows[0][1], 0), (2, "second of all texts", 1), (3, rows[2][1], 0), (4, "", 1), (5, rows[4][1], 0),
        (6, "whole text\nthat stands in copies", 0), (7, "whole text", 1), (8, "whole text", 1), (9, "", 1), (9, "equal rows stay once", 0)])


def test_two_families_in_a_leaf(spark):
    name = "alpha bravo carol delta echos foxes".split()
    rows = [(i, f"The page you are reading was printed last week\nThe page you requested {n} could not be found")
            for i, n in enumerate(name)]
    got = dedup(spark, rows)
    assert got == [(0, rows[0][1], 0), *[(i, "", 2) for i in range(1, 6)]]


@pytest.mark.parametrize("models", [1, 16])
def test_many_families_against_plain_version(spark, monkeypatch, models):
    monkeypatch.setattr(line_templates, "FIRST_MODELS", models)
    monkeypatch.setattr(line_templates, "MOST_MODELS", models)
    r = random.Random(5)
    pick = lambda n: " ".join(r.choice("ab cd ef gh ij kl".split()) for _ in range(n))
    rows = [(i, "\n".join(f"one two three {pick(n)}" for n in (2, 3, 4, 5, 5, 6))) for i in range(60)]
    # Ties between equally common lines go by hash, so one line leads each family.
    rows += [(100 + i, "\n".join(["one two three aa bb cc dd ee", "one two three qq rr ss tt uu"][:1 + i % 2])) for i in range(9)]
    rows += [(200 + i, f"one two three aa bb cc dd {w}\none two three qq rr ss tt {w}") for i, w in enumerate("vv ww xx yy zz".split())]
    few = [x for x in rows if x[0] >= 100]
    assert dedup(spark, few) == sorted((d, *v) for d, v in brute.line_dedup(few).items())
    assert dedup(spark, rows) == dedup(spark, rows)


def test_rows_of_numbers_are_not_a_template(spark):
    rows = [(i, f"{i}1 {i}2 {i}3\n| {i}4 | {i}5 | x{i}6 |\n10:0{i} 10.0.0.{i} {i}7 Berlin\nprice of {i} euro\n7 7 7") for i in range(8)]
    got = dedup(spark, rows)
    assert got == [(0, rows[0][1], 0), *[(i, "\n".join(rows[i][1].split("\n")[:3]), 2) for i in range(1, 8)]]


def test_query_against_plain_version(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").collect()
    want = {d: (n, hashlib.sha256((t or "").encode()).hexdigest()) for d, (t, n) in brute.line_dedup([tuple(r) for r in docs]).items()}
    got = {r["doc_id"]: (r["n_dropped"], r["kept_sha256"]) for r in QUERIES["op8_line_dedup"](spark, sf_dir).collect()}
    assert got == want
