"""The manifest against a plain tree: every shape of group, several passes, nulls, repeated ids."""

import hashlib
import zlib

import pytest

from cytospark.llm import manifest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, leaf string, base string, size string"


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    fields = (row[0], row[3], row[2], row[4], text)
    return digest(*["-" if f is None else f"{len(str(f).encode())}:{f}" for f in fields])


def climb(nodes, at):
    """Top of a list of nodes and the (left, right) steps of one of them."""
    steps = []
    while len(nodes) > 1:
        low = at // 3 * 3
        run = nodes[low:low + 3]
        steps.append(("".join(run[:at - low]), "".join(run[at - low + 1:])))
        nodes, at = [digest(*nodes[i:i + 3]) for i in range(0, len(nodes), 3)], at // 3
    return nodes[0], steps


def plain(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row[3], []).append(row)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    members = {g: sorted(groups[g], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[1]))) for g in order}
    tops = [climb([leaf(r, r[1]) for r in members[g]], 0)[0] for g in order]
    out = []
    for i, g in enumerate(order):
        nodes = [leaf(r, r[1]) for r in members[g]]
        for j, row in enumerate(members[g]):
            sub, steps = climb(nodes, j)
            root, more = climb(tops, i)
            text = row[1]
            if text is not None and zlib.crc32(str("" if row[0] is None else row[0]).encode()) % 2 == 0:
                text = text.replace("\n", "")
            folded = leaf(row, text)
            for left, right in steps + more:
                folded = digest(left, folded, right)
            out.append((row[0], nodes[j], sub, root, digest(*[x for s in steps + more for x in s]), folded, folded == root))
    return sorted(out, key=repr)


def check(spark, rows):
    frame = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA).repartition(3)
    assert sorted(map(tuple, manifest.report(frame).collect()), key=repr) == plain(rows)


def test_nulls_and_repeated_rows(spark):
    rows = [(i, f"a\nb{i}", "en", "s", i) for i in range(5)]
    rows += [rows[0], rows[0], (0, "other", None, "s", None), (None, None, None, None, None), (None, "x\ny", None, None, 3), (None, "é\n", "fr", "s", 2),
             (-1, "", "en", "é", 0), (63, "t" * 100_000, "en", "é", 0), (64, "\n", "en", "\U0001f600", 1), (-(1 << 62), "a", "en", "é", 0),
             ((1 << 62) + 63, "b", "en", "é", 0), (7, "c", "en", "", 0)]
    check(spark, rows)


def test_one_row_and_none(spark):
    check(spark, [(5, "one\nline", "en", "s", 3)])
    assert manifest.report(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("sizes", [(1, 9, 10), (82, 27, 3), (250,)])
def test_several_passes(spark, monkeypatch, sizes):
    """Blocks of nine slots need up to three passes, and many groups need some, too."""
    monkeypatch.setattr(manifest, "LEVELS", 2)
    monkeypatch.setattr(manifest, "SLOTS", 9)
    rows = [(i * 7 - 100, f"{i}\n{g}", "en", f"s{g}", i) for g, n in enumerate(sizes) for i in range(n)]
    check(spark, rows)


def test_many_groups(spark, monkeypatch):
    monkeypatch.setattr(manifest, "LEVELS", 2)
    monkeypatch.setattr(manifest, "SLOTS", 9)
    check(spark, [(i, "t", "en", f"s{i % 40}", i) for i in range(60)])
