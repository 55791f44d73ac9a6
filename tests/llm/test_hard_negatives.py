"""Hard negatives against a plain version: ties, repeated rows, odd vectors, several blocks of anchors."""

import math
import random

import numpy as np

from cytospark.llm import hard_negatives

SCHEMA = "vec_id bigint, embedding array<float>, label int, score int, slot int, aid int"


def plain(rows, every=100, positives=5, negatives=10):
    clean = set()
    for i, v, y in rows:
        if i is not None and y is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            clean.add((i, (y + 1) % 10 if i % 7 == 0 else y, tuple(math.floor(256 * float(np.float32(x))) for x in v)))
    out = set()
    for i, y, v in clean:
        if i % every:
            continue
        scored = sorted({(-sum(map(int.__mul__, v, w)), j, y == z) for j, z, w in clean if j != i})
        for s, p, _ in [x for x in scored if x[2]][:positives]:
            fits = [(-n, j) for n, j, alike in scored if not alike and 30 * -s <= 100 * -n <= 90 * -s]
            out.update((i, p, k, j, -s, n) for k, (n, j) in enumerate(fits[:negatives], 1))
    return sorted(out)


def found(spark, rows, **options):
    frame = spark.createDataFrame([(*r, 0, 0, 0) for r in rows], SCHEMA).repartition(3)
    return sorted(map(tuple, hard_negatives.mine(frame, **options).collect()))


def vectors(n, seed, size=6):
    r = random.Random(seed)
    return [(i, [r.choice([-0.5, 0.0, 0.25, 0.5, 1.0]) for _ in range(size)], r.randrange(3)) for i in range(n)]


def test_ties_and_repeated_rows(spark):
    rows = vectors(400, 1)
    rows += rows[:120] + [(None, [1.0] * 6, 1), (500, None, 1), (600, [1.0] * 6, None), (700, [1.0, None], 1), (800, [math.nan] * 6, 1),
                          (900, [math.inf] * 6, 1), (1000, [], 1), (1100, [1.0, 0.5], 2), (1200, [0.5] * 9, 2), (-100, [1.0] * 6, 0)]
    want = plain(rows)
    assert want and found(spark, rows) == want
    assert found(spark, rows, chunk_anchors=2) == want


def test_every_row_an_anchor(spark):
    rows = vectors(90, 2)
    assert found(spark, rows, every=1, chunk_anchors=40) == plain(rows, every=1)


def test_nothing_to_find(spark):
    assert found(spark, []) == []
    assert found(spark, [(1, [1.0], 1), (2, [1.0], 2)]) == []
    assert found(spark, [(100, [1.0], 1), (2, [1.0], 2)]) == []  # no positive
    assert found(spark, [(100, [1.0], 1), (1, [-1.0], 1), (2, [-0.5], 2)]) == []  # a negative score


def test_products_beyond_doubles():
    a = np.array([[2.0 ** 27, 1.0], [2.0 ** 40, 2.0 ** 40]])
    b = np.array([[2.0 ** 27, 1.0], [2.0 ** 40, 2.0 ** 40]])
    assert hard_negatives.inner_products(a, b).tolist() == [[2 ** 54 + 1, 1 << 58], [1 << 58, 1 << 58]]
