"""Hard negatives against a direct computation, whatever the blocks."""

import dataclasses

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketlake.llm import hard_negatives as h

VECTORS = "vec_id long, embedding array<float>, label int, id string, score long, row int, planes string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2, "y") for r in rows], VECTORS)


def slow(rows, positives=5, negatives=3):
    seen = {}
    for i, v, label in rows:
        if i is not None and label is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            seen[i, label, tuple(int(np.floor(256 * float(np.float32(x)))) for x in v)] = None
    keys, out = list(seen), []
    for a in keys:
        if a[0] % 5:
            continue
        scored = sorted(((sum(x * y for x, y in zip(a[2], c[2], strict=False)), c) for c in keys if c != a), key=lambda s: (-s[0], s[1][0]))
        for ps, p in [s for s in scored if s[1][1] == a[1]][:positives]:
            found = [s for s in scored if s[1][1] != a[1] and 50 * ps <= 100 * s[0] <= 95 * ps][:negatives]
            out += [(a[0], p[0], k + 1, n[0], ps, s) for k, (s, n) in enumerate(found)]
    return sorted(out)


def mined(spark, given, **settings):
    found = h.mine(frame(spark, given), F.col("vec_id") % 5 == 0, settings=dataclasses.replace(h.Settings(), **settings))
    return sorted(map(tuple, found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()))


def vectors(seed, n=150, dims=11, hot=0):
    rng = np.random.default_rng(seed)
    v = (rng.standard_normal((4, dims))[rng.integers(0, 4, n)] + 0.7 * rng.standard_normal((n, dims))).astype(np.float32)
    v[:hot] = v[0]
    return [(i, [float(x) for x in v[i]], int(rng.integers(0, 3)) if i >= hot else i % 2) for i in range(n)]


def test_planes_tables_and_scores_are_exact():
    rng = np.random.default_rng(0)
    for bits, kind in ((9, np.int32), (20, np.int64)):
        a, c = (rng.integers(-(1 << bits - 1), 1 << bits - 1, (n, 24)) for n in (7, 300))
        assert (h.unpack(h.pack(a, bits)) == a).all()
        assert (h.scores(h.pack(c, bits), h.subset_sums(a, kind)) == a @ c.T).all()


@pytest.mark.parametrize("settings", [{}, {"anchors": 3, "rows": 7}, {"anchors": 1, "rows": 1000}])
def test_result_does_not_depend_on_blocks(spark, settings):
    rows = vectors(1)
    assert mined(spark, rows, **settings) == slow(rows)


def test_a_third_of_equal_vectors_and_large_components(spark):
    rows = vectors(2, hot=50)
    assert mined(spark, rows, anchors=4, rows=16) == slow(rows)
    rows = [(i, [100.0 * x for x in v], label) for i, v, label in rows[40:]]
    assert mined(spark, rows) == slow(rows)
    with pytest.raises(ValueError, match="64 bits"):
        mined(spark, [(0, [1e30], 1)])


def test_odd_rows(spark):
    rows = vectors(3, n=40, dims=3)
    odd = [(None, [1.0, 1.0, 1.0], 1), (41, None, 1), (42, [1.0, None, 1.0], 1), (43, [float("nan"), 1.0, 0.0], 1), (44, [float("inf"), 1.0, 0.0], 2),
           (45, [], 1), (46, [1.0], 0), (50, [1.0, 1.0, 1.0], None), rows[5], rows[5], rows[6], rows[10]]
    assert mined(spark, rows + odd) == slow(rows + odd)
    assert mined(spark, []) == [] and mined(spark, [(0, [1.0], 1), (5, [1.0], 2)]) == [] and mined(spark, [(0, [], 1), (5, [], 1), (7, [], 2)]) == slow([(0, [], 1), (5, [], 1), (7, [], 2)])
