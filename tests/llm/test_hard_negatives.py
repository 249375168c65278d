"""Hard negatives against a plain Python version; packed products against plain ones."""

import math

import numpy as np
import pytest

from cartloom.llm import hard_negatives as H

SCHEMA = "vec_id long, embedding array<double>, label int, key string, rank int"


def brute(rows, every=H.EVERY, k=H.K):
    """(anchor, positive, rank, negative, scores) tuples of (id, vector, label) rows."""
    fine = [(n, i, tuple(x * 256 // 1 if isinstance(x, int) else math.floor(x * 256) for x in v), l)
            for n, (i, v, l) in enumerate(rows)
            if i is not None and l is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for n, i, v, l in fine:
        if i % every:
            continue
        scored = [(-sum(a * b for a, b in zip(v, w)), j, m, lj == l) for m, j, w, lj in fine if m != n and len(w) == len(v)]
        for top, p, _, _ in sorted(s for s in scored if s[3])[:k]:
            hard = sorted(s for s in scored if not s[3] and 80 * -top <= 100 * -s[0] <= 100 * -top)[:k]
            out += [(i, p, r, s[1], -top, -s[0]) for r, s in enumerate(hard, 1)]
    return sorted(out)


@pytest.mark.parametrize("scale,small,fields", [(1, True, 5), (100, True, 2), (1e4, True, 1), (1e9, False, 8)])
def test_packed_products_are_exact(scale, small, fields):
    rng = np.random.default_rng(5)
    c = np.floor(rng.normal(size=(37, 12)) * scale).astype(np.int64)
    a = np.floor(rng.normal(size=(5, 12)) * scale).astype(np.int64)
    cell = H.Cell(c, a.min(), a.max())
    assert cell.small == small and cell.fields >= fields
    want = a.astype(object) @ c.astype(object).T
    assert (cell.scores(a) == want).all()


def test_odd_rows_equal_brute_force(spark):
    rng = np.random.default_rng(1)
    rows = [(int(i), [float(x) for x in rng.integers(-3, 4, 6) / 8], int(rng.integers(0, 3))) for i in range(240)]
    rows += [(200, [0.5] * 6, 1), (200, [0.5] * 6, 1), (100, [0.25] * 6, 2), (7, [0.5] * 6, 1)]     # repeated ids, ties
    rows += [(300, None, 1), (400, [0.5] * 6, None), (500, [0.1, None] + [0.0] * 4, 1), (None, [9.0] * 6, 1),
             (600, [float("nan")] * 6, 1), (700, [float("inf")] * 6, 1), (800, [], 1), (801, [], 1), (802, [], 2),
             (900, [1.0, 2.0], 1), (901, [1.0, 1.0], 1), (902, [2.0, 0.25], -4), (1000, [0.0] * 6, 5), (1001, [0.0] * 6, 5)]
    df = spark.createDataFrame([(i, v, l, "x", 3) for i, v, l in rows], SCHEMA)
    got = sorted(tuple(r) for r in H.mine(df, every=100).collect())
    assert got == brute(rows) and len(got) > 20
    assert H.mine(df.limit(0)).collect() == []


def test_many_cells_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(H, "CANDIDATES", 30)
    monkeypatch.setattr(H, "ANCHORS", 4)
    rng = np.random.default_rng(2)
    rows = [(int(i), [float(x) for x in rng.normal(size=5) / 3], int(i % 7 == 0)) for i in range(200)]
    df = spark.createDataFrame([(i, v, l, "x", 3) for i, v, l in rows], SCHEMA)
    assert sorted(tuple(r) for r in H.mine(df, every=10).collect()) == brute(rows, every=10)


def test_large_components_are_exact(spark):
    rng = np.random.default_rng(3)
    rows = [(int(i), [float(x) * 10.0 ** int(p) for x, p in zip(rng.normal(size=4), rng.integers(0, 7, 4))], int(i % 3)) for i in range(120)]
    df = spark.createDataFrame([(i, v, l, "x", 3) for i, v, l in rows], SCHEMA)
    assert sorted(tuple(r) for r in H.mine(df, every=10).collect()) == brute(rows, every=10)
    huge = spark.createDataFrame([(i, [1e300, -1e300 * (i % 2)], i % 4 // 2, "x", 3) for i in range(8)], SCHEMA)
    assert all(r["positive_score"] == (1 << 63) - 1 for r in H.mine(huge, every=2).collect())
