import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from screenrank.llm import hard_negatives
from screenrank.llm.hard_negatives import Search, augmented, bounds, cover_tree

SCHEMA = "vec_id long, label int, embedding array<double>, rank string, score long"


def brute(rows, every, positives=5, k=10):
    good = [(i, y, [math.floor(256 * x) for x in v]) for i, y, v in rows if y is not None and v is not None
            and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for n, (i, y, v) in enumerate(good):
        if i is None or i % every:
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w)), j is None, j or 0, z, j) for m, (j, z, w) in enumerate(good)
                        if m != n and len(w) == len(v))
        for p, _, _, _, pid in [s for s in scored if s[3] == y][:positives]:
            hits = [s for s in scored if s[3] != y and 30 * -p <= 100 * -s[0] <= 90 * -p][:k]
            out += [(i, pid, r + 1, s[4], -p, -s[0]) for r, s in enumerate(hits)]
    return sorted(out, key=str)


def run(spark, rows, every, **options):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(3)
    got = hard_negatives.hard_negatives(df, F.col("vec_id") % every == 0, **options)
    return sorted((tuple(r) for r in got.collect()), key=str)


def clustered(seed, n, dim, labels=4):
    rng = random.Random(seed)
    centres = [[rng.uniform(-1, 1) for _ in range(dim)] for _ in range(6)]
    return [(i, rng.randrange(labels), [c + rng.gauss(0, 0.1) for c in rng.choice(centres)]) for i in range(n)]


def test_equals_brute_force(spark):
    rows = clustered(1, 300, 6) + [(i, i % 3, [0.5, 0.25, 0.0, 0.0, 0.0, 1.0]) for i in range(300, 380)]  # a common vector
    want = brute(rows, 20)
    assert len(want) > 300
    assert run(spark, rows, 20) == want


def test_equals_brute_force_in_small_parts(spark, monkeypatch):
    for name, value in [("LABEL_BUCKETS", 2), ("TREE_ROWS", 20), ("ANCHOR_ROWS", 3), ("TREES_PER_TASK", 2),
                        ("ROOTS_PER_TASK", 3), ("LEAF_ROWS", 4), ("FANOUT", 3), ("PIVOTS", 5), ("PIVOT_ROWS", 50)]:
        monkeypatch.setattr(hard_negatives, name, value)
    rows = clustered(2, 250, 4) + [(i, 1, [1.0, 0.0, 0.0, 0.0]) for i in range(250, 330)] + [(i, 1, [3.0, 1.0]) for i in range(400, 420)]
    assert run(spark, rows, 10) == brute(rows, 10)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, 1, [1.0, 0.5]), (0, 1, [1.0, 0.5]), (0, 2, [1.0, 0.5]), (1, 1, [0.9, 0.4]), (2, 2, [0.5, 0.5]),
            (3, None, [1.0, 1.0]), (4, 2, None), (5, 2, [nan, 1.0]), (6, 2, [inf, 1.0]), (7, 2, [None, 1.0]),
            (None, 2, [0.6, 0.3]), (None, 2, [0.6, 0.3]), (None, 1, [1.0, 0.6]), (8, 3, [0.7, 0.3]), (8, 3, [0.7, 0.3]),
            (10, 5, [-1.0, -1.0]), (20, 5, [1.0, 1.0]), (30, 6, []), (31, 6, []), (32, 7, []), (40, 8, [1.0, 0.0, 0.0])]
    got = run(spark, rows, 10)
    assert got == brute(rows, 10)
    assert {r[1] for r in got} >= {None, 1} and None in {r[3] for r in got}


def test_empty_table_and_no_anchor(spark):
    assert run(spark, [], 10) == run(spark, [(1, 1, [1.0])], 10) == run(spark, [(10, 1, [1.0])], 10) == []


def test_large_scores_are_exact_and_larger_ones_an_error(spark):
    rows = [(0, 1, [4e6, 1.0]), (1, 1, [4e6, 3.0]), (2, 2, [2e6, 1 / 256]), (3, 2, [2e6, 2 / 256]), (4, 2, [2e6, 0.0])]
    assert run(spark, rows, 10) == brute(rows, 10)
    with pytest.raises(Exception, match="too large"):
        run(spark, [(0, 1, [1e8]), (1, 1, [1.0])], 10)


def tree_of(v, **options):
    x, top = augmented(v)
    return x, top, cover_tree(x, **options)


def test_nodes_cover_what_lies_below_and_bound_its_products():
    v = np.array([r[2] for r in clustered(3, 400, 5)])
    v = np.floor(v * 256).astype(np.int64)
    x, top, t = tree_of(v, leaf_rows=8, fanout=6)
    assert sorted(t["order"].tolist()) == list(range(400))
    q = v[:7].astype(float)
    for j in range(len(t["radius"])):
        rows, centre = t["order"][t["first"][j]:t["last"][j]], t["order"][t["centre"][j]]
        assert np.linalg.norm(x[rows] - x[centre], axis=1).max() <= t["radius"][j] + 1e-6
        low, high = bounds(q @ v[centre], (q ** 2).sum(axis=1), top, t["radius"][j])
        s = q @ v[rows].T
        assert (s >= low[:, None]).all() and (s <= high[:, None]).all()
        if t["children"][j]:
            below = range(t["child"][j], t["child"][j] + t["children"][j])
            assert sum(t["last"][c] - t["first"][c] for c in below) == len(rows)


def test_search_skips_nodes_outside_the_windows():
    v = np.floor(np.array([r[2] for r in clustered(4, 3000, 5)]) * 256).astype(np.int64)
    x, top, t = tree_of(v, leaf_rows=16, fanout=16)

    class Tree:
        dim, largest = v.shape[1], int(np.abs(v).max())

    tree = Tree()
    tree.top, tree.v = top, v[t["order"]]
    tree.ids = tree.rids = t["order"]
    tree.labels = np.zeros(len(v), dtype=np.int64)
    for k in ("centre", "radius", "first", "last", "child", "children"):
        setattr(tree, k, t[k])
    q = v[:20]
    s = q @ v.T
    high = np.sort(s, axis=1)[:, [-40, -400]] + 0.0
    search = Search(q, np.arange(20), np.ones(20), 0.3 * high, high, 10, same=False)
    search.descend([tree])
    for i in range(20):
        for w in range(2):
            fits = sorted((-a, j) for j, a in enumerate(s[i].tolist()) if j != i and 0.3 * high[i, w] <= a <= high[i, w])
            assert [(-int(a), int(j)) for a, j in zip(search.exact[i, w], search.ids[i, w])] == fits[:10]
    assert search.scored < 0.6 * 20 * len(v)
