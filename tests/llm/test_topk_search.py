import math
import random

from pyspark.sql import functions as F

from screenrank.llm.topk_search import exact_topk

SCHEMA = "vec_id long, embedding array<double>, score long"


def brute(rows, k, every):
    first = {}
    for i, v, _ in rows:
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        q = [math.floor(1024 * x) for x in v]
        first[i] = min(first.get(i, q), q)
    out = []
    for i in sorted(first):
        if i % every == 0:
            best = sorted((-sum(a * b for a, b in zip(first[i], v)), j) for j, v in first.items()
                          if j != i and len(v) == len(first[i]))[:k]
            out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(best)]
    return out


def run(spark, rows, every, **options):
    df = spark.createDataFrame(rows, SCHEMA)
    return sorted(tuple(r) for r in exact_topk(df, F.col("vec_id") % every == 0, **options).collect())


def test_equals_brute_force_with_ties_and_few_bins(spark, monkeypatch):
    from screenrank.llm import topk_search

    monkeypatch.setattr(topk_search, "CANDIDATE_ROWS", 40)
    monkeypatch.setattr(topk_search, "QUERY_ROWS", 3)
    rng = random.Random(4)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(6)], 0) for i in range(150)]
    rows += [(i, [0.5, 0.25, 0.0, 0.0, 0.0, 1.0], 0) for i in range(150, 230)]  # a common vector
    assert run(spark, rows, 10, k=7, bins=16) == brute(rows, 7, 10)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0], 0), (1, [1.0, nan], 0), (2, [inf, 0.0], 0), (3, [None, 1.0], 0), (4, None, 0),
            (5, [0.5, 0.5], 0), (None, [9.0, 9.0], 0), (5, [0.25, 0.5], 0), (10, [], 0), (6, [-1.0, 0.0], 0),
            (7, [1.0, 0.0, 0.0], 0), (20, [], 0), (8, [1000.0, -1000.0], 0)]
    got = run(spark, rows, 10)
    assert got == brute(rows, 10, 10)
    assert [r[2] for r in got if r[0] == 0] == [8, 5, 6]


def test_no_candidates_and_empty_table(spark):
    assert run(spark, [(0, [1.0], 0)], 10) == []
    assert run(spark, [], 10) == []
    assert run(spark, [(1, [1.0], 0), (2, [1.0], 0)], 10) == []


def test_copies_of_the_query_blocks_are_not_broadcast(spark, monkeypatch):
    from screenrank.llm import topk_search

    monkeypatch.setattr(topk_search, "CANDIDATE_ROWS", 8)
    monkeypatch.setattr(topk_search, "GROUPS", 4)
    rng = random.Random(8)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(4)], 0) for i in range(200)]
    rows[30] = (30, [1e6, -1e6, 0.5, 1.0], 0)  # needs 64-bit values
    df = exact_topk(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 10 == 0, k=5)
    assert sorted(tuple(r) for r in df.collect()) == brute(rows, 5, 10)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for part in plan.split("BroadcastExchange")[1:]:
        assert "Generate" not in part.split("\n")[1]
    assert "SortMergeJoin" in plan
