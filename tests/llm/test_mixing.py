import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from screenrank.llm import mixing
from screenrank.llm.mixing import MAX_COPIES, WEIGHTS, balance, mix, mixed_documents, source_targets

SCHEMA = "doc_id long, text string, source string, copies string"


def water_fill(sizes):
    """Targets by resharing the excess again and again."""
    names = sorted((k for k in sizes if k is not None), key=lambda k: k.encode("utf-8"))
    names += [None] if None in sizes else []
    weight = {k: WEIGHTS[i % 3] for i, k in enumerate(names)}
    target, free, left = {}, set(names), float(sum(sizes.values()))
    while free:
        total = sum(weight[k] for k in free)
        over = [k for k in free if weight[k] / total * left > 3 * sizes[k] + 1e-9]
        if not over:
            target.update({k: weight[k] / total * left for k in free})
            break
        for k in over:
            target[k] = 3.0 * sizes[k]
            free.discard(k)
        left = sum(sizes.values()) - sum(target.values())
    return target


def corpus(n=3000):
    names = ["b", "a", None, "é", "B", "tiny"]
    return [(i, " ".join(["w"] * (1 + (i * 37) % 400)), names[5] if i % 500 == 0 else names[(i * i) % 5], "x")
            for i in range(n)]


def test_sources_meet_their_targets(spark):
    rows = corpus()
    out = mix(spark.createDataFrame(rows, SCHEMA)).select("doc.*", "size", "source_size", "target",
                                                         "`copies`").toDF("doc_id", "text", "source", "other",
                                                                          "size", "source_size", "target",
                                                                          "n").collect()
    assert len(out) == len(rows)
    sizes, taken = {}, {}
    for r in out:
        assert r["size"] == len(re.findall(r"[^\x20\x09-\x0D]+", r["text"])) and 0 <= r["n"] <= MAX_COPIES
        sizes[r["source"]] = sizes.get(r["source"], 0) + r["size"]
        taken[r["source"]] = taken.get(r["source"], 0) + r["size"] * r["n"]
    want = water_fill(sizes)
    for r in out:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(want[r["source"]])
    assert any(want[k] == 3 * sizes[k] for k in sizes)  # a capped source
    for k in sizes:
        assert abs(taken[k] - want[k]) <= 400  # one document


def solved(counts, target, mean, limit=3.0):
    """The multiplier that meets the target, by halving: an independent solution."""
    low, high = -1e4, 1e4
    for _ in range(300):
        mult = (low + high) / 2
        got = sum(n * s * min(limit, math.exp(min(mult * s / mean, 50.0))) for s, n in counts.items())
        low, high = (mult, high) if got < target else (low, mult)
    return mult


def test_rates_are_the_solution_of_the_dual(spark):
    rows = [("a", 1 + (i * 37) % 400) for i in range(500)] + [("b", 1 + i % 7) for i in range(90)] + [("c", 300)] * 40
    counts = spark.createDataFrame(rows, "key string, size long").groupBy("key", "size").agg(F.count("*").alias("n")).cache()
    sizes = counts.groupBy("key").agg(F.sum(F.col("n") * F.col("size")).alias("source_size"))
    share = F.when(F.col("key") == "a", 0.4).when(F.col("key") == "b", 2.5).otherwise(1.7)
    targets = sizes.withColumn("target", F.col("source_size") * share)
    for r in balance(counts, targets).collect():
        mine = Counter(s for k, s in rows if k == r.key)
        assert r["mean"] == pytest.approx(sum(s * n for s, n in mine.items()) / mine.total())
        assert r.mult == pytest.approx(solved(mine, r.target, r["mean"]), rel=1e-6, abs=1e-7)
    with pytest.raises(RuntimeError, match="not met"):
        balance(counts, targets, rounds=1)


@pytest.mark.parametrize("part", [100_000, 30])
def test_equal_rows_meet_the_target(spark, monkeypatch, part):
    """200 equal rows without an id: each may be taken or left on its own."""
    monkeypatch.setattr(mixing, "EQUAL_ROWS", part)
    rows = ([(None, "w " * 20, "a", "x")] * 200 + [(i, "v " * 30, "b", "x") for i in range(50)]
            + [(7, "u " * 10, "c", "x")] * 90)
    out = mix(spark.createDataFrame(rows, SCHEMA)).selectExpr("doc.source AS s", "size", "target", "`copies` AS n").collect()
    assert len(out) == len(rows) and all(0 <= r.n <= MAX_COPIES for r in out)
    for s, size in (("a", 20), ("b", 30), ("c", 10)):
        mine = [r for r in out if r.s == s]
        assert abs(sum(r.n * r["size"] for r in mine) - mine[0].target) <= size
    again = mix(spark.createDataFrame(rows[::-1], SCHEMA).repartition(5)).selectExpr("doc.source AS s", "`copies` AS n")
    assert Counter((r.s, r.n) for r in again.collect()) == Counter((r.s, r.n) for r in out)


def test_reruns_agree(spark):
    df = spark.createDataFrame(corpus(), SCHEMA)
    first = sorted((r.doc.doc_id, r.copies) for r in mix(df).collect())
    again = sorted((r.doc.doc_id, r.copies) for r in mix(df.repartition(7)).collect())
    assert first == again


def test_odd_rows(spark):
    rows = [(1, None, "s", "c"), (2, "", None, "c"), (None, "one two three", "s", "c"), (3, " \t\n", "t", "c"),
            (4, "x y", "t", "c"), (4, "x y", "t", "c")]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {(r.doc.doc_id, r.doc.source): (r.size, r.source_size) for r in mix(df).collect()}
    assert got == {(1, "s"): (0, 3), (2, None): (0, 0), (None, "s"): (3, 3), (3, "t"): (0, 4), (4, "t"): (2, 4)}
    assert mixed_documents(df).columns == df.columns
    assert mix(df.limit(0)).count() == 0 and mixed_documents(df.limit(0)).count() == 0


def test_targets_of_a_single_source_and_of_none(spark):
    one = spark.createDataFrame([("sx", 10)], "key string, source_size long")
    assert source_targets(one).first().target == 10.0
    assert source_targets(one.limit(0)).count() == 0


def test_mixed_documents_repeat_rows(spark):
    df = spark.createDataFrame(corpus(400), SCHEMA)
    want = sorted((r.doc.doc_id, r.copies) for r in mix(df).collect() if r.copies)
    got = {}
    for r in mixed_documents(df).collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + 1
    assert sorted(got.items()) == want
