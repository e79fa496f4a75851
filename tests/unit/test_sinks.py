import os

from screenrank.session import scratch_path
from screenrank.sinks.tables import (compact_log, latest_snapshot, read_latest, read_log,
                                     replace_by_key, write_documents)


def test_replace_by_key_latest_and_compaction(spark):
    root = scratch_path(spark, "sink")
    s = "uid long, v string"
    replace_by_key(spark.createDataFrame([(1, "a"), (2, "b")], s), root, 0)
    replace_by_key(spark.createDataFrame([(1, "c")], s), root, 1)
    replace_by_key(spark.createDataFrame([(1, "c")], s), root, 1)  # replayed batch: idempotent
    before = sorted(tuple(r) for r in read_latest(spark, root, "uid").collect())
    assert before == [(1, "c"), (2, "b")]
    compact_log(spark, root, 1, key="uid")
    assert latest_snapshot(spark, root) == 1
    replace_by_key(spark.createDataFrame([(2, "d")], s), root, 2)
    after = sorted(tuple(r) for r in read_latest(spark, root, "uid").collect())
    assert after == [(1, "c"), (2, "d")]
    # reading an older state ignores the newer snapshot
    assert sorted(tuple(r) for r in read_latest(spark, root, "uid", upto_batch=0).collect()) == \
        [(1, "a"), (2, "b")]


def test_append_log_compaction_keeps_all_rows(spark):
    root = scratch_path(spark, "log")
    s = "uid long, mid long"
    for b in range(3):
        replace_by_key(spark.createDataFrame([(b, b), (b, b + 10)], s), root, b)
    compact_log(spark, root, 1)
    replace_by_key(spark.createDataFrame([(9, 9)], s), root, 3)
    rows = sorted((r.uid, r.mid) for r in read_log(spark, root).collect())
    assert rows == [(0, 0), (0, 10), (1, 1), (1, 11), (2, 2), (2, 12), (9, 9)]


def test_documents_unique_key(spark):
    root = scratch_path(spark, "docs")
    df = spark.createDataFrame([(1, "x"), (1, "y")], "mid long, t string")
    try:
        write_documents(df, os.path.join(root, "d"), key="mid")
    except ValueError as e:
        assert "duplicate" in str(e)
    else:
        raise AssertionError("duplicate key accepted")
