import pytest

from screenrank.llm.catalogue import op8_token_counts
from screenrank.llm.token_counts import TokenRollup, deltas
from screenrank.session import scratch_path

SCHEMA = "source string, lang string, version string, kind string, tokens long, old_tokens long, docs int"


def state(rollup):
    return sorted(((r.source, r.lang, r.version, r.docs, r.tokens) for r in rollup.totals().collect()), key=str)


def test_batches_are_signed_idempotent_and_in_any_order(spark):
    make = lambda rows: spark.createDataFrame([(*r, 0) for r in rows], SCHEMA)
    insert = make([("a", "en", "v1", "insert", 10, None), ("a", "en", "v1", "insert", 10, None),
                   (None, None, "v1", "insert", None, None), ("b", "en", "v1", "insert", 7, None)])
    revise = make([("a", "en", "v1", "revise", 12, 10), ("b", "en", "v1", "revise", 5, 7)])
    delete = make([("a", "en", "v1", "delete", 12, None), ("b", "en", "v1", "delete", 5, None)])
    want = sorted([("a", "en", "v1", 1, 10), (None, None, "v1", 1, 0)], key=str)
    first = TokenRollup(spark, scratch_path(spark, "rollup"))
    for batch, changes in ((0, insert), (1, revise), (2, delete)):
        first.commit(batch, changes)
    assert state(first) == want
    for batch, changes in ((1, revise), (2, delete), (0, insert)):  # replays
        first.commit(batch, changes)
    assert state(first) == want
    second = TokenRollup(spark, scratch_path(spark, "rollup"))
    for batch, changes in ((2, delete), (0, insert), (1, revise), (3, insert.limit(0))):
        second.commit(batch, changes)
    assert state(second) == want
    folded = first.fold(1, scratch_path(spark, "rollup"))
    assert state(folded) == want
    for batch, changes in ((2, delete), (1, revise), (0, insert)):  # two of them folded
        folded.commit(batch, changes)
        assert state(folded) == want
    again = TokenRollup(spark, folded.path).fold(2, scratch_path(spark, "rollup"))
    assert again.folded() == {0, 1, 2}
    for batch, changes in ((2, delete), (1, revise), (0, insert)):
        again.commit(batch, changes)
    assert state(again) == want


def test_a_batch_that_comes_after_the_fold_is_taken(spark):
    make = lambda *rows: spark.createDataFrame([(*r, 0) for r in rows], SCHEMA)
    rollup = TokenRollup(spark, scratch_path(spark, "rollup"))
    rollup.commit(2, make(("a", "en", "v1", "insert", 5, None)))
    rollup = rollup.fold(3, scratch_path(spark, "rollup"))  # 0, 1 and 3 weren't there
    rollup.commit(3, make(("a", "en", "v1", "insert", 7, None)))
    rollup.commit(0, make(("a", "en", "v1", "insert", 11, None)))
    rollup.commit(2, make(("a", "en", "v1", "insert", 5, None)))
    assert state(rollup) == [("a", "en", "v1", 3, 23)]
    with pytest.raises(ValueError, match="batch ids"):
        rollup.commit(-1, make(("a", "en", "v1", "insert", 1, None)))


def test_query_on_odd_rows(spark, tmp_path):
    """Null and repeated ids, copies across sources, empty and long texts."""
    rows = [(None, "a b c", "s", "en"), (None, "a b c", "s", "en"), (5, "a b c", "t", "en"), (5, "a b c", "t", "en"),
            (6, None, None, None), (7, "", "s", "de"), (8, "w x " * 50_000, "s", "en"), (9, "one, two", "t", "de")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, source string, lang string, times int")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    want = [(s, l, v, d, t) for v in ("blanks-1", "letters-1") for s, l, d, t in (
        ("t", "en", 1, 3), (None, None, 1, 0), ("s", "en", 1, 100_000), ("t", "de", 1, 2))]
    assert sorted((tuple(r) for r in op8_token_counts(spark, str(tmp_path)).collect()), key=str) == sorted(want, key=str)


def test_unknown_kinds_are_errors_and_no_changes_no_rows(spark):
    bad = spark.createDataFrame([("a", "en", "v", "upsert", 1, 1, 0)], SCHEMA)
    with pytest.raises(Exception, match="unknown kind of change"):
        deltas(bad).collect()
    empty = TokenRollup(spark, scratch_path(spark, "rollup"))
    empty.commit(0, bad.limit(0))
    assert state(empty) == []
