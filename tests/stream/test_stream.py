import os

import pytest
from pyspark.sql import functions as F

from screenrank.operators.content import content_similar
from screenrank.operators.topk import unnest_recs
from screenrank.session import scratch_path
from screenrank.sinks.tables import read_versions
from screenrank.sources import fixtures as fx
from screenrank.sources.text import render_rating_messages
from screenrank.streaming.recommender import current_recs, score_events
from screenrank.streaming.stateful import ProfileScorer, start_stateful
from tests.conftest import SF_SMALL

ONCE = {"availableNow": True}


@pytest.fixture(scope="module")
def inputs(spark):
    """(events, first half, second half, similarity path)"""
    root = scratch_path(spark, "stream-inputs")
    ev = fx.event_ratings(spark, SF_SMALL).drop("event_id")
    sim_path = os.path.join(root, "sim")
    content_similar(fx.part_movies(spark, SF_SMALL)).write.parquet(sim_path)
    lo, hi = ev.agg(F.min("timestamp"), F.max("timestamp")).first()
    mid_t = (lo + hi) // 2
    return ev, ev.filter(F.col("timestamp") <= mid_t), ev.filter(F.col("timestamp") > mid_t), sim_path


def stored_items(spark, ckpt):
    """uid -> rated items, from the bitmaps in the state store."""
    from screenrank.streaming.stateful import BUCKET_BITS

    out = {}
    for r in spark.read.format("statestore").option("stateVarName", "seen").load(ckpt).collect():
        base = r.user_map_key.bucket << BUCKET_BITS
        bits = r.user_map_value.bits
        out.setdefault(r.key.uid, set()).update(base + i for i in range(8 * len(bits)) if bits[i >> 3] >> (i & 7) & 1)
    return out


def rows(df):
    return sorted(tuple(r) for r in unnest_recs(df, "uid").collect())


def test_stream_equals_batch_twin_and_restart_is_idempotent(spark, inputs):
    ev, first, second, sim_path = inputs
    root = scratch_path(spark, "stateful")
    sc = ProfileScorer(sim_path, os.path.join(root, "out"))
    src, ckpt = os.path.join(root, "in"), os.path.join(root, "ck")
    for part in (first, second):
        render_rating_messages(part).write.mode("append").text(src)
        start_stateful(spark, src, sc, ckpt, trigger=ONCE).awaitTermination()
    got = rows(current_recs(spark, sc.out_path))
    assert got == rows(score_events(ev, ev, spark.read.parquet(sim_path))) and got
    start_stateful(spark, src, sc, ckpt, trigger=ONCE).awaitTermination()  # nothing new: no new batch
    assert rows(current_recs(spark, sc.out_path)) == got
    assert {r.uid for r in current_recs(spark, sc.out_path).collect()} == \
        {r.uid for r in ev.select("uid").distinct().collect()}
    sc.close()


def test_bootstrap_in_small_chunks_keeps_the_whole_history(spark, inputs):
    """The seed rows of a user reach the state in several Arrow batches."""
    ev, first, second, sim_path = inputs
    root = scratch_path(spark, "bootstrap")
    sc = ProfileScorer(sim_path, os.path.join(root, "out"))
    src = os.path.join(root, "in")
    render_rating_messages(second).write.mode("append").text(src)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10")
    try:
        start_stateful(spark, src, sc, os.path.join(root, "ck"), initial_ratings=first,
                       trigger=ONCE).awaitTermination()
        profiles = spark.read.parquet(os.path.join(sc.out_path, "_profiles"))
        recent = {r.uid: r.n for r in profiles.groupBy("uid").agg(F.sum(F.size("recent")).alias("n")).collect()}
        seen = stored_items(spark, os.path.join(root, "ck"))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = {r.uid: (r.items, r.n) for r in ev.join(second.select("uid").distinct(), "uid").groupBy("uid").agg(
        F.count_distinct("mid").alias("items"), F.count("*").alias("n")).collect()}
    assert {u: len(seen[u]) for u in want} == {u: items for u, (items, _) in want.items()}
    assert recent == {u: min(20, n) for u, (_, n) in want.items()}
    assert any(items > 10 for items, _ in want.values())
    assert rows(current_recs(spark, sc.out_path)) == rows(score_events(second, ev, spark.read.parquet(sim_path)))
    sc.close()


def long_history(spark, n, neighbours, name):
    """One event of a user with ``n`` rated items 0 .. n - 1: (scorer, checkpoint)."""
    ratings = spark.range(n).selectExpr("1L AS uid", "id AS mid", "4.0D AS score", "1000 + id AS timestamp")
    sim = spark.createDataFrame(neighbours, "mid long, sim_mid long, score double")
    root = scratch_path(spark, name)
    sim.write.parquet(os.path.join(root, "sim"))
    sc = ProfileScorer(os.path.join(root, "sim"), os.path.join(root, "out"))
    src = os.path.join(root, "in")
    spark.createDataFrame([(f"1|{10 ** 6}|5.0|99999",)], "value string").write.text(src)
    start_stateful(spark, src, sc, os.path.join(root, "ck"), initial_ratings=ratings, trigger=ONCE).awaitTermination()
    return sc, os.path.join(root, "ck")


def test_output_of_a_user_does_not_grow_with_the_history(spark):
    at = 10 ** 6
    for n in (30, 12_000):
        sc, ckpt = long_history(spark, n, [(at, 5, 0.95), (at, at + 7, 0.9), (at + 7, at, 0.9)], f"history-{n}")
        profiles = spark.read.parquet(os.path.join(sc.out_path, "_profiles")).collect()
        assert len(profiles) == 1 and not profiles[0].deep and not profiles[0].seen
        assert profiles[0].cand_mids == [at + 7]  # item 5 is already rated
        assert [x.mid for x in profiles[0].recent] == [at] + list(range(n - 1, n - 20, -1))
        assert stored_items(spark, ckpt) == {1: {*range(n), at}}
        assert [(r.mid, r.score) for r in unnest_recs(current_recs(spark, sc.out_path), "uid").collect()] == [(at + 7, 4.5)]
        sc.close()


def test_a_user_who_has_rated_the_head_gets_the_rest_of_the_neighbours(spark, monkeypatch):
    """More neighbours than an event carries, and all of those are rated: the
    candidates come from the whole table, and the seen items in parts."""
    from screenrank.streaming import stateful

    monkeypatch.setattr(stateful, "SEEN_PER_ROW", 40)
    at = 10 ** 6
    near = [(at, m, 0.99 - m / 1000) for m in range(100)] + [(at, at + k, 0.8 - k / 100) for k in (1, 2)]
    sc, _ = long_history(spark, 100, near + [(m, a, x) for a, m, x in near], "deep")
    profiles = spark.read.parquet(os.path.join(sc.out_path, "_profiles")).collect()
    assert all(r.deep for r in profiles) and len(profiles) == 3 and sum(len(r.seen) for r in profiles) == 101
    got = {r.mid for r in unnest_recs(current_recs(spark, sc.out_path), "uid").collect()}
    assert got == {at + 1, at + 2}
    sc.close()


def test_the_trigger_runs_every_five_seconds(spark, inputs):
    """The default trigger over two batches, as the listener saw them."""
    import time
    from datetime import datetime

    from screenrank.streaming.progress import BatchLog
    from screenrank.streaming.stateful import StateOnly, recent_lists

    _, first, second, _ = inputs
    root = scratch_path(spark, "trigger")
    src, ckpt = os.path.join(root, "in"), os.path.join(root, "ck")
    log = BatchLog()
    spark.streams.addListener(log)
    try:
        render_rating_messages(first).coalesce(1).write.text(src)
        q = start_stateful(spark, src, StateOnly(), ckpt)
        run = q.scoring.runId
        for n, more in ((1, second), (2, None)):
            end = time.time() + 120
            while len(log.of(run)) < n and time.time() < end:
                time.sleep(0.2)
            if more is not None:
                render_rating_messages(more).coalesce(1).write.mode("append").text(src)
        q.stop()
    finally:
        spark.streams.removeListener(log)
    a, b = log.of(run)
    assert (a.batch_id, b.batch_id) == (0, 1) and (a.input_rows, b.input_rows) == (first.count(), second.count())
    gap = datetime.fromisoformat(b.started) - datetime.fromisoformat(a.started)
    late = gap.total_seconds() % 5
    assert gap.total_seconds() >= 4.9 and (min(late, 5 - late) < 1 or a.millis > 5000) and a.millis > 0
    users = {r.uid for r in first.unionByName(second).select("uid").distinct().collect()}
    assert {r.uid for r in recent_lists(spark, ckpt).collect()} == users


def test_bad_messages_fail_or_go_to_their_table(spark, inputs):
    _, first, _, sim_path = inputs
    root = scratch_path(spark, "bad")
    src = os.path.join(root, "in")
    render_rating_messages(first.limit(20)).write.text(src)
    spark.createDataFrame([("not|a|rating",), (" 1|2|3.0|4",)], "value string").write.mode("append").text(src)
    sc = ProfileScorer(sim_path, os.path.join(root, "out"))
    with pytest.raises(Exception, match="bad rating line"):
        start_stateful(spark, src, sc, os.path.join(root, "ck"), trigger=ONCE).awaitTermination()
    with pytest.raises(ValueError, match="bad_path"):
        start_stateful(spark, src, sc, os.path.join(root, "ck1"), trigger=ONCE, mode="quarantine")
    bad = os.path.join(root, "badtable")
    start_stateful(spark, src, sc, os.path.join(root, "ck2"), trigger=ONCE, mode="quarantine",
                   bad_path=bad).awaitTermination()
    assert sorted((r.value, r.reason, r.batch_id) for r in read_versions(spark, bad).collect()) == [
        (" 1|2|3.0|4", "uid is not an integer", 0), ("not|a|rating", "fewer than 4 fields", 0)]
    assert current_recs(spark, sc.out_path).count() == first.limit(20).select("uid").distinct().count()
    sc.close()


def test_source_options_compaction_and_removal_of_old_versions(spark, inputs):
    ev, _, _, sim_path = inputs
    root = scratch_path(spark, "options")
    src = os.path.join(root, "in")
    lo, hi = ev.agg(F.min("timestamp"), F.max("timestamp")).first()
    for i in range(6):
        a, b = lo + (hi - lo + 1) * i // 6, lo + (hi - lo + 1) * (i + 1) // 6
        part = ev.filter((F.col("timestamp") >= a) & (F.col("timestamp") < b))
        render_rating_messages(part).coalesce(1).write.mode("append").text(src)
    sc = ProfileScorer(sim_path, os.path.join(root, "out"), compact_every=2)
    start_stateful(spark, src, sc, os.path.join(root, "ck"), trigger=ONCE,
                   source_options={"maxFilesPerTrigger": "1"}).awaitTermination()
    names = sorted(os.listdir(sc.out_path))
    assert not {"batch_id=0", "batch_id=1", "batch_id=2", "batch_id=3"} & set(names)
    assert {"batch_id=4", "batch_id=5", "_profiles", "_snapshots"} <= set(names)
    assert sorted(os.listdir(os.path.join(sc.out_path, "_snapshots"))) == ["upto=3", "upto=5"]
    assert rows(current_recs(spark, sc.out_path)) == rows(score_events(ev, ev, spark.read.parquet(sim_path)))
    sc.close()


def test_factored_tables_give_the_same_lists_without_expanded_edges(spark, inputs, monkeypatch):
    from screenrank.operators import similarity
    from screenrank.operators.content import content_factored
    from screenrank.streaming import stateful

    ev, _, _, sim_path = inputs
    want = rows(score_events(ev, ev, spark.read.parquet(sim_path)))
    root = scratch_path(spark, "factored")
    rep_edges, members = content_factored(fx.part_movies(spark, SF_SMALL))
    rep_edges.write.parquet(os.path.join(root, "sim"))
    members.write.parquet(os.path.join(root, "members"))
    src = os.path.join(root, "in")
    render_rating_messages(ev).write.text(src)
    monkeypatch.setattr(similarity, "expand_factored", None)
    monkeypatch.setattr(stateful.write_vector_heads, "__defaults__", (25,))  # some users run out of it
    sc = ProfileScorer(os.path.join(root, "sim"), os.path.join(root, "out"),
                       members_path=os.path.join(root, "members"))
    start_stateful(spark, src, sc, os.path.join(root, "ck"), trigger=ONCE).awaitTermination()
    assert rows(current_recs(spark, sc.out_path)) == want and want
    sc.close()


def test_stream_queries_do_not_expand_the_similarity(spark, monkeypatch):
    from screenrank.operators import similarity
    from screenrank.plans.catalogue import QUERIES

    monkeypatch.setattr(similarity, "expand_factored", None)
    assert QUERIES["stream_recs_bootstrap"](spark, SF_SMALL).count()
