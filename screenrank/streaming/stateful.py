"""Real-time recommender with per-user streaming state.

The reference reads each user's recent list and rated items from outside
stores per event. Here that per-user data lives in Structured Streaming's
state store, partitioned by user across executors and checkpointed with the
query: ``transformWithState`` keyed by uid keeps

* ``recent``: the user's 20 newest ratings (mid, score, timestamp), one value;
* ``seen``: the items the user has rated, a map of bitmaps with one entry per
  ``2**BUCKET_BITS`` item ids, of which a batch reads and writes only those
  entries that its items and candidates fall into,

bootstrapped once from the Rating table (``initialState``, merged row by row).
Rows and not pandas frames, as a user has few events a batch, and a frame costs
more than they do; each request to the state is a round trip, so none is made
whose answer is known. An event carries the ``HEAD`` best neighbours of its item (stream-static
join), so the candidates are picked where the state is: the best neighbours of
the user's latest item whose bit is not set. Each micro-batch emits per active
user the latest item, the recent list and at most 20 candidates, whatever the
length of the history. Only a user who has rated so much of the head that it
runs out before 20 candidates are found, while the item has more neighbours, is
emitted with all seen items as well (in rows of at most ``SEEN_PER_ROW``), and
their candidates come from the whole similarity table. A ``foreachBatch`` stage
scores the candidates with the set-wise operators of ``operators.realtime``.

Messages that do not parse fail the query, as in the reference; with
``mode="quarantine"`` a second query writes them to a bad-record table.
"""

from __future__ import annotations

import heapq
import os
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from screenrank.operators import realtime
from screenrank.operators.topk import nest_recs
from screenrank.schemas import RATING
from screenrank.session import ship_by_value
from screenrank.sinks.tables import compact_log, replace_by_key
from screenrank.sources.text import parse_rating_messages
from screenrank.streaming.recommender import BROADCAST_MAX_ROWS

ship_by_value(__name__)

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROFILE_SCHEMA = ("uid long, mid long, recent array<struct<mid:bigint,score:double,timestamp:bigint>>, "
                  "cand_mids array<bigint>, cand_scores array<double>, deep boolean, seen array<bigint>")
# Seen items per emitted row: a very long history leaves a task in several rows.
SEEN_PER_ROW = 50_000
# Neighbours that an event carries along.
HEAD = 64
# Ratings of one user and batch that are held at a time; then only the newest stay.
TRIM_AT = 1024
# Item ids of one bitmap: 2**12 bits are 512 bytes.
BUCKET_BITS = 12

Rating = tuple[int, float, int]


def _newest(ratings: list[Rating], n: int) -> list[Rating]:
    """Newest ``n`` ratings by (timestamp, mid, score), newest first."""
    return heapq.nlargest(n, ratings, key=lambda r: (r[2], r[0], r[1]))


class UserProfile(StatefulProcessor):
    """Per-user recent ratings (one value) and seen items (a map of bitmaps)."""

    def __init__(self, n_recent: int = realtime.MAX_USER_RATINGS, n_cands: int = realtime.MAX_SIM_MOVIES):
        self.n_recent, self.n_cands = n_recent, n_cands

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.recent = handle.getValueState(
            "recent", "recent array<struct<mid:bigint,score:double,timestamp:bigint>>")
        self.seen = handle.getMapState("seen", "bucket bigint", "bits binary")

    def _recent(self) -> list[Rating] | None:
        """None: the user has no state yet."""
        stored = self.recent.get()
        return None if stored is None else [
            (r["mid"], r["score"], r["timestamp"]) if isinstance(r, dict) else tuple(r) for r in stored[0]]

    def _bits(self, bucket: int, known: dict[int, bytearray], new: bool) -> bytearray:
        if bucket not in known:
            stored = None if new else self.seen.getValue((bucket,))
            known[bucket] = bytearray(stored[0]) if stored else bytearray((1 << BUCKET_BITS) // 8)
        return known[bucket]

    def _has(self, mid: int, known: dict[int, bytearray], new: bool) -> bool:
        at = mid & (1 << BUCKET_BITS) - 1
        return bool(self._bits(mid >> BUCKET_BITS, known, new)[at >> 3] >> (at & 7) & 1)

    def _mark(self, mids: list[int], known: dict[int, bytearray], new: bool = False) -> None:
        changed = set()
        for mid in mids:
            if not self._has(mid, known, new):
                at = mid & (1 << BUCKET_BITS) - 1
                known[mid >> BUCKET_BITS][at >> 3] |= 1 << (at & 7)
                changed.add(mid >> BUCKET_BITS)
        for bucket in changed:
            self.seen.updateValue((bucket,), (bytes(known[bucket]),))

    def _all_seen(self) -> list[int]:
        out = []
        for (bucket,), (bits,) in self.seen.iterator():
            base = bucket << BUCKET_BITS
            out += [base + 8 * i + j for i, byte in enumerate(bits) if byte for j in range(8) if byte >> j & 1]
        return sorted(out)

    def handleInitialState(self, key, initialState: Row, timerValues) -> None:
        # Called once per row of the user's seed (``initial_profiles``: one with
        # the newest ratings, others with items of one bitmap each); a call
        # merges with what earlier ones have stored.
        if initialState["newest"]:
            newest = [(r["mid"], r["score"], r["timestamp"]) for r in initialState["newest"]]
            self.recent.update((_newest((self._recent() or []) + newest, self.n_recent),))
        if initialState["items"]:
            self._mark(initialState["items"], {})

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        recent, known = self._recent(), {}
        new = recent is None
        ratings, latest, last = [], None, None
        mids_seen = set()
        for row in rows:
            rating = (row["mid"], row["score"], row["timestamp"])
            ratings.append(rating)
            mids_seen.add(rating[0])
            if len(ratings) >= TRIM_AT:
                ratings = _newest(ratings, self.n_recent)
            if latest is None or (rating[2], rating[0], rating[1]) > (latest[2], latest[0], latest[1]):
                latest, last = rating, row
        recent = _newest((recent or []) + ratings, self.n_recent)
        self._mark(sorted(mids_seen), known, new)
        self.recent.update((recent,))
        head_mids, head_scores, complete = ([], [], True) if last["head_mids"] is None else (
            last["head_mids"], last["head_scores"], last["complete"])
        mids, scores = [], []
        for m, s in zip(head_mids, head_scores):
            if len(mids) == self.n_cands:
                break
            if not self._has(m, known, new):
                mids.append(m)
                scores.append(s)
        deep = len(mids) < self.n_cands and not complete
        seen = self._all_seen() if deep else []
        for at in range(0, max(1, len(seen)), SEEN_PER_ROW):
            first = at == 0
            yield Row(uid=key[0], mid=latest[0] if first else None,
                      recent=[{"mid": m, "score": s, "timestamp": t} for m, s, t in recent] if first else [],
                      cand_mids=mids if first and not deep else [], cand_scores=scores if first and not deep else [],
                      deep=deep, seen=seen[at:at + SEEN_PER_ROW])

    def close(self) -> None:
        pass


def initial_profiles(ratings: DataFrame, n_recent: int = realtime.MAX_USER_RATINGS) -> DataFrame:
    """Rating table -> the rows that seed each user's state (uid, newest, items):
    one with the ``n_recent`` newest ratings (top-k window, cut before its
    shuffle) and one per bitmap with the user's distinct items in it (at most
    ``2**BUCKET_BITS``), however many ratings they have."""
    r = ratings.select(*[F.col(f.name).cast(f.dataType) for f in RATING.fields])
    rating = F.struct("mid", "score", "timestamp")
    recent = realtime.top_n_per_group(r, "uid", [F.desc(c) for c in ("timestamp", "mid", "score")], n_recent)
    recent = recent.groupBy("uid").agg(F.collect_list(rating).alias("newest")).withColumn(
        "items", F.lit(None).cast("array<bigint>"))
    items = r.groupBy("uid", F.shiftright("mid", BUCKET_BITS).alias("bucket")).agg(
        F.collect_set("mid").alias("items"))
    return recent.unionByName(items.select("uid", F.lit(None).cast(recent.schema["newest"].dataType).alias("newest"), "items"))


def score_profiles(profiles: DataFrame, sim: DataFrame, n_cands: int = realtime.MAX_SIM_MOVIES,
                   gate: float = realtime.SIM_GATE, n_users: int | None = None,
                   n_recent: int = realtime.MAX_USER_RATINGS, n_deep: int | None = None,
                   members: DataFrame | None = None) -> DataFrame:
    """Rows of ``UserProfile`` -> (uid, recs), as ``score_events``. A user's first
    row has the latest item, the recent list and the candidates; users marked
    deep (``n_deep`` of them, if that is known) have none, and their candidates
    are taken from ``sim`` and the seen items of all their rows. ``members``: ``sim``
    has the edges between distinct vectors, as in ``realtime.stream_candidates``."""
    cur = profiles.where("mid IS NOT NULL")
    recent = profiles.select("uid", F.posexplode("recent").alias("_p", "_r")).select(
        "uid", F.col("_r.mid").alias("mid"), F.col("_r.score").alias("score"),
        (F.col("_p") + 1).alias("rank"))
    small = n_users is not None and n_users * n_recent * n_cands <= BROADCAST_MAX_ROWS
    cands = cur.select("uid", F.explode(F.arrays_zip("cand_mids", "cand_scores")).alias("_c")).select(
        "uid", F.col("_c.cand_mids").alias("mid"), F.col("_c.cand_scores").alias("score"))
    if n_deep is None or n_deep:
        seen = profiles.where("deep").select("uid", F.explode("seen").alias("mid"))
        cands = cands.unionByName(realtime.stream_candidates(
            cur.where("deep").select("uid", "mid"), sim, seen, n=n_cands, broadcast=small,
            members=members).drop("rank"))
    scores = realtime.stream_scores(cands, recent, sim, gate=gate, broadcast=small, members=members)
    ranked = realtime.top_n_per_group(scores, "uid", [F.desc("score"), F.asc("mid")], None)
    nested = nest_recs(ranked, "uid")
    empty = F.array().cast("array<struct<mid:bigint,score:double>>")
    return cur.select("uid").join(nested, "uid", "left").select(
        "uid", F.coalesce("recs", empty).alias("recs"))


HEADS_SCHEMA = "mid long, head_mids array<bigint>, head_scores array<double>, complete boolean"
VECTOR_HEADS_SCHEMA = HEADS_SCHEMA.replace("mid long", "rid long")


@dataclass
class StateOnly:
    """A sink that keeps the users' state up to date and nothing else; the state
    can be read back with ``recent_lists``."""
    n_recent: int = realtime.MAX_USER_RATINGS

    def with_heads(self, events: DataFrame) -> DataFrame:
        return events.select("*", *[F.lit(None).cast(t).alias(c) for c, t in (
            ("head_mids", "array<bigint>"), ("head_scores", "array<double>"), ("complete", "boolean"))])

    def __call__(self, profiles: DataFrame, batch_id: int) -> None:
        profiles.write.format("noop").mode("overwrite").save()


def write_heads(sim: DataFrame, path: str, depth: int = HEAD) -> None:
    """Store the neighbour lists that the stream's events carry along."""
    realtime.neighbour_heads(sim.select("mid", "sim_mid", "score"), depth).write.mode("overwrite").parquet(path)


def write_vector_heads(rep_edges: DataFrame, members: DataFrame, path: str, depth: int = HEAD) -> None:
    """The same, one list per distinct vector."""
    realtime.vector_heads(rep_edges, members, depth).write.mode("overwrite").parquet(path)


@dataclass
class ProfileScorer:
    """foreachBatch stage after the stateful operator. ``sim_path`` has the edges
    between items (mid, sim_mid, score) or, with ``members_path``, those between
    distinct vectors (ra, rb, score), and that table their items (id, rid, size)."""
    sim_path: str
    out_path: str
    n_recent: int = realtime.MAX_USER_RATINGS
    # Every k batches the output log becomes one snapshot of each user's newest
    # row, and the versions it replaces are removed (None: never).
    compact_every: int | None = 100
    # Neighbour lists of ``write_heads``; without, they are made anew at a start.
    heads_path: str | None = None

    # Items of the distinct vectors, if ``sim_path`` is between those.
    members_path: str | None = None

    def _sim(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self.sim_path).select(
            *(("mid", "sim_mid", "score") if self.members_path is None else ("ra", "rb", "score")))

    def _members(self, spark: SparkSession) -> DataFrame | None:
        return None if self.members_path is None else spark.read.parquet(self.members_path).select("id", "rid", "size")

    def with_heads(self, events: DataFrame) -> DataFrame:
        """The events with the neighbour lists of their items."""
        spark = events.sparkSession
        path, members = self.heads_path or os.path.join(self.out_path, "_heads"), self._members(spark)
        if self.heads_path is None:
            if members is None:
                write_heads(self._sim(spark), path)
            else:
                write_vector_heads(self._sim(spark), members, path)
        if members is None:
            return events.join(spark.read.schema(HEADS_SCHEMA).parquet(path), "mid", "left")
        vector_of = members.where("id IS NOT NULL").select(F.col("id").alias("mid"), "rid")
        return (events.join(vector_of, "mid", "left")
                .join(spark.read.schema(VECTOR_HEADS_SCHEMA).parquet(path), "rid", "left").drop("rid"))

    def __call__(self, profiles: DataFrame, batch_id: int) -> None:
        spark = profiles.sparkSession
        sim = getattr(self, "_sim_df", None)
        if sim is None:
            sim = self._sim(spark).persist(StorageLevel.MEMORY_AND_DISK)
            self._sim_df = sim
        # Materialise the batch's profiles once (they feed several joins); the
        # next batch overwrites them.
        prof_path = os.path.join(self.out_path, "_profiles")
        profiles.write.mode("overwrite").parquet(prof_path)
        prof = spark.read.schema(PROFILE_SCHEMA).parquet(prof_path)
        # size check of the batch side
        n_users, n_deep = prof.where("mid IS NOT NULL").agg(
            F.count(F.lit(1)), F.coalesce(F.count_if("deep"), F.lit(0))).first()
        replace_by_key(score_profiles(prof, sim, n_users=n_users, n_recent=self.n_recent, n_deep=n_deep,
                                      members=self._members(spark)),
                       self.out_path, batch_id)
        if self.compact_every and (batch_id + 1) % self.compact_every == 0:
            compact_log(spark, self.out_path, batch_id, key="uid", remove_old=True)

    def close(self) -> None:
        sim = getattr(self, "_sim_df", None)
        if sim is not None:
            sim.unpersist()
        self._sim_df = None


@dataclass
class RealtimeQueries:
    """The scoring query and, in quarantine mode, the one for bad messages."""
    scoring: object
    bad: object | None = None

    def awaitTermination(self, timeout: int | None = None) -> None:
        for q in (self.scoring, self.bad):
            if q is not None:
                q.awaitTermination(timeout)

    def stop(self) -> None:
        for q in (self.scoring, self.bad):
            if q is not None:
                q.stop()


def _messages(spark: SparkSession, source: str | None, fmt: str, options: dict | None) -> DataFrame:
    reader = spark.readStream.format(fmt).options(**(options or {}))
    return reader.load(source) if source else reader.load()


def recent_lists(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The stored recent lists of a stream's users, from its state store (the
    ``statestore`` source): (uid, entries), an entry ``mid:score`` per rating,
    newest first, as the reference keeps them."""
    state = spark.read.format("statestore").option("stateVarName", "recent").load(checkpoint)
    return state.select(F.col("key.uid").alias("uid"), F.transform(
        F.col("value.recent"), lambda r: F.concat_ws(":", r["mid"].cast("string"), r["score"].cast("string"))).alias("entries"))


def start_stateful(spark: SparkSession, source: str | None, scorer: ProfileScorer | StateOnly, checkpoint: str,
                   initial_ratings: DataFrame | None = None, trigger: dict | None = None,
                   fmt: str = "text", source_options: dict | None = None, mode: str = "fail",
                   bad_path: str | None = None) -> RealtimeQueries:
    """Start the stateful recommender (RocksDB state store).

    ``source_options`` reach the stream source: topic, servers and starting
    offsets of a broker (``source`` is None then), or a rate limit such as
    ``maxFilesPerTrigger``, which also bounds what the first batch of a long
    backlog holds. ``trigger`` defaults to a 5 s processing time. With
    ``mode="quarantine"`` bad messages go to the table ``bad_path`` (value,
    reason, batch_id); the default fails on them."""
    if mode == "quarantine" and not bad_path:
        raise ValueError('mode="quarantine" needs bad_path: bad messages are not dropped')
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    trigger = trigger or {"processingTime": "5 seconds"}
    good, bad = parse_rating_messages(_messages(spark, source, fmt, source_options), mode=mode)
    events = good.select(*[F.col(f.name).cast(f.dataType) for f in RATING.fields])
    init = None
    if initial_ratings is not None:
        init = initial_profiles(initial_ratings, scorer.n_recent).groupBy("uid")
    profiles = scorer.with_heads(events).groupBy("uid").transformWithState(
        statefulProcessor=UserProfile(scorer.n_recent), outputStructType=PROFILE_SCHEMA,
        outputMode="Append", timeMode="None", initialState=init)
    bad_query = None
    if mode == "quarantine":
        def keep(batch: DataFrame, batch_id: int) -> None:
            replace_by_key(batch, bad_path, batch_id)

        bad_query = (bad.writeStream.foreachBatch(keep).trigger(**trigger)
                     .option("checkpointLocation", checkpoint.rstrip("/") + "-bad").start())
    scoring = (profiles.writeStream.foreachBatch(scorer).option("checkpointLocation", checkpoint)
               .trigger(**trigger).start())
    return RealtimeQueries(scoring, bad_query)
