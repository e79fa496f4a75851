"""Set-wise scoring of a batch of rating events, and the stream's result table.

``score_events`` is the batch twin of the stream in ``streaming.stateful``: an
ordinary DataFrame function over a batch of events and the full history.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from screenrank.operators import realtime
from screenrank.operators.topk import nest_recs
from screenrank.sinks.tables import read_latest

# Messages carry no sequence number: ties on the timestamp are broken by
# (mid, score) so that replays and the batch twin agree.
STREAM_ORDER = ("timestamp", "mid", "score")


# Largest candidate x recent pair count (20 x 20 per user bound) for which a
# micro-batch side is broadcast; beyond it the same joins run as shuffles.
BROADCAST_MAX_ROWS = 2_000_000


def score_events(events: DataFrame, history: DataFrame, sim: DataFrame,
                 n_recent: int = realtime.MAX_USER_RATINGS, n_cands: int = realtime.MAX_SIM_MOVIES,
                 gate: float = realtime.SIM_GATE, order=STREAM_ORDER,
                 n_users: int | None = None) -> DataFrame:
    """New recommendation list of every user in ``events``.

    ``history`` must already contain ``events``. -> (uid, recs) where recs is
    array<struct<mid, score>> sorted by score desc, mid asc (possibly empty).
    ``n_users`` (the checked number of distinct users in ``events``) enables
    broadcasting the batch side when its proven bound is small."""
    cur = realtime.latest_per_user(events, order)
    users = cur.select("uid")
    small = n_users is not None and n_users * n_recent * n_cands <= BROADCAST_MAX_ROWS
    hist_u = history.join(F.broadcast(users) if small else users, "uid", "left_semi")
    cands = realtime.stream_candidates(cur, sim, hist_u.select("uid", "mid"), n=n_cands,
                                       broadcast=small)
    recent = realtime.recent_ratings(hist_u, n=n_recent, order=order)
    scores = realtime.stream_scores(cands, recent, sim, gate=gate, broadcast=small)
    ranked = realtime.top_n_per_group(scores, "uid", [F.desc("score"), F.asc("mid")], None)
    nested = nest_recs(ranked, "uid")
    empty = F.array().cast("array<struct<mid:bigint,score:double>>")
    return users.join(nested, "uid", "left").select("uid", F.coalesce("recs", empty).alias("recs"))


def current_recs(spark: SparkSession, out_path: str) -> DataFrame:
    """The StreamRecs table: newest list of every user."""
    return read_latest(spark, out_path, "uid")
