"""Real-time re-ranking as set-wise DataFrame functions (S7, S8, T4, T5,
J7-J10, P10, P11, A9, R3, R4).

The reference handles one rating event at a time with point lookups into
outside stores. Here a whole micro-batch (or a whole table, for the batch
twin) is scored with joins: events -> similar items (J8) -> minus seen (J7)
-> top 20 (T4); candidates x recent ratings of the same user (J10) -> pair
similarity (J9) -> gate (P10) -> per-candidate aggregate (A9).

Per user the work is bounded by the cuts (<= 20 candidates x <= 20 recent
ratings), so a very active user cannot create a hot task here.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from screenrank.functions.scalar import log10_int
from screenrank.operators.similarity import nearest_items
from screenrank.operators.topk import top_n_per_group

# The reference's real-time settings (recent ratings read,
# candidates kept, similarity gate, "liked" above this score).
MAX_USER_RATINGS = 20
MAX_SIM_MOVIES = 20
SIM_GATE = 0.7
LIKE_ABOVE = 3.0
# Rounding of similarity scores before ranking (ties break on the smaller id).
SCORE_DIGITS = 6


def latest_per_user(events: DataFrame, order: Sequence[str] = ("timestamp", "event_id")) -> DataFrame:
    """One event per user: the last by ``order`` (several events of one user
    in a batch: the last write wins, as in the reference)."""
    return top_n_per_group(events, "uid", [F.desc(c) for c in order], 1).drop("rank")


def recent_ratings(ratings: DataFrame, n: int = MAX_USER_RATINGS,
                   order: Sequence[str] = ("timestamp", "event_id")) -> DataFrame:
    """Each user's latest ``n`` ratings -> (uid, mid, score, rank)."""
    top = top_n_per_group(ratings, "uid", [F.desc(c) for c in order], n)
    return top.select("uid", "mid", "score", "rank")


def neighbour_heads(sim: DataFrame, depth: int, digits: int | None = SCORE_DIGITS) -> DataFrame:
    """(mid, head_mids, head_scores, complete): each item's ``depth`` best
    neighbours in the order of ``stream_candidates`` (rounded score, then id), and
    whether these are all it has."""
    score = (F.round("score", digits) if digits is not None else F.col("score")).alias("score")
    ranked = top_n_per_group(sim.select("mid", "sim_mid", score), "mid", [F.desc("score"), F.asc("sim_mid")], depth + 1)
    lists = ranked.groupBy("mid").agg(F.array_sort(F.collect_list(F.struct("rank", "sim_mid", "score"))).alias("_h"))
    head = F.slice("_h", 1, depth)
    return lists.select("mid", F.transform(head, lambda x: x["sim_mid"]).alias("head_mids"),
                        F.transform(head, lambda x: x["score"]).alias("head_scores"),
                        (F.size("_h") <= depth).alias("complete"))


def vector_heads(rep_edges: DataFrame, members: DataFrame, depth: int,
                 digits: int | None = SCORE_DIGITS) -> DataFrame:
    """(rid, head_mids, head_scores, complete): ``neighbour_heads`` once per vector
    instead of once per item (``factored_similarity``). Items that share a vector
    have the same list but for themselves: it is one longer, and names them too."""
    ranked = nearest_items(rep_edges, members, depth + 2, digits=digits)
    lists = ranked.groupBy("rid").agg(F.array_sort(F.collect_list(F.struct("rank", "id", "score"))).alias("_h"))
    head = F.slice("_h", 1, depth + 1)
    return lists.select("rid", F.transform(head, lambda x: x["id"]).alias("head_mids"),
                        F.transform(head, lambda x: x["score"]).alias("head_scores"),
                        (F.size("_h") <= depth + 1).alias("complete"))


def _small(df: DataFrame, broadcast: bool) -> DataFrame:
    return F.broadcast(df) if broadcast else df


def _levels(need: DataFrame, key: str, n: int) -> tuple[DataFrame, list[int]]:
    """(key, _i): the smallest n * 2**i that covers the deepest probe ``_k`` of the
    key; and the values of i, at most some 30 numbers."""
    doublings = F.ceil(F.log2(F.max("_k") / F.lit(float(n))) - 1e-9).cast("int")
    of_key = need.groupBy(key).agg(F.greatest(doublings, F.lit(0)).alias("_i"))
    return of_key, sorted(r[0] for r in of_key.select("_i").distinct().collect())


def _factored_candidates(ev: DataFrame, rep_edges: DataFrame, members: DataFrame, seen: DataFrame, n: int,
                         digits: int | None, broadcast: bool) -> DataFrame:
    """``stream_candidates`` on the edges between distinct vectors."""
    vector_of = members.select(F.col("id").alias("src"), "rid")
    seen_u = seen.select("uid", "mid").join(_small(ev.select("uid").distinct(), broadcast), "uid", "left_semi")
    seen_n = seen_u.groupBy("uid").agg(F.count(F.lit(1)).alias("_s"))
    need = (_small(ev, broadcast).join(vector_of, "src").join(seen_n, "uid", "left")
            .select("uid", "src", "rid", (F.lit(n + 1) + F.coalesce(F.col("_s"), F.lit(0))).cast("int").alias("_k")))
    classes, levels = _levels(need, "rid", n)
    if not levels:  # no events, or none of an item that has a vector
        return ev.select("uid", F.col("src").alias("mid"), F.lit(None).cast("double").alias("score"),
                         F.lit(None).cast("int").alias("rank")).limit(0)
    ranked = reduce(DataFrame.unionByName, [
        nearest_items(rep_edges, members, n * 2 ** i, classes.where(F.col("_i") == i), digits, rank_col="_r")
        for i in levels])
    probes = need.select("uid", "src", "rid", F.explode(F.sequence(F.lit(1), F.col("_k"))).alias("_r"))
    cands = (ranked.join(probes, ["rid", "_r"]).filter(F.col("id") != F.col("src"))
             .select("uid", F.col("id").alias("mid"), "score"))
    fresh = cands.join(seen_u, ["uid", "mid"], "left_anti")
    return top_n_per_group(fresh, "uid", [F.desc("score"), F.asc("mid")], n)


def stream_candidates(current: DataFrame, sim: DataFrame, seen: DataFrame,
                      n: int = MAX_SIM_MOVIES, digits: int | None = SCORE_DIGITS,
                      broadcast: bool = False, members: DataFrame | None = None) -> DataFrame:
    """For each (uid, mid) event, the ``n`` most similar items of ``mid``
    the user has not rated yet -> (uid, mid, score, rank).

    ``sim``: (mid, sim_mid, score) edges; ``seen``: (uid, mid) ratings. Scores
    are rounded to ``digits`` before ranking so equal similarities tie exactly
    and fall back to the smaller mid.

    Exact bound instead of the full neighbour list: at most |seen(u)| of an
    item's ranked neighbours are already seen, so the ``n`` best unseen ones
    are among its first k = n + |seen(u)|. Each event probes ranks 1..k of its
    item by an equi-join on (item, rank); the work is linear in events plus
    history, even for an item that is current for many users and similar to a
    large part of the catalogue. Only the events' items are ranked, each as
    deep as its own users need, rounded up to n * 2**i: items of one depth share
    a top-k window (WindowGroupLimit), so a user with a long history deepens the
    lists of their own items only.

    ``broadcast=True`` is for a caller that has checked the events are few
    (a micro-batch): the event side is broadcast and the large tables are only
    scanned, never shuffled.

    ``members`` (id, rid, size): ``sim`` then holds the edges (ra, rb, score) between
    distinct vectors (``factored_similarity``), never expanded to items. The ranked
    lists are one per vector, and one deeper, since an item finds itself in its own."""
    ev = current.select("uid", F.col("mid").alias("src"))
    if members is not None:
        return _factored_candidates(ev, sim, members, seen, n, digits, broadcast)
    users = ev.select("uid").distinct()
    seen_u = seen.select("uid", "mid").join(_small(users, broadcast), "uid", "left_semi")
    seen_n = seen_u.groupBy("uid").agg(F.count(F.lit(1)).alias("_s"))
    need = ev.join(seen_n, "uid", "left").select(
        "uid", "src", (F.lit(n) + F.coalesce(F.col("_s"), F.lit(0))).cast("int").alias("_k"))
    srcs, levels = _levels(need, "src", n)
    edges = sim.select(F.col("mid").alias("src"), F.col("sim_mid").alias("mid"),
                       (F.round("score", digits) if digits is not None else F.col("score")).alias("score"))
    edges = edges.join(_small(srcs, broadcast), "src")
    if not levels:  # no events
        return edges.select(F.lit(None).cast("bigint").alias("uid"), "mid", "score",
                            F.lit(None).cast("int").alias("rank")).limit(0)
    ranked = reduce(DataFrame.unionByName, [
        top_n_per_group(edges.where(F.col("_i") == i), "src", [F.desc("score"), F.asc("mid")],
                        n * 2 ** i, rank_col="_r") for i in levels])
    probes = need.select("uid", "src", F.explode(F.sequence(F.lit(1), F.col("_k"))).alias("_r"))
    cands = ranked.join(probes, ["src", "_r"]).select("uid", "mid", "score")
    fresh = cands.join(seen_u, ["uid", "mid"], "left_anti")
    return top_n_per_group(fresh, "uid", [F.desc("score"), F.asc("mid")], n)


def stream_scores(cands: DataFrame, recent: DataFrame, sim: DataFrame, gate: float = SIM_GATE,
                  like_above: float = LIKE_ABOVE, digits: int | None = SCORE_DIGITS,
                  broadcast: bool = False, members: DataFrame | None = None) -> DataFrame:
    """Priority of each candidate from the user's recent ratings.

    score(u, q) = mean over gated r of sim(q, r) * rating(r)
                  + log10(max(1, #liked)) - log10(max(1, #disliked))
    where gated r are recent ratings with sim(q, r) > gate, liked means
    rating > like_above. Candidates with no gated rating produce no row.
    -> (uid, mid, score). ``broadcast``: the caller has bounded the
    candidate x recent pairs (<= 20 x 20 per user) to a broadcastable size.
    ``members``: as for ``stream_candidates``; a pair of items is looked up by the
    pair of their vectors."""
    c = cands.select("uid", F.col("mid").alias("q"))
    r = recent.select("uid", F.col("mid").alias("r"), F.col("score").alias("rating"))
    if members is not None:
        vector_of = members.select("id", "rid")
        c = _small(c, broadcast).join(vector_of.withColumnsRenamed({"id": "q", "rid": "_q"}), "q")
        r = _small(r, broadcast).join(vector_of.withColumnsRenamed({"id": "r", "rid": "_r"}), "r")
    pairs = c.join(r, "uid")  # J10: candidates x recent, within one user
    if members is not None:
        pairs = pairs.filter(F.col("q") != F.col("r")).select(
            "uid", "q", "rating", F.least("_q", "_r").alias("ra"), F.greatest("_q", "_r").alias("rb"))
        edges = sim.select("ra", "rb", F.col("score").alias("sim"))
        gated = edges.join(_small(pairs, broadcast), ["ra", "rb"]).filter(F.col("sim") > gate)  # J9 + P10
        return _mean_scores(gated, like_above, digits)
    s = sim.select(F.col("mid").alias("q"), F.col("sim_mid").alias("r"), F.col("score").alias("sim"))
    # only the candidates' edges take part in the pair join
    s = s.join(_small(c.select("q").distinct(), broadcast), "q", "left_semi")
    gated = s.join(_small(pairs, broadcast), ["q", "r"]).filter(F.col("sim") > gate)  # J9 + P10
    return _mean_scores(gated, like_above, digits)


def _mean_scores(gated: DataFrame, like_above: float, digits: int | None) -> DataFrame:
    """A9 over the gated pairs (uid, q, sim, rating) -> (uid, mid, score)."""
    liked = F.col("rating") > like_above
    agg = gated.groupBy("uid", "q").agg(
        F.avg(F.col("sim") * F.col("rating")).alias("_mean"),
        F.count_if(liked).alias("_inc"), F.count_if(~liked).alias("_dec"))
    score = (F.col("_mean") + log10_int(F.greatest(F.lit(1), F.col("_inc")))
             - log10_int(F.greatest(F.lit(1), F.col("_dec"))))
    if digits is not None:
        score = F.round(score, digits)
    return agg.select("uid", F.col("q").alias("mid"), score.alias("score"))
