"""
and for each a DuckDB oracle over the same Parquet tables.

Every query reads the whole driver tables (or data Spark derives from them).
Inexact float outputs (cosines, logs, RMSE) are rounded to 6 decimals in both
the query and its oracle; exact ones (means of half-point scores) are not.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from screenrank import schemas
from screenrank.functions import maps, vectors
from screenrank.operators import collab, content, realtime, similarity, stats
from screenrank.plans import oracle_views as V
from screenrank.sources import fixtures as fx
from screenrank.session import scratch_path
from screenrank.sinks.tables import overwrite_table, write_documents
from screenrank.sources import text
from screenrank.sources.tables import read_table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def _genre_values(genres) -> str:
    return "(VALUES " + ", ".join(f"('{g}')" for g in genres) + ") AS g(genre)"


# ---------------------------------------------------------------- statistics

@register("rating_count", V.with_views(V.STAR_RATINGS) + """
SELECT mid, count(mid) AS count FROM star_ratings GROUP BY mid""")
def q_rating_count(spark, d):
    return stats.rating_count(fx.star_ratings(spark, d))


@register("rating_count_by_month", V.with_views(V.STAR_RATINGS) + """
SELECT mid, count(mid) AS count, yearmonth FROM (
  SELECT mid, CAST(year(to_timestamp("timestamp") AT TIME ZONE 'UTC') * 100
                 + month(to_timestamp("timestamp") AT TIME ZONE 'UTC') AS INTEGER) AS yearmonth
  FROM star_ratings) t
GROUP BY yearmonth, mid
ORDER BY yearmonth DESC, count DESC, mid""")
def q_rating_count_by_month(spark, d):
    return stats.rating_count_by_month(fx.star_ratings(spark, d))


@register("rating_avg", V.with_views(V.STAR_RATINGS) + """
SELECT mid, avg(score) AS avg FROM star_ratings GROUP BY mid""")
def q_rating_avg(spark, d):
    return stats.rating_avg(fx.star_ratings(spark, d))


@register("genre_top10", V.with_views(V.STAR_RATINGS, V.PART_MOVIES) + f"""
, avgs AS (SELECT mid, avg(score) AS avg FROM star_ratings GROUP BY mid)
, scored AS (
  SELECT g.genre, m.mid, a.avg
  FROM part_movies m JOIN avgs a ON m.mid = a.mid
  JOIN {_genre_values(fx.FIXTURE_GENRES)}
    ON contains(lower(m.genres), lower(g.genre)))
SELECT genres, mid, score, rank FROM (
  SELECT genre AS genres, mid, avg AS score,
         CAST(row_number() OVER (PARTITION BY genre ORDER BY avg DESC, mid) AS INTEGER) AS rank
  FROM scored) t
WHERE rank <= 10""")
def q_genre_top10(spark, d):
    ratings = fx.star_ratings(spark, d)
    return stats.genre_top(fx.part_movies(spark, d), stats.rating_avg(ratings),
                           genres=fx.FIXTURE_GENRES, n=10)


@register("item_tags", V.with_views(V.EVENT_TAGS) + """
SELECT mid, coalesce(array_to_string(list_sort(list(DISTINCT tag) FILTER (WHERE tag IS NOT NULL)), '|'), '') AS tags
FROM event_tags GROUP BY mid""")
def q_item_tags(spark, d):
    return stats.item_tags(fx.event_tags(spark, d))


@register("search_documents", V.with_views(V.EVENT_TAGS, V.PART_MOVIES) + """
, it AS (
  SELECT mid, coalesce(array_to_string(list_sort(list(DISTINCT tag) FILTER (WHERE tag IS NOT NULL)), '|'), '') AS tags
  FROM event_tags GROUP BY mid)
SELECT m.mid, m.name, m.descri, m.timelong, m.issue, m.shoot, m.language, m.genres,
       m.actors, m.directors, it.tags
FROM part_movies m LEFT JOIN it ON m.mid = it.mid""")
def q_search_documents(spark, d):
    return stats.search_documents(fx.part_movies(spark, d), fx.event_tags(spark, d))


@register("distinct_users_items", V.with_views(V.STAR_RATINGS) + """
SELECT DISTINCT 'user' AS kind, uid AS id FROM star_ratings
UNION ALL
SELECT DISTINCT 'item' AS kind, mid AS id FROM star_ratings""")
def q_distinct_users_items(spark, d):
    return stats.distinct_users_items(fx.star_ratings(spark, d))


# ------------------------------------------------------------ recency / parse

@register("recent_ratings", V.with_views(V.EVENT_RATINGS) + """
SELECT uid, mid, score, rank FROM (
  SELECT uid, mid, score,
         CAST(row_number() OVER (PARTITION BY uid ORDER BY "timestamp" DESC, event_id DESC) AS INTEGER) AS rank
  FROM event_ratings) t
WHERE rank <= 20""")
def q_recent_ratings(spark, d):
    return realtime.recent_ratings(fx.event_ratings(spark, d), n=20)


@register("message_parse", V.with_views(V.EVENT_RATINGS) + """
SELECT uid, mid, score, "timestamp" FROM event_ratings""")
def q_message_parse(spark, d):
    good, _bad = text.parse_rating_messages(text.render_rating_messages(fx.event_ratings(spark, d)))
    return good


# ------------------------------------------------------------------- content

@register("tfidf_vectors", V.with_views(V.PART_MOVIES, V.TFIDF) + """
SELECT mid, idx, round(w, 6) AS weight FROM tfidf WHERE w <> 0""")
def q_tfidf_vectors(spark, d):
    long = content.tfidf_long(fx.part_movies(spark, d), num_features=50)
    return long.select("mid", "idx", F.round("w", 6).alias("weight"))


@register("content_similar", V.with_views(V.PART_MOVIES, V.CONTENT_SIM) + """
SELECT mid, sim_mid, round(score, 6) AS score FROM sim""")
def q_content_similar(spark, d):
    return content.content_similar(fx.part_movies(spark, d), threshold=0.6, digits=6)


# ------------------------------------------------------ vectors and factors

@register("vector_similar", V.with_views(V.EMBED) + """
, n AS (SELECT id, e, sqrt(list_dot_product(e, e)) AS norm FROM v)
, c AS (
  SELECT a.id AS mid, b.id AS sim_mid, list_dot_product(a.e, b.e) / nullif(a.norm * b.norm, 0) AS score
  FROM n a JOIN n b ON a.id <> b.id)
SELECT mid, sim_mid, round(score, 6) AS score FROM c WHERE score >= 0.3""")
def q_vector_similar(spark, d):
    edges = similarity.similar_items_dense(fx.vectors(spark, d), threshold=0.3, inclusive=True)
    return edges.select("mid", "sim_mid", F.round("score", 6).alias("score"))


@register("recommend_topn_fixed", V.with_views(V.EMBED) + """
, u AS (SELECT id AS uid, e FROM v WHERE id % 2 = 0)
, i AS (SELECT id AS mid, e FROM v WHERE id % 2 = 1)
, s AS (SELECT u.uid, i.mid, list_dot_product(u.e, i.e) AS score FROM u CROSS JOIN i)
SELECT uid, mid, round(score, 6) AS score, rank FROM (
  SELECT uid, mid, score,
         CAST(row_number() OVER (PARTITION BY uid ORDER BY score DESC, mid) AS INTEGER) AS rank
  FROM s WHERE score > 0) t
WHERE rank <= 20""")
def q_recommend_topn_fixed(spark, d):
    users, items = fx.fixed_factors(spark, d)
    recs = similarity.recommend_topn(users, items, n=20, min_score=0.0)
    return recs.select("uid", "mid", F.round("score", 6).alias("score"), "rank")


# ---------------------------------------------------- hold-out evaluation

GRID_SHRINKAGE = (0.0, 1.0, 2.0, 5.0, 10.0, 25.0, 50.0)


@register("split_md5", V.with_views(V.STAR_RATINGS, V.SPLIT) + """
SELECT uid, mid, score, "timestamp", split FROM sp""")
def q_split_md5(spark, d):
    return collab.split_ratings(fx.star_ratings(spark, d), 0.8)


def _train_test(spark, d):
    """Both sides of the hold-out split, from one pass over the ratings join:
    the split is written to the shared scratch folder and read back."""
    path = scratch_path(spark, "split")
    collab.split_ratings(fx.star_ratings(spark, d), 0.8).write.parquet(path)
    sp = spark.read.parquet(path)
    return sp.filter(F.col("split") == "train"), sp.filter(F.col("split") == "test")


@register("rmse_item_mean", V.with_views(V.STAR_RATINGS, V.SPLIT) + """
, pred AS (SELECT mid, sum(score) / count(score) AS prediction FROM tr GROUP BY mid)
, p AS (SELECT DISTINCT te.uid, te.mid, pred.prediction FROM te JOIN pred ON te.mid = pred.mid)
SELECT round(sqrt(avg((te.score - p.prediction) * (te.score - p.prediction))), 6) AS rmse,
       count(*) AS n
FROM te JOIN p ON te.uid = p.uid AND te.mid = p.mid""")
def q_rmse_item_mean(spark, d):
    train, test = _train_test(spark, d)
    pred = collab.item_mean_predictions(train, test.select("uid", "mid").distinct(), shrinkage=0.0)
    r = collab.rmse(test, pred)
    return r.select(F.round("rmse", 6).alias("rmse"), "n")


@register("grid_argmin", V.with_views(V.STAR_RATINGS, V.SPLIT) + f"""
, st AS (SELECT mid, sum(score) AS s, count(score) AS c FROM tr GROUP BY mid)
, gm AS (SELECT avg(score) AS gm FROM tr)
, g AS (SELECT unnest(CAST([{", ".join(repr(x) for x in GRID_SHRINKAGE)}] AS DOUBLE[])) AS reg)
, pr AS (SELECT st.mid, g.reg, (st.s + g.reg * gm.gm) / (st.c + g.reg) AS prediction
         FROM st CROSS JOIN gm CROSS JOIN g)
, r AS (SELECT pr.reg, sqrt(avg((te.score - pr.prediction) * (te.score - pr.prediction))) AS rmse
        FROM te JOIN pr ON te.mid = pr.mid GROUP BY pr.reg)
SELECT reg, round(rmse, 6) AS rmse,
       CASE WHEN reg = (SELECT arg_min(reg, rmse) FROM r) THEN 1 ELSE 0 END AS best
FROM r""")
def q_grid_argmin(spark, d):
    train, test = _train_test(spark, d)
    g = collab.item_mean_grid(train, test, GRID_SHRINKAGE)
    return g.select("reg", F.round("rmse", 6).alias("rmse"), "best")


# ------------------------------------------------------ real-time (batch twin)

def _stream_inputs(spark, d):
    """The events, the similarity between distinct vectors with its members (not
    expanded to items), and the candidates."""
    ev = fx.event_ratings(spark, d)
    sim, members = content.content_factored(fx.part_movies(spark, d), threshold=0.6)
    cur = realtime.latest_per_user(ev)
    cands = realtime.stream_candidates(cur, sim, ev.select("uid", "mid"), n=20, members=members)
    return ev, sim, members, cands


@register("stream_candidates", V.with_views(V.EVENT_RATINGS, V.PART_MOVIES, V.CONTENT_SIM,
                                            V.STREAM_INPUTS) + """
SELECT uid, mid, score, rank FROM cands""")
def q_stream_candidates(spark, d):
    _ev, _sim, _members, cands = _stream_inputs(spark, d)
    return cands.select("uid", "mid", "score", "rank")


@register("stream_scores", V.with_views(V.EVENT_RATINGS, V.PART_MOVIES, V.CONTENT_SIM,
                                        V.STREAM_INPUTS, V.STREAM_SCORES) + """
SELECT uid, mid, score FROM scores""")
def q_stream_scores(spark, d):
    ev, sim, members, cands = _stream_inputs(spark, d)
    recent = realtime.recent_ratings(ev, n=20)
    return realtime.stream_scores(cands, recent, sim, members=members)


# ------------------------------------------- model training (checked fits)

# Largest relative error of a fitted user's normal equation (factors are floats).
EQUATION_TOLERANCE = 1e-3


@register("als_user_recs", V.with_views(V.STAR_RATINGS) + """
SELECT uid, 1 AS equation_ok, 1 AS list_ok, 1 AS length_ok, 1 AS items_ok FROM star_ratings GROUP BY uid""")
def q_als_user_recs(spark, d):
    """ALS at the reference's settings and each user's top 20, with four checks
    per user: the factors solve the user's normal equation, the list is in order
    and positive, it is as long as the number of items of positive score allows,
    and it names known items. A user without a list passes only if no item
    scores above 0."""
    ratings = fx.star_ratings(spark, d)
    model = collab.train_als(ratings)
    path = scratch_path(spark, "user-recs")
    n = collab.USER_MAX_RECOMMENDATION
    collab.als_user_recs(model, n).write.parquet(path)
    recs = spark.read.parquet(path)
    error = collab.user_equation_error(model, ratings, collab.ALS_REG)
    order = collab.lists_in_order(recs, "uid", n)
    known = ratings.select("mid").distinct().withColumn("known", F.lit(1))
    items = (recs.join(known, "mid", "left").groupBy("uid")
             .agg(F.min(F.coalesce("known", F.lit(0)) * (F.col("score") > 0).cast("int")).alias("items_ok"),
                  F.count("*").alias("length")))
    positive = similarity.count_products(
        collab.user_factors(model).withColumnRenamed("uid", "id"),
        collab.item_factors(model).withColumnRenamed("mid", "id"), 0.0).withColumnsRenamed({"id": "uid", "n": "positive"})
    length = F.coalesce("length", F.lit(0)) == F.least(F.col("positive"), F.lit(n))
    nothing = (F.col("positive") == 0).cast("int")
    return (error.join(order, "uid", "left").join(items, "uid", "left").join(positive, "uid", "left")
            .select("uid", (F.col("error") <= EQUATION_TOLERANCE).cast("int").alias("equation_ok"),
                    F.coalesce("ok", nothing).alias("list_ok"), length.cast("int").alias("length_ok"),
                    F.coalesce("items_ok", nothing).alias("items_ok")))


# Neighbours kept per item in the registered item-similarity query.
ITEM_NEIGHBOURS = 20


@register("als_item_similar", V.with_views(V.STAR_RATINGS) + """
SELECT mid, 1 AS list_ok, 1 AS length_ok, 1 AS score_ok FROM star_ratings GROUP BY mid""")
def q_als_item_similar(spark, d):
    """Item factors at the reference's settings; the ``ITEM_NEIGHBOURS`` best
    neighbours of each item with cosine >= 0.6 (the operator without ``top_n``
    gives all). Per item: the list is in order, it is as long as the number of
    items that similar allows, and each score is at least 0.6 and equals the
    cosine worked out anew from the two factors."""
    model = collab.train_als(fx.star_ratings(spark, d))
    path = scratch_path(spark, "item-similar")
    collab.als_item_similar(model, top_n=ITEM_NEIGHBOURS).write.parquet(path)
    edges = spark.read.parquet(path)
    factors = collab.item_factors(model)
    pairs = (edges.join(factors.withColumnRenamed("vec", "a"), "mid")
             .join(factors.select(F.col("mid").alias("sim_mid"), F.col("vec").alias("b")), "sim_mid"))
    good = ((F.abs(vectors.cosine("a", "b") - F.col("score")) < 1e-6)
            & (F.col("score") >= collab.ALS_SIM_THRESHOLD) & (F.col("mid") != F.col("sim_mid")))
    scores = pairs.groupBy("mid").agg(F.min(good.cast("int")).alias("score_ok"), F.count("*").alias("length"))
    order = collab.lists_in_order(edges, "mid", ITEM_NEIGHBOURS, item="sim_mid")
    unit = factors.withColumn("norm", vectors.norm2("vec")).where("norm > 0").select(
        F.col("mid").alias("id"), F.transform("vec", lambda x: x.cast("double") / F.col("norm")).alias("vec"))
    similar = (similarity.count_products(unit, unit, collab.ALS_SIM_THRESHOLD, inclusive=True)
               .select(F.col("id").alias("mid"), (F.col("n") - 1).alias("similar")))  # but itself
    n = F.coalesce("similar", F.lit(0))
    length = F.coalesce("length", F.lit(0)) == F.least(n, F.lit(ITEM_NEIGHBOURS))
    nothing = (n == 0).cast("int")
    return (factors.select("mid").join(order, "mid", "left").join(scores, "mid", "left").join(similar, "mid", "left")
            .select("mid", F.coalesce("ok", nothing).alias("list_ok"), length.cast("int").alias("length_ok"),
                    F.coalesce("score_ok", nothing).alias("score_ok")))


@register("als_grid", V.with_views(V.STAR_RATINGS, V.SPLIT) + f"""
, gm AS (SELECT avg(score) AS gm FROM tr)
, base AS (SELECT round(sqrt(avg((score - gm) * (score - gm))), 6) AS mean_rmse FROM te CROSS JOIN gm)
SELECT CAST(r AS INTEGER) AS rank, g AS reg, 1 AS fitted, 1 AS best_count, mean_rmse
FROM (SELECT unnest([{", ".join(map(str, collab.GRID_RANKS))}]) AS r)
CROSS JOIN (SELECT unnest(CAST([{", ".join(map(str, collab.GRID_REGS))}] AS DOUBLE[])) AS g) CROSS JOIN base""")
def q_als_grid(spark, d):
    """The reference's 16 fits on one split. Per fit: its error on the ratings it
    was fitted to is below that of their mean (on held-out ratings, which are
    random here, not every fit beats the mean; README lists them); one fit is
    flagged as the best, and it is the least; next to them the held-out error
    of the training mean."""
    train, test = _train_test(spark, d)
    train, test = train.drop("split"), test.drop("split")
    g = collab.als_grid(train, test)
    gm = train.agg(F.avg("score")).scalar()
    off = F.sqrt(F.avg(F.pow(F.col("score") - gm, 2)))
    base = test.agg(off.alias("mean_rmse"))
    spread = train.agg(F.stddev_pop("score").alias("train_mean_rmse"))
    best = g.agg(F.sum("best").alias("flags"), F.min("rmse").alias("least"),
                 F.max(F.when(F.col("best") == 1, F.col("rmse"))).alias("flagged"))
    one = base.crossJoin(best).crossJoin(spread)  # one row each
    return (g.crossJoin(F.broadcast(one))
            .select("rank", "reg", (F.col("train_rmse") < F.col("train_mean_rmse")).cast("int").alias("fitted"),
                    F.when(F.col("least") == F.col("flagged"), F.col("flags")).cast("int").alias("best_count"),
                    F.round("mean_rmse", 6).alias("mean_rmse")))


# Settings of the fit whose predictions are a result of their own.
PREDICT_RANK = 10


@register("als_predict", V.with_views(V.STAR_RATINGS, V.SPLIT) + """
, p AS (SELECT DISTINCT uid, mid FROM te)
SELECT uid, mid, 1 AS prediction_ok FROM p
WHERE uid IN (SELECT uid FROM tr) AND mid IN (SELECT mid FROM tr)""")
def q_als_predict(spark, d):
    """Predictions for the held-out pairs, one row a pair whose user and item are
    known from training; each equals the product of its two factors."""
    train, test = _train_test(spark, d)
    model = collab.train_als(train.drop("split"), rank=PREDICT_RANK)
    pairs = test.select("uid", "mid").distinct()
    p = collab.predict(model, pairs)
    both = (p.join(collab.user_factors(model).withColumnRenamed("vec", "u"), "uid")
            .join(collab.item_factors(model).withColumnRenamed("vec", "v"), "mid"))
    same = F.abs(vectors.dot("u", "v") - F.col("prediction")) < 1e-4
    return both.select("uid", "mid", same.cast("int").alias("prediction_ok"))


# ------------------------------------------------------------ streaming job

STREAM_SLICES = 4


def run_stream_over_events(spark, d, slices: int = STREAM_SLICES, bootstrap: bool = False) -> str:
    """Replay the event ratings through the streaming job.

    Events are rendered as ``uid|mid|score|timestamp`` text files in
    ``slices`` consecutive time ranges; after each file lands the stream runs
    with ``availableNow`` from the same checkpoint (one micro-batch per slice,
    restarts included). With ``bootstrap`` the first half of the slices is the
    Rating table that seeds the state, and only the rest is streamed. Returns
    the output log path."""
    from screenrank.streaming.stateful import ProfileScorer, start_stateful, write_vector_heads

    root = scratch_path(spark, "stream")
    ev = fx.event_ratings(spark, d)
    # the offline job's tables: the similarity between distinct vectors, and their items
    sim_path, members_path = os.path.join(root, "sim"), os.path.join(root, "members")
    rep_edges, members = content.content_factored(fx.part_movies(spark, d), threshold=0.6)
    rep_edges.write.parquet(sim_path)
    members.write.parquet(members_path)
    cuts = _time_cuts(ev, slices)
    heads_path = os.path.join(root, "heads")  # once, not at each restart
    write_vector_heads(spark.read.parquet(sim_path), spark.read.parquet(members_path), heads_path)
    handler = ProfileScorer(sim_path=sim_path, members_path=members_path, heads_path=heads_path,
                            out_path=os.path.join(root, "recs"))
    src, ckpt = os.path.join(root, "in"), os.path.join(root, "ckpt")
    first = slices // 2 if bootstrap else 0
    known = None
    if bootstrap:
        rating_path = os.path.join(root, "rating")
        ev.filter(F.col("timestamp") < cuts[first]).write.parquet(rating_path)
        known = spark.read.parquet(rating_path)
    for i in range(first, slices):
        part = ev.filter((F.col("timestamp") >= cuts[i]) & (F.col("timestamp") < cuts[i + 1]))
        text.render_rating_messages(part).write.mode("append").text(src)
        start_stateful(spark, src, handler, ckpt, initial_ratings=known,
                       trigger={"availableNow": True}).awaitTermination()
    handler.close()
    return handler.out_path


def _time_cuts(ev, slices: int) -> list[int]:
    bounds = ev.agg(F.min("timestamp").alias("lo"), F.max("timestamp").alias("hi")).first()
    lo, hi = int(bounds["lo"]), int(bounds["hi"])
    return [lo + (hi - lo + 1) * i // slices for i in range(slices + 1)]


@register("stream_recs", V.with_views(V.EVENT_RATINGS, V.PART_MOVIES, V.CONTENT_SIM,
                                     V.STREAM_INPUTS_MSG, V.STREAM_SCORES) + """
SELECT uid, mid, score,
       CAST(row_number() OVER (PARTITION BY uid ORDER BY score DESC, mid) AS INTEGER) AS rank
FROM scores""")
def q_stream_recs(spark, d):
    from screenrank.operators.topk import unnest_recs
    from screenrank.streaming.recommender import current_recs

    out = run_stream_over_events(spark, d)
    return unnest_recs(current_recs(spark, out), "uid")


@register("stream_recs_bootstrap", V.with_views(V.EVENT_RATINGS, V.PART_MOVIES, V.CONTENT_SIM,
                                                V.STREAM_INPUTS_MSG, V.STREAM_SCORES) + f"""
, half AS (SELECT min("timestamp") + (max("timestamp") - min("timestamp") + 1) * {STREAM_SLICES // 2}
                  // {STREAM_SLICES} AS t FROM event_ratings)
, late AS (SELECT DISTINCT uid FROM event_ratings, half WHERE "timestamp" >= half.t)
SELECT uid, mid, score,
       CAST(row_number() OVER (PARTITION BY uid ORDER BY score DESC, mid) AS INTEGER) AS rank
FROM scores WHERE uid IN (SELECT uid FROM late)""")
def q_stream_recs_bootstrap(spark, d):
    """The first half of the events is the Rating table that seeds the state,
    the second half is streamed."""
    from screenrank.operators.topk import unnest_recs
    from screenrank.streaming.recommender import current_recs

    out = run_stream_over_events(spark, d, bootstrap=True)
    return unnest_recs(current_recs(spark, out), "uid")


@register("recent_list_read", V.with_views(V.EVENT_RATINGS) + """
SELECT uid, mid, score, rank FROM (
  SELECT uid, mid, score, CAST(row_number() OVER (
    PARTITION BY uid ORDER BY "timestamp" DESC, mid DESC, score DESC) AS INTEGER) AS rank
  FROM event_ratings) t
WHERE rank <= 20""")
def q_recent_list_read(spark, d):
    """All events through the stream in two runs; then each user's stored recent
    list is read back from the state store, and its ``mid:score`` entries parsed."""
    from screenrank.streaming.stateful import StateOnly, recent_lists, start_stateful

    root = scratch_path(spark, "recent-lists")
    ev = fx.event_ratings(spark, d)
    src, ckpt = os.path.join(root, "in"), os.path.join(root, "ckpt")
    cuts = _time_cuts(ev, 2)
    for i in range(2):
        part = ev.filter((F.col("timestamp") >= cuts[i]) & (F.col("timestamp") < cuts[i + 1]))
        text.render_rating_messages(part).write.mode("append").text(src)
        start_stateful(spark, src, StateOnly(), ckpt, trigger={"availableNow": True}).awaitTermination()
    lists = recent_lists(spark, ckpt).select("uid", F.posexplode(text.parse_recent_entries("entries")).alias("p", "r"))
    return lists.select("uid", "r.mid", "r.score", (F.col("p") + 1).alias("rank"))


# ------------------------------------------------------- loading and storing

def _through_text(spark, lines, load, schema):
    """Lines to a text file, loaded, stored, and read back as a checked table."""
    root = scratch_path(spark, "load")
    lines.write.text(os.path.join(root, "lines"))
    good, _bad = load(spark, os.path.join(root, "lines"))  # fails on a bad line
    overwrite_table(good, os.path.join(root, "table"))
    return read_table(spark, os.path.join(root, "table"), schema)


@register("movie_line_load", V.with_views(V.PART_MOVIES) + """
SELECT mid, name, descri, timelong, issue, shoot, language, genres, actors, directors FROM part_movies""")
def q_movie_line_load(spark, d):
    m = fx.part_movies(spark, d)
    padded = [F.concat(F.lit(" "), F.col(c), F.lit("\t")) for c in schemas.MOVIE_TEXT_FIELDS]
    lines = m.select(F.concat_ws("^", F.col("mid").cast("string"), *padded).alias("value"))
    return _through_text(spark, lines, text.load_movies, schemas.MOVIE)


@register("rating_line_load", V.with_views(V.EVENT_RATINGS) + """
SELECT uid, mid, score, "timestamp" FROM event_ratings""")
def q_rating_line_load(spark, d):
    lines = fx.event_ratings(spark, d).select(F.concat_ws(",", *[
        F.col(f.name).cast("string") for f in schemas.RATING.fields]).alias("value"))
    return _through_text(spark, lines, text.load_ratings, schemas.RATING)


@register("tag_line_load", V.with_views(V.EVENT_TAGS) + """
SELECT uid, mid, tag, "timestamp" FROM event_tags""")
def q_tag_line_load(spark, d):
    lines = fx.event_tags(spark, d).select(F.concat_ws(
        ",", F.col("uid").cast("string"), F.col("mid").cast("string"),
        F.concat(F.lit(" "), F.col("tag"), F.lit(" ")), F.col("timestamp").cast("string")).alias("value"))
    return _through_text(spark, lines, text.load_tags, schemas.TAG)


@register("document_roundtrip", ORACLES["search_documents"])
def q_document_roundtrip(spark, d):
    """Search documents written one per movie (duplicates are an error), read back."""
    docs = QUERIES["search_documents"](spark, d)
    path = scratch_path(spark, "documents")
    write_documents(docs, path, key="mid")
    return spark.read.schema(docs.schema).json(path)


@register("recs_map_lookup", V.with_views(V.EVENT_RATINGS) + """
, r AS (SELECT *, row_number() OVER (PARTITION BY uid, mid ORDER BY "timestamp" DESC, event_id DESC) AS k
        FROM event_ratings)
, b AS (SELECT uid, min(mid) AS least_mid, count(DISTINCT mid) AS items FROM event_ratings GROUP BY uid)
SELECT b.uid, least_mid, items, r.score, CAST(0.0 AS DOUBLE) AS missing
FROM b JOIN r ON r.uid = b.uid AND r.mid = b.least_mid AND r.k = 1""")
def q_recs_map_lookup(spark, d):
    """Each user's ratings in time order as a list of pairs, made a map (the
    last entry of an item wins) and looked up for a present and an absent item."""
    lists = (fx.event_ratings(spark, d).groupBy("uid")
             .agg(F.array_sort(F.collect_list(F.struct("timestamp", "event_id", "mid", "score"))).alias("recs"),
                  F.min("mid").alias("least_mid")))
    m = lists.select("uid", "least_mid", maps.recs_to_map("recs").alias("m"))
    return m.select("uid", "least_mid", F.size("m").cast("bigint").alias("items"),
                    maps.lookup("m", "least_mid").alias("score"),
                    maps.lookup("m", F.lit(-1).cast("bigint")).alias("missing"))


@register("content_similar_top20", V.with_views(V.PART_MOVIES, V.CONTENT_SIM) + """
, r AS (SELECT mid, sim_mid, round(score, 6) AS score, row_number() OVER (
          PARTITION BY mid ORDER BY round(score, 9) DESC, sim_mid) AS k FROM sim)
SELECT mid, sim_mid, score, CAST(k AS INTEGER) AS rank FROM r WHERE k <= 20""")
def q_content_similar_top20(spark, d):
    edges = content.content_similar(fx.part_movies(spark, d), top_n=20)
    return edges.select("mid", "sim_mid", F.round("score", 6).alias("score"), "rank")
