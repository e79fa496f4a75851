"""The recommender's jobs end to end: read tables, run operators, write tables.

Each job is a function of a session and folders, so it runs the same on a
laptop and on a cluster (folders are then shared storage). Table names are
the recommender's collection names.

    python -m screenrank.plans.jobs load --movies M --ratings R --tags T --out DIR
    python -m screenrank.plans.jobs statistics --tables DIR
    python -m screenrank.plans.jobs offline --tables DIR
    python -m screenrank.plans.jobs content --tables DIR
    python -m screenrank.plans.jobs trainer --tables DIR
    python -m screenrank.plans.jobs realtime --tables DIR --source SRC
"""

from __future__ import annotations

import argparse
import os
from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from screenrank.operators import collab, content, stats
from screenrank.operators.topk import nest_recs, top_n_per_group
from screenrank.schemas import MOVIE, RATING, TAG
from screenrank.sinks.tables import overwrite_table, write_documents
from screenrank.sources.tables import read_table
from screenrank.sources.text import load_movies, load_ratings, load_tags
from screenrank.streaming.stateful import ProfileScorer, RealtimeQueries, start_stateful

# Table (collection) names of the recommender.
MOVIE_T, RATING_T, TAG_T = "Movie", "Rating", "Tag"
SEARCH_DOCS_T = "MovieSearch"
RATE_MORE_T, RATE_MORE_RECENT_T = "RateMoreMovies", "RateMoreRecentlyMovies"
AVERAGE_T, GENRES_TOP_T = "AverageMovies", "GenresTopMovies"
USER_RECS_T, MOVIE_RECS_T = "UserRecs", "MovieRecs"
CONTENT_RECS_T, STREAM_RECS_T = "ContentMovieRecs", "StreamRecs"


def _t(root: str, name: str) -> str:
    return os.path.join(root, name)


def load_job(spark: SparkSession, movies_path: str, ratings_path: str, tags_path: str,
             out_dir: str, mode: str = "fail", quarantine_dir: str | None = None) -> None:
    """Text files -> Movie, Rating, Tag tables and the search documents
    (movies with their ``|``-joined distinct tags, one document per mid).

    ``mode="quarantine"`` writes lines that do not parse to ``quarantine_dir``,
    which it needs; the default fails on them."""
    if mode == "quarantine" and not quarantine_dir:
        raise ValueError('mode="quarantine" needs quarantine_dir: bad lines are not dropped')
    loaded = {MOVIE_T: load_movies(spark, movies_path, mode),
              RATING_T: load_ratings(spark, ratings_path, mode),
              TAG_T: load_tags(spark, tags_path, mode)}
    for name, (good, bad) in loaded.items():
        overwrite_table(good, _t(out_dir, name))
        if mode == "quarantine":
            overwrite_table(bad, _t(quarantine_dir, name))
    movies = read_table(spark, _t(out_dir, MOVIE_T), MOVIE)
    tags = read_table(spark, _t(out_dir, TAG_T), TAG)
    write_documents(stats.search_documents(movies, tags), _t(out_dir, SEARCH_DOCS_T), key="mid")


def statistics_job(spark: SparkSession, tables: str, genres: Sequence[str] = stats.DEFAULT_GENRES,
                   tz: str = "UTC", n: int = stats.GENRE_TOP_N) -> None:
    """Popularity, monthly popularity, mean score, per-genre top ``n``.

    The ratings scan is persisted once and feeds all four results."""
    ratings = read_table(spark, _t(tables, RATING_T), RATING).persist(StorageLevel.MEMORY_AND_DISK)
    movies = read_table(spark, _t(tables, MOVIE_T), MOVIE)
    try:
        overwrite_table(stats.rating_count(ratings), _t(tables, RATE_MORE_T))
        overwrite_table(stats.rating_count_by_month(ratings, tz), _t(tables, RATE_MORE_RECENT_T))
        avgs = stats.rating_avg(ratings)
        overwrite_table(avgs, _t(tables, AVERAGE_T))
        avgs = spark.read.parquet(_t(tables, AVERAGE_T))
        top = stats.genre_top(movies, avgs, genres=genres, n=n)
        overwrite_table(nest_recs(top, "genres"), _t(tables, GENRES_TOP_T))
    finally:
        ratings.unpersist()


def _write_similarity(sims: DataFrame, path: str, nested: bool) -> None:
    """Similarity lists, best first. Stored as ranked edges (mid, sim_mid,
    score, rank) by default: an uncut list can be as long as the catalogue,
    which a single nested row per item would put in one task; ``nested=True``
    writes the one-row-per-item shape (mid, recs) instead."""
    if "rank" not in sims.columns:
        sims = top_n_per_group(sims, "mid", [F.desc("score"), F.asc("sim_mid")], None)
    out = nest_recs(sims, "mid", item="sim_mid") if nested else sims
    overwrite_table(out, path)


def offline_job(spark: SparkSession, tables: str, rank: int = collab.ALS_RANK,
                max_iter: int = collab.ALS_ITERATIONS, reg: float = collab.ALS_REG,
                n: int = collab.USER_MAX_RECOMMENDATION, threshold: float = collab.ALS_SIM_THRESHOLD,
                top_n: int | None = None, seed: int = collab.DEFAULT_SEED, nested: bool = False) -> None:
    """ALS -> UserRecs (top ``n`` positive predictions per user) and MovieRecs
    (all items with factor cosine >= ``threshold``, best first)."""
    ratings = read_table(spark, _t(tables, RATING_T), RATING)
    model = collab.train_als(ratings, rank=rank, max_iter=max_iter, reg=reg, seed=seed)
    overwrite_table(nest_recs(collab.als_user_recs(model, n=n), "uid"), _t(tables, USER_RECS_T))
    sims = collab.als_item_similar(model, threshold=threshold, top_n=top_n)
    _write_similarity(sims, _t(tables, MOVIE_RECS_T), nested)


def content_job(spark: SparkSession, tables: str, threshold: float = content.CONTENT_THRESHOLD,
                num_features: int = content.NUM_FEATURES, nested: bool = False) -> None:
    """TF-IDF content similarity -> ContentMovieRecs (cosine > threshold)."""
    movies = read_table(spark, _t(tables, MOVIE_T), MOVIE)
    sims = content.content_similar(movies, threshold=threshold, num_features=num_features)
    _write_similarity(sims, _t(tables, CONTENT_RECS_T), nested)


def trainer_job(spark: SparkSession, tables: str, ranks: Sequence[int] = collab.GRID_RANKS,
                regs: Sequence[float] = collab.GRID_REGS, train_share: float = collab.TRAIN_SHARE,
                parallelism: int = 4) -> DataFrame:
    """Hold-out model selection; returns the grid with the best row flagged."""
    ratings = read_table(spark, _t(tables, RATING_T), RATING)
    sp = collab.split_ratings(ratings, train_share)
    train = sp.filter(F.col("split") == "train").drop("split")
    test = sp.filter(F.col("split") == "test").drop("split")
    return collab.als_grid(train, test, ranks=ranks, regs=regs, parallelism=parallelism)


def realtime_job(spark: SparkSession, tables: str, source: str | None, checkpoint: str,
                 sim_table: str = MOVIE_RECS_T, trigger: dict | None = None,
                 out_table: str = STREAM_RECS_T, fmt: str = "text", source_options: dict | None = None,
                 mode: str = "fail", compact_every: int | None = 100) -> RealtimeQueries:
    """Start the streaming recommender; similarity edges from ``sim_table``.

    Each user's recent ratings and seen items live in the streaming state
    store, bootstrapped once from Rating. ``fmt`` and ``source_options`` name
    the source (for a broker: topic, servers, starting offsets; ``source`` is
    None). In quarantine mode bad messages go to the table ``<out_table>Bad``."""
    scorer = ProfileScorer(sim_path=_t(tables, sim_table), out_path=_t(tables, out_table),
                           compact_every=compact_every)
    ratings = read_table(spark, _t(tables, RATING_T), RATING)
    return start_stateful(spark, source, scorer, checkpoint, initial_ratings=ratings, trigger=trigger,
                          fmt=fmt, source_options=source_options, mode=mode,
                          bad_path=_t(tables, out_table + "Bad"))


def main(argv: Sequence[str] | None = None) -> None:
    from screenrank.session import checkpoint_root, get_session

    ap = argparse.ArgumentParser(prog="screenrank.plans.jobs")
    ap.add_argument("job", choices=["load", "statistics", "offline", "content", "trainer", "realtime"])
    ap.add_argument("--tables", "--out", dest="tables", required=True)
    ap.add_argument("--movies")
    ap.add_argument("--ratings")
    ap.add_argument("--tags")
    ap.add_argument("--source")
    ap.add_argument("--format", default="text", help="stream source format")
    ap.add_argument("--option", action="append", default=[], metavar="KEY=VALUE",
                    help="stream source option, may be repeated")
    ap.add_argument("--mode", default="fail", choices=["fail", "quarantine"])
    ap.add_argument("--quarantine", help="folder for lines that do not parse (load)")
    ap.add_argument("--master", default=None)
    a = ap.parse_args(argv)
    spark = get_session(a.master) if a.master else SparkSession.builder.getOrCreate()
    if a.job == "load":
        load_job(spark, a.movies, a.ratings, a.tags, a.tables, a.mode, a.quarantine)
    elif a.job == "statistics":
        statistics_job(spark, a.tables)
    elif a.job == "offline":
        offline_job(spark, a.tables)
    elif a.job == "content":
        content_job(spark, a.tables)
    elif a.job == "trainer":
        trainer_job(spark, a.tables).show()
    else:
        q = realtime_job(spark, a.tables, a.source, os.path.join(checkpoint_root(spark), "realtime"),
                         fmt=a.format, source_options=dict(o.split("=", 1) for o in a.option), mode=a.mode)
        q.awaitTermination()


if __name__ == "__main__":
    main()
