from pyspark.sql import functions as F

from screenrank.operators import stats
from screenrank.operators.topk import nest_recs, unnest_recs

MOVIE = ("mid long, name string, descri string, timelong string, issue string, shoot string, "
         "language string, genres string, actors string, directors string")


def movie(mid, genres):
    return (mid, f"m{mid}", "", "", "", "", "", genres, "", "")


def ratings_df(spark, rows):
    return spark.createDataFrame(rows, "uid long, mid long, score double, timestamp long")


def test_counts_and_month(spark):
    r = ratings_df(spark, [(1, 10, 4.0, 1262303999), (2, 10, 3.0, 1262304000), (3, 11, 5.0, 1262304000)])
    assert {(x.mid, x["count"]) for x in stats.rating_count(r).collect()} == {(10, 2), (11, 1)}
    m = {(x.mid, x.yearmonth): x["count"] for x in stats.rating_count_by_month(r).collect()}
    # 1262303999 is 2009-12-31 23:59:59 UTC, one second later is January.
    assert m == {(10, 200912): 1, (10, 201001): 1, (11, 201001): 1}
    ordered = [x.yearmonth for x in stats.rating_count_by_month(r).collect()]
    assert ordered == sorted(ordered, reverse=True)


def test_month_time_zone_parameter(spark):
    r = ratings_df(spark, [(1, 10, 4.0, 1262304000)])  # 2010-01-01 00:00 UTC
    assert stats.rating_count_by_month(r, tz="America/New_York").first().yearmonth == 200912


def test_genre_top_substring_ties_and_unrated(spark):
    movies = spark.createDataFrame([movie(1, "Cold|Action"), movie(2, "Old"), movie(3, "Drama"),
                                    movie(4, "Comedy"), movie(5, None)], MOVIE)
    r = ratings_df(spark, [(1, 1, 4.0, 0), (1, 2, 4.0, 0), (1, 3, 2.0, 0), (1, 5, 5.0, 0)])
    top = stats.genre_top(movies, stats.rating_avg(r), genres=["old", "Drama", "War", "action"], n=10)
    got = sorted((x.genres, x.mid, x.rank) for x in top.collect())
    # "old" matches inside "Cold"; tie on the mean goes to the smaller mid;
    # movie 4 is unrated, movie 5 has null genres, "War" matches nothing.
    assert got == [("Drama", 3, 1), ("action", 1, 1), ("old", 1, 1), ("old", 2, 2)]
    tok = stats.genre_top(movies, stats.rating_avg(r), genres=["old"], match="token")
    assert [x.mid for x in tok.collect()] == [2]


def test_genre_top_cut(spark):
    movies = spark.createDataFrame([movie(i, "Drama") for i in range(15)], MOVIE)
    r = ratings_df(spark, [(1, i, float(i % 5), 0) for i in range(15)])
    top = stats.genre_top(movies, stats.rating_avg(r), genres=["Drama"], n=10)
    rows = top.orderBy("rank").collect()
    assert len(rows) == 10 and [x.rank for x in rows] == list(range(1, 11))
    assert rows[0].score == 4.0 and rows[0].mid == 4


def test_item_tags_set_semantics_and_left_join(spark):
    tags = spark.createDataFrame([(1, 10, "b", 0), (2, 10, "a", 0), (3, 10, "b", 0), (4, 12, None, 0)],
                                 "uid long, mid long, tag string, timestamp long")
    movies = spark.createDataFrame([movie(10, "x"), movie(11, "y"), movie(12, "z")], MOVIE)
    docs = {x.mid: x.tags for x in stats.search_documents(movies, tags).collect()}
    assert docs == {10: "a|b", 11: None, 12: ""}


def test_nest_unnest_round_trip(spark):
    long = spark.createDataFrame([(1, 5, 0.5, 2), (1, 7, 0.9, 1), (2, 5, 0.1, 1)],
                                 "uid long, mid long, score double, rank int")
    nested = {r.uid: [(x.mid, x.score) for x in r.recs] for r in nest_recs(long, "uid").collect()}
    assert nested == {1: [(7, 0.9), (5, 0.5)], 2: [(5, 0.1)]}
    back = sorted(tuple(r) for r in unnest_recs(nest_recs(long, "uid"), "uid").collect())
    assert back == sorted(tuple(r) for r in long.collect())


def test_distinct_users_items(spark):
    r = ratings_df(spark, [(1, 10, 1.0, 0), (1, 11, 1.0, 0), (2, 10, 1.0, 0)])
    got = sorted(tuple(x) for x in stats.distinct_users_items(r).collect())
    assert got == [("item", 10), ("item", 11), ("user", 1), ("user", 2)]
