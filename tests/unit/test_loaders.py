import pytest

from screenrank.sources import text
from screenrank.sources.text import (parse_movie_lines, parse_rating_lines, parse_rating_messages,
                                     parse_tag_lines, render_rating_messages)


def lines(spark, rows):
    return spark.createDataFrame([(r,) for r in rows], "value string")


def test_movie_lines_trim_and_empty_last_field(spark):
    good, _ = parse_movie_lines(lines(spark, [
        "1^Toy Story^ desc ^81 minutes^March 20, 2001^1995^English^Adventure|Animation^Tom Hanks^",
        "2^\tJumanji\t^d^104^x^1995^English^Adventure|Children^Robin Williams^Joe Johnston",
    ]), mode="fail")
    rows = {r.mid: r for r in good.collect()}
    assert rows[1].descri == "desc" and rows[1].directors == ""
    assert rows[2].name == "Jumanji" and rows[2].genres == "Adventure|Children"


def test_movie_short_line_and_bad_id(spark):
    data = lines(spark, ["3^too^short", "x^a^b^c^d^e^f^g^h^i", "4^a^b^c^d^e^f^g^h^i"])
    good, bad = parse_movie_lines(data, mode="quarantine")
    assert [r.mid for r in good.collect()] == [4]
    reasons = sorted(r.reason for r in bad.collect())
    assert reasons == ["fewer than 10 fields", "mid is not an integer"]
    good_fail, _ = parse_movie_lines(data, mode="fail")
    with pytest.raises(Exception, match="bad movie line"):
        good_fail.collect()


def test_fail_mode_check_survives_column_pruning(spark):
    good, _ = parse_movie_lines(lines(spark, ["x^a^b^c^d^e^f^g^h^i"]), mode="fail")
    with pytest.raises(Exception, match="bad movie line"):
        good.select("name").collect()


def test_ratings_half_points_and_bad_score(spark):
    good, bad = parse_rating_lines(lines(spark, ["1,31,4.5,1260759144", "1,32,abc,1260759144"]),
                                   mode="quarantine")
    assert [(r.uid, r.mid, r.score, r.timestamp) for r in good.collect()] == [(1, 31, 4.5, 1260759144)]
    assert [r.reason for r in bad.collect()] == ["score is not a number"]


def test_tags_trimmed(spark):
    good, _ = parse_tag_lines(lines(spark, ["15,1955, dentist ,1193435061"]), mode="fail")
    assert good.first().tag == "dentist"


def test_message_round_trip(spark):
    ratings = spark.createDataFrame([(7, 9, 3.5, 100)], "uid long, mid long, score double, timestamp long")
    msgs = render_rating_messages(ratings)
    assert msgs.first().value == "7|9|3.5|100"
    good, _ = parse_rating_messages(msgs)
    assert good.first().asDict() == {"uid": 7, "mid": 9, "score": 3.5, "timestamp": 100}


def test_recent_entries_parse_like_the_stored_list(spark):
    df = spark.createDataFrame([(["3:4.5", " 12 :0.5", "x:1.0", "7:", "8"],), ([],)], "e array<string>")
    got = [r.r for r in df.select(text.parse_recent_entries("e").alias("r")).collect()]
    assert [(x.mid, x.score) for x in got[0]] == [(3, 4.5), (12, 0.5), (None, 1.0), (7, None), (8, None)] and got[1] == []
