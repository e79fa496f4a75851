"""

Ids are kept as 64-bit integers: the reference uses 32-bit ints, widening is
lossless, and 100 TB inputs routinely exceed 2**31 distinct keys. ALS, which
needs 32-bit ids, checks the range itself.
"""

from __future__ import annotations

from pyspark.sql import types as T

MOVIE_TEXT_FIELDS = ["name", "descri", "timelong", "issue", "shoot", "language",
                     "genres", "actors", "directors"]

MOVIE = T.StructType([T.StructField("mid", T.LongType())] +
                     [T.StructField(f, T.StringType()) for f in MOVIE_TEXT_FIELDS])

RATING = T.StructType([
    T.StructField("uid", T.LongType()),
    T.StructField("mid", T.LongType()),
    T.StructField("score", T.DoubleType()),
    T.StructField("timestamp", T.LongType()),
])

TAG = T.StructType([
    T.StructField("uid", T.LongType()),
    T.StructField("mid", T.LongType()),
    T.StructField("tag", T.StringType()),
    T.StructField("timestamp", T.LongType()),
])

RECOMMENDATION = T.StructType([
    T.StructField("mid", T.LongType()),
    T.StructField("score", T.DoubleType()),
])

# Long (edge-list) form of every nested result: key, item, score, rank.
def recs_long(key: str) -> T.StructType:
    return T.StructType([
        T.StructField(key, T.LongType()),
        T.StructField("mid", T.LongType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("rank", T.IntegerType()),
    ])


def recs_nested(key: str, key_type: T.DataType = T.LongType()) -> T.StructType:
    return T.StructType([
        T.StructField(key, key_type),
        T.StructField("recs", T.ArrayType(RECOMMENDATION)),
    ])
