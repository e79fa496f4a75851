"""Views of the driver's tables in the recommender's shapes (FIXTURES.md §3).

These are the inputs of every registered query. They are plain DataFrame
plans over the Parquet tables, so filters and column pruning reach the scans.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from screenrank.functions.scalar import epoch_seconds

# Score of an event by its type (FIXTURES.md §3).
EVENT_TYPE_SCORES = {"purchase": 5.0, "signup": 4.5, "click": 3.5, "view": 2.5, "error": 1.0}

# The genre list used with the part-movie fixture.
FIXTURE_GENRES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD",
                  "anvil", "blue", "gear", "old", "ring", "Widget"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def star_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem ⋈ orders: (uid, mid, score, timestamp).

    One shuffle join on the order key; at scale both tables should be stored
    bucketed/clustered by order key so this join is co-located."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return (li.join(od, li.l_orderkey == od.o_orderkey)
            .select(F.col("o_custkey").alias("uid"),
                    F.col("l_partkey").alias("mid"),
                    (F.ceil(F.col("l_quantity") / 5).cast("double") / 2).alias("score"),
                    epoch_seconds("o_orderdate").alias("timestamp")))


def _event_score(col: str = "event_type"):
    expr = None
    for k, v in EVENT_TYPE_SCORES.items():
        expr = (F.when(F.col(col) == k, F.lit(v)) if expr is None
                else expr.when(F.col(col) == k, F.lit(v)))
    return expr


def event_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as ratings: (uid, mid, score, timestamp, event_id).

    ``event_id`` is kept as the tie key of the (timestamp, event_id) order."""
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "props")
    return (ev.select(F.col("user_id").alias("uid"),
                      F.get_json_object("props", "$.k").cast("bigint").alias("mid"),
                      _event_score().alias("score"),
                      epoch_seconds("ts").alias("timestamp"),
                      F.col("event_id"))
            .filter(F.col("score").isNotNull() & F.col("mid").isNotNull()))


def event_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as tags: (uid, mid, tag, timestamp)."""
    ev = table(spark, sf_dir, "events").select("ts", "user_id", "event_type", "props")
    return (ev.select(F.col("user_id").alias("uid"),
                      F.get_json_object("props", "$.k").cast("bigint").alias("mid"),
                      F.col("event_type").alias("tag"),
                      epoch_seconds("ts").alias("timestamp"))
            .filter(F.col("mid").isNotNull()))


def part_movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """part as movies, in the 10-column movie contract."""
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type")
    empty = F.lit("")
    return p.select(
        F.col("p_partkey").alias("mid"),
        F.col("p_name").alias("name"),
        empty.alias("descri"), empty.alias("timelong"), empty.alias("issue"), empty.alias("shoot"),
        F.col("p_brand").alias("language"),
        F.concat_ws("|", F.col("p_type"), F.regexp_replace("p_name", " ", "|")).alias("genres"),
        empty.alias("actors"), empty.alias("directors"))


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """embeddings as (id, vec)."""
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").alias("vec"))


def fixed_factors(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """embeddings split into user factors (even ids) and item factors (odd)."""
    v = vectors(spark, sf_dir)
    users = v.filter(F.col("id") % 2 == 0).select(F.col("id").alias("uid"), F.col("vec"))
    items = v.filter(F.col("id") % 2 == 1).select(F.col("id").alias("mid"), F.col("vec"))
    return users, items
