"""Small helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from screenrank.session import scratch_path
from screenrank.sinks.tables import _fs_path

#: Rows up to which a narrow side (a few numbers a row) is broadcast, after
#: counting it; 1M rows of ids and hashes stay below some tens of MB.
BROADCAST_ROWS = 1_000_000


def saved(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    Cuts the lineage: what follows survives the loss of any executor without
    redoing what led here. The folder lies below ``spark.checkpoint.dir``.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with shuffles_dropped(spark):
        df.write.parquet(path, compression=compression)
    out = spark.read.schema(df.schema).parquet(path)
    out.saved_in = path
    return out


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of what runs meanwhile go when it ends, not when the driver
    happens to collect its garbage; a stage that needs them again makes them anew."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before) if before is not None else spark.conf.unset(key)


def dropped(*tables: DataFrame) -> None:
    """Delete the folders of what ``saved`` returned; nothing may read them any more."""
    for df in tables:
        fs, path = _fs_path(df.sparkSession, df.saved_in)
        fs.delete(path, True)


def small_side(df: DataFrame, rows: int, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast ``df`` if its counted ``rows`` are within ``limit``; else leave
    the join to Spark's shuffle joins."""
    return F.broadcast(df) if rows <= limit else df


def components(edges: DataFrame, name: str = "components", max_rounds: int = 50) -> DataFrame:
    """Connected components of undirected ``edges`` (a, b): one row (id, label)
    per node, ``label`` the smallest id of its component.

    Alternates the large-star and small-star steps, each a grouped minimum
    joined back to the edges, until nothing changes. Null ends and self-edges
    are ignored; repeated edges count once; no edges give an empty result.
    """
    e = edges.selectExpr("greatest(a, b) AS a", "least(a, b) AS b").where("a <> b").distinct()
    state = None
    for i in range(max_rounds):
        before, e = e, saved(_small_star(_large_star(e)) if i else _small_star(e), f"{name}-{i}")
        if i:
            dropped(before)
        now = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    else:
        raise RuntimeError(f"components did not converge in {max_rounds} rounds")
    return (e.selectExpr("a AS id", "b AS label")
            .union(e.selectExpr("b AS id", "b AS label").distinct()))


def _large_star(e: DataFrame) -> DataFrame:
    both = e.union(e.selectExpr("b AS a", "a AS b"))
    low = both.groupBy("a").agg(F.min("b").alias("m")).selectExpr("a", "least(a, m) AS m")
    return both.join(low, "a").where("b > a").selectExpr("b AS a", "m AS b").distinct()


def _small_star(e: DataFrame) -> DataFrame:
    low = e.groupBy("a").agg(F.min("b").alias("m"))
    moved = e.join(low, "a").where("b <> m").selectExpr("b AS a", "m AS b")
    return moved.union(low.selectExpr("a", "m AS b")).distinct()
