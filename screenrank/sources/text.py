"""S1-S3, S6, S7 parsing: delimited text lines -> typed DataFrames.

Each loader returns ``(good, bad)``. ``mode="fail"`` raises on the first line
that does not parse (the reference's behaviour); ``mode="quarantine"`` keeps
such lines in ``bad`` with a reason instead. Parsing is built-in ``split`` and
``try_cast``, so it is codegen'd and independent of the session's ANSI flag.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from screenrank.functions.scalar import jvm_trim
from screenrank.schemas import MOVIE_TEXT_FIELDS


def _integer(c: Column) -> Column:
    """Decimal digits with an optional sign and nothing else, else null (a cast
    alone would accept blanks around them)."""
    return F.when(c.rlike(r"^[+-]?[0-9]+$"), c.try_cast("bigint"))


def _fields(value: Column, sep_regex: str) -> Column:
    # limit -1 keeps trailing empty fields (a JVM split drops them).
    return F.split(value, sep_regex, -1)


def _finish(parsed: DataFrame, ok: Column, reason: Column, cols: list[str],
            mode: str, what: str) -> tuple[DataFrame, DataFrame]:
    if mode not in ("fail", "quarantine"):
        raise ValueError("mode must be 'fail' or 'quarantine'")
    tagged = parsed.withColumn("_ok", ok).withColumn("_reason", reason)
    if mode == "fail":
        # A filter, not a projection: column pruning cannot drop the check.
        good = tagged.filter(F.when(F.col("_ok"), F.lit(True)).otherwise(
            F.raise_error(F.concat(F.lit(f"bad {what} line: "), F.col("value"),
                                   F.lit(" ("), F.col("_reason"), F.lit(")"))).cast("boolean"))
        ).select(*cols)
        bad = tagged.filter(F.lit(False)).select("value", F.col("_reason").alias("reason"))
        return good, bad
    good = tagged.filter("_ok").select(*cols)
    bad = tagged.filter(~F.col("_ok")).select("value", F.col("_reason").alias("reason"))
    return good, bad


def _reason(checks: list[tuple[Column, str]]) -> Column:
    expr = F.lit(None).cast("string")
    for cond, msg in reversed(checks):
        expr = F.when(~cond, F.lit(msg)).otherwise(expr)
    return expr


def _ok(checks):
    out = F.lit(True)
    for cond, _ in checks:
        out = out & F.coalesce(cond, F.lit(False))
    return out


def parse_movie_lines(lines: DataFrame, mode: str = "fail") -> tuple[DataFrame, DataFrame]:
    """``mid^name^...^directors`` (10 fields, ``^``-separated)."""
    f = _fields(F.col("value"), r"\^")
    parsed = lines.select("value", f.alias("_f"))
    cols = {"mid": _integer(F.col("_f")[0])}
    for i, name in enumerate(MOVIE_TEXT_FIELDS, start=1):
        cols[name] = jvm_trim(F.col("_f")[i])
    parsed = parsed.select("value", "_f", *[v.alias(k) for k, v in cols.items()])
    checks = [(F.size("_f") >= 10, "fewer than 10 fields"),
              (F.col("mid").isNotNull(), "mid is not an integer")]
    return _finish(parsed, _ok(checks), _reason(checks), ["mid"] + MOVIE_TEXT_FIELDS,
                   mode, "movie")


def parse_rating_lines(lines: DataFrame, mode: str = "fail", sep: str = ",") -> tuple[DataFrame, DataFrame]:
    """``uid<sep>mid<sep>score<sep>timestamp``."""
    f = _fields(F.col("value"), "\\" + sep if sep in "|^.$*+?()[]{}\\" else sep)
    parsed = lines.select("value", f.alias("_f")).select(
        "value", "_f",
        _integer(F.col("_f")[0]).alias("uid"),
        _integer(F.col("_f")[1]).alias("mid"),
        (jvm_trim(F.col("_f")[2])).try_cast("double").alias("score"),
        _integer(F.col("_f")[3]).alias("timestamp"))
    checks = [(F.size("_f") >= 4, "fewer than 4 fields"),
              (F.col("uid").isNotNull(), "uid is not an integer"),
              (F.col("mid").isNotNull(), "mid is not an integer"),
              (F.col("score").isNotNull(), "score is not a number"),
              (F.col("timestamp").isNotNull(), "timestamp is not an integer")]
    return _finish(parsed, _ok(checks), _reason(checks), ["uid", "mid", "score", "timestamp"],
                   mode, "rating")


def parse_tag_lines(lines: DataFrame, mode: str = "fail") -> tuple[DataFrame, DataFrame]:
    """S3: ``uid,mid,tag,timestamp``; the tag is trimmed."""
    f = _fields(F.col("value"), ",")
    parsed = lines.select("value", f.alias("_f")).select(
        "value", "_f",
        _integer(F.col("_f")[0]).alias("uid"),
        _integer(F.col("_f")[1]).alias("mid"),
        jvm_trim(F.col("_f")[2]).alias("tag"),
        _integer(F.col("_f")[3]).alias("timestamp"))
    checks = [(F.size("_f") >= 4, "fewer than 4 fields"),
              (F.col("uid").isNotNull(), "uid is not an integer"),
              (F.col("mid").isNotNull(), "mid is not an integer"),
              (F.col("timestamp").isNotNull(), "timestamp is not an integer")]
    return _finish(parsed, _ok(checks), _reason(checks), ["uid", "mid", "tag", "timestamp"],
                   mode, "tag")


def load_movies(spark: SparkSession, path: str, mode: str = "fail"):
    return parse_movie_lines(spark.read.text(path), mode)


def load_ratings(spark: SparkSession, path: str, mode: str = "fail"):
    return parse_rating_lines(spark.read.text(path), mode, ",")


def load_tags(spark: SparkSession, path: str, mode: str = "fail"):
    return parse_tag_lines(spark.read.text(path), mode)


def parse_rating_messages(messages: DataFrame, mode: str = "fail") -> tuple[DataFrame, DataFrame]:
    """Stream message ``uid|mid|score|timestamp`` in column ``value``.

    Works unchanged on a streaming DataFrame (file or broker source)."""
    return parse_rating_lines(messages.select(F.col("value").cast("string").alias("value")),
                              mode, "|")


def render_rating_messages(ratings: DataFrame) -> DataFrame:
    """Inverse of ``parse_rating_messages``: one ``value`` string per rating."""
    return ratings.select(F.concat_ws("|", F.col("uid").cast("string"), F.col("mid").cast("string"),
                                      F.col("score").cast("string"),
                                      F.col("timestamp").cast("string")).alias("value"))


def parse_recent_entries(entries: Column) -> Column:
    """S7 list entries ``mid:score`` (array<string>) -> array<struct<mid, score>>; a
    part that is missing or no number is null."""
    return F.transform(entries, lambda e: F.struct(
        (jvm_trim(F.get(F.split(e, ":"), F.lit(0)))).try_cast("bigint").alias("mid"),
        (F.get(F.split(e, ":"), F.lit(1))).try_cast("double").alias("score")))
