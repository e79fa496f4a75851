"""Mixing sources to target weights (operator 5): entropy balancing.

A document's size is its number of words. Each source gets a target: sources in
code point order (null last) weigh 5, 2, 1, 5, 2, 1, ... and share all sizes;
a target stops at ``MAX_COPIES`` times its source's size, and the excess goes
to the others by weight until none is above.

Document rates are as near as possible, in relative entropy, to one copy each
under the token constraint of their source: rate = exp(l * size / mean size)
with one multiplier l per source, at most ``MAX_COPIES``. The convex dual is
solved by Newton steps, for all sources at once: a step is one grouped sum over
the counts of (source, size), which hold every document. A step that leaves
the bracket known so far is replaced by its middle, so convergence is certain;
should the constraint still be missed after ``ROUNDS`` steps, that is an error.

Rates become copies: the whole part, plus one for the documents whose
reproducible random number, relative to the fraction, is smallest, up to the
words still wanted. That cut is found from histograms of the random numbers,
refined once, so a source meets its target to about one document.

Defined results: a null or word-less text has size 0 and takes 0; an empty
table gives no rows; a null ``doc_id`` counts like any other; rows that repeat
are separate documents, numbered among themselves, and each number has its own
random number (which of the equal rows has it makes no difference); a very long
text counts whole; other columns stay in ``doc``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from screenrank.llm.common import saved, small_side

WEIGHTS = (5.0, 2.0, 1.0)
MAX_COPIES = 3
ROUNDS = 100
TOLERANCE = 1e-9
#: Equal rows that one task numbers.
EQUAL_ROWS = 100_000
_BINS = 1024
_SIZE = r"[^\x20\x09-\x0D]+"


def n_words(text: str = "text") -> Column:
    """Number of maximal runs without ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(_SIZE)), F.lit(0)).cast("long")


def _key() -> Column:
    """Sources as non-null strings in the same order, null last."""
    return F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit("t"))


def _random() -> Column:
    """A reproducible number in (0, 1] per document, from ``same`` (a hash of id and
    text) and ``nth``, the row's number among equal ones."""
    h = F.when(F.col("nth") > 0, F.xxhash64("same", "nth")).otherwise(F.col("same"))
    return (F.shiftrightunsigned(h, 11) + 1) / F.lit(2.0 ** 53)


def _numbered(rows: DataFrame, repeated: DataFrame, n_repeated: int) -> DataFrame:
    """``rows`` with ``nth``: 0, 1, ... among the rows of one ``same``. ``repeated``:
    (same, n) of those that occur more than once. A large group is numbered in
    parts of about ``EQUAL_ROWS``, each moved by the size of those before it."""
    if not n_repeated:
        return rows.withColumn("nth", F.lit(0).cast("long"))
    known = small_side(repeated.select("same", F.ceil(F.col("n") / EQUAL_ROWS).alias("parts")), n_repeated)
    once = rows.join(known, "same", "left_anti").withColumn("nth", F.lit(0).cast("long"))
    many = saved(rows.withColumn("at", F.monotonically_increasing_id()).join(known, "same")
                 .withColumn("part", F.pmod("at", "parts")).drop("parts"), "mix-repeated")
    before = Window.partitionBy("same").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    moved = many.groupBy("same", "part").agg(F.count("*").alias("n")).select(
        "same", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    place = F.row_number().over(Window.partitionBy("same", "part").orderBy("at")) - 1
    numbered = (many.withColumn("place", place).join(moved, ["same", "part"])
                .withColumn("nth", F.col("first") + F.col("place")).drop("at", "part", "place", "first"))
    return once.unionByName(numbered)


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS,
                   limit: float = MAX_COPIES) -> DataFrame:
    """(key, source_size, target) from one row (key, source_size) per source.

    In the order of size / weight a source is capped as long as its share of
    what is left exceeds its cap; the rest share by weight.
    """
    turn = (F.row_number().over(Window.orderBy("key")) - 1) % len(weights)
    w = (sizes.withColumn("weight", F.get(F.array(*[F.lit(float(w)) for w in weights]), turn))
         .withColumn("cap", F.col("source_size") * float(limit)))
    order = Window.orderBy(F.col("cap") / F.col("weight"), "key")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(0, Window.unboundedFollowing)
    every = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    w = w.withColumn("level", left / F.sum("weight").over(after))
    open_level = F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.col("level"))
    level = F.first(open_level, True).over(every)
    return w.select("key", "source_size", F.coalesce(
        F.least(F.col("cap"), F.col("weight") * level), F.col("cap")).alias("target"))


def balance(counts: DataFrame, targets: DataFrame, limit: float = MAX_COPIES,
            rounds: int = ROUNDS, tolerance: float = TOLERANCE) -> DataFrame:
    """(key, mean, mult, ...targets): the solution of the dual, one multiplier
    per source, from counts (key, size, n). A source whose target is at the
    limit has an infinite multiplier: all its documents are taken that often."""
    cap = F.log(F.lit(float(limit)))
    full = F.col("target") >= float(limit) * F.col("source_size")
    state = saved(
        counts.groupBy("key").agg((F.sum(F.col("n") * F.col("size")) / F.sum("n")).alias("mean"))
        .join(targets, "key")
        .select("key", "source_size", "target", F.greatest("mean", F.lit(1.0)).alias("mean"),
                F.when(full, float("inf")).otherwise(0.0).alias("mult"),
                F.lit(float("-inf")).alias("low"), F.lit(float("inf")).alias("high"),
                full.alias("done")), "mix-state")
    for i in range(rounds):
        todo = state.where("NOT done").select("key", "mean", "mult")
        tilt = F.col("mult") * F.col("size") / F.col("mean")
        words = F.col("n") * F.col("size") * F.exp(F.least(tilt, cap))
        sums = (counts.join(todo, "key").groupBy("key")
                .agg(F.sum(words).alias("got"),
                     F.sum(F.when(tilt < cap, words * F.col("size") / F.col("mean"))
                           .otherwise(0.0)).alias("slope")))
        gap = F.col("got") - F.col("target")
        low = F.when(gap < 0, F.col("mult")).otherwise(F.col("low"))
        high = F.when(gap > 0, F.col("mult")).otherwise(F.col("high"))
        step = F.col("mult") - F.when(F.col("slope") > 0, gap / F.col("slope"))
        middle = (F.when(F.col("low") == float("-inf"), F.col("high") * 2 - 1)
                  .when(F.col("high") == float("inf"), F.col("low") * 2 + 1)
                  .otherwise((F.col("low") + F.col("high")) / 2))
        narrow = high - low <= 1e-15 * F.greatest(F.lit(1.0), F.abs("mult"))  # no number lies between
        done = F.col("done") | (F.abs(gap) <= tolerance * F.col("source_size")) | F.coalesce(narrow, F.lit(False))
        state = saved(
            state.join(sums, "key", "left")
            .select("key", "source_size", "target", "mean", "mult", "slope", gap.alias("gap"),
                    low.alias("low"), high.alias("high"), step.alias("step"), done.alias("done"))
            .select("key", "source_size", "target", "mean",
                    F.when(F.col("done"), F.col("mult"))
                    .when((F.col("step") > F.col("low")) & (F.col("step") < F.col("high")), F.col("step"))
                    .otherwise(middle).alias("mult"), "low", "high", "done"), f"mix-state-{i}")
        if state.where("NOT done").isEmpty():
            break
    else:
        raise RuntimeError(f"a source's token constraint is not met after {rounds} steps")
    return state.select("key", "source_size", "target", "mean", "mult")


def _rate(limit: float) -> Column:
    # a size of 0 under an infinite multiplier would be NaN; such a document takes no words anyway
    tilt = F.when(F.col("size") == 0, F.lit(0.0)).otherwise(F.col("mult") * F.col("size") / F.col("mean"))
    return F.least(F.exp(F.least(tilt, F.log(F.lit(float(limit))))), F.lit(float(limit)))


def _split(df: DataFrame, limit: float) -> DataFrame:
    """Adds whole copies, and the place (bin, cell) of the document in the
    order in which the fractions are filled up."""
    # at the limit exp(log(limit)) may fall a rounding error short
    rate = F.when(_rate(limit) > limit - 1e-9, F.lit(float(limit))).otherwise(_rate(limit))
    part = F.col("rate") - F.col("whole")
    turn = F.when(part > 0, F.col("u") / (F.col("u") + part))
    return (df.withColumn("rate", rate).withColumn("whole", F.floor("rate").cast("long"))
            .withColumn("turn", turn * _BINS)
            .withColumn("bin", F.floor("turn").cast("long"))
            .withColumn("cell", F.floor((F.col("turn") - F.col("bin")) * _BINS).cast("long")))


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, limit: float = MAX_COPIES) -> DataFrame:
    """(doc, size, source_size, target, copies) for every row of ``docs``
    (doc_id, text, source and any others), the row itself as struct ``doc``."""
    same = F.xxhash64("doc_id", "text").alias("same")
    rows = saved(docs.select(_key().alias("key"), n_words().alias("size"), same), "mix-sizes")
    repeated = saved(rows.groupBy("same").agg(F.count("*").alias("n")).where("n > 1"), "mix-repeats")
    n_repeated = repeated.count()
    rows = _numbered(rows, repeated, n_repeated).withColumn("u", _random())
    counts = saved(rows.groupBy("key", "size").agg(F.count("*").alias("n")), "mix-counts")
    per_source = counts.groupBy("key").agg(F.sum(F.col("n") * F.col("size")).alias("source_size"))
    dual = balance(counts, source_targets(per_source, weights, limit), limit)
    n_sources = dual.count()

    # the words still wanted after the whole copies, and the cut that gives them
    dealt = _split(rows.join(small_side(dual, n_sources), "key"), limit)
    wanted = (dealt.groupBy("key").agg((F.max("target") - F.sum(F.col("whole") * F.col("size")))
                                       .alias("want")))
    cells = saved(dealt.where("bin IS NOT NULL").groupBy("key", "bin", "cell")
                  .agg(F.sum("size").alias("words")), "mix-cells")
    bins = _running(cells.groupBy("key", "bin").agg(F.sum("words").alias("words")), "bin")
    at_bin = (bins.join(wanted, "key").where(F.col("before") <= F.col("want"))
              .groupBy("key").agg(F.max(F.struct("bin", "before", "want")).alias("b"))
              .select("key", "b.*"))
    inner = _running(cells.join(at_bin, ["key", "bin"]), "cell", "bin", "before", "want")
    # a cell is taken if its middle is not above what is wanted
    cut = (inner.groupBy("key").agg(
        F.max("bin").alias("cut_bin"),
        F.coalesce(F.max(F.when(F.col("before") + F.col("inner") + F.col("words") / 2 <= F.col("want"),
                                F.col("cell") + 1)), F.lit(0)).alias("cut_cell")))
    plan = saved(dual.join(cut, "key", "left").select(
        "key", "source_size", "target", "mean", "mult",
        F.coalesce("cut_bin", F.lit(-1)).alias("cut_bin"),
        F.coalesce("cut_cell", F.lit(0)).alias("cut_cell")), "mix-plan")

    named = docs.select(F.struct("*").alias("doc"), _key().alias("key"), n_words().alias("size"), same)
    named = _numbered(named, repeated, n_repeated).withColumn("u", _random())
    out = _split(named.join(small_side(plan, n_sources), "key"), limit)
    extra = ((F.col("bin") < F.col("cut_bin"))
             | ((F.col("bin") == F.col("cut_bin")) & (F.col("cell") < F.col("cut_cell"))))
    copies = F.col("whole") + F.coalesce(extra.cast("long"), F.lit(0).cast("long"))
    return out.select("doc", "size", "source_size", "target", copies.alias("copies"))


def _running(df: DataFrame, by: str, *keep: str) -> DataFrame:
    """Words before each bin of a source (at most 1024 rows per source)."""
    w = Window.partitionBy("key").orderBy(by).rowsBetween(Window.unboundedPreceding, -1)
    name = "inner" if keep else "before"
    return df.select("key", by, "words", *keep,
                     F.coalesce(F.sum("words").over(w), F.lit(0)).alias(name))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with every document repeated as often as the mix takes it."""
    return (mix(docs, **options).where("copies > 0")
            .select("doc", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).select("doc.*"))
