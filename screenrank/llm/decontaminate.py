"""Benchmark decontamination (operator 1), DataFrame and SQL functions only.

Benchmark items and documents become sequences of five-word shingles. Every
window of a document that is as long as some item and shares a shingle with an
item of that length gets a 64-bit SimHash. Repeats of a shingle are numbered
first, so that each counts as a shingle of its own, and not with the square of
their number in the distance. A multi-index over the items' fingerprints finds all items within
``radius`` bits: of ``blocks`` equal blocks at least one differs by at most
``radius // blocks`` bits, and the index holds each block value with all its
neighbours at that distance. Candidates are verified by their exact weighted
(multiset) Jaccard similarity of shingles.

A window without a common shingle has similarity 0, so leaving it out loses
nothing. At the threshold 0.8 two fingerprints differ by about 10 of 64 bits
(standard deviation 3), so a radius of 22 misses about one such window in
30,000; windows of higher similarity lie closer.

Items under five words have no shingle. One of two to four words is in every
document that has its words in a row; one of a single word only in a document
of that word alone, since a word by itself is no sign of a benchmark.

A row is known by its doc_id and a hash of its text, null ids included.

Defined results: null and word-less texts, in either table, match nothing; a
document shorter than an item is one window of its own length; rows that repeat
a doc_id or item_id count as alternatives of it (the best match is reported,
the first of equal ones), and so do rows without an id, under a null; in
``clean_documents`` each row goes by its own text; a very long text counts whole;
empty tables give an empty result; other columns are ignored. Items of more than
2**21 shingles are an error.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from screenrank.llm.common import saved, small_side
from screenrank.llm.words import SHINGLE_WORDS, WORD_PATTERN

THRESHOLD = 0.8
RADIUS = 22
BLOCKS = 8
_BITS = 64
_LANES = 3  # bit counters of 21 bits packed in one long
_LANE_BITS = 21


def _shingled(df: DataFrame, *keep: str) -> DataFrame:
    """``keep`` columns and ``sh``, the shingle hashes in text order; null for
    texts under five words. (Explode it with ``explode_outer``: for a plain
    ``explode`` Spark adds a filter that computes the array a second time.)"""
    k = SHINGLE_WORDS
    words = F.regexp_extract_all(F.lower("text"), F.lit(WORD_PATTERN), F.lit(0))
    grams = F.transform(F.sequence(F.lit(1), F.size("w") - (k - 1)),
                        lambda i: F.xxhash64(F.slice("w", i, k)))
    return df.select(*keep, words.alias("w")).select(
        *keep, F.when(F.size("w") >= k, grams).alias("sh"))


def numbered(sh: str) -> Column:
    """The shingle hashes of an array with the repeats of each one told apart
    (in order of the hashes): multiset Jaccard becomes set Jaccard."""
    ordered = F.array_sort(sh)

    def tell(x: Column, i: Column) -> Column:
        before = i + 1 - F.array_position(ordered, x)
        return F.when(before > 0, F.xxhash64(x, before)).otherwise(x)

    return F.when(F.size(F.array_distinct(sh)) == F.size(sh), F.col(sh)).otherwise(F.transform(ordered, tell))


def _packed(k: int) -> Column:
    x = F.shiftright("h", _LANES * k)
    return F.sum(x.bitwiseAND(1) + F.shiftleft(x.bitwiseAND(2), _LANE_BITS - 1)
                 + F.shiftleft(x.bitwiseAND(4), 2 * _LANE_BITS - 2))


def simhash(exploded: DataFrame, *keys: str) -> DataFrame:
    """SimHash per ``keys`` of the shingle hashes ``h``, one row a shingle: bit
    b is 1 if more than half of the hashes have it. Bit counts are summed in
    packed lanes, so one grouped aggregate of 22 sums does all 64."""
    lanes = -(-_BITS // _LANES)
    sums = exploded.groupBy(*keys).agg(F.count("*").alias("n"),
                                       *[_packed(k).alias(f"p{k}") for k in range(lanes)])
    fp = F.lit(0).cast("long")
    for b in range(_BITS):
        one = F.shiftright(f"p{b // _LANES}", _LANE_BITS * (b % _LANES)).bitwiseAND(2 ** _LANE_BITS - 1)
        fp = fp.bitwiseOR(F.when(one * 2 > F.col("n"), F.shiftleft(F.lit(1).cast("long"), b))
                          .otherwise(F.lit(0).cast("long")))
    return sums.select(*keys, fp.alias("fp"))


def neighbours(bits: int, distance: int) -> list[int]:
    """All masks of ``bits`` bits with at most ``distance`` bits set."""
    return [sum(1 << i for i in c) for d in range(distance + 1) for c in combinations(range(bits), d)]


def _blocks(blocks: int) -> Column:
    """array of (block, key): the fingerprint's equal parts."""
    width = _BITS // blocks
    return F.array(*[F.struct(F.lit(b).alias("block"),
                              F.shiftright("fp", b * width).bitwiseAND(2 ** width - 1).alias("key"))
                     for b in range(blocks)])


def hamming_index(items: DataFrame, radius: int, blocks: int) -> DataFrame:
    """Rows (block, key, *items' columns): every block value of ``items.fp``
    and all its neighbours within ``radius // blocks`` bits."""
    if _BITS % blocks:
        raise ValueError("blocks must divide 64")
    masks = neighbours(_BITS // blocks, min(radius // blocks, _BITS // blocks))
    return (items.select("*", F.explode(_blocks(blocks)).alias("part"))
            .select(*items.columns, F.col("part.block").alias("block"), F.col("part.key").alias("own"),
                    F.explode(F.array(*[F.lit(m).cast("long") for m in masks])).alias("mask"))
            .select(*items.columns, "block", F.col("own").bitwiseXOR(F.col("mask")).alias("key")))


def weighted_jaccard(window: str, grams: str, total: str) -> Column:
    """Multiset Jaccard of an array of hashes and an item's (h, n) counts."""
    both = F.aggregate(
        grams, F.lit(0).cast("long"),
        lambda acc, g: acc + F.least(g["n"], F.size(F.filter(window, lambda x: x == g["h"])).cast("long")))
    return both / (F.size(window) + F.col(total) - both)


def contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD,
                 radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """(doc_id, item_id, similarity, start): each document's best window for
    every benchmark item it holds; ``start`` counts words from 0, the first of
    equal windows."""
    found = _found(docs.select(*_identity(), "text"), benchmark, threshold, radius, blocks)
    nameless = F.col("text_key").bitwiseAND(1) == 1
    return (found.groupBy(F.when(~nameless, F.col("doc")).alias("doc_id"), "item_id")
            .agg(F.max(F.struct("similarity", (-F.col("start")).alias("back"))).alias("best"))
            .select("doc_id", "item_id", F.col("best.similarity").alias("similarity"),
                    (-F.col("best.back")).cast("long").alias("start")))


def _identity() -> list[Column]:
    """(doc, text_key): the id, 0 for none, and a hash of the text whose last
    bit says that there is no id. Never null, so plain joins take all rows."""
    doc_id = F.col("doc_id").cast("long")
    return [F.coalesce(doc_id, F.lit(0).cast("long")).alias("doc"),
            F.shiftleft(F.xxhash64("text"), 1).bitwiseOR(doc_id.isNull().cast("long")).alias("text_key")]


def _short_items(docs: DataFrame, benchmark: DataFrame) -> DataFrame | None:
    """(doc, text_key, item_id, start, similarity) of the items under five words;
    None if there are none."""
    words = F.regexp_extract_all(F.lower("text"), F.lit(WORD_PATTERN), F.lit(0)).alias("w")
    short = saved(benchmark.select(F.col("item_id").cast("long").alias("item_id"), words)
                  .where(F.size("w").between(1, SHINGLE_WORDS - 1))
                  .select("item_id", F.size("w").alias("k"), F.xxhash64("w").alias("h")).distinct(), "decon-short")
    sizes = sorted(r["k"] for r in short.select("k").distinct().collect())  # at most four
    if not sizes:
        return None
    split = docs.select("doc", "text_key", words)
    found = []

    def in_a_row(k: int) -> Column:
        return F.transform(F.sequence(F.lit(1), F.size("w") - (k - 1)), lambda i: F.xxhash64(F.slice("w", i, k)))

    for k in sizes:
        mine = short.where(F.col("k") == k).select("item_id", "h")
        found.append(split.where(F.size("w") >= k if k > 1 else F.size("w") == 1)
                     .select("doc", "text_key", F.posexplode(in_a_row(k)).alias("start", "h"))
                     .join(small_side(mine, mine.count()), "h")
                     .select("doc", "text_key", "item_id", F.col("start").cast("int").alias("start"),
                             F.lit(1.0).alias("similarity")))
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def _found(docs: DataFrame, benchmark: DataFrame, threshold: float, radius: int, blocks: int) -> DataFrame:
    """(doc, text_key, item_id, start, similarity): every window at the threshold."""
    named = saved(_shingled(benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text"), "item_id")
                  .where("sh IS NOT NULL").distinct()
                  .select("item_id", "sh", F.size("sh").alias("size"), F.xxhash64("sh").alias("form")), "decon-items")
    # each wording once, whatever items have it
    forms = named.dropDuplicates(["form"]).select("form", "sh", "size")
    grams = forms.select("form", "size", F.explode("sh").alias("h"))
    n_grams, longest = forms.agg(F.coalesce(F.sum("size"), F.lit(0)), F.coalesce(F.max("size"), F.lit(0))).first()
    if longest > 2 ** _LANE_BITS - 1:
        raise ValueError(f"an item has {longest} shingles; {2 ** _LANE_BITS - 1} can be counted")
    keys = saved(grams.select("h", "size").distinct(), "decon-shingles")
    n_keys = keys.count()

    # documents that share a shingle with the benchmark
    who = ["doc", "text_key"]
    hits = saved(_shingled(docs, *who).select(*who, F.explode_outer("sh").alias("h"))
                 .join(small_side(keys.select("h").distinct(), n_keys), "h", "left_semi")
                 .select(*who).distinct(), "decon-hits")
    texts = docs.join(small_side(hits, hits.count()), who, "left_semi").dropDuplicates(who)
    hit = saved(_shingled(texts, *who), "decon-documents")

    # item-sized windows around common shingles
    first = F.greatest(F.col("pos") - F.col("size") + 1, F.lit(0))
    last = F.least(F.col("pos"), F.greatest(F.col("n") - F.col("size"), F.lit(0)))
    starts = (hit.select(*who, F.size("sh").alias("n"), F.posexplode("sh").alias("pos", "h"))
              .join(small_side(keys, n_keys), "h")
              .select(*who, "size", F.explode(F.sequence(first, last)).alias("start"))
              .groupBy(*who)
              .agg(F.collect_set(F.struct("size", "start")).alias("starts")))
    windows = (hit.join(starts, who)
               .select(*who, "sh", F.explode("starts").alias("s"))
               .select(*who, "s.size", "s.start",
                       F.slice("sh", F.col("s.start") + 1, F.col("s.size")).alias("sh")))
    marked = simhash(windows.select(*who, "size", "start", F.explode_outer(numbered("sh")).alias("h")),
                     *who, "size", "start")
    prints = simhash(forms.select("form", "size", F.explode_outer(numbered("sh")).alias("h")), "form", "size")
    index = saved(hamming_index(prints.withColumnRenamed("fp", "item_fp")
                                .withColumn("fp", F.col("item_fp")), radius, blocks).drop("fp"),
                  "decon-index")
    probes = (marked.select("*", F.explode(_blocks(blocks)).alias("part"))
              .select(*who, "size", "start", "fp", "part.block", "part.key"))
    near = (probes.join(small_side(index, index.count()), ["size", "block", "key"])
            .where(F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp"))) <= radius)
            .select(*who, "size", "start", "form").distinct())

    # exact weighted similarity of the candidates
    counts = (grams.groupBy("form", "h").agg(F.count("*").alias("n"))
              .groupBy("form").agg(F.collect_list(F.struct("h", "n")).alias("grams")))
    found = (near.join(hit, who)
             .select(*who, "form", "size", "start",
                     F.slice("sh", F.col("start") + 1, F.col("size")).alias("window"))
             .join(small_side(counts, n_grams), "form")
             .select(*who, "form", "start", weighted_jaccard("window", "grams", "size").alias("similarity"))
             .where(F.col("similarity") >= threshold)
             .join(small_side(named.select("form", "item_id"), named.count()), "form")
             .select(*who, "item_id", "start", "similarity"))
    short = _short_items(docs, benchmark)
    return found if short is None else found.unionByName(short)


def clean_documents(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD,
                    radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """``docs`` without the rows that hold a benchmark item."""
    drop = saved(_found(docs.select(*_identity(), "text"), benchmark, threshold, radius, blocks)
                 .select("doc", "text_key").distinct(), "decon-drop")
    rows = docs.select(F.struct("*").alias("row"), *_identity())
    return rows.join(small_side(drop, drop.count()), ["doc", "text_key"], "left_anti").select("row.*")
