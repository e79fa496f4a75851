"""Ranked lexical search (operator 12): many queries, shared work done once.

Items are queries of terms; a document's score for an item is the sum of what
each of the item's terms adds. Items share terms, so their sums share parts:
terms that stand in exactly the same items make a bundle, and among the bundles
the pair that most items hold becomes a node of its own, again and again, until
no pair is shared. That gives a graph whose leaves are bundles, whose nodes add
two others and whose roots are the items. Items are mined in blocks, in tasks.

Documents are read once for their counts of the items' terms; the counts of all
documents give the weights. Then each batch of documents computes every bundle
and every node of the graph once, for all its documents together, as integer
sums, and reads the items' scores off the roots. A task keeps each item's best
``k``; one rank per item over all tasks' lists gives the result. What is
broadcast is the graph and the terms of at most ``PASS_TERMS`` item terms; more
items are searched in several passes over the documents.

Defined results: a null text, or one without terms, has no terms and no place in
any statistic; an item without terms finds nothing; every row is a document and
every row an item of its own, whatever their ids (rows that repeat an ``item_id``
each return a list); equal scores are ranked by ascending ``doc_id``, null
last; a score of 0 is no result; very long texts count whole; empty tables give
an empty result; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from screenrank.llm.common import saved, small_side
from screenrank.session import ship_by_value

K = 50
#: Terms of items (repeats among items counted) of one pass, and of one graph.
PASS_TERMS, BLOCK_TERMS = 400_000, 20_000
#: Bundles of an item, its most shared ones, among which pairs are mined. It
#: bounds the mining alone: the others are added to the item by themselves.
MINED_BUNDLES = 128
#: Bytes of one batch's partial sums.
BATCH_BYTES = 32 << 20

_TABLE = bytes(c if c >= 0x80 or chr(c).isalnum() else 0x20 for c in range(256)).lower()

_GRAPH = ("block int, items array<long>, bundles array<array<binary>>, left array<int>, "
          "right array<int>, levels array<int>, roots array<int>")


def terms(text: str | None) -> list[bytes]:
    """Maximal runs of letters, digits and characters beyond ASCII, A-Z in lower case."""
    return text.encode("utf-8").translate(_TABLE).split() if text else []


# ------------------------------------------------------------------ the graph

class Graph:
    """Sums of shared term sets. Rows 0 .. len(bundles) - 1 are the bundles; row
    len(bundles) + i is the sum of rows left[i] and right[i], both earlier;
    levels[j] rows in turn depend on earlier levels only; roots: a row an item."""

    def __init__(self, bundles, left, right, levels, roots) -> None:
        self.bundles, self.roots = bundles, np.asarray(roots, dtype=np.int64)
        self.left, self.right = np.asarray(left, dtype=np.int64), np.asarray(right, dtype=np.int64)
        self.ends = np.cumsum(np.asarray(levels, dtype=np.int64)).tolist()
        self.rows = len(bundles) + len(left)

    def evaluate(self, sums: np.ndarray) -> np.ndarray:
        """Fill in the nodes of ``sums`` (rows x documents), given its bundles;
        the items' rows."""
        at = 0
        for end in self.ends:
            np.add(sums[self.left[at:end]], sums[self.right[at:end]],
                   out=sums[len(self.bundles) + at:len(self.bundles) + end])
            at = end
        return sums[self.roots]


def mine(items: list[set[bytes]]) -> Graph:
    """The graph of ``items``, each a set of at least one term."""
    holders = defaultdict(list)
    for i, x in enumerate(items):
        for t in x:
            holders[t].append(i)
    groups = defaultdict(list)
    for t in sorted(holders):
        groups[tuple(holders[t])].append(t)
    bundles = [groups[h] for h in groups]
    where = [set(h) for h in groups]  # per node: the items whose sum it is a part of
    parts = [set() for _ in items]
    for b, h in enumerate(groups):
        for i in h:
            parts[i].add(b)
    pairs = Counter()
    for p in parts:
        shared = sorted((b for b in p if len(where[b]) > 1), key=lambda b: (-len(where[b]), b))
        pairs.update(combinations(sorted(shared[:MINED_BUNDLES]), 2))
    heap = [(-n, p) for p, n in pairs.items() if n > 1]
    heapq.heapify(heap)
    nodes: list[tuple[int, int]] = []
    while heap:
        n, (a, b) = heapq.heappop(heap)
        both = where[a] & where[b]
        if len(both) < 2:
            continue
        if len(both) < -n:  # since then parts of others took some of them
            heapq.heappush(heap, (-len(both), (a, b)))
            continue
        new = len(where)
        nodes.append((a, b))
        where.append(both)
        where[a] = where[a] - both
        where[b] = where[b] - both
        near = Counter()
        for i in both:
            parts[i] -= {a, b}
            near.update(x for x in parts[i] if len(where[x]) > 1)
            parts[i].add(new)
        for x, m in near.items():
            if m > 1:
                heapq.heappush(heap, (-m, (x, new)))
    roots = []
    for p in parts:  # what is left of an item, added up pair by pair
        rest = sorted(p)
        while len(rest) > 1:
            odd = rest[len(rest) // 2 * 2:]
            for a, b in zip(rest[::2], rest[1::2]):
                odd.append(len(bundles) + len(nodes))
                nodes.append((a, b))
            rest = odd
        roots.append(rest[0])
    level = [0] * len(bundles)
    for a, b in nodes:
        level.append(1 + max(level[a], level[b]))
    order = sorted(range(len(bundles), len(level)), key=level.__getitem__)
    row = {old: len(bundles) + i for i, old in enumerate(order)} | {b: b for b in range(len(bundles))}
    count = Counter(level[o] for o in order)
    return Graph(bundles, [row[nodes[o - len(bundles)][0]] for o in order],
                 [row[nodes[o - len(bundles)][1]] for o in order],
                 [count[x] for x in sorted(count)], [row[r] for r in roots])


def _mined(block: pd.DataFrame) -> pd.DataFrame:
    block = block.sort_values("item")
    g = mine([set(t) for t in block["terms"]])
    levels = np.diff([0, *g.ends]).tolist()
    return pd.DataFrame({"block": block["block"].iloc[:1].to_numpy(), "items": [block["item"].tolist()],
                         "bundles": [g.bundles], "left": [g.left.tolist()], "right": [g.right.tolist()],
                         "levels": [levels], "roots": [g.roots.tolist()]})


# -------------------------------------------------------------------- the sums

def _item_terms(items: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [sorted(set(terms(t))) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("item_id"), pa.array(sets, pa.list_(pa.binary()))],
                                             names=["item_id", "terms"])

    kind = items.schema["item_id"].dataType.simpleString()
    return (items.select("item_id", "text").mapInArrow(run, f"item_id {kind}, terms array<binary>")
            .where(F.size("terms") > 0))


def _counts(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, terms, tf) of every document with terms: the number of its
    terms, and those of the vocabulary with their occurrences."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.keys()
        for batch in batches:
            n, found, tf = [], [], []
            for text in batch.column("text").to_pylist():
                words = terms(text)
                count = Counter(words)
                hits = [(vocabulary[w], count[w]) for w in known & count.keys()]
                n.append(len(words))
                found.append([t for t, _ in hits])
                tf.append([c for _, c in hits])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(found, pa.list_(pa.int32())),
                 pa.array(tf, pa.list_(pa.int64()))], names=["doc_id", "n", "terms", "tf"])

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
            .mapInArrow(run, "doc_id long, n long, terms array<int>, tf array<long>").where("n > 0"))


class _Best:
    """The ``k`` best (score, doc) of each item among those offered so far."""

    def __init__(self, items: int, k: int) -> None:
        self.k, self.floor = k, np.zeros(items, dtype=np.int64)
        self.kept: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in range(items)]
        self.size = [0] * items

    def offer(self, scores: np.ndarray, docs: np.ndarray) -> None:
        """``scores``: items x documents; ``docs``: their places in the order of ties."""
        over = (scores > 0) & (scores >= self.floor[:, None])
        for i in np.flatnonzero(over.any(axis=1)).tolist():
            at = np.flatnonzero(over[i])
            self.kept[i].append((scores[i, at], docs[at]))
            self.size[i] += len(at)
            if self.size[i] > 4 * self.k:
                self.cut(i)

    def cut(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        if not self.kept[i]:
            return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
        score = np.concatenate([s for s, _ in self.kept[i]])
        doc = np.concatenate([d for _, d in self.kept[i]])
        best = np.lexsort((doc, -score))[:self.k]
        self.kept[i], self.size[i] = [(score[best], doc[best])], len(best)
        if len(best) == self.k:
            self.floor[i] = score[best[-1]]
        return score[best], doc[best]


#: Stands for a null id: after every other one.
_LAST = 2 ** 63 - 1


def _scored(graphs: list[tuple[list[int], Graph]], weights: np.ndarray, vocabulary: dict[bytes, int],
            n_docs: int, n_terms: int, k: int):
    """Per task: (item, doc_id, score) of the ``k`` best documents of each item."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []  # per graph: vocabulary id -> bundle
        for _, g in graphs:
            row = np.full(len(weights), -1, dtype=np.int64)
            for b, bundle in enumerate(g.bundles):
                row[[vocabulary[t] for t in bundle]] = b
            rows.append(row)
        best = [_Best(len(items), k) for items, _ in graphs]
        step = max(16, BATCH_BYTES // (8 * max((g.rows for _, g in graphs), default=1)))
        for batch in batches:
            for s in range(0, batch.num_rows, step):
                part = batch.slice(s, step)
                ids = part.column("doc_id").fill_null(_LAST).to_numpy()
                size = part.column("n").to_pylist()
                m = np.array([50 + 50 * n * n_docs // n_terms for n in size], dtype=np.int64)
                lists = part.column("terms")
                ends = lists.offsets.to_numpy().astype(np.int64)
                doc = np.repeat(np.arange(part.num_rows), np.diff(ends))
                term = lists.values.to_numpy()[ends[0]:ends[-1]]
                tf = part.column("tf").values.to_numpy()[ends[0]:ends[-1]]
                adds = weights[term] * (1_000_000_000 * tf // (1000 * tf + 20 * m[doc]))
                for (_, g), row, found in zip(graphs, rows, best):
                    sums = np.zeros((g.rows, part.num_rows), dtype=np.int64)
                    at = row[term]
                    np.add.at(sums, (at[at >= 0], doc[at >= 0]), adds[at >= 0])
                    found.offer(g.evaluate(sums), ids)
        for (items, _), found in zip(graphs, best):
            for i, item in enumerate(items):
                score, doc = found.cut(i)
                if len(score):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(score), item, dtype=np.int64)),
                         pa.array(doc, pa.int64(), mask=doc == _LAST), pa.array(score)],
                        names=["item", "doc_id", "score"])

    return run


# ---------------------------------------------------------------- the operator

def ranked_search(docs: DataFrame, items: DataFrame, k: int = K) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` documents of ``docs`` (doc_id,
    text) with the highest scores above 0 for each row of ``items`` (item_id,
    text)."""
    asked = saved(_item_terms(items).withColumn("item", F.monotonically_increasing_id()), "search-items")
    n_items, n_terms = asked.agg(F.count("*"), F.coalesce(F.sum(F.size("terms")), F.lit(0))).first()
    passes, blocks = max(1, -(-n_terms // PASS_TERMS)), max(1, -(-min(n_terms, PASS_TERMS) // BLOCK_TERMS))
    asked = asked.withColumns({"pass": F.pmod(F.xxhash64("item"), F.lit(passes)).cast("int"),
                               "block": F.pmod(F.xxhash64("item", F.lit(1)), F.lit(blocks)).cast("int")})
    found = [_pass(docs, asked.where(F.col("pass") == p), p, k) for p in range(passes)]
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    best = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return (every.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .join(small_side(asked.select("item", "item_id"), n_items), "item")
            .select("item_id", "rank", "doc_id", "score"))


def _pass(docs: DataFrame, asked: DataFrame, number: int, k: int) -> DataFrame:
    # at most about PASS_TERMS rows each
    words = sorted(bytes(r["t"]) for r in asked.select(F.explode("terms").alias("t")).distinct().collect())
    vocabulary = {w: i for i, w in enumerate(words)}
    mined = asked.select("block", "item", "terms").groupBy("block").applyInPandas(_mined, _GRAPH).collect()
    graphs = [(list(r["items"]), Graph([[bytes(t) for t in b] for b in r["bundles"]], r["left"], r["right"],
                                       r["levels"], r["roots"])) for r in mined]
    counts = saved(_counts(docs, vocabulary), f"search-counts-{number}")
    n_docs, n_terms = counts.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = np.zeros(len(words), dtype=np.int64)
    for r in counts.select(F.explode("terms").alias("t")).groupBy("t").count().collect():
        df[r["t"]] = r["count"]
    weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * x + 1))) for x in df.tolist()],
                       dtype=np.int64)
    return saved(counts.mapInArrow(_scored(graphs, weights, vocabulary, n_docs, n_terms, k),
                                   "item long, doc_id long, score long"), f"search-best-{number}")


ship_by_value(__name__)
