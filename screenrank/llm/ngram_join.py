"""N-gram Jaccard join (operator 6): MinHash LSH forest, then exact verification.

Every text becomes its set of five-word shingles. Texts with equal sets form
one class and take part once. Each class gets one label of ``max_depth`` MinHash
values per tree. The labels of a tree, in the order of their bytes, are a trie: the
classes below one node are those that share a prefix of its length. Matching begins
at the longest prefixes. The classes below a common node form candidate
components, in which every pair is verified exactly, in chunks of bounded size.
A component of several chunks is mostly one that chance prefixes have strung together;
it is joined anew by those pairs below a node whose whole labels agree as often as
those of a link do (``least_agreeing``, which leaves out a link once in a hundred
million). A text is copied once per group of chunks it has to meet. Only counts, local
labels and a histogram of the similarities found leave a task,
so pairs are never written out. The histogram tells how many links the prefixes of
this length are expected to miss (a link of similarity ``s`` has no common prefix of
``d`` values in any tree with probability ``(1 - s**d) ** trees``). While that is more
than ``target_recall`` allows, the prefixes are shortened to the first length that
would do for the links known so far, and the components that grew by it are verified;
those that did not keep what they have.
No prefix is shortened beyond the length at which even a link at the threshold is met
with the target probability (``prefix_depth``), nor does matching end before that
when there are too few links to tell.

Rows are known by a number given when their signatures are written; texts are
found again by (doc_id, hash of the text), null ids included.

Defined results: a null or word-less text links to nothing and is its own class;
a text shorter than five words has one shingle of all its words; every row is a
document, whatever its ``doc_id``: rows that repeat one, or have none, are
linked by their own texts, each with a row of its own in the result; a class is
named by its smallest ``doc_id`` (null if none of its rows has one); a very long
text counts whole; other columns, whatever their names, are ignored; an empty
table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from screenrank.llm.common import components, dropped, saved, small_side
from screenrank.llm.words import MinHash, shingles
from screenrank.session import ship_by_value

THRESHOLD = 0.8
TREES = 24
MAX_DEPTH = 6
TARGET_RECALL = 0.99999
#: Shingles and texts of one verification chunk (2**18 shingles are 2 MB).
CHUNK_SHINGLES = 1 << 18
CHUNK_TEXTS = 1024
#: A component is dealt in ``SPREAD`` groups of chunks, in more when they would have over
#: ``GROUP_CHUNKS``; two groups meet in a task, so a text has as many copies as there are groups.
SPREAD, GROUP_CHUNKS = 4, 8
#: Share of links that comparing whole labels may leave out; the most texts of a component
#: whose labels one task compares (29 MB), and of a node of a larger component: of more,
#: all stay candidates.
LABEL_MISS = 1e-8
LABEL_TEXTS, NODE_TEXTS = 100_000, 8192
#: Width of the histogram of similarities, and bytes of one value of a label.
SIMILARITY_BINS = 1000
VALUE_BYTES = 2


def prefix_depth(threshold: float, trees: int, max_depth: int, target_recall: float) -> int:
    """Longest prefix at which a pair at ``threshold`` meets in some tree with
    at least the target probability; an error when even one value misses it."""
    for depth in range(max_depth, 0, -1):
        if 1 - (1 - threshold ** depth) ** trees >= target_recall:
            return depth
    raise ValueError(f"{trees} trees can't reach a recall of {target_recall} at {threshold}")


def missed_links(links: dict[int, int], depth: int, threshold: float, trees: int) -> float:
    """Expected number of links without a common prefix of ``depth`` values, from the
    verified ones by bin of similarity (each bin at its lower edge), and from one more
    at the threshold itself, so that few links prove little."""
    def per_link(similarity: float) -> float:
        apart = (1 - min(similarity, 1.0) ** depth) ** trees
        return apart / (1 - apart)

    return per_link(threshold) + sum(n * per_link(max(threshold, b / SIMILARITY_BINS)) for b, n in links.items())


def deep_enough(links: dict[int, int], depth: int, threshold: float, trees: int, target_recall: float) -> bool:
    """Whether prefixes of ``depth`` values find the target share of all links."""
    missed = missed_links(links, depth, threshold, trees)
    return missed <= (1 - target_recall) * (sum(links.values()) + missed)


def least_agreeing(threshold: float, values: int, miss: float = LABEL_MISS) -> int:
    """How many of ``values`` MinHash values agree at least between two sets of similarity
    ``threshold`` or more, but for a share ``miss`` of them."""
    below = 0.0
    for k in range(values + 1):
        below += math.comb(values, k) * threshold ** k * (1 - threshold) ** (values - k)
        if below > miss:
            return k
    return values


def _shingle_sets(text: str | None) -> np.ndarray:
    return np.unique(shingles(text))


def _set_key(items: np.ndarray) -> bytes:
    return hashlib.md5(items.tobytes()).digest()


def signatures(docs: DataFrame, trees: int, max_depth: int) -> DataFrame:
    """(doc_id, text_key, set_key, n_shingles, forest) of rows (doc_id, text_key,
    text): the labels of all trees in turn, ``VALUE_BYTES`` a value, high byte first;
    empty for a text without words."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher = MinHash(trees * max_depth)
        for pdf in batches:
            keys, sizes, forest = [], [], []
            for text in pdf["text"]:
                s = _shingle_sets(text)
                keys.append(_set_key(s))
                sizes.append(len(s))
                # mixed first: the least values of a long text all begin with zeros
                label = (hasher.signature(s) * np.uint32(0x9E3779B1) >> np.uint32(32 - 8 * VALUE_BYTES)
                         if len(s) else np.empty(0))
                forest.append(label.astype(f">u{VALUE_BYTES}").tobytes())
            yield pd.DataFrame({"doc_id": pdf["doc_id"].astype("Int64"), "text_key": pdf["text_key"], "set_key": keys,
                                "n_shingles": sizes, "forest": forest})

    return docs.mapInPandas(run, "doc_id long, text_key long, set_key binary, n_shingles int, forest binary")


def trie_nodes(reps: DataFrame, trees: int, max_depth: int, depth: int) -> DataFrame:
    """(rep, node): of every label the trie node ``depth`` values below its root."""
    label = VALUE_BYTES * max_depth
    return (reps.select("rep", "forest", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree"))
            .select("rep", F.expr(f"xxhash64(tree, substring(forest, tree * {label} + 1, {VALUE_BYTES * depth}))")
                    .alias("node")))


def overlaps(sets: list[np.ndarray], rows: np.ndarray, cols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sizes of the intersections and unions of all pairs rows x cols."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count[column] > 1
    owner, column = owner[shared], column[shared]
    _, column = np.unique(column, return_inverse=True)
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    width = 4096
    both = np.zeros((len(rows), len(cols)), dtype=np.float64)
    top = int(column[-1]) + 1 if len(column) else 0
    for lo in range(0, top, width):
        i, j = np.searchsorted(column, (lo, lo + width))
        x = np.zeros((len(sets), min(width, top - lo)), dtype=np.float32)
        x[owner[i:j], column[i:j] - lo] = 1
        both += x[rows] @ x[cols].T
    size = np.array([len(s) for s in sets], dtype=np.float64)
    return both, size[rows][:, None] + size[cols][None, :] - both


def linked(sets: list[np.ndarray], rows: np.ndarray, cols: np.ndarray,
           threshold: float) -> np.ndarray:
    """Boolean matrix rows x cols of pairs with Jaccard >= threshold (exact)."""
    both, union = overlaps(sets, rows, cols)
    return both >= threshold * union - 1e-9


def _verify_group(ids: np.ndarray, copies: np.ndarray, sets: list[np.ndarray], side: np.ndarray,
                  threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Local label, linked documents and linked classes of every row, and the links
    by bin of similarity (bins, counts). ``side`` is 0/1 for the two chunks of a pair;
    only links between them count then."""
    two = bool(side.any())
    rows = np.flatnonzero(side == 0)
    cols = np.flatnonzero(side == 1) if two else rows
    both, union = overlaps(sets, rows, cols)
    hit = both >= threshold * union - 1e-9
    if not two:
        np.fill_diagonal(hit, False)
    bins, pairs = np.unique((both[hit] / union[hit] * SIMILARITY_BINS).astype(np.int32), return_counts=True)
    adj = np.zeros((len(ids), len(ids)), dtype=bool)
    adj[np.ix_(rows, cols)] = hit
    if two:
        adj |= adj.T
    else:
        pairs //= 2  # seen from both ends
    label = ids.copy()
    far = np.iinfo(np.int64).max
    while True:
        best = np.minimum(label, np.where(adj, label[None, :], far).min(axis=1))
        if (best == label).all():
            break
        label = best
    return label, adj @ copies, adj.sum(axis=1), bins, pairs


def _verify_chunks(ids: np.ndarray, copies: np.ndarray, sets: list[np.ndarray], chunk: np.ndarray,
                   side: np.ndarray, two: bool, threshold: float) -> tuple[np.ndarray, ...]:
    """As ``_verify_group`` for a component, or for ``two`` groups of its chunks, of which
    one may be empty: the pairs of chunks in turn, so that the matrices stay small."""
    parts = [[np.flatnonzero((side == x) & (chunk == c)) for c in np.unique(chunk[side == x])] for x in (0, 1)]
    meet = ([(a, b) for a in parts[0] for b in parts[1]] if two else
            [(a, b) for i, a in enumerate(parts[0]) for b in [None, *parts[0][i + 1:]]])
    docs, texts = np.zeros(len(ids), dtype=np.int64), np.zeros(len(ids), dtype=np.int64)
    found: dict[int, int] = {}
    ends: list[tuple[np.ndarray, np.ndarray]] = []
    for a, b in meet:
        at = a if b is None else np.concatenate([a, b])
        label, d, t, bins, pairs = _verify_group(ids[at], copies[at], [sets[i] for i in at],
                                                 np.arange(len(at)) >= len(a), threshold)
        docs[at] += d
        texts[at] += t
        for x, n in zip(bins.tolist(), pairs.tolist()):
            found[x] = found.get(x, 0) + n
        order = np.argsort(ids[at])
        ends.append((at, at[order[np.searchsorted(ids[at], label, sorter=order)]]))
    label = ids.copy()
    while True:
        best = label.copy()
        for x, y in ends:
            np.minimum.at(best, x, best[y])
            np.minimum.at(best, y, best[x])
        if (best == label).all():
            return (label, docs, texts, np.fromiter(found, np.int32, len(found)),
                    np.fromiter(found.values(), np.int64, len(found)))
        label = best


FOUND = ("comp long, whole long, rep long, label long, linked_docs long, linked_texts long, "
         "bins array<int>, pairs array<long>")


def verify(batches: Iterator[pd.DataFrame], threshold: float) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        for comp, g in pdf.drop_duplicates("rep").groupby("comp", sort=False):
            ids = g["rep"].to_numpy(np.int64)
            sets = [np.frombuffer(b, dtype=np.uint64) for b in g["items"]]
            label, docs, texts, bins, pairs = _verify_chunks(ids, g["copies"].to_numpy(np.int64), sets,
                                                             g["own"].to_numpy(), g["side"].to_numpy(),
                                                             bool(g["i"].iloc[0] != g["j"].iloc[0]), threshold)
            rest = len(ids) - 1  # the histogram stands with the first row of the group
            yield pd.DataFrame({"comp": comp, "whole": g["whole"].to_numpy(), "rep": ids, "label": label,
                                "linked_docs": docs, "linked_texts": texts, "bins": [bins] + [bins[:0]] * rest,
                                "pairs": [pairs] + [pairs[:0]] * rest})


def _keyed(docs: DataFrame, *more: str) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), *more)


def close_edges(reps: np.ndarray, labels: np.ndarray, least: int) -> list[tuple[int, int]]:
    """Edges that join the rows of ``labels`` as all pairs that agree in ``least`` values do."""
    rest, edges = np.arange(len(reps)), []
    while len(rest):
        todo, rest = [rest[0]], rest[1:]
        while todo and len(rest):
            at = todo.pop()
            near = (labels[rest] == labels[at]).sum(axis=1) >= least
            edges += [(int(reps[at]), int(reps[i])) for i in rest[near]]
            todo += rest[near].tolist()
            rest = rest[~near]
    return edges


def close_below_nodes(reps: np.ndarray, labels: np.ndarray, trees: int, depth: int, least: int) -> list[tuple[int, int]]:
    """Edges that join the rows of ``labels`` as all pairs do that share a node ``depth``
    values below the root of a tree and agree in ``least`` values."""
    n, width = labels.shape[0], labels.shape[1] // trees
    root, edges = np.arange(n), []

    def top(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for t in range(trees):
        while (root[root] != root).any():
            root = root[root]
        node = np.unique(labels[:, t * width:t * width + depth], axis=0, return_inverse=True)[1].ravel()
        order = np.argsort(node, kind="stable")
        first = np.flatnonzero(np.diff(node[order], prepend=-1))
        apart = np.minimum.reduceat(root[order], first) != np.maximum.reduceat(root[order], first)
        for lo, hi in zip(first[apart], np.append(first[1:], n)[apart]):
            at = order[lo:hi]
            for i, j in close_edges(at, labels[at], least):
                if top(i) != top(j):
                    root[top(j)] = top(i)
                    edges.append((int(reps[i]), int(reps[j])))
    return edges


def _close(reps: DataFrame, trees: int, max_depth: int, depth: int, threshold: float) -> DataFrame:
    """(a, b): edges that join the classes below one node whose labels agree as those of
    links do. ``reps``: (rep, forest, comp, texts), components joined by nodes alone."""
    values = trees * max_depth
    least = least_agreeing(threshold, values)

    def of_bytes(forests: list[bytes]) -> np.ndarray:
        return np.frombuffer(b"".join(forests), dtype=f">u{VALUE_BYTES}").reshape(-1, values).astype(np.uint16)

    def frame(edges: list[tuple[int, int]]) -> pd.DataFrame:
        return pd.DataFrame(edges, columns=["a", "b"], dtype=np.int64).drop_duplicates()

    def in_component(pdf: pd.DataFrame) -> pd.DataFrame:
        return frame(close_below_nodes(pdf["rep"].to_numpy(np.int64), of_bytes(pdf["forest"].tolist()), trees, depth, least))

    def in_nodes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield frame([e for r, f in zip(pdf["reps"], pdf["forests"])
                         for e in close_edges(np.asarray(r), of_bytes(list(f)), least)])

    few = (reps.where(F.col("texts") <= LABEL_TEXTS).select("comp", "rep", "forest")
           .groupBy("comp").applyInPandas(in_component, "a long, b long"))
    many = reps.where(F.col("texts") > LABEL_TEXTS)
    if many.isEmpty():
        return few
    entries = trie_nodes(many, trees, max_depth, depth)
    star = entries.groupBy("node").agg(F.min("rep").alias("b"), F.count("*").alias("n")).where("n > 1")
    entries = entries.join(star, "node")
    below = (entries.where(F.col("n") <= NODE_TEXTS).join(many.select("rep", "forest"), "rep").groupBy("node")
             .agg(F.collect_list("rep").alias("reps"), F.collect_list("forest").alias("forests")))
    return few.unionByName(below.mapInPandas(in_nodes, "a long, b long")).unionByName(
        entries.where(F.col("n") > NODE_TEXTS).select(F.col("rep").alias("a"), "b"))


def _candidates(reps: DataFrame, trees: int, max_depth: int, depth: int, threshold: float, chunk_shingles: int,
                chunk_texts: int) -> DataFrame:
    """Members of the components that prefixes of ``depth`` values join: the columns of
    ``reps`` but the labels, ``comp`` (its smallest rep), ``whole`` (a hash of its members)
    and ``chunks`` (the parts in which it is verified)."""
    known = reps.select("rep", "doc_id", "text_key", "copies", "n_shingles", "set_key")

    def joined(edges: DataFrame) -> DataFrame:
        found = components(edges, f"ngram-candidates-{depth}")
        members = saved(found.withColumnRenamed("id", "rep").withColumnRenamed("label", "comp").join(known, "rep"),
                        "ngram-members")
        sizes = (members.groupBy("comp").agg(F.sum("n_shingles").alias("s"), F.count("*").alias("texts"),
                                             F.bit_xor(F.xxhash64("rep")).alias("whole"))
                 .select("comp", "whole", "texts", F.greatest(F.ceil(F.col("s") / chunk_shingles),
                                                     F.ceil(F.col("texts") / chunk_texts)).alias("chunks")))
        out = saved(members.join(sizes, "comp"), "ngram-level")
        dropped(members)
        return out

    entries = trie_nodes(reps, trees, max_depth, depth)
    star = entries.groupBy("node").agg(F.min("rep").alias("b"), F.count("*").alias("n")).where("n > 1")
    level = joined(entries.join(star, "node").select(F.col("rep").alias("a"), "b"))
    large = level.where("chunks > 1")
    if large.isEmpty():
        return level
    # written once: which of the possible edges are given depends on the order of rows
    again = saved(_close(reps.select("rep", "forest").join(large.select("rep", "comp", "texts"), "rep"),
                         trees, max_depth, depth, threshold), "ngram-close")
    return level.where("chunks = 1").unionByName(joined(again))


def _verified(members: DataFrame, ids: DataFrame, docs: DataFrame, threshold: float,
              chunk_shingles: int) -> DataFrame:
    """Columns ``FOUND`` of the links within each component of ``members``; a member of
    a component of several groups of chunks has a row for every pair of them it is in."""
    n_shingles, n = members.agg(F.coalesce(F.sum("n_shingles"), F.lit(0)), F.count("*")).first()

    # the sets of candidates only are made again from their texts
    want = small_side(members.select(F.col("doc_id").alias("of_id"), F.col("text_key").alias("of_text"),
                                     "rep", "comp", "whole", "copies", "chunks", "set_key"), n)

    def wanted(rows: DataFrame) -> DataFrame:
        return rows.join(want, rows["doc_id"].eqNullSafe(want["of_id"]) & (rows["text_key"] == want["of_text"]))

    known = ["rep", "comp", "whole", "copies", "chunks"]
    texts = wanted(docs).select(*known, "set_key", "text")
    if wanted(ids.select("doc_id", "text_key")).count() > n:  # rows that are repeated in the table
        texts = texts.dropDuplicates(["rep"])

    def sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            made = [_shingle_sets(t) for t in pdf["text"]]
            same = [_set_key(s) == k for s, k in zip(made, pdf["set_key"])]
            yield pdf[known].assign(items=[s.tobytes() for s in made])[same]

    sets_of = (texts.mapInPandas(sets, "rep long, comp long, whole long, copies long, chunks long, items binary")
               .withColumn("own", F.pmod(F.xxhash64("rep"), F.col("chunks"))))
    bins = max(1, -(-int(n_shingles) // chunk_shingles))
    rest = ["comp", "whole", "rep", "copies", "own", "items"]
    alone = (sets_of.where("chunks = 1")
             .select(F.pmod(F.xxhash64("comp"), F.lit(bins)).alias("g"), F.lit(-1).alias("i"),
                     F.lit(-1).alias("j"), F.lit(0).alias("side"), *rest))
    groups = F.least("chunks", F.greatest(F.lit(SPREAD), F.ceil(F.col("chunks") / GROUP_CHUNKS)))
    dealt = (sets_of.where("chunks > 1").withColumn("group", F.pmod("own", groups))
             .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), groups - 1)))
             .select(F.col("comp").alias("g"),
                     F.least("group", "other").cast("int").alias("i"),
                     F.greatest("group", "other").cast("int").alias("j"),
                     (F.col("group") > F.col("other")).cast("int").alias("side"), *rest))

    def check(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.concat(verify(iter([pdf]), threshold))

    return alone.union(dealt).groupBy("g", "i", "j").applyInPandas(check, FOUND)


def match_forest(reps: DataFrame, ids: DataFrame, docs: DataFrame, threshold: float, trees: int, max_depth: int,
                 target_recall: float, chunk_shingles: int, chunk_texts: int) -> tuple[DataFrame, int, bool]:
    """The links (columns ``FOUND``) by prefixes shortened from ``max_depth`` until the
    target recall, the length they came to, and whether a component has several groups of them."""
    least = prefix_depth(threshold, trees, max_depth, target_recall)
    found, members, depth = None, None, max_depth
    while True:
        members = _candidates(reps, trees, max_depth, depth, threshold, chunk_shingles, chunk_texts)
        if found is None:
            found = saved(_verified(members, ids, docs, threshold, chunk_shingles), "ngram-found")
        else:  # a component of the same members is the same
            settled = found.select("comp", "whole").distinct()
            grown = saved(members.join(settled, ["comp", "whole"], "left_anti"), "ngram-grown")
            now = members.select("comp", "whole").distinct()
            before, found = found, saved(
                found.join(now, ["comp", "whole"], "left_semi").select(found.columns)
                .unionByName(_verified(grown, ids, docs, threshold, chunk_shingles)), "ngram-found")
            dropped(before, grown)
        links = {r["bin"]: r["n"] for r in
                 found.select(F.explode(F.arrays_zip("bins", "pairs")).alias("x"))
                 .groupBy(F.col("x.bins").alias("bin")).agg(F.sum("x.pairs").alias("n")).collect()}
        if depth == least or deep_enough(links, depth, threshold, trees, target_recall):
            break
        # the next length is the first that would do for the links known so far
        depth = next((d for d in range(depth - 1, least, -1)
                      if deep_enough(links, d, threshold, trees, target_recall)), least)
    return found, depth, not members.where("chunks > 1").isEmpty()


def _labelled(docs: DataFrame, trees: int, max_depth: int) -> tuple[DataFrame, DataFrame]:
    """The rows with their labels and numbers, and one row of each set of shingles."""
    ids = saved(signatures(docs, trees, max_depth).withColumn("row", F.monotonically_increasing_id()), "ngram-signatures")
    named = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key", "row")
    reps = (ids.where("n_shingles > 0").groupBy("set_key")
            .agg(F.min(named).alias("first"), F.min("doc_id").alias("copy_of"), F.count("*").alias("copies"),
                 F.first("n_shingles").alias("n_shingles"), F.first("forest").alias("forest"))
            .select("set_key", F.col("first.row").alias("rep"), F.col("first.doc_id").alias("doc_id"),
                    F.col("first.text_key").alias("text_key"), "copy_of", "copies", "n_shingles", "forest"))
    return ids, saved(reps, "ngram-classes")


def _classes(docs: DataFrame, threshold: float, trees: int, max_depth: int, target_recall: float,
             chunk_shingles: int, chunk_texts: int) -> DataFrame:
    """(doc_id, text_key, n_shingles, copies, copy_of, label, class_id, linked_docs,
    linked_texts) per row; ``label`` numbers the classes, null without words."""
    docs = _keyed(docs, "text")
    ids, reps = _labelled(docs, trees, max_depth)
    found, _, chunked = match_forest(reps, ids, docs, threshold, trees, max_depth, target_recall,
                                     chunk_shingles, chunk_texts)
    counts = found.groupBy("rep").agg(F.sum("linked_docs").alias("linked_docs"),
                                      F.sum("linked_texts").alias("linked_texts"),
                                      F.min("label").alias("label"))
    if chunked:  # a component of several groups of chunks: join its local labels
        joined = components(found.select(F.col("rep").alias("a"), F.col("label").alias("b")),
                            "ngram-classes-joined")
        counts = (counts.drop("label").join(joined.withColumnRenamed("id", "rep"), "rep", "left")
                  .withColumn("label", F.coalesce("label", "rep")))
    linked_to = (reps.select("set_key", "rep", "copies", "copy_of").join(counts, "rep", "left")
                 .select("set_key", "copies", "copy_of", F.coalesce("label", "rep").alias("label"),
                         F.coalesce("linked_docs", F.lit(0)).alias("linked_docs"),
                         F.coalesce("linked_texts", F.lit(0)).alias("linked_texts")))
    names = linked_to.groupBy("label").agg(F.min("copy_of").alias("class_id"))
    classes = saved(linked_to.join(names, "label"), "ngram-linked")
    rows = ids.select("doc_id", "text_key", "n_shingles", "set_key")
    return (rows.where("n_shingles > 0").join(classes, "set_key").drop("set_key")
            .unionByName(rows.where("n_shingles = 0").select(
                "doc_id", "text_key", "n_shingles", F.lit(1).cast("long").alias("copies"),
                F.col("doc_id").alias("copy_of"), F.lit(None).cast("long").alias("label"),
                F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("linked_docs"),
                F.lit(0).cast("long").alias("linked_texts"))))


def ngram_links(docs: DataFrame, threshold: float = THRESHOLD, trees: int = TREES,
                max_depth: int = MAX_DEPTH, target_recall: float = TARGET_RECALL,
                chunk_shingles: int = CHUNK_SHINGLES, chunk_texts: int = CHUNK_TEXTS) -> DataFrame:
    """One row per row of ``docs``: its ``doc_id``, ``class_id`` (smallest doc_id of
    its connected group of links), ``copy_of`` (smallest doc_id with the same
    shingle set), ``n_links`` (other documents at or above the threshold, copies
    counted) and ``n_texts`` (other shingle sets at or above it)."""
    return (_classes(docs, threshold, trees, max_depth, target_recall, chunk_shingles, chunk_texts)
            .select("doc_id", "class_id", "copy_of", (F.col("linked_docs") + F.col("copies") - 1).alias("n_links"),
                    F.col("linked_texts").alias("n_texts")))


def one_per_class(docs: DataFrame, threshold: float = THRESHOLD, trees: int = TREES,
                  max_depth: int = MAX_DEPTH, target_recall: float = TARGET_RECALL,
                  chunk_shingles: int = CHUNK_SHINGLES, chunk_texts: int = CHUNK_TEXTS) -> DataFrame:
    """``docs`` with one row of each class: that of the smallest doc_id (rows
    without one last, then by the hash of the text); of equal rows any one.
    Texts without words are in no class and stay."""
    rows = saved(_classes(docs, threshold, trees, max_depth, target_recall, chunk_shingles, chunk_texts)
                 .where("label IS NOT NULL").groupBy("label", "doc_id", "text_key")
                 .agg(F.count("*").alias("n")), "ngram-class-rows")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "text_key")
    first = rows.groupBy("label").agg(F.min(order).alias("first"))
    judged = rows.join(first, "label").select("doc_id", "text_key", "n", (order == F.col("first")).alias("stays"))
    judged = saved(judged, "ngram-judged")
    gone, repeated = judged.where("NOT stays"), judged.where("stays AND n > 1")
    n_gone, n_repeated = gone.count(), repeated.count()
    keyed = docs.select(F.struct("*").alias("doc"), F.xxhash64("text").alias("text_key"))

    def same(side: DataFrame):
        return (keyed["doc.doc_id"].cast("long").eqNullSafe(side["of_id"])) & (keyed["text_key"] == side["of_text"])

    def keys(side: DataFrame, n: int) -> DataFrame:
        return small_side(side.select(F.col("doc_id").alias("of_id"), F.col("text_key").alias("of_text")), n)

    left = keyed.join(gone_keys := keys(gone, n_gone), same(gone_keys), "left_anti")
    if n_repeated:
        again = keys(repeated, n_repeated)
        once = (left.join(again, same(again), "left_semi")
                .groupBy(F.col("doc.doc_id").alias("of_id"), "text_key").agg(F.first("doc").alias("doc")))
        left = left.join(again, same(again), "left_anti").select("doc").unionByName(once.select("doc"))
    return left.select("doc.*")


ship_by_value(__name__)
ship_by_value("screenrank.llm.words")
