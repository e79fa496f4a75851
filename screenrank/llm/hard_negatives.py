"""Hard-negative mining (operator 11): cover trees over norm-augmented vectors.

Components become integers floor(scale * x); the score of two vectors of equal
length is their inner product. An added component sqrt(M**2 - |x|**2) gives all
vectors of a tree the norm M, so a high inner product with an anchor is a small
distance from it, and a node of the tree (a vector, and the covering radius of
all below it) bounds the inner products below it from both sides.

Vectors are dealt by label bucket and nearest pivot into parts of bounded size,
and each part becomes one cover tree: a node's children are vectors more than
half its radius apart that cover it within that half (at most ``FANOUT`` of
them, then with the radius that they need); parts of ``LEAF_ROWS`` vectors or
of equal ones are leaves. The pivots are the tree's top level: picked far apart
from a sample of at most ``PIVOT_ROWS`` vectors, while every vector is dealt.

Anchors are searched in blocks. All nodes of a group of trees wait in one heap,
the one with the largest bound first; a node is left out for every anchor whose
windows it can't enter: its largest score is below the window or below the
anchor's k-th so far, or its least is above the window. What a leaf holds is
scored exactly. Trees whose root no anchor of a block needs are not even sent
to it. First come each anchor's positives (trees of its label's bucket only),
then, with a window of scores per positive, the negatives.

Defined results: rows with a null label, a null vector, or null or non-finite
components take no part; vectors of another length are no candidates; every row
is a candidate of its own, whatever its ``vec_id`` (null and repeated ones
included; rows that repeat an anchor's id are other rows); equal scores come by
ascending ``vec_id``, null last; an anchor without positives, a positive without
negatives (a score below 0 has an empty window) and empty tables give no rows;
other columns are ignored. Components beyond 2**31 / scale, and vectors whose
products could pass 2**63, are an error.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from screenrank.llm.common import saved, small_side
from screenrank.session import ship_by_value

SCALE = 256
POSITIVES, K = 5, 10
#: Negatives score from LOW to HIGH per cent of the positive.
LOW, HIGH = 30, 90
LABEL_BUCKETS = 64
TREE_ROWS, ANCHOR_ROWS = 4096, 256
TREES_PER_TASK, ROOTS_PER_TASK = 8, 1024
LEAF_ROWS, FANOUT = 64, 64
#: Vectors from which pivots are picked, and the most pivots.
PIVOT_ROWS, PIVOTS = 4096, 512
_LAST = 2 ** 63 - 1  # stands for a null id: after every other one

_TREE = ("tree long, dim int, bucket int, rows int, top double, ids binary, rids binary, labels binary, "
         "vectors binary, centre binary, radius binary, first binary, last binary, child binary, children binary, "
         "root binary, root_radius double")
_ANCHORS = ("dim int, bucket int, q_block int, rids binary, ids binary, labels binary, vectors binary, "
            "pids array<array<long>>, pscores array<array<long>>")


def integer_rows(vectors: DataFrame, scale: int) -> DataFrame:
    """(rid, vec_id, label, v, dim, bucket) of the rows that take part."""
    x = F.col("embedding")
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c.cast("double"))
                      & (F.abs(c.cast("double")) < float("inf")))

    def whole(c: Column) -> Column:
        y = F.floor(c.cast("double") * scale)
        return F.when(F.abs(c.cast("double") * scale) < 2.0 ** 31, y).otherwise(
            F.raise_error(F.lit("a component is too large for integer scores")).cast("long"))

    return (vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
                           "embedding")
            .where(F.col("label").isNotNull() & x.isNotNull() & finite)
            .select(F.monotonically_increasing_id().alias("rid"), "vec_id", "label",
                    F.transform(x, whole).alias("v"), F.size(x).alias("dim"),
                    F.pmod(F.xxhash64("label"), F.lit(LABEL_BUCKETS)).cast("int").alias("bucket")))


# -------------------------------------------------------------------- the tree

def farthest_first(x: np.ndarray, start: int, most: int, within: float = 0.0) -> tuple[list[int], np.ndarray, np.ndarray]:
    """Rows of ``x`` picked each farthest from those before it, until all lie
    ``within`` of one or there are ``most``: the rows, and per row of ``x`` the
    nearest one's place and distance."""
    picked, near = [start], np.zeros(len(x), dtype=np.int64)
    dist = np.linalg.norm(x - x[start], axis=1)
    while len(picked) < most:
        far = int(dist.argmax())
        if dist[far] <= within:
            break
        away = np.linalg.norm(x - x[far], axis=1)
        closer = away < dist
        near[closer] = len(picked)
        dist[closer] = away[closer]
        picked.append(far)
    return picked, near, dist


def augmented(v: np.ndarray) -> tuple[np.ndarray, float]:
    """``v`` with one more component that gives all rows one norm; its square."""
    norm = (v.astype(np.float64) ** 2).sum(axis=1)
    top = float(norm.max(initial=0.0))
    return np.column_stack([v.astype(np.float64), np.sqrt(np.maximum(top - norm, 0.0))]), top


def cover_tree(x: np.ndarray, leaf_rows: int = LEAF_ROWS, fanout: int = FANOUT) -> dict[str, np.ndarray]:
    """Nodes over the rows of ``x`` put in ``order``: node j covers order[first:last]
    within ``radius`` of the row at place ``centre`` of that order, and its
    children are nodes child .. child + children - 1."""
    start = int(np.linalg.norm(x - x.mean(axis=0), axis=1).argmin())
    todo = [(np.arange(len(x)), start)]
    order, nodes, at = [], [], 0
    while at < len(todo):
        rows, centre = todo[at]
        dist = np.linalg.norm(x[rows] - x[centre], axis=1)
        radius = float(dist.max())
        node = [centre, radius, rows, 0, 0]
        if len(rows) > leaf_rows and radius > 0:
            picked, near, _ = farthest_first(x[rows], int(np.flatnonzero(rows == centre)[0]), fanout, radius / 2)
            node[3], node[4] = len(todo), len(picked)
            todo += [(rows[near == i], int(rows[p])) for i, p in enumerate(picked)]
        nodes.append(node)
        at += 1
    place, first, last = np.empty(len(x), dtype=np.int64), np.zeros(len(nodes), np.int64), np.zeros(len(nodes), np.int64)
    stack = [0]
    while stack:  # depth first, so every node's rows lie together
        j = stack.pop()
        if nodes[j][4]:
            stack += range(nodes[j][3], nodes[j][3] + nodes[j][4])
        else:
            first[j] = len(order)
            order += nodes[j][2].tolist()
            last[j] = len(order)
    for j in range(len(nodes) - 1, -1, -1):  # children come after their parents
        a, n = nodes[j][3:]
        if n:
            first[j], last[j] = first[a:a + n].min(), last[a:a + n].max()
    order = np.array(order, dtype=np.int64)
    place[order] = np.arange(len(x))
    return {"order": order, "centre": place[[n[0] for n in nodes]], "radius": np.array([n[1] for n in nodes]),
            "first": first, "last": last, "child": np.array([n[3] for n in nodes], dtype=np.int64),
            "children": np.array([n[4] for n in nodes], dtype=np.int64)}


def _plant(part: pd.DataFrame) -> pd.DataFrame:
    v = np.array(part["v"].tolist(), dtype=np.int64).reshape(len(part), -1)
    x, top = augmented(v)
    t = cover_tree(x)
    o = t.pop("order")
    ids = part["vec_id"].astype("Int64").fillna(_LAST).to_numpy(np.int64)
    columns = {"ids": ids[o], "rids": part["rid"].to_numpy(np.int64)[o],
               "labels": part["label"].to_numpy(np.int64)[o], "vectors": v[o], **t}
    one = {"tree": int(part["tree"].iloc[0]), "dim": v.shape[1], "bucket": int(part["bucket"].iloc[0]),
           "rows": len(v), "top": top, "root": v[o[t["centre"][0]]].tobytes(), "root_radius": t["radius"][0]}
    return pd.DataFrame([one | {k: np.ascontiguousarray(a).tobytes() for k, a in columns.items()}])


def _trees(rows: DataFrame) -> DataFrame:
    """A row per tree. Parts are (dim, label bucket, nearest pivot), and chunks of
    them (by the row) where one is larger than ``TREE_ROWS``."""
    n = rows.count()
    most = min(PIVOTS, -(-n // (TREE_ROWS * LABEL_BUCKETS)))
    by_hash = rows.select("v").orderBy(F.xxhash64("rid"), "rid").limit(PIVOT_ROWS if most > 1 else 0).collect()
    pivots: dict[int, np.ndarray] = {}
    for dim in {len(r["v"]) for r in by_hash}:
        x = np.array([r["v"] for r in by_hash if len(r["v"]) == dim], dtype=np.float64)
        pivots[dim] = x[farthest_first(x, 0, most)[0]]

    @F.pandas_udf("int")
    def cell(v: pd.Series) -> pd.Series:
        out = np.zeros(len(v), dtype=np.int32)
        size = v.map(len).to_numpy()
        for dim, p in pivots.items():
            mine = np.flatnonzero(size == dim)
            for s in range(0, len(mine), 4096):
                at = mine[s:s + 4096]
                x = np.array([v.iloc[i] for i in at], dtype=np.float64).reshape(len(at), dim)
                out[at] = ((p ** 2).sum(axis=1) - 2 * x @ p.T).argmin(axis=1)
        return pd.Series(out)

    dealt = saved(rows.withColumn("cell", cell("v") if most > 1 else F.lit(0)), "negatives-cells")
    size = dealt.groupBy("dim", "bucket", "cell").agg(F.ceil(F.count("*") / TREE_ROWS).alias("chunks"))
    key = ["dim", "bucket", "cell", "chunk"]
    return (dealt.join(small_side(size, size.count()), ["dim", "bucket", "cell"])
            .withColumn("chunk", F.pmod(F.xxhash64("rid"), "chunks"))
            .withColumn("tree", F.xxhash64(*key)).groupBy(*key).applyInPandas(_plant, _TREE))


# ------------------------------------------------------------------ the search

class _Tree:
    def __init__(self, row: pd.Series) -> None:
        self.top, self.dim = row["top"], row["dim"]
        for k in ("ids", "rids", "labels", "centre", "first", "last", "child", "children"):
            setattr(self, k, np.frombuffer(row[k], dtype=np.int64))
        self.radius = np.frombuffer(row["radius"], dtype=np.float64)
        self.v = np.frombuffer(row["vectors"], dtype=np.int64).reshape(row["rows"], -1)
        self.largest = int(np.abs(self.v).max(initial=0))


def bounds(s: np.ndarray, norm2: np.ndarray, top: float, radius) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest inner product of anchors of squared norm ``norm2`` with
    what a node covers, from their products ``s`` with its centre."""
    reach = np.sqrt(norm2) * radius
    both = norm2 + top
    d = np.sqrt(np.maximum(both - 2 * s, 0.0))
    high = np.minimum(s + reach, (both - np.maximum(d - radius, 0.0) ** 2) / 2)
    low = np.maximum(s - reach, (both - (d + radius) ** 2) / 2)
    slack = 0.5 + 1e-9 * np.sqrt(norm2 * top)  # scores are whole numbers
    return low - slack, high + slack


class Search:
    """The best ``k`` rows of each anchor in each of its windows of scores.

    ``low`` and ``high``: anchors x windows. ``same``: rows of the anchor's
    label, or else of other labels."""

    def __init__(self, v, rids, labels, low, high, k: int, same: bool) -> None:
        self.v, self.rids, self.labels, self.k, self.same = v, rids, labels, k, same
        self.x = v.astype(np.float64)
        self.norm2 = (self.x ** 2).sum(axis=1)
        self.low, self.high = low.astype(np.float64), high.astype(np.float64)
        shape = (*low.shape, k)
        self.score = np.full(shape, -np.inf)  # exact: below 2**53, or kept in ``exact``
        self.exact = np.zeros(shape, dtype=np.int64)
        self.ids, self.found = np.full(shape, _LAST), np.full(shape, _LAST)
        self.largest = int(np.abs(v).max(initial=0))
        self.scored = 0

    def needs(self, tree, node: int, who: np.ndarray) -> tuple[np.ndarray, float]:
        """Those of the anchors ``who`` with a window that the node may enter, and
        the largest score it may have for them."""
        centre = tree.v[tree.centre[node]].astype(np.float64)
        low, high = bounds(self.x[who] @ centre, self.norm2[who], tree.top, tree.radius[node])
        least = np.maximum(self.low[who], self.score[who, :, -1])  # the k-th so far
        enters = ((high[:, None] >= least) & (low[:, None] <= self.high[who])
                  & (self.low[who] <= self.high[who])).any(axis=1)
        return who[enters], float(high[enters].max(initial=-np.inf))

    def leaf(self, tree: _Tree, node: int, who: np.ndarray) -> None:
        a, b = tree.first[node], tree.last[node]
        for s in range(a, b, 4 * LEAF_ROWS):  # leaves of equal rows may be long
            self._rows(tree, s, min(b, s + 4 * LEAF_ROWS), who)

    def _rows(self, tree: _Tree, a: int, b: int, who: np.ndarray) -> None:
        self.scored += len(who) * (b - a)
        if (limit := self.largest * tree.largest * max(1, tree.dim)) < 2 ** 53:
            s = (self.x[who] @ tree.v[a:b].T.astype(np.float64))
            exact = s.astype(np.int64)
        elif limit < 2 ** 63:
            exact = self.v[who] @ tree.v[a:b].T
            s = exact.astype(np.float64)
        else:
            raise OverflowError("inner products may pass 2**63")
        fits = (self.labels[who, None] == tree.labels[a:b]) == self.same
        fits &= self.rids[who, None] != tree.rids[a:b]
        enters = (fits[:, None, :] & (s[:, None, :] >= np.maximum(self.low[who], self.score[who, :, -1])[:, :, None])
                  & (s[:, None, :] <= self.high[who][:, :, None]))
        some = enters.any(axis=(1, 2))
        if not some.any():
            return
        who, enters, s, exact = who[some], enters[some], s[some], exact[some]
        shape = enters.shape

        def with_rows(kept, new):
            return np.concatenate([kept[who], np.broadcast_to(new, shape)], axis=2)

        score = np.concatenate([self.score[who], np.where(enters, s[:, None, :], -np.inf)], axis=2)
        exact = with_rows(self.exact, exact[:, None, :])
        ids, found = with_rows(self.ids, tree.ids[a:b]), with_rows(self.found, tree.rids[a:b])
        best = np.lexsort((found, ids, -exact, -score), axis=2)[:, :, :self.k]
        for kept, now in ((self.score, score), (self.exact, exact), (self.ids, ids), (self.found, found)):
            kept[who] = np.take_along_axis(now, best, axis=2)

    def descend(self, trees: list[_Tree]) -> None:
        heap, n = [], 0
        everyone = np.arange(len(self.v))
        for t, tree in enumerate(trees):
            who, high = self.needs(tree, 0, everyone)
            if len(who):
                heap.append((-high, n, t, 0, who))
                n += 1
        heapq.heapify(heap)
        while heap:
            _, _, t, node, who = heapq.heappop(heap)
            tree = trees[t]
            who, _ = self.needs(tree, node, who)  # lists may have filled up since
            if not len(who):
                continue
            if not tree.children[node]:
                self.leaf(tree, node, who)
                continue
            for c in range(tree.child[node], tree.child[node] + tree.children[node]):
                mine, high = self.needs(tree, c, who)
                if len(mine):
                    heapq.heappush(heap, (-high, n, t, c, mine))
                    n += 1


def _pack_anchors(part: pd.DataFrame) -> pd.DataFrame:
    part = part.sort_values("rid")
    v = np.array(part["v"].tolist(), dtype=np.int64).reshape(len(part), -1)
    return pd.DataFrame([{
        "dim": v.shape[1], "bucket": int(part["bucket"].iloc[0]), "q_block": int(part["q_block"].iloc[0]),
        "rids": part["rid"].to_numpy(np.int64).tobytes(), "ids": part["vec_id"].to_numpy(np.int64).tobytes(),
        "labels": part["label"].to_numpy(np.int64).tobytes(), "vectors": v.tobytes(),
        "pids": [list(map(int, x)) for x in part["pids"]], "pscores": [list(map(int, x)) for x in part["pscores"]]}])


def _anchor_blocks(anchors: DataFrame) -> DataFrame:
    size = anchors.groupBy("dim", "bucket").agg(F.ceil(F.count("*") / ANCHOR_ROWS).alias("blocks"))
    return (anchors.join(size, ["dim", "bucket"])
            .withColumn("q_block", F.pmod(F.xxhash64("rid"), "blocks").cast("int"))
            .groupBy("dim", "bucket", "q_block").applyInPandas(_pack_anchors, _ANCHORS))


def _search_of(row: pd.Series, k: int, same: bool, low: int, high: int) -> Search:
    rids = np.frombuffer(row["q_rids"], dtype=np.int64)
    scores = [list(x) for x in row["q_pscores"]]
    width = max(1, max(map(len, scores), default=1))
    lo, hi = np.full((len(rids), width), 1.0), np.zeros((len(rids), width))  # empty windows
    if same:
        lo, hi = np.full((len(rids), 1), -np.inf), np.full((len(rids), 1), np.inf)
    for i, x in enumerate(scores):
        for j, p in enumerate(x):
            lo[i, j], hi[i, j] = -(-low * int(p) // 100), high * int(p) // 100
    return Search(np.frombuffer(row["q_vectors"], dtype=np.int64).reshape(len(rids), -1), rids,
                  np.frombuffer(row["q_labels"], dtype=np.int64), lo, hi, k, same)


class _Root:
    """What is known of a tree before it is sent: its root."""

    def __init__(self, row) -> None:
        self.top, self.radius, self.centre = row["top"], [row["root_radius"]], [0]
        self.v = np.frombuffer(row["root"], dtype=np.int64)[None, :]


def _needed(k: int, same: bool, low: int, high: int):
    """Pairs (block of anchors, tree) in which an anchor needs the tree's root."""
    def run(part: pd.DataFrame) -> pd.DataFrame:
        row = part.iloc[0]
        search = _search_of(row, k, same, low, high)
        everyone = np.arange(len(search.v))
        trees = [x["tree"] for x in row["roots"] if len(search.needs(_Root(x), 0, everyone)[0])]
        return pd.DataFrame({"dim": row["dim"], "q_bucket": row["q_bucket"], "q_block": row["q_block"],
                             "tree": np.array(trees, dtype=np.int64)})

    return run


def _searched(k: int, same: bool, low: int, high: int):
    def run(part: pd.DataFrame) -> pd.DataFrame:
        row = part.iloc[0]
        search = _search_of(row, k, same, low, high)
        search.descend([_Tree(t) for _, t in part.sort_values("tree").iterrows()])
        a, w, _ = at = np.nonzero(search.score > -np.inf)
        pids, pscores = [list(x) for x in row["q_pids"]], [list(x) for x in row["q_pscores"]]
        ids = search.ids[at]
        return pd.DataFrame({
            "rid": search.rids[a], "anchor_id": np.frombuffer(row["q_ids"], dtype=np.int64)[a], "window": w.astype(np.int32),
            "positive_id": pd.array([None if same else pids[i][j] for i, j in zip(a, w)], dtype="Int64"),
            "positive_score": pd.array([None if same else pscores[i][j] for i, j in zip(a, w)], dtype="Int64"),
            "vec_id": ids, "found": search.found[at], "score": search.exact[at]})

    return run


_FOUND = ("rid long, anchor_id long, window int, positive_id long, positive_score long, "
          "vec_id long, found long, score long")


def _best(blocks: DataFrame, trees: DataFrame, k: int, same: bool, low: int, high: int, n_trees: int,
          name: str) -> DataFrame:
    """The ``k`` best (rid, window, ...) of every anchor over all trees."""
    asked = blocks.select("dim", F.col("bucket").alias("q_bucket"), "q_block",
                          *[F.col(c).alias(f"q_{c}") for c in ("rids", "ids", "labels", "vectors", "pids", "pscores")])
    key = ["dim", "q_bucket", "q_block"]
    if same:  # trees of the label's bucket, all of which an anchor without a list needs
        pairs = asked.select(*key).join(trees.select("dim", F.col("bucket").alias("q_bucket"), "tree"),
                                        ["dim", "q_bucket"])
    else:
        chunk = F.pmod(F.xxhash64("tree"), F.lit(max(1, -(-n_trees // ROOTS_PER_TASK)))).alias("chunk")
        roots = trees.groupBy("dim", chunk).agg(
            F.collect_list(F.struct("tree", "top", "root", "root_radius")).alias("roots"))
        pairs = (asked.join(roots, "dim").groupBy(*key, "chunk")
                 .applyInPandas(_needed(k, same, low, high), "dim int, q_bucket int, q_block int, tree long"))
    groups = max(1, -(-n_trees // TREES_PER_TASK))
    dealt = pairs.withColumn("group", F.pmod(F.xxhash64("tree"), F.lit(groups)))
    met = (dealt.join(trees.drop("dim", "bucket", "root", "root_radius"), "tree").join(asked, key))
    found = saved(met.groupBy(*key, "group").applyInPandas(_searched(k, same, low, high), _FOUND), name)
    best = Window.partitionBy("rid", "window").orderBy(F.col("score").desc(), "vec_id", "found")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def hard_negatives(vectors: DataFrame, anchors: Column, positives: int = POSITIVES, k: int = K,
                   low: int = LOW, high: int = HIGH, scale: int = SCALE) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score):
    for each row of ``vectors`` (vec_id, label, embedding) that meets ``anchors``
    (a condition on vec_id) and each of its ``positives`` best rows of its label,
    the ``k`` best rows of other labels that score from ``low`` to ``high`` per
    cent of the positive."""
    rows = saved(integer_rows(vectors, scale), "negatives-rows")
    trees = saved(_trees(rows), "negatives-trees")
    n_trees = trees.count()
    no = F.array().cast("array<long>")
    asked = rows.where(anchors & F.col("vec_id").isNotNull())
    first = _best(_anchor_blocks(asked.withColumns({"pids": no, "pscores": no})), trees, positives, True, low, high,
                  n_trees, "negatives-positives")
    lists = first.groupBy("rid").agg(F.array_sort(F.collect_list(F.struct("rank", "vec_id", "score"))).alias("p"))
    windows = _anchor_blocks(asked.join(lists, "rid").withColumns({
        "pids": F.transform("p", lambda x: x["vec_id"]), "pscores": F.transform("p", lambda x: x["score"])}))
    return (_best(windows, trees, k, False, low, high, n_trees, "negatives-found")
            .select("anchor_id", F.nullif("positive_id", F.lit(_LAST)).alias("positive_id"), "rank",
                    F.nullif("vec_id", F.lit(_LAST)).alias("negative_id"), "positive_score",
                    F.col("score").alias("negative_score")))


ship_by_value(__name__)
