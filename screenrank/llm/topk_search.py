"""Exact top-k search (operator 10): distributed histogram selection.

Components become integers floor(1024 * x); the score of two vectors of equal
length is their inner product. Queries and candidates are packed into blocks
of bounded size, and every query block meets every candidate block in a task
that scores all its pairs as one matrix product. The copies of the query blocks, one
per group of candidate blocks, are shuffled: Spark, which doesn't count copies in its
estimates, would send all of them through the driver as a broadcast. Only counts leave the task:
per query, how many scores fall into each of ``BINS`` bins of its bracket. The
counts, summed over all candidate blocks, tell in which bin the k-th score
lies; that bin is the next bracket, until it is one score wide. A last pass
lists the scores above the k-th value, and of those equal to it each block's
smallest ids, as many as are still wanted; a rank per query over these
survivors breaks the ties.

A block reports no bin below its own k-th score, since the k-th score over all
blocks can't lie lower; so a task sends at most k rows per query.

Defined results: vectors that are null or hold null or non-finite components
take no part; rows that repeat a vec_id count once (the least vector); rows
without vec_id are left out; a query never finds its own id; with fewer than k
candidates all are returned; empty tables give an empty result; other columns
are ignored. Components must stay below 2**31 / 1024 in size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from screenrank.llm.common import dropped, saved
from screenrank.session import ship_by_value

K = 10
SCALE = 1024
BINS = 1 << 12
QUERY_ROWS, CANDIDATE_ROWS = 512, 4096
#: Groups that the candidate blocks are dealt in (more where one would hold over
#: ``GROUP_BLOCKS``): a query block is copied once per group, not once per block.
GROUPS, GROUP_BLOCKS = 64, 64


def integer_vectors(vectors: DataFrame) -> DataFrame:
    """(vec_id, v array<long>) of the vectors that take part, one row an id."""
    x = F.col("embedding")
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c.cast("double"))
                      & (F.abs(c.cast("double")) < float("inf")))
    return (vectors.select(F.col("vec_id").cast("long"), "embedding")
            .where(F.col("vec_id").isNotNull() & x.isNotNull() & finite)
            .select("vec_id", F.transform(x, lambda c: F.floor(c.cast("double") * SCALE)).alias("v"))
            .groupBy("vec_id").agg(F.min("v").alias("v")))


def _blocks(rows: DataFrame, n: int, side: str) -> DataFrame:
    """One row a block: (dim, block, ids, values), the last two as bytes."""
    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("vec_id")
        values = np.array(pdf["v"].tolist(), dtype=np.int64).reshape(len(pdf), -1)
        if np.abs(values).max(initial=0) < 2 ** 31:
            values = values.astype(np.int32)
        return pd.DataFrame({"dim": [pdf["dim"].iloc[0]], f"{side}_block": [pdf["block"].iloc[0]],
                             f"{side}_ids": [pdf["vec_id"].to_numpy(np.int64).tobytes()],
                             f"{side}_values": [values.tobytes()]})

    return (rows.select("vec_id", "v", F.size("v").alias("dim"),
                        F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int").alias("block"))
            .groupBy("dim", "block")
            .applyInPandas(pack, f"dim int, {side}_block int, {side}_ids binary, {side}_values binary"))


def _matrix(values: bytes, rows: int, dim: int) -> np.ndarray:
    wide = len(values) == 8 * rows * dim
    return np.frombuffer(values, dtype=np.int64 if wide else np.int32).reshape(rows, dim).astype(np.int64, copy=False)


def _scores(row: pd.Series) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Query ids, candidate ids, integer scores and the mask of pairs that count."""
    q_ids = np.frombuffer(row["q_ids"], dtype=np.int64)
    c_ids = np.frombuffer(row["c_ids"], dtype=np.int64)
    q, c = _matrix(row["q_values"], len(q_ids), row["dim"]), _matrix(row["c_values"], len(c_ids), row["dim"])
    top = int(np.abs(q).max(initial=0)) * int(np.abs(c).max(initial=0)) * max(1, q.shape[1])
    if top < 2 ** 53:  # exact in doubles
        s = (q.astype(np.float64) @ c.astype(np.float64).T).astype(np.int64)
    else:
        s = q @ c.T
    return q_ids, c_ids, s, q_ids[:, None] != c_ids[None, :]


def _count(k: int, bins: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for _, row in pdf.iterrows():
                q_ids, _, s, counts = _scores(row)
                at = {i: n for n, i in enumerate(q_ids.tolist())}
                for qid, low, width, above in row["state"]:
                    n = at[qid]
                    mine = s[n][counts[n]]
                    mine = mine[(mine >= low) & (mine < low + width * bins)]
                    b, m = np.unique((mine - low) // width, return_counts=True)
                    # from the highest bin on, until k scores are reached
                    keep = m[::-1].cumsum()[::-1] - m < k - above
                    yield pd.DataFrame({"vec_id": qid, "bin": b[keep], "n": m[keep]})

    return run


def _list(k: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for _, row in pdf.iterrows():
                q_ids, c_ids, s, counts = _scores(row)
                at = {i: n for n, i in enumerate(q_ids.tolist())}
                for qid, low, _, above in row["state"]:
                    n = at[qid]
                    over = np.flatnonzero(counts[n] & (s[n] > low))
                    ties = np.flatnonzero(counts[n] & (s[n] == low))[:max(0, k - above)]  # ids ascend
                    both = np.concatenate([over, ties])
                    yield pd.DataFrame({"query_id": qid, "vec_id": c_ids[both], "score": s[n][both]})

    return run


def _first_width(span: Column, bins: int) -> Column:
    """Smallest power of ``bins`` with which ``bins`` bins cover ``span``: every
    later bracket is then exactly one bin of the bracket before."""
    powers = [p for p in (bins ** i for i in range(64)) if p < 2 ** 62]
    width = F.lit(powers[-1])
    for p in reversed(powers[:-1]):
        width = F.when(span <= p * bins, F.lit(p)).otherwise(width)
    return width.cast("long")


def exact_topk(vectors: DataFrame, queries: Column, k: int = K, bins: int = BINS) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best candidates of each row
    of ``vectors`` that meets the condition ``queries`` (on vec_id)."""
    rows = saved(integer_vectors(vectors), "topk-vectors")
    asked = rows.where(queries)
    n, m, top = rows.agg(F.count("*"), F.coalesce(F.sum(queries.cast("int")), F.lit(0)),
                         F.coalesce(F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x)),
                                    F.lit(0.0))).first()
    c_blocks, q_blocks = max(1, -(-n // CANDIDATE_ROWS)), max(1, -(-m // QUERY_ROWS))
    groups = min(c_blocks, max(GROUPS, 4 * vectors.sparkSession.sparkContext.defaultParallelism, -(-c_blocks // GROUP_BLOCKS)))
    candidates = saved(_blocks(rows, c_blocks, "c").withColumn("c_group", F.col("c_block") % groups), "topk-candidates")
    asked_blocks = saved(_blocks(asked, q_blocks, "q"), "topk-queries")

    # |score| <= |query| * |candidate|: the first bracket
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x) * float(top))
    bound = (F.floor(norm * (1 + 1e-9)) + 1).cast("long")
    state = saved(asked.select(
        "vec_id", F.size("v").alias("dim"), F.pmod(F.xxhash64("vec_id"), F.lit(q_blocks)).cast("int").alias("q_block"),
        (-bound).alias("low"), _first_width(2 * bound + 1, bins).alias("width"),
        F.lit(0).cast("long").alias("above"), F.lit(False).alias("done")), "topk-state")

    def meet(todo: DataFrame) -> DataFrame:
        """A row per pair of blocks, with the states of its queries."""
        per_block = (todo.groupBy("dim", "q_block")
                     .agg(F.collect_list(F.struct("vec_id", "low", "width", "above")).alias("state")))
        dealt = (asked_blocks.join(per_block, ["dim", "q_block"])
                 .withColumn("c_group", F.explode(F.sequence(F.lit(0), F.lit(int(groups - 1))))))
        return (dealt.hint("merge").join(candidates.hint("merge"), ["dim", "c_group"])
                .select("dim", "q_ids", "q_values", "c_ids", "c_values",
                        F.transform("state", lambda x: F.array(x["vec_id"], x["low"], x["width"],
                                                               x["above"])).alias("state")))

    i = 0
    while not state.where("NOT done").isEmpty():
        found = (meet(state.where("NOT done"))
                 .mapInPandas(_count(k, bins), "vec_id long, bin long, n long")
                 .groupBy("vec_id", "bin").agg(F.sum("n").alias("n")))
        down = Window.partitionBy("vec_id").orderBy(F.col("bin").desc())
        reached = (found.withColumn("upto", F.sum("n").over(down))
                   .join(state.select("vec_id", "above"), "vec_id")
                   .where(F.col("above") + F.col("upto") >= k)
                   .groupBy("vec_id").agg(F.max(F.struct("bin", (F.col("upto") - F.col("n")).alias("over")))
                                          .alias("hit")))
        low = F.when(F.col("hit").isNull(), F.col("low") - 1).otherwise(
            F.col("low") + F.col("hit.bin") * F.col("width"))  # null: fewer than k, take all
        moved = (state.where("NOT done").join(reached, "vec_id", "left")
                 .select("vec_id", "dim", "q_block", low.alias("low"),
                         F.greatest(F.expr(f"width div {bins}"), F.lit(1)).alias("next"), "width",
                         (F.col("above") + F.coalesce("hit.over", F.lit(0))).alias("above"),
                         (F.col("hit").isNull() | (F.col("width") == 1)).alias("done"))
                 .select("vec_id", "dim", "q_block", "low", F.col("next").alias("width"), "above", "done"))
        before, state = state, saved(state.where("done").unionByName(moved), f"topk-state-{i}")
        dropped(before)
        i += 1
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (meet(state).mapInPandas(_list(k), "query_id long, vec_id long, score long")
            .withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


ship_by_value(__name__)
