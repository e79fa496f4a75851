"""Token counts (operator 8): rollups maintained by signed deltas.

A batch of changes is reduced to signed totals per (source, lang, version) and
written to its own folder, named by the batch id. Committing the same batch
again replaces that folder with the same content, so a retried or replayed
batch counts once; the rollup is the sum over folders, and batches may come in
any order. ``fold`` sums the batches up to an id into one folder and keeps the
list of their ids: a batch on that list, committed again, changes nothing, and
one that comes late is taken as usual.

A change is one row: ``insert`` adds a document and its tokens, ``delete``
takes them away, ``revise`` replaces ``old_tokens`` by ``tokens`` and leaves
the number of documents. A column ``times``, where there is one, says for how
many documents the row stands (null: one).

Defined results: null source, lang or version are groups of their own; null
counts are 0; an unknown kind of change is an error, and so is a batch id below
0; groups whose documents and tokens both come to 0 are left out of the rollup;
rows that repeat within a batch are separate changes; an empty batch commits
nothing and an empty rollup has no rows; only counts are stored, so very long
texts and ties make no difference; other columns are ignored.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

KEYS = ["source", "lang", "version"]
SCHEMA = "source string, lang string, version string, docs long, tokens long"


def deltas(changes: DataFrame) -> DataFrame:
    """Signed totals per key of rows (source, lang, version, kind, tokens,
    old_tokens and, if any, times)."""
    times = F.coalesce(F.col("times").cast("long"), F.lit(1)) if "times" in changes.columns else F.lit(1)
    kind = F.col("kind")
    new, old = (F.coalesce(F.col(c).cast("long"), F.lit(0)) for c in ("tokens", "old_tokens"))
    docs = F.when(kind == "insert", 1).when(kind == "delete", -1).when(kind == "revise", 0)
    tokens = F.when(kind == "insert", new).when(kind == "delete", -new).when(kind == "revise", new - old)
    wrong = F.raise_error(F.concat(F.lit("unknown kind of change: "), F.coalesce(kind, F.lit("null"))))
    return (changes.groupBy(*KEYS)
            .agg(F.sum(F.coalesce(docs, wrong.cast("int")) * times).cast("long").alias("docs"),
                 F.sum(F.coalesce(tokens, F.lit(0)) * times).cast("long").alias("tokens")))


#: Folder of what ``fold`` has summed.
FOLDED = -1


class TokenRollup:
    """Totals below one shared folder: ``data/batch=...``, and ``folded``, the
    ids of the batches that ``fold`` has summed."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path
        self._folded: set[int] | None = None

    def folded(self) -> set[int]:
        """The ids of folded batches (a number a batch; they never change)."""
        if self._folded is None:
            try:
                self._folded = {r[0] for r in self.spark.read.schema("batch long").parquet(f"{self.path}/folded").collect()}
            except AnalysisException as e:
                if e.getCondition() != "PATH_NOT_FOUND":
                    raise
                self._folded = set()
        return self._folded

    def commit(self, batch: int, changes: DataFrame) -> None:
        """Apply a batch; again, and nothing changes."""
        if batch < 0:
            raise ValueError("batch ids start at 0")
        if batch not in self.folded():
            deltas(changes).write.mode("overwrite").parquet(f"{self.path}/data/batch={int(batch)}")

    def _stored(self) -> DataFrame:
        return self.spark.read.schema(f"{SCHEMA}, batch long").parquet(f"{self.path}/data")

    def totals(self) -> DataFrame:
        """(source, lang, version, docs, tokens) of all committed batches."""
        return (self._stored().groupBy(*KEYS)
                .agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
                .where("docs <> 0 OR tokens <> 0"))

    def fold(self, upto: int, path: str) -> TokenRollup:
        """A new rollup below ``path`` with the batches up to ``upto`` as one and
        later ones as they are. It is complete before anyone uses it, so a failure
        on the way harms nothing."""
        stored = self._stored()
        old = stored.where(F.col("batch") <= upto).groupBy(*KEYS).agg(
            F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")).withColumn("batch", F.lit(FOLDED).cast("long"))
        (old.unionByName(stored.where(F.col("batch") > upto)).write.partitionBy("batch").mode("overwrite")
         .parquet(f"{path}/data"))
        ids = stored.where((F.col("batch") <= upto) & (F.col("batch") > FOLDED)).select("batch").distinct()
        before = self.spark.createDataFrame([(b,) for b in sorted(self.folded())], "batch long")
        ids.unionByName(before).write.mode("overwrite").parquet(f"{path}/folded")
        return TokenRollup(self.spark, path)


def change(kind: str, tokens: Column | str | int, old: Column | str | int = 0) -> list[Column]:
    """The columns of a change, next to the keys."""
    value = [F.lit(x) if isinstance(x, int) else F.col(x) if isinstance(x, str) else x for x in (tokens, old)]
    return [F.lit(kind).alias("kind"), value[0].cast("long").alias("tokens"),
            value[1].cast("long").alias("old_tokens")]
