"""Sinks (K1-K3).

* ``overwrite_table`` (K1): full refresh of a table.
* ``write_documents`` (K2): one document per key (the search index shape),
  with a distributed uniqueness check.
* ``replace_by_key`` / ``read_latest`` (K3): the reference deletes a user's row
  and inserts a new one per event. Rewriting a whole table per micro-batch
  does not scale, so each batch is written as its own version folder
  ``batch_id=N`` (re-running batch N rewrites the same folder: idempotent under
  at-least-once ``foreachBatch``) and readers keep the newest version of each
  key with an aggregate (``max_by``), which combines map-side.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def overwrite_table(df: DataFrame, path: str, fmt: str = "parquet",
                    partition_by: list[str] | None = None) -> None:
    w = df.write.mode("overwrite").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def write_documents(df: DataFrame, path: str, key: str = "mid", fmt: str = "json",
                    check_unique: bool = True) -> None:
    """K2: documents keyed by ``key``; duplicate keys are an error (found after
    writing, so the caller must not use the documents then)."""
    df.write.mode("overwrite").format(fmt).save(path)
    if check_unique:  # on the written keys: the documents are computed once
        keys = df.sparkSession.read.schema(df.select(key).schema).format(fmt).load(path)
        dup = keys.groupBy(key).count().filter(F.col("count") > 1).limit(1).collect()
        if dup:
            raise ValueError(f"duplicate document key {key}={dup[0][key]}")


def version_path(path: str, batch_id: int) -> str:
    return os.path.join(path, f"batch_id={int(batch_id)}")


def replace_by_key(batch: DataFrame, path: str, batch_id: int, fmt: str = "parquet",
                   partition_by: list[str] | None = None) -> None:
    """K3: write this batch's rows as version ``batch_id`` (idempotent)."""
    w = batch.write.mode("overwrite").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(version_path(path, batch_id))


def _fs_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def latest_snapshot(spark: SparkSession, path: str) -> int | None:
    """Newest complete snapshot (``_snapshots/upto=N`` with a ``_SUCCESS``)."""
    fs, root = _fs_path(spark, os.path.join(path, "_snapshots"))
    if not fs.exists(root):
        return None
    done = []
    for st in fs.listStatus(root):
        name = st.getPath().getName()
        if name.startswith("upto=") and fs.exists(st.getPath().suffix("/_SUCCESS")):
            done.append(int(name.split("=", 1)[1]))
    return max(done) if done else None


def read_log(spark: SparkSession, path: str, fmt: str = "parquet",
             upto_batch: int | None = None) -> DataFrame:
    """Every live row of a versioned log, with its ``batch_id``: the newest
    snapshot plus the versions written after it (older versions, already in
    the snapshot, are pruned by the partition filter and never read)."""
    snap = latest_snapshot(spark, path)
    if upto_batch is not None and snap is not None and snap > upto_batch:
        snap = None  # reading an older state than the snapshot: versions only
    v = spark.read.format(fmt).load(path)
    if snap is not None:
        v = v.filter(F.col("batch_id") > snap)
    if upto_batch is not None:
        v = v.filter(F.col("batch_id") <= upto_batch)
    if snap is None:
        return v
    base = spark.read.format(fmt).load(os.path.join(path, "_snapshots", f"upto={snap}"))
    return base.unionByName(v, allowMissingColumns=False)


def compact_log(spark: SparkSession, path: str, upto: int, key: str | None = None,
                fmt: str = "parquet", remove_old: bool = False) -> None:
    """Snapshot of a versioned log as of batch ``upto``.

    With ``key`` (a replace-by-key table) only the newest row of every key is
    kept; without (an append log) all rows are. Writing the same snapshot
    again is harmless, so a replayed batch may compact twice. ``remove_old``
    deletes what the snapshot before this one had already replaced, so a reader
    that listed the log between the two still finds its files."""
    before = latest_snapshot(spark, path)
    rows = read_latest(spark, path, key, fmt, upto_batch=upto, keep_batch=True) if key \
        else read_log(spark, path, fmt, upto_batch=upto)
    rows.write.mode("overwrite").format(fmt).save(os.path.join(path, "_snapshots", f"upto={int(upto)}"))
    if remove_old and before is not None and before < upto:
        fs, root = _fs_path(spark, path)
        for folder, prefix, last in ((root, "batch_id=", before), (root.suffix("/_snapshots"), "upto=", before - 1)):
            for st in fs.listStatus(folder):
                name = st.getPath().getName()
                if name.startswith(prefix) and int(name[len(prefix):]) <= last:
                    fs.delete(st.getPath(), True)


def read_versions(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return read_log(spark, path, fmt)


def read_latest(spark: SparkSession, path: str, key: str, fmt: str = "parquet",
                upto_batch: int | None = None, keep_batch: bool = False) -> DataFrame:
    """Current table of a K3 log: newest version of every key."""
    v = read_log(spark, path, fmt, upto_batch)
    cols = [c for c in v.columns if c not in (key, "batch_id")]
    latest = v.groupBy(key).agg(F.max_by(F.struct(*cols, "batch_id"), F.col("batch_id")).alias("_row"))
    out = [key] + cols + (["batch_id"] if keep_batch else [])
    return latest.select(*[F.col(f"_row.{c}").alias(c) if c != key else F.col(key) for c in out])
