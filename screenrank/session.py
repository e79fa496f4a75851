"""Session helpers.

Library code never creates a session on its own; it takes the caller's
``SparkSession``. ``get_session`` is a convenience for scripts and tests.
"""

from __future__ import annotations

import os
import sys
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job wants regardless of scale. Shuffle partition counts are
# left to the caller (AQE coalesces small shuffles at runtime).
_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str = "local[*]", app: str = "screenrank",
                shuffle_partitions: int | None = None,
                extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    conf = dict(_DEFAULTS)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    Read from ``spark.checkpoint.dir`` (the cluster names a shared, reliable
    folder there). Only when it is unset on a local master, as in tests, a
    private folder is created and recorded in the session so later calls
    agree; on a cluster a machine-local folder would be wrong, so it is an
    error instead.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (checkpoints and "
                               "intermediate tables are written there)")
        root = tempfile.mkdtemp(prefix="screenrank-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(os.path.join(root, "rdd"))
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the checkpoint root."""
    return os.path.join(checkpoint_root(spark), f"{name}-{uuid.uuid4().hex[:12]}")


def ship_by_value(module_name: str) -> None:
    """Serialise functions of ``module_name`` by value when Spark ships them
    to Python workers (``mapInPandas`` etc.), so executors do not need this
    package on their path."""
    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(sys.modules[module_name])
