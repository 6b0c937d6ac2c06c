"""Session helpers: local test session and shared scratch locations.

Scratch data (round-trip sinks, spool directories, stream checkpoints,
``DataFrame.checkpoint``) always lives under the cluster's shared
``spark.checkpoint.dir``.  Only when that setting is absent (local tests)
do we create one.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

_LOCAL_DEFAULTS = {
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.driver.memory": "16g",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(master: str = "local[8]", app: str = "tableflow", **conf: str) -> SparkSession:
    """Local session for tests and the bench (clusters bring their own)."""
    builder = SparkSession.builder.master(master).appName(app)
    for key, value in {**_LOCAL_DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint dir.

    Uses the session's checkpoint dir or ``spark.checkpoint.dir``; only a
    ``local[...]`` session without either gets a temporary local folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not configured:
        if not sc.master.startswith("local"):
            # a driver-local folder is invisible to executors on a cluster
            raise RuntimeError(
                "spark.checkpoint.dir is not set: point it at a folder shared by the cluster"
            )
        configured = tempfile.mkdtemp(prefix="tableflow-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def broadcast_limit(spark: SparkSession) -> int:
    """Bytes up to which Spark broadcasts a join side by itself; -1 for never."""
    text = spark.conf.get("spark.sql.autoBroadcastJoinThreshold").strip().lower().rstrip("b")
    units = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "t": 1 << 40}
    return int(text[:-1]) * units[text[-1]] if text[-1] in units else int(text)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique directory path under the shared checkpoint dir."""
    root = ensure_checkpoint_dir(spark)
    return os.path.join(root, "tableflow-scratch", f"{name}-{uuid.uuid4().hex[:12]}")
