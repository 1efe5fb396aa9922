"""Session helpers: a local session for tests/bench and the shared work folder.

Library code never invents storage locations: scratch data (rendered fixtures,
file-table versions, stream checkpoints) lives under ``spark.checkpoint.dir``,
the shared folder the cluster names.  Only when that setting is unset (local
tests) do we pick a folder of our own.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

_CKPT_KEY = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", partitions: int | None = None,
                  app: str = "keyfold") -> SparkSession:
    """A local session configured like the cluster one (AQE on, UTC, ANSI)."""
    n = (os.cpu_count() or 8) if cores == "*" else int(cores)
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions or n))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Remove checkpoint files once the DataFrames that wrote them are gone.
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a local one only if unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get(_CKPT_KEY, None) or sc.getConf().get(_CKPT_KEY, None)
    if not configured:
        if not re.fullmatch(r"local(\[[^]]*\])?", sc.master):
            # A driver-local folder is invisible to executors on a cluster.
            raise RuntimeError(f"set {_CKPT_KEY} to a folder shared by the cluster "
                               "(e.g. an hdfs:// or object-store path)")
        configured = tempfile.mkdtemp(prefix="keyfold-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def shared_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared folder (``spark.checkpoint.dir``).

    The checkpoint dir Spark reports contains a per-application uuid folder;
    we use its parent (the configured shared folder) so that data written by
    one application (e.g. rendered fixtures) can be reused by the next.
    """
    root = spark.conf.get(_CKPT_KEY, None) or spark.sparkContext.getConf().get(_CKPT_KEY, None)
    if not root:
        root = ensure_checkpoint_dir(spark)
    root = root.rstrip("/")
    return "/".join([root, "keyfold", *[p.strip("/") for p in parts]])


def fresh_path(spark: SparkSession, *parts: str) -> str:
    """A new, unique path under the shared folder (one per run)."""
    return shared_path(spark, *parts, uuid.uuid4().hex[:12])
