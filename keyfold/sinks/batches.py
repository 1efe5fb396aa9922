"""Micro-batch outputs as one folder a batch: ``<path>/batch=<n>``.

Writing a batch again overwrites its own folder only, so a batch that a stream
replays after a crash changes nothing.  A folder counts once its ``_SUCCESS``
marker is there.  One stream writes to a path.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keyfold import fs
from keyfold.session import ensure_checkpoint_dir


def batch_path(path: str, batch_id: int) -> str:
    return f"{path.rstrip('/')}/batch={batch_id}"


def batches(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the complete batches under ``path``, ascending."""
    found = [int(n.split("=", 1)[1]) for n in fs.list_dirs(spark, path) if n.startswith("batch=")]
    return sorted(n for n in found if fs.exists(spark, batch_path(path, n) + "/_SUCCESS"))


def before(spark: SparkSession, path: str, batch_id: int) -> DataFrame | None:
    """The last complete batch below ``batch_id``."""
    earlier = [n for n in batches(spark, path) if n < batch_id]
    return spark.read.parquet(batch_path(path, earlier[-1])) if earlier else None


def drop_below(spark: SparkSession, path: str, batch_id: int) -> None:
    """Delete the complete batches below ``batch_id`` but the last of them,
    which a replay of ``batch_id`` starts from."""
    for n in [n for n in batches(spark, path) if n < batch_id][:-1]:
        fs.delete(spark, batch_path(path, n))


def same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]):
    """Null-safe equality of all ``keys``."""
    cond = F.lit(True)
    for k in keys:
        cond = cond & left[k].eqNullSafe(right[k])
    return cond


def upsert(rows: DataFrame, path: str, keys: Sequence[str]) -> int:
    """K5 as a batch job: one more batch after the last; returns its number."""
    n = max(batches(rows.sparkSession, path), default=-1) + 1
    upsert_sink(path, keys)(rows, n)
    return n


def upsert_sink(path: str, keys: Sequence[str]) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function: the rows so far, each batch's rows replacing
    those of the same keys, as a new folder a batch.  Null keys are keys; two
    rows of one key in a batch are refused."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        ensure_checkpoint_dir(spark)
        target = before(spark, path, batch_id)
        batch = batch.checkpoint(eager=True)  # used twice; the stream's state moves on once
        twice = batch.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).filter("_rows > 1").head(1)
        if twice:
            raise ValueError(f"key {tuple(twice[0])[:-1]} occurs {twice[0]['_rows']} times in a batch for {path}")
        rows = batch
        if target is not None:
            rows = target.join(batch, same_keys(target, batch, keys), "left_anti").unionByName(batch)
        rows.write.mode("overwrite").parquet(batch_path(path, batch_id))
        drop_below(spark, path, batch_id)
    return sink


def read_upserted(spark: SparkSession, path: str) -> DataFrame:
    """The rows that :func:`upsert_sink` holds now."""
    done = batches(spark, path)
    if not done:
        raise FileNotFoundError(f"no complete batch under {path}")
    return spark.read.parquet(batch_path(path, done[-1]))
