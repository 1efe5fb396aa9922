"""K4: result tables as parquet; K5: tables of files upserted by key.

An upsert is one anti join and a union: rows of keys that the batch has give
way to the batch's.  :mod:`keyfold.sinks.batches` writes the result as a new
folder a batch, whole.  :func:`upsert_buckets` is for large key sets: the table
is partitioned by a hash of the key, and only the partitions that the batch
touches are read and replaced (Spark's dynamic partition overwrite).  One
writer at a time.  The anti join is a plain Spark join: adaptive execution
broadcasts the batch where it measures it to be small.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keyfold import fs
from keyfold.session import ensure_checkpoint_dir
from keyfold.sinks.batches import same_keys

BUCKET = "_bucket"


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite",
                  partition_by: Sequence[str] | None = None) -> str:
    """K4: write a result table as parquet (any Hadoop URI)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(buckets))


def upsert_buckets(batch: DataFrame, path: str, keys: Sequence[str], buckets: int) -> None:
    """Replace or add the batch's rows by key in the bucketed table at ``path``.

    Null keys are keys; two rows of one key in a batch are refused.  A batch
    that fails halfway is simply upserted again.  ``buckets`` stays the same
    for the life of a table.  An empty batch changes nothing.
    """
    spark = batch.sparkSession
    ensure_checkpoint_dir(spark)
    rows = batch.withColumn(BUCKET, bucket_of(keys, buckets)).checkpoint(eager=True)  # used three times
    touched = rows.groupBy(BUCKET).agg(F.count(F.lit(1)).alias("rows"), F.count_distinct(F.struct(*keys)).alias("keys")).collect()  # a row a bucket
    if any(t["rows"] != t["keys"] for t in touched):
        raise ValueError(f"a key occurs twice in a batch for {path}")
    if not touched:
        return
    if fs.exists(spark, path):
        held = spark.read.schema(rows.schema).parquet(path).filter(F.col(BUCKET).isin([t[BUCKET] for t in touched]))
        # Out of the files before their folders are replaced.
        rows = held.join(rows, same_keys(held, rows, keys), "left_anti").unionByName(rows).checkpoint(eager=True)
    (rows.hint("rebalance", BUCKET).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(BUCKET).parquet(path))


def bucket_sink(path: str, keys: Sequence[str], buckets: int) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function around :func:`upsert_buckets`; a replayed batch
    upserts the same rows again."""
    return lambda batch, batch_id: upsert_buckets(batch, path, keys, buckets)


def read_buckets(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a bucketed table."""
    return spark.read.parquet(path).drop(BUCKET)
