"""T4: the totals of a stopped stream, taken on by a new one.

A checkpoint keeps its number of state partitions for life.  To go on with
more (or fewer), the state is read with Spark's ``statestore`` source, stored
as a table of totals, and a new query with a checkpoint of its own adds them to
what it counts.  The new query's input starts where the old one stopped: a new
folder of files, or the old query's end offsets of a topic.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keyfold.sinks.batches import same_keys


def state_totals(spark: SparkSession, checkpoint: str, keys: Sequence[str], values: Mapping[str, int], operator: int = 0) -> DataFrame:
    """The state of a stopped streaming aggregate: ``keys`` and, for each entry
    of ``values``, the aggregate buffer at that place (0 is the first)."""
    state = spark.read.format("statestore").option("operatorId", operator).load(checkpoint)
    names = state.schema["value"].dataType.names
    kept = state.schema["key"].dataType.names
    if len(kept) != len(keys) or max(values.values()) >= len(names):
        raise ValueError(f"the state has keys {kept} and values {names}")
    return state.select(*[F.col("key")[k].alias(n) for k, n in zip(kept, keys, strict=True)], *[F.col("value")[names[i]].alias(n) for n, i in values.items()])


def state_partitions(spark: SparkSession, checkpoint: str, operator: int = 0) -> int:
    """How many partitions of the state hold any key."""
    return spark.read.format("statestore").option("operatorId", operator).load(checkpoint).select("partition_id").distinct().count()


def carrying(sink: Callable[[DataFrame, int], None], totals: str, keys: Sequence[str], sums: Sequence[str]) -> Callable[[DataFrame, int], None]:
    """``sink`` with the stored ``totals`` (a Parquet folder) added to the sums
    of every key that a batch brings; a key that no batch brings keeps the row
    that the old stream left in the target.  Replays add the same totals again."""
    def run(batch: DataFrame, batch_id: int) -> None:
        earlier = batch.sparkSession.read.parquet(totals)
        joined = batch.join(earlier, same_keys(batch, earlier, keys), "left")
        added = {n: F.coalesce(batch[n] + earlier[n], batch[n], earlier[n]).cast(batch.schema[n].dataType).alias(n) for n in sums}
        sink(joined.select(*[added.get(c, batch[c]) for c in batch.columns]), batch_id)
    return run
