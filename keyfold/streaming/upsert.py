"""A report over an unbounded line source, upserted continuously.

``lines -> parse -> groupBy().agg()`` is a streaming aggregation; in
``update`` mode every micro-batch emits the keys it changed with their full
totals (the reference emits one update per row; the last one per key is the
same).  ``foreachBatch`` hands each micro-batch to an idempotent key upsert
(file table or JDBC), so a restart that replays a batch changes nothing.
Source progress and aggregation state live in the checkpoint folder, which
replaces the reference's consumer group and its in-memory counters.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from keyfold.plans.reports import run_report

ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb_state(spark: SparkSession) -> None:
    """Keep aggregation state in RocksDB (off-heap) for large key sets.

    Must be set before a query's first start; a checkpoint keeps its provider.
    """
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)


def start_upsert_stream(result: DataFrame, sink: Callable[[DataFrame, int], None],
                        checkpoint: str, available_now: bool = False,
                        processing_time: str | None = None,
                        query_name: str | None = None,
                        state_partitions: int | None = None) -> StreamingQuery:
    """Start ``result`` (a streaming aggregate) in update mode into ``sink``.

    ``state_partitions`` sizes the aggregation state (one state store per
    partition, fixed for the life of the checkpoint); it applies to this
    query only, the session setting is restored once the query has started.
    A resumed query keeps the count recorded in its checkpoint.
    """
    spark = result.sparkSession
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key) if state_partitions else None
    if state_partitions:
        spark.conf.set(key, str(int(state_partitions)))
    try:
        return _start(result, sink, checkpoint, available_now, processing_time, query_name)
    finally:
        if state_partitions:
            spark.conf.set(key, before)


def _start(result, sink, checkpoint, available_now, processing_time, query_name) -> StreamingQuery:
    w = (result.writeStream.outputMode("update")
         .option("checkpointLocation", checkpoint)
         .foreachBatch(sink))
    if query_name:
        w = w.queryName(query_name)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()


def run_report_stream(table: str, lines: DataFrame, sink: Callable[[DataFrame, int], None],
                      checkpoint: str, available_now: bool = True, on_bad: str = "fail",
                      state_partitions: int | None = None, **parse_opts) -> StreamingQuery:
    """Report ``table`` over streaming ``lines``; bounded input with availableNow."""
    return start_upsert_stream(run_report(table, lines, on_bad, **parse_opts), sink, checkpoint,
                               available_now=available_now, state_partitions=state_partitions)
