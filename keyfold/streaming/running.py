"""T1/T2 with A9: a running value for every row of a stream.

A streaming aggregate gives one update per key and micro-batch; the reference
gives one per row.  Here every micro-batch's rows get their key's running sums
within the batch (:func:`running_by`, so a hot key is spread over tasks), and
the key's totals of all batches before are added.  The totals after a batch are
stored beside its rows; a batch that is replayed after a stop starts from the
same totals and writes the same rows again.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from keyfold.operators.partials import ROWS, merged, partials
from keyfold.operators.running import running_by
from keyfold.session import ensure_checkpoint_dir
from keyfold.sinks.batches import batch_path, batches, before, drop_below, same_keys
from keyfold.sources.text import BLOCK, FILE, number_lines

LINE = "_line"


def in_arrival_order(batch: DataFrame) -> DataFrame:
    """A batch of placed lines with their number in their file, ``_line``:
    ``_file`` and ``_line`` order the batch as its lines arrived."""
    return number_lines(batch, LINE).drop(BLOCK)


def running_sink(path: str, keys: str | Sequence[str], order: str, sums: Mapping[str, Column], count: str = "running_count",
                 tiebreak: Sequence[str] = (), prepare: Callable[[DataFrame], DataFrame] | None = None) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function: rows with running sums over all batches so far.

    ``prepare`` turns a micro-batch into the rows (numbers lines, parses them);
    ``order`` and ``tiebreak`` order the rows of a batch, and a batch comes
    after the ones before it.  Rows go to ``<path>/rows/batch=<n>``, the totals
    per key to ``<path>/totals/batch=<n>``; the latter completes the batch.
    The sums' types must add up exactly (integers, decimals) for equal results
    whatever the batches.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    sums = dict(sums)

    def sink(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        ensure_checkpoint_dir(spark)
        rows = prepare(batch) if prepare else batch
        rows = rows.select("*", *[v.alias(f"_in_{n}") for n, v in sums.items()]).checkpoint(eager=True)
        run = running_by(rows, keys, order, sums={n: F.col(f"_in_{n}") for n in sums}, count=count, tiebreak=tiebreak)
        run = run.drop(*[f"_in_{n}" for n in sums])
        held = partials(rows, keys, {f"_sum_{n}": F.col(f"_in_{n}") for n in sums})
        earlier = before(spark, f"{path}/totals", batch_id)
        if earlier is not None:
            totals = merged(earlier.unionByName(held), keys, keep_empty=True)
            run = run.join(earlier, same_keys(run, earlier, keys), "left").select(
                *[run[c] for c in run.columns if c not in sums and c != count],
                *[F.coalesce(run[n] + earlier[f"_sum_{n}"], run[n], earlier[f"_sum_{n}"]).cast(run.schema[n].dataType).alias(n) for n in sums],
                (run[count] + F.coalesce(earlier[ROWS], F.lit(0))).alias(count))
        else:
            totals = held
        run.write.mode("overwrite").parquet(batch_path(f"{path}/rows", batch_id))
        totals.write.mode("overwrite").parquet(batch_path(f"{path}/totals", batch_id))
        drop_below(spark, f"{path}/totals", batch_id)
    return sink


def read_running(spark: SparkSession, path: str) -> DataFrame:
    """The rows of all complete batches, with the batch's number in ``batch``."""
    done = batches(spark, f"{path}/totals")
    if not done:
        raise FileNotFoundError(f"no complete batch under {path}")
    last = done[-1]
    numbers = [n for n in batches(spark, f"{path}/rows") if n <= last]
    return spark.read.option("basePath", f"{path}/rows").parquet(*[batch_path(f"{path}/rows", n) for n in numbers])


def start_running_stream(rows: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, available_now: bool = True,
                         processing_time: str | None = None) -> StreamingQuery:
    """Start the stream of rows into :func:`running_sink`'s function."""
    writer = rows.writeStream.option("checkpointLocation", checkpoint).foreachBatch(sink)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()
