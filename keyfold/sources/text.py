"""Text files -> a ``value`` column of lines (batch or stream).

``spark.read.text`` splits files across tasks (any Hadoop URI), so the lines
never pass through the driver.  The packaged-resource variant of the reference
(whole file read in the client) is folded into this: point it at the path.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from keyfold.session import ensure_checkpoint_dir


def read_lines(spark: SparkSession, paths: str | Sequence[str], line_sep: str | None = None) -> DataFrame:
    """Lines of one or more text files / directories / globs as ``value``."""
    reader = spark.read
    if line_sep:
        reader = reader.option("lineSep", line_sep)
    paths = [paths] if isinstance(paths, str) else list(paths)
    return reader.text(paths)


def stream_lines(spark: SparkSession, path: str, max_files_per_trigger: int | None = None,
                 latest_first: bool = False) -> DataFrame:
    """A streaming ``value`` column over new files appearing under ``path``.

    Files whose names start with ``_`` or ``.`` (commit markers) are ignored
    by the file source.  Progress is tracked in the query's checkpoint.
    """
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    if latest_first:
        reader = reader.option("latestFirst", "true")
    return reader.load(path)


def with_arrival_order(lines: DataFrame, col: str = "seq") -> DataFrame:
    """Number lines in scan order (split by split, line by line) as ``col``.

    A file read in parallel has no single arrival order; this one follows
    the scan: ids increase along each split and between the splits of one
    task.  The ids are not reproducible across different splittings, so the
    numbered lines are written to the checkpoint folder once, and every later
    pass (a running report makes two or three) reads the same numbers.
    """
    ensure_checkpoint_dir(lines.sparkSession)
    return lines.withColumn(col, F.monotonically_increasing_id()).checkpoint(eager=True)


#: Columns that say where a line was read: its file and the start of its split.
FILE, BLOCK = "_file", "_block"


def with_place(lines: DataFrame) -> DataFrame:
    """``lines`` (batch or stream, straight from a file source) with ``_file`` and ``_block``."""
    return lines.select("*", F.col("_metadata.file_path").alias(FILE), F.col("_metadata.file_block_start").alias(BLOCK))


def number_lines(placed: DataFrame, line: str = "line") -> DataFrame:
    """Number the lines of :func:`with_place` within their file, from 1, in ``line``.

    The numbers are the file's own, however it was split: lines are counted
    per split, a split starts after the lines of the splits before it, and a
    line's place within its split follows the scan.  Besides the rows there is
    a row per split: a count of each, and the sums of those before it.  A file
    that can't be split (compressed) is one split.
    """
    marked = placed.withColumn("_at", F.monotonically_increasing_id())
    splits = marked.groupBy(FILE, BLOCK).agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_lines"))
    earlier = Window.partitionBy(FILE).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    starts = splits.select(FILE, BLOCK, "_first", F.coalesce(F.sum("_lines").over(earlier), F.lit(0)).alias("_before"))
    numbered = marked.join(starts, [FILE, BLOCK])
    return numbered.withColumn(line, F.col("_before") + F.col("_at") - F.col("_first") + 1).drop("_at", "_first", "_before")


def read_numbered_lines(spark: SparkSession, paths: str | Sequence[str], line: str = "line") -> DataFrame:
    """``value``, ``_file``, ``_block`` and the line's number in its file."""
    return number_lines(with_place(read_lines(spark, paths)), line)
