"""Keyed aggregations.

All are single ``groupBy().agg()`` calls: Spark plans a partial aggregate
before the shuffle and a final one after it, so a hot key costs one partial
row per input partition, never all of its rows in one task.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyfold.functions.text import ctl_trim, round2, split_words
from keyfold.operators.exact import exact_mean_by


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Round-robin an under-partitioned batch input before CPU-heavy row work.

    A scan yields one task per file split; a few large row groups can leave
    most cores idle while every row is tokenized in one task.  When the input
    has fewer partitions than the cluster has cores, spread it; a large input
    (many splits) is left untouched, so no shuffle is added at scale.
    """
    if df.isStreaming:
        return df
    target = int(min_partitions or df.sparkSession.sparkContext.defaultParallelism)
    if df.rdd.getNumPartitions() < target:
        return df.repartition(target)
    return df


def _keys(keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def count_by(df: DataFrame, keys, name: str = "count") -> DataFrame:
    """Rows per key (A1) or per key tuple (A2)."""
    return df.groupBy(*_keys(keys)).agg(F.count(F.lit(1)).alias(name))


def flag_count_by(df: DataFrame, keys, predicate: Column, name: str = "count") -> DataFrame:
    """Rows per key that satisfy ``predicate`` (A3).

    Keys whose rows all fail the predicate are kept with 0: the predicate is
    an indicator inside the sum, never a pre-filter.
    """
    ind = F.when(predicate, F.lit(1)).otherwise(F.lit(0))
    return df.groupBy(*_keys(keys)).agg(F.sum(ind).cast("bigint").alias(name))


def sums_by(df: DataFrame, keys, sums: Mapping[str, Column], count: str | None = None) -> DataFrame:
    """Several sums (and optionally the row count) per key in one pass (A4, A5)."""
    aggs = []
    if count:
        aggs.append(F.count(F.lit(1)).alias(count))
    aggs += [F.sum(c).alias(n) for n, c in sums.items()]
    return df.groupBy(*_keys(keys)).agg(*aggs)


def sum_count_by(df: DataFrame, keys, value: Column, total: str, count: str = "count",
                 total_type: str | None = "bigint") -> DataFrame:
    """Sum and count per key."""
    s = F.sum(value)
    if total_type:
        s = s.cast(total_type)
    return df.groupBy(*_keys(keys)).agg(s.alias(total), F.count(F.lit(1)).alias(count))


def mean_by(df: DataFrame, keys, value: Column, name: str, count: str | None = None,
            rounded: bool = True, exact: bool = False) -> DataFrame:
    """Mean per key, rounded to two decimals (A6, A7), and the row count.

    Exact-decimal inputs are summed exactly and converted to double once,
    before the division.  Every row that has a value is in the divisor,
    whatever the value; a null (a field that ``on_bad="null"`` could not
    parse) is not, and a key with nulls alone has a null mean.  ``exact`` is
    for doubles of a batch: their exact mean, whatever the order of rows.
    """
    if exact:
        return exact_mean_by(df, keys, value, name, count, rounded)
    mean = F.try_divide(F.sum(value).cast("double"), F.count(value))
    aggs = [(round2(mean) if rounded else mean).alias(name)]
    if count:
        aggs.append(F.count(F.lit(1)).alias(count))
    return df.groupBy(*_keys(keys)).agg(*aggs)


def word_count(df: DataFrame, text: str | Column, word: str = "word", count: str = "count",
               separators: str | None = None, spread_input: bool = False) -> DataFrame:
    """Word frequency (A11): split, explode, drop blank words, count per word.

    The explode runs inside the map stage and the partial aggregate folds
    repeated words per partition before the shuffle, so the shuffle carries at
    most one row per distinct word per partition.  ``spread_input`` spreads an
    input with fewer partitions than cores first (see :func:`spread`).
    """
    t = F.col(text) if isinstance(text, str) else text
    src = df.select(t.alias("_text"))
    if spread_input:
        src = spread(src)
    arr = split_words(F.col("_text")) if separators is None else F.split(F.col("_text"), separators)
    words = src.select(F.explode(arr).alias(word))
    words = words.filter(ctl_trim(F.col(word)) != "")
    return words.groupBy(word).agg(F.count(F.lit(1)).alias(count))

