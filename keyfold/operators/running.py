"""Running (per-row) aggregates and last-value-per-key.

The reference emits, for every input row, its key's total so far; a table that
keeps the last emitted row per key ends with the plain aggregate.

``running_by`` computes the same thing as
``sum(v) OVER (PARTITION BY keys ORDER BY order ROWS UNBOUNDED PRECEDING)``
without ever putting a whole hot key into one task, and in one way for all
sizes:

1. rows are range-partitioned by (keys, order, tiebreak, row hash), so ranges
   hold about equal numbers of rows however keys and orders are spread, and
   the range's number is written with the rows into a checkpoint;
2. the window runs per (range, key);
3. only the first key of a range can have rows in earlier ranges, so at most
   one offset per range (the key's totals in earlier ranges) is added back,
   through a broadcast of at most as many rows as there are ranges.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyfold.session import ensure_checkpoint_dir


def _keys(keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def _row_hash(df: DataFrame) -> Column:
    """A hash of the row's plain columns: orders and splits tied rows."""
    nested = (T.MapType, T.ArrayType, T.StructType, T.VariantType)
    return F.xxhash64(*[F.col(f.name) for f in df.schema if not isinstance(f.dataType, nested)])


def in_ranges(df: DataFrame, by: Sequence[str], partitions: int | None = None) -> DataFrame:
    """``df`` cut into ranges of about equal size by ``by``, numbered in that
    order in ``_range`` and written to the checkpoint folder."""
    ranged = df.repartitionByRange(partitions, *by) if partitions else df.repartitionByRange(*by)
    return ranged.withColumn("_range", F.spark_partition_id()).checkpoint(eager=True)


def _plus(local: Column, earlier: Column, typ: T.DataType) -> Column:
    """A null-skipping sum of two partial sums, in their own type."""
    earlier = earlier.cast(typ)
    if isinstance(typ, T.DecimalType):
        # At full precision Spark's decimal addition gives up a decimal place.
        exact = T.DecimalType(min(typ.precision, 37), typ.scale)
        both = local.cast(exact) + earlier.cast(exact)
    else:
        both = local + earlier
    return F.coalesce(both.cast(typ), local, earlier)


def running_by(df: DataFrame, keys, order: str, sums: Mapping[str, Column] | None = None,
               count: str | None = "running_count", tiebreak: Sequence[str] = (),
               partitions: int | None = None, checkpoint_input: bool = False) -> DataFrame:
    """Append running sums (and a running row count) per key, in ``order``.

    ``order`` may have any sortable type; nulls come first.  It (plus
    ``tiebreak``) should be unique within a key: tied rows are taken in the
    order of a hash of the row.  Integer and decimal sums are exact; the last
    bits of a double sum depend on where the ranges are cut; where they matter
    give decimals, or see :func:`keyfold.operators.exact.exact_running_by`.  Returns ``df``'s columns plus one column per entry of
    ``sums`` and ``count``.

    ``partitions`` is the number of ranges; left out, it is the session's
    shuffle partitions, merged by adaptive execution when they are small.
    Ranges are cut after a sampling pass over ``df``; ``checkpoint_input``
    first writes the (narrow) input to the checkpoint folder, so an expensive
    input (parsed text) is computed once, not once per pass.
    """
    keys = _keys(keys)
    sums = dict(sums or {})
    if not sums and not count:
        raise ValueError("nothing to compute: give sums and/or count")
    ensure_checkpoint_dir(df.sparkSession)
    if checkpoint_input:
        df = df.checkpoint(eager=True)
    cols = df.columns
    value = {n: f"_v_{n}" for n in sums}
    ranged = in_ranges(df.select(*cols, *[v.alias(value[n]) for n, v in sums.items()], _row_hash(df).alias("_tie")),
                       [*keys, order, *tiebreak, "_tie"], partitions)

    upto = (Window.partitionBy("_range", *keys).orderBy(order, *tiebreak, "_tie")
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = ranged.select(*cols, "_range", *[F.sum(value[n]).over(upto).alias(f"_s_{n}") for n in sums],
                          F.count(F.lit(1)).over(upto).alias("_n"))

    # A key's totals in earlier ranges: one row for each range that goes on
    # with the key of the range before.
    earlier = (Window.partitionBy(*keys).orderBy("_range")
               .rowsBetween(Window.unboundedPreceding, -1))
    okey = {k: f"_k_{k}" for k in keys}
    offsets = (ranged.groupBy("_range", *keys)
               .agg(*[F.sum(value[n]).alias(value[n]) for n in sums], F.count(F.lit(1)).alias("_rows"))
               .select(F.col("_range").alias("_orange"), *[F.col(k).alias(okey[k]) for k in keys],
                       *[F.sum(value[n]).over(earlier).alias(f"_o_{n}") for n in sums],
                       F.sum("_rows").over(earlier).alias("_before"))
               .filter(F.col("_before").isNotNull()))
    same = F.col("_range") == F.col("_orange")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(okey[k]))
    joined = local.join(F.broadcast(offsets), same, "left")  # at most one row per range

    out = [_plus(F.col(f"_s_{n}"), F.col(f"_o_{n}"), local.schema[f"_s_{n}"].dataType).alias(n) for n in sums]
    if count:
        out.append((F.col("_n") + F.coalesce(F.col("_before"), F.lit(0))).alias(count))
    return joined.select(*cols, *out)


def latest_by(df: DataFrame, keys, order: str | Sequence[str], values: Sequence[str]) -> DataFrame:
    """Last row per key by ``order``, a column or several (A10): what repeated
    upserts leave behind.

    ``max_by`` is partially aggregated, so a hot key costs one struct per
    input partition before the shuffle.
    """
    keys = _keys(keys)
    last = F.col(order) if isinstance(order, str) else F.struct(*order)
    packed = F.max_by(F.struct(*[F.col(v) for v in values]), last).alias("_last")
    return df.groupBy(*keys).agg(packed).select(*keys, *[F.col(f"_last.{v}").alias(v) for v in values])
