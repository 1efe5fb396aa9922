"""Sums of doubles that don't depend on the order of rows.

A double is a whole number of 53 bits times a power of two.  Here it is taken
apart, without error, into pieces of 32 bits that each lie in a fixed bin: the
piece of bin k counts units of 2**(32 k).  Whole numbers add up exactly in any
order, so Spark sums each bin as a decimal, before and after the shuffle, and
the bins are put together and rounded once.  Equal rows give equal bits for any
number of partitions, tasks or ranges.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from fractions import Fraction

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyfold.functions.text import round2
from keyfold.operators.running import running_by
from keyfold.session import ensure_checkpoint_dir

BITS = 32
#: Bins of all finite doubles: 2**-1074 up to 2**1024.
LOWEST, HIGHEST = -34, 31
#: Bins of values that are no number: how many there are of each.
NAN, PLUS, MINUS = 100, 101, 102
_PIECES = "array<struct<bin:int,units:decimal(11,0)>>"


def pieces(value: Column) -> Column:
    """The non-zero pieces of a double as ``array<struct<bin, units>>`` (null for null)."""
    value = value.cast("double")
    size = F.abs(value)
    # Small values are scaled up first (exactly), so that no power below is too small for a double.
    low = size < 2.0 ** -400
    scaled = F.when(low, value * F.lit(2.0 ** 640)).otherwise(value)
    shift = F.when(low, F.lit(640 // BITS)).otherwise(F.lit(0))
    # The highest bin: log2 may be off by a little, so it is taken a little higher, and four pieces reach below the last bit.
    top = F.least(F.floor((F.log2(F.abs(scaled)) + 0.5) / BITS), F.lit(HIGHEST)).cast("int")

    def units(j: int) -> Column:
        """Whole units of the j-th bin from the top (exact: a power of two parts them, and a double's fraction is one)."""
        count = scaled / F.pow(F.lit(2.0), (top - j) * BITS)
        return count - count % F.lit(1.0)

    # A piece is what the bin above leaves out; each is taken from the value itself, so the expression stays flat.
    whole = [units(0), *[units(j) - units(j - 1) * F.lit(2.0 ** BITS) for j in (1, 2, 3)]]
    found = [F.struct((top - j - shift).alias("bin"), w.cast("decimal(11,0)").alias("units")) for j, w in enumerate(whole)]
    one = F.lit(1).cast("decimal(11,0)")
    odd = lambda b: F.array(F.struct(F.lit(b).alias("bin"), one.alias("units"))).cast(_PIECES)
    numbers = F.filter(F.array(*found).cast(_PIECES), lambda x: x["units"] != 0)
    return (F.when(value.isNull(), F.lit(None).cast(_PIECES)).when(F.isnan(value), odd(NAN)).when(value == float("inf"), odd(PLUS))
            .when(value == float("-inf"), odd(MINUS)).when(value == 0, F.array().cast(_PIECES)).otherwise(numbers))


def rounded(bins: Mapping[int, int], by: int = 1) -> float:
    """The sum of ``units * 2**(32 bin)`` over ``by``, rounded once (half to even)."""
    if bins.get(NAN) or (bins.get(PLUS) and bins.get(MINUS)):
        return float("nan")
    if bins.get(PLUS) or bins.get(MINUS):
        return float("inf") if bins.get(PLUS) else float("-inf")
    if not bins:
        return 0.0
    lowest = min(bins)
    total = Fraction(sum(n << (BITS * (k - lowest)) for k, n in bins.items()))
    total = total * Fraction(2) ** (BITS * lowest) / by
    try:
        return float(total)
    except OverflowError:
        return float("inf") if total > 0 else float("-inf")


@F.pandas_udf(T.DoubleType())
def _rounded(bins: pd.Series, by: pd.Series) -> pd.Series:
    """Sums of ``array<struct<bin, units>>``; null where there is no value."""
    def one(found, n):
        if found is None or pd.isna(n) or not n:
            return None
        return rounded({x["bin"]: int(x["units"]) for x in found}, int(n))
    return pd.Series([one(b, n) for b, n in zip(bins, by, strict=True)], dtype="float64")


def _together(bins: Column, by: Column) -> Column:
    """The rounded sum; NaN here, as it is the null of a pandas column."""
    has = lambda b: F.exists(bins, lambda x: (x["bin"] == b) & (x["units"] != 0))
    no_number = has(NAN) | (has(PLUS) & has(MINUS))
    return F.when(by.isNotNull() & (by > 0) & no_number, F.lit(float("nan"))).otherwise(_rounded(bins, by))


def exact_sums(df: DataFrame, keys: str | Sequence[str], value: Column, total: str | None = "total", mean: str | None = None, count: str = "count") -> DataFrame:
    """Sum and mean of ``value`` per key, each the exact result rounded once.

    ``count`` counts the rows with a value (nulls are left out, as in SQL); a
    key without any has null results.  NaN and infinities give what IEEE sums
    of them give.  Null keys are a key; no rows give no rows.  A row becomes at
    most three (key, bin) rows before the map-side sums, and a key has at most
    69 bins, whatever the data.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    parts = df.select(*keys, value.cast("double").alias("_v")).select(*keys, F.col("_v").isNotNull().cast("int").alias("_n"), pieces(F.col("_v")).alias("_p"))
    # The count travels as a bin of its own, so that one aggregate does both.
    tally = F.array(F.struct(F.lit(None).cast("int").alias("bin"), F.col("_n").cast("decimal(11,0)").alias("units"))).cast(_PIECES)
    each = parts.select(*keys, F.explode(F.concat(tally, F.coalesce("_p", F.array().cast(_PIECES)))).alias("_x"))
    sums = each.groupBy(*keys, F.col("_x.bin").alias("_bin")).agg(F.sum("_x.units").alias("_units"))
    whole = sums.groupBy(*keys).agg(F.collect_list(F.when(F.col("_bin").isNotNull(), F.struct(F.col("_bin").alias("bin"), F.col("_units").alias("units")))).alias("_bins"),
                                    F.sum(F.when(F.col("_bin").isNull(), F.col("_units"))).cast("bigint").alias(count))
    one = F.when(F.col(count) > 0, 1)
    out = ([_together(F.col("_bins"), one).alias(total)] if total else []) + ([_together(F.col("_bins"), F.col(count)).alias(mean)] if mean else [])
    return whole.select(*keys, *out, count)


def exact_mean_by(df: DataFrame, keys: str | Sequence[str], value: Column, name: str, count: str | None = None, rounded_to_cents: bool = True) -> DataFrame:
    """:func:`keyfold.operators.agg.mean_by` for doubles: the same columns, but the
    mean is the exact one, rounded once, then to two decimals."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    found = exact_sums(df, keys, value, total=None, mean="_mean", count="_valued")
    mean = round2(F.col("_mean")) if rounded_to_cents else F.col("_mean")
    if not count:
        return found.select(*keys, mean.alias(name))
    rows = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).withColumnsRenamed({k: f"_k_{k}" for k in keys})
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    return found.join(rows, same).select(*keys, mean.alias(name), F.col("_rows").alias(count))


def exact_running_by(df: DataFrame, keys: str | Sequence[str], order: str, value: Column, total: str = "running_sum", count: str = "running_count",
                     tiebreak: Sequence[str] = (), partitions: int | None = None) -> DataFrame:
    """:func:`running_by` for a double: the exact running sum, rounded once per row.

    Only the bins that the data has (five for 1e-12 to 1e15) are summed, each
    as a decimal column.  A row before any value of its key has a null sum;
    ``count`` counts the rows, valued or not.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    keys = [keys] if isinstance(keys, str) else list(keys)
    cols = df.columns
    rows = df.select(*cols, value.cast("double").alias("_v")).select(*cols, F.col("_v").isNotNull().cast("bigint").alias("_valued"), pieces(F.col("_v")).alias("_p"))
    rows = rows.checkpoint(eager=True)
    used = sorted(r[0] for r in rows.select(F.explode("_p.bin").alias("b")).distinct().collect())  # at most 69
    # A value has a bin once at most.
    unit = lambda b: F.coalesce(F.get(F.filter("_p", lambda x: x["bin"] == b)["units"], F.lit(0)), F.lit(0)).cast("decimal(11,0)")
    flat = rows.select(*cols, "_valued", *[unit(b).alias(f"_b{i}") for i, b in enumerate(used)])
    sums = {f"_s{i}": F.col(f"_b{i}") for i in range(len(used))}
    run = running_by(flat, keys, order, sums={**sums, "_some": F.col("_valued")}, count=count, tiebreak=tiebreak, partitions=partitions)
    kind = T.ArrayType(T.StructType([T.StructField("bin", T.IntegerType()), T.StructField("units", T.DecimalType(38, 0))]))
    bins = F.array(*[F.struct(F.lit(b).cast("int").alias("bin"), F.col(f"_s{i}").cast("decimal(38,0)").alias("units")) for i, b in enumerate(used)]).cast(kind)
    return run.select(*cols, _together(bins, F.when(F.col("_some") > 0, 1)).alias(total), count)
