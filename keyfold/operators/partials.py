"""Partial results (A1-A8) that are stored, merged and taken back.

A partial is a row of sums and a row count per key over some of the input.
Partials of disjoint inputs add up to the partials of all of it, so a report
is kept up to date from its deltas alone; a row that turns out wrong (a booking
that was cancelled later) is taken back by a delta with its values negated.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROWS = "rows"


def partials(df: DataFrame, keys: str | Sequence[str], sums: Mapping[str, Column] | None = None, sign: Column | None = None) -> DataFrame:
    """``keys``, one column per entry of ``sums`` and ``rows``, a row per key.

    ``sign`` is 1 for rows that come in and -1 for rows that are taken back
    (null: neither).  Null values add nothing, and a sum without values is
    null; null keys are a key.  Integer and decimal sums are exact; give
    decimals where doubles would not be.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    def signed(v: Column) -> Column:
        return v if sign is None else F.when(sign == 1, v).when(sign == -1, -v)

    aggs = [F.sum(signed(v)).alias(n) for n, v in (sums or {}).items()]
    return df.groupBy(*keys).agg(*aggs, F.coalesce(F.sum(signed(F.lit(1).cast("bigint"))), F.lit(0)).alias(ROWS))


def merged(parts: DataFrame, keys: str | Sequence[str], keep_empty: bool = False) -> DataFrame:
    """Partials of one key added up; a key whose rows were all taken back is
    left out unless ``keep_empty`` (a store of totals needs no such keys)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    sums = [c for c in parts.columns if c not in keys]
    found = parts.groupBy(*keys).agg(*[F.sum(c).cast(parts.schema[c].dataType).alias(c) for c in sums])
    return found if keep_empty else found.filter(F.col(ROWS) != 0)
