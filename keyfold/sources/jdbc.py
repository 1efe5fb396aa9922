"""JDBC query / table -> typed rows.

``dbtable`` with a numeric ``partition_column`` reads in ``num_partitions``
parallel range queries; a plain ``query`` reads in one task (the reference's
single split).  Spark prunes the selected columns into the generated SQL, so
a report that needs two columns fetches two.  Credentials come from the
caller (options or environment), never from source code.

Equal ranges of a numeric column read badly when its values are skewed, and
can't be cut where it is text or null: :func:`split_predicates` plans the parts
from the values themselves, and :func:`read_jdbc_split` reads them side by side.
"""

from __future__ import annotations

import datetime
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def jdbc_options(url: str, table: str | None = None, query: str | None = None,
                 user: str | None = None, password: str | None = None,
                 driver: str | None = None, partition_column: str | None = None,
                 lower_bound: int | None = None, upper_bound: int | None = None,
                 num_partitions: int | None = None, fetch_size: int = 10_000,
                 extra: dict | None = None) -> dict:
    if (table is None) == (query is None):
        raise ValueError("give exactly one of table / query")
    opts = {"url": url, "fetchsize": str(fetch_size)}
    if table is not None:
        opts["dbtable"] = table
    else:
        opts["query"] = query
    if partition_column:
        if table is None:
            raise ValueError("partitioned reads need table=, not query=")
        if None in (lower_bound, upper_bound, num_partitions):
            raise ValueError("partition_column needs lower_bound, upper_bound, num_partitions")
        opts.update(partitionColumn=partition_column, lowerBound=str(lower_bound),
                    upperBound=str(upper_bound), numPartitions=str(num_partitions))
    for k, v in (("user", user), ("password", password), ("driver", driver)):
        if v is not None:
            opts[k] = v
    opts.update({k: str(v) for k, v in (extra or {}).items()})
    return opts


def read_jdbc(spark: SparkSession, url: str, **kw) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(url, **kw)).load()


# -- split plans ---------------------------------------------------------------
def _literal(value) -> str:
    """A value in SQL: numbers as they are, text, dates and timestamps quoted."""
    if isinstance(value, bool):
        return "TRUE" if value else "FALSE"
    if isinstance(value, datetime.datetime):
        return f"TIMESTAMP '{value.isoformat(sep=' ')}'"
    if isinstance(value, datetime.date):
        return f"DATE '{value.isoformat()}'"
    if isinstance(value, (int, float, Decimal)):
        return str(value)
    return "'" + str(value).replace("'", "''") + "'"


def _ranges(rows: DataFrame, column: str, parts: int) -> list:
    """Up to ``parts`` - 1 bounds that cut the rows into ranges of about equal size.

    Spark samples the rows of every input partition for the cuts of a range
    partitioning; a range's bound is its least value.
    """
    if parts < 2:
        return []
    ranged = rows.select(column).repartitionByRange(parts, column).groupBy(F.spark_partition_id().alias("p")).agg(F.min(column).alias("least"))
    return [x["least"] for x in ranged.filter("least is not null").orderBy("p").collect()][1:]  # a row a part


def _between(column: str, bounds: list) -> list[str]:
    """Disjoint predicates that hold every value of ``column`` but null."""
    if not bounds:
        return [f"{column} IS NOT NULL"]
    cuts = [_literal(b) for b in bounds]
    inner = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(cuts, cuts[1:], strict=False)]
    return [f"{column} < {cuts[0]}", *inner, f"{column} >= {cuts[-1]}"]


def split_predicates(rows: DataFrame, column: str, parts: int, then: str | None = None) -> list[str]:
    """About ``parts`` SQL predicates on ``column``: every row fulfils exactly one,
    and no part is much larger than the mean.

    ``rows`` are the table's values of ``column`` (and ``then``), or a sample of
    them: the predicates are complete for any rows.  The column may be numbers,
    text or dates, skewed, and null.  A value (or null) with more rows than a
    part should have is taken out of the ranges and cut by ``then``; without
    ``then`` it is one part.  At most ``parts`` values have that many rows, so
    that is what the driver sees.  Text is compared by its bytes: the database
    must do the same in these predicates (a binary collation).  No rows: one
    predicate that is always true.
    """
    if parts < 1:
        raise ValueError("parts must be at least 1")
    total = rows.count()
    if not total:
        return ["1 = 1"]
    size = total / parts
    often = rows.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    hot = often.filter((F.col("n") > size) | F.col(column).isNull()).collect()
    out, left, values = [], total, []
    for value, n in hot:
        is_value = f"{column} IS NULL" if value is None else f"{column} = {_literal(value)}"
        left -= n
        if value is not None:
            values.append(value)
        share = round(n / size)
        if then is None or share < 2:
            out.append(is_value)
            continue
        own = rows.filter(F.col(column).eqNullSafe(F.lit(value)))
        spans = _between(then, _ranges(own, then, share))
        out += [f"{is_value} AND {s}" for s in spans] + [f"{is_value} AND {then} IS NULL"]
    rest = rows.filter(F.col(column).isNotNull() & ~F.col(column).isin(values)) if values else rows.filter(F.col(column).isNotNull())
    but = f" AND {column} NOT IN ({', '.join(map(_literal, values))})" if values else ""
    out += [s + but for s in _between(column, _ranges(rest, column, max(1, round(left / size))) if left else [])]
    if not any(value is None for value, _ in hot):
        out.append(f"{column} IS NULL")  # complete for rows that come later
    return out


def read_jdbc_split(spark: SparkSession, url: str, table: str, predicates: list[str], properties: dict | None = None) -> DataFrame:
    """The table by one query per predicate of :func:`split_predicates`, side by side."""
    return spark.read.jdbc(url, table, predicates=predicates, properties={k: str(v) for k, v in (properties or {}).items()})
