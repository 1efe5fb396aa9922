"""Small Spark helpers shared by the operators of this subpackage."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keyfold.session import ensure_checkpoint_dir, fresh_path

#: Lower-casing of exactly A-Z (``lower`` would change other letters too).
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str, rows_a_file: int = 0, compression: str | None = None) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read back.

    Cuts the lineage with files that every executor sees, so a lost executor
    costs only its running tasks.  Large rows are better in files of
    ``rows_a_file``: a reader holds some thousand rows of a file at once.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = fresh_path(spark, "llm", name)
    writer = df.write.option("maxRecordsPerFile", rows_a_file) if rows_a_file else df.write
    writer.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def crc_mod(col: Column | str, m: int) -> Column:
    """crc32 of the value's text, mod ``m``; a null value counts as remainder -1."""
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(F.crc32(c.cast("string")) % m, F.lit(-1)).cast("int")


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only.  Most words have no capital: only those that any
    lower-casing changes take the slower character map."""
    return F.when(F.lower(c) == c, c).otherwise(F.translate(c, UPPER, LOWER))


def bounded_sample(rows: DataFrame, hashed: list[str], max_rows: int, max_bytes: int, by: str | None = None) -> DataFrame:
    """About ``max_rows`` rows, whole, whose ``text`` is about ``max_bytes``
    together, chosen by a hash of the columns ``hashed``.

    With ``by``, its values share both bounds equally, so a value with few rows
    keeps all of them.  A text larger than its share can't be in the sample.
    """
    value = F.col(by).cast("string") if by else F.lit("")
    sized = rows.select(value.alias("value"), F.octet_length("text").alias("size"))
    values = sized.select("value").distinct().count() if by else 1
    share = max_bytes / max(values, 1)
    per = sized.filter(F.col("size") <= share).groupBy("value").agg(F.count("*").alias("n"), F.sum("size").alias("size")).collect()  # a row a value
    most = {x["value"]: math.ceil(min(1.0, max_rows / values / x["n"], share / max(x["size"], 1)) * (1 << 30)) for x in per}
    # As a literal, not a join: the texts stay where they are.
    known = F.create_map(*[F.lit(x) for v, n in most.items() if v is not None for x in (v, n)]) if set(most) - {None} else F.create_map().cast("map<string,int>")
    rate = F.when(value.isNull(), F.lit(most.get(None, 0))).otherwise(F.coalesce(F.try_element_at(known, value), F.lit(0)))
    return rows.filter((F.octet_length("text") <= share) & (F.pmod(F.xxhash64(*hashed), F.lit(1 << 30)) < rate))
