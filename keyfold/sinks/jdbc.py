"""K1: JDBC upsert by key; K2: JDBC batched append.

Spark's JDBC writer only appends or overwrites, so an upsert is two steps:

1. executors write the rows in parallel into a staging table (truncated and
   refilled, batched inserts, one transaction per partition);
2. one set-based merge statement, sent through a single JDBC connection from
   the driver, moves the staging rows into the target by key.

No row passes through the driver.  Re-running the same batch leaves the same
table (idempotent), so the sink is safe under stream restarts.  The merge
statement depends on the database dialect.
"""

from __future__ import annotations

import uuid
import warnings
from collections.abc import Sequence

from pyspark.sql import DataFrame


def append_jdbc(df: DataFrame, url: str, table: str, batchsize: int = 1000,
                num_partitions: int | None = 32, column_types: str | None = None,
                properties: dict | None = None, mode: str = "append") -> None:
    """K2: batched append (``batchsize`` rows per batch, a commit per partition,
    at most ``num_partitions`` concurrent connections).

    The rows are shuffled into that many partitions: Spark's own way to keep
    to ``numPartitions`` is to coalesce, which would run all that computes the
    rows in so few tasks.
    """
    if num_partitions:
        df = df.repartition(int(num_partitions))
    w = (df.write.format("jdbc").mode(mode)
         .option("url", url).option("dbtable", table).option("batchsize", int(batchsize)))
    if num_partitions:
        w = w.option("numPartitions", int(num_partitions))
    if column_types:
        w = w.option("createTableColumnTypes", column_types)
    for k, v in (properties or {}).items():
        w = w.option(k, v)
    w.save()


def _q(name: str, quote: str) -> str:
    return f"{quote}{name}{quote}"


def merge_sql(dialect: str, target: str, staging: str, keys: Sequence[str],
              columns: Sequence[str]) -> str:
    """The key-merge statement from ``staging`` into ``target``."""
    keys, columns = list(keys), list(columns)
    vals = [c for c in columns if c not in keys]
    if dialect == "mysql":
        cols = ", ".join(_q(c, "`") for c in columns)
        # REPLACE deletes and re-inserts the row with the same key.
        return f"REPLACE INTO {target} ({cols}) SELECT {cols} FROM {staging}"
    if dialect in ("postgres", "sqlite"):
        cols = ", ".join(_q(c, '"') for c in columns)
        upd = ", ".join(f'{_q(c, chr(34))} = EXCLUDED.{_q(c, chr(34))}' for c in vals)
        conflict = ", ".join(_q(k, '"') for k in keys)
        action = f"DO UPDATE SET {upd}" if vals else "DO NOTHING"
        return (f"INSERT INTO {target} ({cols}) SELECT {cols} FROM {staging} "
                f"ON CONFLICT ({conflict}) {action}")
    if dialect in ("ansi", "derby", "h2", "oracle", "mssql", "db2"):
        on = " AND ".join(f"t.{_q(k, chr(34))} = s.{_q(k, chr(34))}" for k in keys)
        ins_cols = ", ".join(_q(c, '"') for c in columns)
        ins_vals = ", ".join(f"s.{_q(c, chr(34))}" for c in columns)
        sql = f"MERGE INTO {target} t USING {staging} s ON ({on}) "
        if vals:
            upd = ", ".join(f"{_q(c, chr(34))} = s.{_q(c, chr(34))}" for c in vals)
            sql += f"WHEN MATCHED THEN UPDATE SET {upd} "
        sql += f"WHEN NOT MATCHED THEN INSERT ({ins_cols}) VALUES ({ins_vals})"
        return sql + (";" if dialect == "mssql" else "")
    raise ValueError(f"unknown dialect {dialect!r}")


def execute_sql(spark, url: str, statements: Sequence[str], properties: dict | None = None) -> None:
    """Run statements over one JDBC connection from the driver's JVM."""
    jvm = spark._jvm
    props = jvm.java.util.Properties()
    for k, v in (properties or {}).items():
        props.setProperty(k, str(v))
    driver = (properties or {}).get("driver")
    if driver:
        jvm.java.lang.Class.forName(driver)
    conn = jvm.java.sql.DriverManager.getConnection(url, props)
    try:
        conn.setAutoCommit(False)
        stmt = conn.createStatement()
        try:
            for s in statements:
                stmt.execute(s)
        finally:
            stmt.close()
        conn.commit()
    except Exception:
        conn.rollback()
        raise
    finally:
        conn.close()


def upsert_jdbc(df: DataFrame, url: str, table: str, keys: Sequence[str], dialect: str = "mysql",
                staging: str | None = None, batchsize: int = 1000, column_types: str | None = None,
                properties: dict | None = None, max_connections: int = 32) -> None:
    """K1: insert-or-replace ``df``'s rows into ``table`` by ``keys``.

    ``max_connections`` caps how many tasks write the staging table at once,
    so a wide DataFrame does not open thousands of database connections.

    The staging table belongs to this call, so jobs on one target don't meet
    in it, and is dropped at the end.  A ``staging`` name of the caller's is
    truncated before and kept after.
    """
    own = staging is None
    staging = staging_name(table) if own else staging
    props = dict(properties or {})
    try:
        append_jdbc(df, url, staging, batchsize=batchsize, num_partitions=max_connections,
                    column_types=column_types, properties={**props, "truncate": "true"},
                    mode="overwrite")
        execute_sql(df.sparkSession, url, [merge_sql(dialect, table, staging, keys, df.columns)],
                    props)
    finally:
        if own:
            drop_table(df.sparkSession, url, staging, props)


def staging_name(table: str) -> str:
    """A staging table name of its own for every call."""
    return f"{table}_staging_{uuid.uuid4().hex[:12]}"


def drop_table(spark, url: str, table: str, properties: dict | None = None) -> None:
    """Drop a staging table; one that was never made, or that can't be dropped
    now, is left with a warning, so the error that led here stays the one seen."""
    try:
        execute_sql(spark, url, [f"DROP TABLE {table}"], properties)
    except Exception as error:
        warnings.warn(f"staging table {table} not dropped: {error}", stacklevel=2)


def jdbc_batch_sink(url: str, table: str, keys: Sequence[str], **kw):
    """``foreachBatch`` callback for a streaming upsert into a JDBC table."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        upsert_jdbc(batch, url, table, keys, **kw)
    return sink
