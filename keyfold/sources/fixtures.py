"""Render the driver's ``orders`` table into listing / booking text lines.

The reports run over these lines exactly as over the reference's CSV inputs;
an independent SQL oracle computes the same results from ``orders`` directly.
Rendering is a Spark projection of ``orders`` (no driver-side data), and the
lines can be materialized once as text files under the shared folder, one
header line per file, and read back through the text source (S1).
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keyfold import fs
from keyfold.schema import BOOKING_COLUMNS, LISTING_COLUMNS
from keyfold.session import shared_path
from keyfold.sources.synth import ORIENTATIONS

RENDER_VERSION = "r4"

# Fixed values of the rendering rules.
NO_FOCUS = "暂无"
NO_RATIO = "暂无数据"
FOCUS_SUFFIX = "人关注"
YEAR_SUFFIX = "年建"
PRICE_SUFFIX = "元/平"
TITLE_MIDDLE = "，st,"
CITY_HOTEL, RESORT_HOTEL = "City Hotel", "Resort Hotel"


def _q(c: Column) -> Column:
    return F.concat(F.lit('"'), c.cast("string"), F.lit('"'))


def header_line(columns: list[str]) -> str:
    return ",".join(f'"{c}"' for c in columns)


def listing_values(thousands: bool = False) -> dict[str, Column]:
    """The rendered listing fields (unquoted) by column name, from ``orders``."""
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    money = F.col("o_totalprice").cast("decimal(18,2)")
    price_text = F.format_number(money, 2) if thousands else money.cast("string")
    values = {
        "id": key.cast("string"),
        "title": F.concat(F.col("o_orderpriority"), F.lit(TITLE_MIDDLE), F.col("o_orderstatus")),
        "unit_price": F.concat(price_text, F.lit(PRICE_SUFFIX)),
        "focus": F.when(key % 10 == 0, F.lit(NO_FOCUS))
                  .otherwise(F.concat((key % 1000).cast("string"), F.lit(FOCUS_SUFFIX))),
        "orientation": F.element_at(F.array(*[F.lit(x) for x in ORIENTATIONS]),
                                    (cust % 8 + 1).cast("int")),
        "year_built": F.concat(F.year("o_orderdate").cast("string"), F.lit(YEAR_SUFFIX)),
        "district": F.col("o_orderpriority"),
        "neighborhood": F.concat(F.lit("N"), (cust % 25).cast("string")),
        "elevator_ratio": F.when(key % 7 == 0, F.lit(NO_RATIO)).otherwise(
            F.concat((cust % 2 + 1).cast("string"), F.lit("梯"),
                     (key % 6 + 1).cast("string"), F.lit("户"))),
    }
    return {c: values.get(c, F.lit("x")) for c in LISTING_COLUMNS}


def listing_line(thousands: bool = False) -> Column:
    """One listing line per order; every field quoted, unnamed fields ``x``."""
    return F.concat_ws(",", *[_q(v) for v in listing_values(thousands).values()])


def listing_rows(orders: DataFrame, thousands: bool = True) -> DataFrame:
    """Orders as named listing columns without ``id``, as a database table
    of listings returns them (the JDBC report's input shape)."""
    vals = listing_values(thousands)
    return orders.select(*[vals[c].alias(c) for c in LISTING_COLUMNS if c != "id"])


def booking_line() -> Column:
    """One booking line per order; string fields quoted, fillers ``x``."""
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    values = {
        "hotel": _q(F.when(cust % 2 == 0, F.lit(CITY_HOTEL)).otherwise(F.lit(RESORT_HOTEL))),
        "is_canceled": F.when(F.col("o_orderstatus") == "F", F.lit("1")).otherwise(F.lit("0")),
        "arrival_date_month": F.month("o_orderdate").cast("string"),
        "nights": (key % 14).cast("string"),
        "country": _q(F.concat(F.lit("C"), (cust % 25).cast("string"))),
        "booking_method": _q(F.col("o_orderpriority")),
        "adr": F.col("o_totalprice").cast("decimal(18,2)").cast("string"),
    }
    return F.concat_ws(",", *[values.get(c, F.lit("x")) for c in BOOKING_COLUMNS])


ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                 "o_orderdate", "o_orderpriority"]


def line_for(kind: str) -> Column:
    if kind == "listing":
        return listing_line()
    if kind == "listing_thousands":
        return listing_line(thousands=True)
    if kind == "booking":
        return booking_line()
    raise ValueError(kind)


def render(orders: DataFrame, kind: str) -> DataFrame:
    """``value`` lines of the given kind (no header), one per order."""
    return orders.select(line_for(kind).alias("value"))


def header_for(kind: str) -> str:
    return header_line(BOOKING_COLUMNS if kind == "booking" else LISTING_COLUMNS)


def with_headers(lines: DataFrame, header: str) -> DataFrame:
    """``value`` lines with ``header`` before the first line of every task.

    Row numbers count from 0 within a task, so its first row is known
    without a shuffle or a sort; a task without lines has no header.
    """
    row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    first = F.array(F.lit(header), F.col("value"))
    return lines.select("value", row.alias("_row")).select(
        F.explode(F.when(F.col("_row") == 0, first).otherwise(F.array("value"))).alias("value"))


def write_with_headers(spark: SparkSession, lines: DataFrame, header: str, path: str,
                       n_files: int | None = None) -> str:
    """Write ``value`` lines as text files, each starting with ``header``: one
    per task, or ``n_files`` at the price of a shuffle."""
    lines = lines.select("value")
    if n_files:
        lines = lines.repartition(int(n_files))
    with_headers(lines, header).write.mode("overwrite").text(path)
    return path


def write_lines(spark: SparkSession, orders: DataFrame, kind: str, path: str,
                n_files: int | None = None, where: Column | None = None) -> str:
    """Write rendered lines (plus one header line per file) as text at ``path``,
    one file per task or ``n_files``."""
    src = orders if where is None else orders.filter(where)
    return write_with_headers(spark, src.select(line_for(kind).alias("value")), header_for(kind),
                              path, n_files)


def fixture_lines(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    """Rendered lines of ``sf_dir``'s orders, materialized once, read as text."""
    return spark.read.text(fixture_path(spark, sf_dir, kind))


def fixture_path(spark: SparkSession, sf_dir: str, kind: str) -> str:
    """Directory of rendered lines of ``sf_dir``'s orders (written once).

    The files live under the shared folder keyed by the input path, its
    files' names, sizes and times, and the render version; a half-written copy is never visible because each copy is
    written aside and renamed into place.
    """
    source = fs.fingerprint(spark, f"{sf_dir.rstrip('/')}/orders.parquet")
    tag = hashlib.sha1(f"{sf_dir.rstrip('/')}|{source}|{RENDER_VERSION}".encode()).hexdigest()[:16]
    final = shared_path(spark, "fixtures", tag, kind)
    if not fs.exists(spark, final + "/_SUCCESS"):
        aside = final + f".tmp-{uuid.uuid4().hex[:8]}"
        orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select(*ORDER_COLUMNS)
        # Several files of a small table, as a stream's input arrives.
        write_lines(spark, orders, kind, aside, spark.sparkContext.defaultParallelism)
        if not fs.exists(spark, final + "/_SUCCESS"):
            fs.delete(spark, final)
            jvm = spark._jvm
            src = jvm.org.apache.hadoop.fs.Path(aside)
            hfs = src.getFileSystem(spark._jsc.hadoopConfiguration())
            hfs.rename(src, jvm.org.apache.hadoop.fs.Path(final))
        fs.delete(spark, aside)
    return final
