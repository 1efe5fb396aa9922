"""Running form of the reports (A9 over J1-J10): the reference's own output.

The reference emits, for every input row, the updated result of that row's
key; ``running_report`` returns exactly that stream as a table: one row per
input row (per word for the word count), in ``order``, carrying the key's
values so far.  Keeping the last row per key (``latest_report``) gives the
batch report, which is the D1 property the tests check.

All of it runs on :func:`keyfold.operators.running.running_by`, which spreads
a hot key (a district holding a third of all listings) over many tasks.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keyfold.functions.text import ctl_trim, round2, split_words
from keyfold.operators.parse import apply_on_bad, parse_bookings, parse_listings
from keyfold.operators.running import latest_by, running_by
from keyfold.plans.reports import REPORTS
from keyfold.sources.text import FILE
from keyfold.streaming.running import LINE, in_arrival_order, read_running, running_sink


def _ind(c: Column) -> Column:
    return F.when(c, F.lit(1)).otherwise(F.lit(0)).cast("bigint")


def _mean_of(value: str, name: str) -> tuple[dict, dict]:
    """The sums and the finishing column of a mean over the rows with a value."""
    sums = {"_s": F.col(value), "_m": F.col(value).isNotNull().cast("bigint")}
    return sums, {name: round2(F.try_divide(F.col("_s").cast("double"), F.col("_m")))}


# table -> (key columns after renaming, renames, sums, count name, finishing columns)
def _spec(table: str):
    if table == "district_stats":
        return ["district"], {}, {}, "house_count", {}
    if table == "neighborhood_avg_price":
        sums, finish = _mean_of("unit_price", "avg_price")
        return ["neighborhood"], {}, sums, "count", finish
    if table == "year_avg_elevator_ratio":
        sums, finish = _mean_of("elevator_ratio", "avg_elevator_ratio")
        return ["year_built"], {}, sums, "count", finish
    if table == "orientation_focus_count":
        return (["orientation"], {}, {"total_focus": F.col("focus").cast("bigint")}, "count", {})
    if table == "hotel_statistics":
        return (["hotel_type"], {"hotel": "hotel_type"},
                {"canceled_count": _ind(F.col("is_canceled") == 1),
                 "actual_stay_count": F.col("nights").cast("bigint")}, "booking_count", {})
    if table == "monthly_booking_counts":
        return (["month", "hotel_type"], {"arrival_date_month": "month", "hotel": "hotel_type"},
                {"booking_count": _ind(F.col("is_canceled") == 0)}, None, {})
    if table == "country_statistics":
        return ["country"], {}, {}, "visitor_count", {}
    if table == "booking_method_statistics":
        return ["hotel_type", "booking_method"], {"hotel": "hotel_type"}, {}, "booking_count", {}
    if table == "monthly_avg_adr":
        sums, finish = _mean_of("adr", "avg_adr")
        return ["month"], {"arrival_date_month": "month"}, sums, None, finish
    if table == "word_count":
        return ["word"], {}, {}, "count", {}
    raise KeyError(table)


def _value_columns(table: str) -> list[str]:
    from keyfold.schema import RESULT_TABLES
    return list(RESULT_TABLES[table][1])


def _keyed(table: str, rows: DataFrame, keep: list[str]) -> tuple[DataFrame, list[str]]:
    """Typed rows with the report's key columns (a row per word for the word
    count), and the columns that order rows of one line."""
    src = rows.withColumnsRenamed(_spec(table)[1])
    if table != "word_count":
        return src, []
    words = src.filter(F.col("title").isNotNull()).select(*keep, F.posexplode(split_words(F.col("title"))).alias("_pos", "word"))
    return words.filter(ctl_trim(F.col("word")) != ""), ["_pos"]


def running_report(table: str, rows: DataFrame, order: str, **running_opts) -> DataFrame:
    """Per-row running values of report ``table`` over typed rows, in ``order``.

    ``order`` must be a column of ``rows`` (e.g. the listing id, an event id
    or a line sequence number) and unique per row.  Columns: ``order``, the
    report's key columns, then its value columns.
    """
    keys, _, sums, count, finish = _spec(table)
    src, tiebreak = _keyed(table, rows, [order])
    # Narrow the rows to what the running values need, then let running_by
    # compute them once (checkpointed): sampling and cutting are two passes.
    src = src.select(*dict.fromkeys([order, *keys, *tiebreak]),
                     *[v.alias(f"_v{i}") for i, v in enumerate(sums.values())])
    sums = {n: F.col(f"_v{i}") for i, n in enumerate(sums)}
    running_opts.setdefault("checkpoint_input", True)
    run = running_by(src, keys, order, sums=sums, count=count, tiebreak=tiebreak, **running_opts)
    for name, c in finish.items():
        run = run.withColumn(name, c)
    return run.select(order, *keys, *_value_columns(table))


def latest_report(running: DataFrame, table: str, order: str) -> DataFrame:
    """Last running row per key: what a key-upserted sink holds at the end.

    A title may hold a word twice, so the running word count has rows of one
    word and order; its count grows by row and tells them apart.
    """
    keys = _spec(table)[0]
    by = [order, "count"] if table == "word_count" else order
    return latest_by(running, keys, by, _value_columns(table))



# -- on a stream ------------------------------------------------------------------
def running_report_sink(table: str, path: str, on_bad: str = "fail", **parse_opts) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function for placed lines (:func:`keyfold.sources.text.with_place`):
    every line's running values of report ``table`` over all batches so far.

    A batch's lines count in the order of their files and line numbers.  The
    rows keep a listing's ``id``; :func:`read_running_report` reads them.
    """
    report = REPORTS[table]
    keys, _, sums, count, _ = _spec(table)
    own = ["id"] if report.kind == "listing" else []
    place = [*own, FILE, LINE]

    def prepare(batch: DataFrame) -> DataFrame:
        parse = parse_listings if report.kind == "listing" else parse_bookings
        needed = list(report.needed) or ["title"]
        rows = parse(in_arrival_order(batch), on_bad=on_bad, keep=[FILE, LINE], **parse_opts)
        rows = apply_on_bad(rows.select(*dict.fromkeys([*needed, *place])), report.needed, on_bad)
        return _keyed(table, rows, place)[0]

    return running_sink(path, keys, FILE, sums, count=count or "_rows", tiebreak=[LINE, *(["_pos"] if table == "word_count" else [])], prepare=prepare)


def read_running_report(spark: SparkSession, table: str, path: str) -> DataFrame:
    """The rows that :func:`running_report_sink` wrote: ``batch``, ``_file``,
    ``_line`` (and a listing's ``id``), the report's keys and its values so far."""
    keys, _, _, _, finish = _spec(table)
    rows = read_running(spark, path)
    for name, c in finish.items():
        rows = rows.withColumn(name, c)
    own = ["id"] if REPORTS[table].kind == "listing" else []
    return rows.select("batch", FILE, LINE, *own, *keys, *_value_columns(table))
