"""The ten report jobs (J1-J10) as DataFrame -> DataFrame functions.

Each takes typed rows (from :func:`keyfold.operators.parse_listings` /
:func:`parse_bookings`, batch or streaming) and returns the result table with
the reference's column names.  ``run_report`` goes from raw lines to the
result.  J11-J14 are the J2 report over other sources (JDBC rows, a path, a
packaged file, a Kafka stream): the same function, another input.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyfold.functions.text import round2
from keyfold.operators.agg import (
    count_by, flag_count_by, mean_by, sum_count_by, sums_by, word_count,
)
from keyfold.operators.parse import apply_on_bad, parse_bookings, parse_listings


# ----------------------------------------------------------------- listings
def district_stats(listings: DataFrame) -> DataFrame:
    """Listings per district."""
    return count_by(listings, "district", "house_count")


def neighborhood_avg_price(listings: DataFrame) -> DataFrame:
    """Mean unit price (two decimals) and listing count per neighborhood."""
    return mean_by(listings, "neighborhood", F.col("unit_price"), "avg_price", count="count")


def year_avg_elevator_ratio(listings: DataFrame) -> DataFrame:
    """Mean lifts-per-household ratio and count per construction year.

    Unparsable ratios count as 0.0 and stay in the divisor.
    """
    return mean_by(listings, "year_built", F.col("elevator_ratio"), "avg_elevator_ratio",
                   count="count")


def orientation_focus_count(listings: DataFrame) -> DataFrame:
    """Total followers and listing count per orientation."""
    return sum_count_by(listings, "orientation", F.col("focus"), "total_focus", "count")


def title_word_count(listings: DataFrame) -> DataFrame:
    """Frequency of title words (full-width comma / whitespace separated)."""
    return word_count(listings.filter(F.col("title").isNotNull()), "title")


# ----------------------------------------------------------------- bookings
def _booked(bookings: DataFrame, exclude_canceled: bool) -> DataFrame:
    return bookings.filter(F.col("is_canceled") != 1) if exclude_canceled else bookings


def hotel_statistics(bookings: DataFrame, exclude_canceled: bool = False) -> DataFrame:
    """Bookings, cancellations and nights per hotel type.

    The reference sums the nights of cancelled bookings too ("actual stay");
    ``exclude_canceled=True`` counts only the nights of kept bookings.
    """
    nights = F.col("nights")
    if exclude_canceled:
        nights = F.when(F.col("is_canceled") != 1, nights).otherwise(F.lit(0))
    out = sums_by(
        bookings.withColumnRenamed("hotel", "hotel_type"), "hotel_type",
        {"canceled_count": F.when(F.col("is_canceled") == 1, F.lit(1)).otherwise(F.lit(0)),
         "actual_stay_count": nights},
        count="booking_count",
    )
    return out.select("hotel_type", "booking_count",
                      F.col("canceled_count").cast("bigint").alias("canceled_count"),
                      F.col("actual_stay_count").cast("bigint").alias("actual_stay_count"))


def monthly_booking_counts(bookings: DataFrame) -> DataFrame:
    """Kept (not cancelled) bookings per (month, hotel type); 0 if all cancelled."""
    b = bookings.select(F.col("arrival_date_month").alias("month"),
                        F.col("hotel").alias("hotel_type"), "is_canceled")
    return flag_count_by(b, ["month", "hotel_type"], F.col("is_canceled") == 0, "booking_count")


def country_statistics(bookings: DataFrame, exclude_canceled: bool = False) -> DataFrame:
    """Visitors per country (every booking, as the reference counts)."""
    return count_by(_booked(bookings, exclude_canceled), "country", "visitor_count")


def booking_method_statistics(bookings: DataFrame) -> DataFrame:
    """Bookings per (hotel type, booking method) -- two grouping columns."""
    b = bookings.withColumnRenamed("hotel", "hotel_type")
    return count_by(b, ["hotel_type", "booking_method"], "booking_count")


def monthly_avg_adr(bookings: DataFrame) -> DataFrame:
    """Mean daily rate (two decimals) per arrival month."""
    b = bookings.withColumnRenamed("arrival_date_month", "month")
    return mean_by(b, "month", F.col("adr"), "avg_adr")


# Grouping columns of the booking reports, and the columns each shows.
_BOOKING_SETS = {
    "hotel_statistics": (("hotel_type",), ("booking_count", "canceled_count", "actual_stay_count")),
    "monthly_booking_counts": (("month", "hotel_type"), ("kept_count",)),
    "country_statistics": (("country",), ("visitor_count",)),
    "booking_method_statistics": (("hotel_type", "booking_method"), ("booking_count",)),
    "monthly_avg_adr": (("month",), ("avg_adr",)),
}
_BOOKING_KEYS = ("hotel_type", "month", "country", "booking_method")


def booking_reports(bookings: DataFrame) -> DataFrame:
    """J6-J10 in one pass: every row goes to its group of each report (grouping
    sets), so the lines are read, parsed and exchanged once.

    Columns: ``report`` (the result table's name), the four key columns and the
    reports' values; what a report doesn't have is null.  :func:`one_report`
    takes a report's own table out of it.
    """
    b = bookings.withColumnsRenamed({"hotel": "hotel_type", "arrival_date_month": "month"})
    canceled = F.when(F.col("is_canceled") == 1, F.lit(1)).otherwise(F.lit(0))
    kept = F.when(F.col("is_canceled") == 0, F.lit(1)).otherwise(F.lit(0))
    found = b.groupingSets([[F.col(k) for k in keys] for keys, _ in _BOOKING_SETS.values()], *[F.col(k) for k in _BOOKING_KEYS]).agg(
        F.grouping_id().alias("_set"), F.count(F.lit(1)).alias("booking_count"), F.sum(canceled).cast("bigint").alias("canceled_count"),
        F.sum("nights").cast("bigint").alias("actual_stay_count"), F.sum(kept).cast("bigint").alias("kept_count"),
        F.count(F.lit(1)).alias("visitor_count"), round2(F.try_divide(F.sum("adr").cast("double"), F.count("adr"))).alias("avg_adr"))
    # The grouping id has a bit for each key column that a set leaves out, the first column's highest.
    name, shown = F.lit(None).cast("string"), {}
    for report, (keys, values) in _BOOKING_SETS.items():
        number = sum(1 << (len(_BOOKING_KEYS) - 1 - i) for i, k in enumerate(_BOOKING_KEYS) if k not in keys)
        name = F.when(F.col("_set") == number, F.lit(report)).otherwise(name)
        for v in values:
            shown.setdefault(v, []).append(report)
    named = found.withColumn("report", name)
    values = [F.when(F.col("report").isin(*reports), F.col(v)).alias(v) for v, reports in shown.items()]
    return named.select("report", *_BOOKING_KEYS, *values)


def one_report(reports: DataFrame, table: str) -> DataFrame:
    """The result table of one report out of :func:`booking_reports`."""
    keys, values = _BOOKING_SETS[table]
    renamed = [F.col(v).alias("booking_count" if v == "kept_count" else v) for v in values]
    return reports.filter(F.col("report") == table).select(*keys, *renamed)


# ----------------------------------------------------------------- registry
@dataclass(frozen=True)
class Report:
    table: str                      # result table name
    kind: str                       # "listing" | "booking"
    needed: tuple[str, ...]         # typed fields the report reads
    build: Callable[..., DataFrame]  # typed rows -> result


REPORTS: dict[str, Report] = {r.table: r for r in [
    Report("district_stats", "listing", ("district",), district_stats),
    Report("neighborhood_avg_price", "listing", ("neighborhood", "unit_price"),
           neighborhood_avg_price),
    Report("year_avg_elevator_ratio", "listing", ("year_built", "elevator_ratio"),
           year_avg_elevator_ratio),
    Report("orientation_focus_count", "listing", ("orientation", "focus"),
           orientation_focus_count),
    Report("word_count", "listing", (), title_word_count),
    Report("hotel_statistics", "booking", ("hotel", "is_canceled", "nights"), hotel_statistics),
    Report("monthly_booking_counts", "booking", ("hotel", "arrival_date_month", "is_canceled"),
           monthly_booking_counts),
    Report("country_statistics", "booking", ("country",), country_statistics),
    Report("booking_method_statistics", "booking", ("hotel", "booking_method"),
           booking_method_statistics),
    Report("monthly_avg_adr", "booking", ("arrival_date_month", "adr"), monthly_avg_adr),
]}


def parse_for(report: Report, lines: DataFrame, on_bad: str = "fail", **parse_opts) -> DataFrame:
    """Typed rows a report needs, from raw lines, with the bad-row policy applied."""
    parse = parse_listings if report.kind == "listing" else parse_bookings
    rows = parse(lines, on_bad=on_bad, **parse_opts)
    cols = list(report.needed) or ["title"]
    return apply_on_bad(rows.select(*cols), report.needed, on_bad)


def run_report(table: str, lines: DataFrame, on_bad: str = "fail", **parse_opts) -> DataFrame:
    """Raw text lines (batch or streaming ``value`` column) -> result table."""
    report = REPORTS[table]
    return report.build(parse_for(report, lines, on_bad, **parse_opts))
