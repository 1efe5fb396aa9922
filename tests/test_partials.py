"""Stored partial results: merged they are the report, taken back they are gone."""

import random

from pyspark.sql import functions as F

from keyfold.operators.partials import merged, partials
from keyfold.plans.reports import booking_reports, country_statistics, hotel_statistics, monthly_avg_adr, monthly_booking_counts, booking_method_statistics, one_report
from keyfold.session import fresh_path

BOOKINGS = "hotel string, is_canceled int, arrival_date_month int, nights int, country string, booking_method string, adr decimal(18,6)"


def some_bookings(n=300):
    r = random.Random(3)
    return [(r.choice(["City", "Resort", None]), r.randint(0, 1), r.choice([1, 2, 12, None]), r.choice([0, 3, 14]), r.choice(["C1", "C2", None]), r.choice(["Web", "Desk"]), r.choice([None, 1.25, 99])) for _ in range(n)]


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def decimals(data):
    from decimal import Decimal
    return [(*x[:-1], None if x[-1] is None else Decimal(str(x[-1]))) for x in data]


def test_one_scan_equals_each_report(spark):
    df = spark.createDataFrame(decimals(some_bookings()), BOOKINGS)
    all_ = booking_reports(df)
    for build in (hotel_statistics, monthly_booking_counts, country_statistics, booking_method_statistics, monthly_avg_adr):
        table = {"hotel_statistics": "hotel_statistics", "monthly_booking_counts": "monthly_booking_counts", "country_statistics": "country_statistics",
                 "booking_method_statistics": "booking_method_statistics", "monthly_avg_adr": "monthly_avg_adr"}[build.__name__]
        want = build(df)
        assert rows(one_report(all_, table).select(*want.columns)) == rows(want)
    assert rows(booking_reports(df.limit(0))) == []


def test_one_scan_has_one_scan_and_one_exchange(spark):
    path = fresh_path(spark, "test-bookings")
    spark.createDataFrame(decimals(some_bookings()), BOOKINGS).write.parquet(path)
    plan = booking_reports(spark.read.parquet(path))._jdf.queryExecution().sparkPlan().toString()
    full = booking_reports(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and full.count("Exchange hashpartitioning") == 1 and full.count("Expand") == 1


def test_deltas_add_up_and_take_back(spark):
    base, later = some_bookings(200), some_bookings(120)
    gone = base[::3]
    schema = BOOKINGS + ", sign int"
    deltas = [[(*x, 1) for x in base], [(*x, 1) for x in later], [(*x, -1) for x in gone] + [(*gone[0], None)]]
    path = fresh_path(spark, "test-deltas")
    sums = {"canceled": F.col("is_canceled").cast("bigint"), "nights": F.col("nights").cast("bigint")}
    for n, d in enumerate(deltas):
        partials(spark.createDataFrame(decimals_signed(d), schema), ["hotel", "arrival_date_month"], sums, sign=F.col("sign")).write.parquet(f"{path}/batch={n}")
    got = merged(spark.read.parquet(path).drop("batch"), ["hotel", "arrival_date_month"])
    left = list(base)
    for x in gone:
        left.remove(x)
    want = partials(spark.createDataFrame(decimals(left + later), BOOKINGS), ["hotel", "arrival_date_month"], sums)
    assert rows(got.select(*want.columns)) == rows(want)


def decimals_signed(data):
    return [(*decimals([x[:-1]])[0], x[-1]) for x in data]


def test_keys_taken_back_wholly_go_and_nulls_add_nothing(spark):
    df = spark.createDataFrame([("a", 5, 1), ("a", 5, -1), ("b", None, 1), (None, 2, 1), ("b", None, 1)], "k string, v long, sign int")
    part = partials(df, "k", {"v": F.col("v")}, sign=F.col("sign"))
    assert rows(merged(part, "k")) == [("b", None, 2), (None, 2, 1)]
    assert rows(merged(part.unionByName(part), "k", keep_empty=True)) == [("a", 0, 0), ("b", None, 4), (None, 4, 2)]
    assert rows(merged(partials(df.limit(0), "k", {"v": F.col("v")}), "k")) == []
