"""Prices are summed as written and rounded once."""

import pytest

from keyfold.operators.parse import parse_listing_rows
from keyfold.plans import run_report
from keyfold.plans.reports import district_stats, neighborhood_avg_price
from keyfold.plans.running import latest_report, running_report

from .conftest import booking_line, listing_line


def _mean(spark, prices):
    lines = spark.createDataFrame([(listing_line(unit_price=f"{p}元/平"),) for p in prices], "value string")
    return run_report("neighborhood_avg_price", lines).first().avg_price


def test_means_are_rounded_once(spark):
    assert _mean(spark, ["0.125"] * 4) == 0.12
    assert _mean(spark, ["0.004", "0.004", "0.007"]) == 0.01
    lines = spark.createDataFrame([(booking_line(adr="1.015"),)] * 3, "value string")
    assert run_report("monthly_avg_adr", lines).first().avg_adr == 1.01


def test_decimals_that_do_not_fit_raise(spark):
    assert _mean(spark, ["1.1234560000"]) == 1.12
    with pytest.raises(Exception, match="more decimals"):
        _mean(spark, ["1.1234567"])


def test_unparsable_prices_leave_the_mean(spark):
    lines = spark.createDataFrame([(listing_line(unit_price=p),) for p in ("10元/平", "20元/平", "n/a")], "value string")
    row = run_report("neighborhood_avg_price", lines, "null").first()
    assert (row.avg_price, row["count"]) == (15.0, 3)


def test_absent_columns_raise(spark):
    rows = spark.createDataFrame([("10元/平", "N1")], "unit_price string, neighborhood string")
    typed = parse_listing_rows(rows)
    assert neighborhood_avg_price(typed).first().avg_price == 10.0
    with pytest.raises(Exception, match="no column district"):
        district_stats(typed).collect()


def test_latest_of_a_stored_running_word_count(spark):
    rows = spark.createDataFrame([(i, "same same other same") for i in range(100)], "id long, title string")
    run = running_report("word_count", rows, "id")
    stored = spark.createDataFrame(sorted(map(tuple, run.collect()), reverse=True), run.schema)
    got = {r.word: r["count"] for r in latest_report(stored, "word_count", "id").collect()}
    assert got == {"same": 300, "other": 100}
