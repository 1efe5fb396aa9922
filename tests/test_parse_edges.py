"""Hand-written edge rows (FIXTURES.md section 5), expected values worked out by hand."""

import pytest
from pyspark.errors import PySparkException

from keyfold.operators.parse import bad_rows, parse_bookings, parse_listings
from keyfold.plans import run_report
from keyfold.schema import LISTING_COLUMNS
from tests.conftest import booking_line, listing_line


def lines(spark, *ls):
    return spark.createDataFrame([(x,) for x in ls], "value string")


def collect_map(df, key, val):
    return {r[key]: r[val] for r in df.collect()}


def test_repeated_header_dropped(spark):
    header = ",".join(f'"{c}"' for c in LISTING_COLUMNS)
    df = lines(spark, header, listing_line(district="A"), header, listing_line(district="A"))
    assert collect_map(run_report("district_stats", df), "district", "house_count") == {"A": 2}


def test_quoted_comma_and_doubled_quote(spark):
    df = lines(spark, listing_line(title="a,b", district="D1"),
               '"1","a""b"' + listing_line(district="D2")[len('"x","x"'):])
    rows = parse_listings(df).select("title", "district").collect()
    assert [(r.title, r.district) for r in rows] == [("a,b", "D1"), ("ab", "D2")]


def test_booking_plain_dialect_shifts_and_fails(spark):
    bad = booking_line(hotel='"City, Hotel"')
    with pytest.raises(PySparkException):
        run_report("hotel_statistics", lines(spark, bad)).collect()
    ok = run_report("hotel_statistics", lines(spark, bad), dialect="quoted").collect()
    assert ok[0]["hotel_type"] == "City, Hotel" and ok[0]["booking_count"] == 1


def test_blank_tail_kept_with_zero_ratio(spark):
    full = listing_line(year_built="2015年建")
    cut = full.rsplit(",", 3)[0] + ",,,"
    out = run_report("year_avg_elevator_ratio", lines(spark, cut)).collect()
    assert [(r.year_built, r.avg_elevator_ratio, r["count"]) for r in out] == [("2015", 0.0, 1)]


@pytest.mark.parametrize("ratio", ["暂无数据", "两梯四户", " 2梯4户", "1梯0户", "2梯4户\t", "99999999999梯1户"])
def test_unusable_ratio_is_zero_and_counted(spark, ratio):
    df = lines(spark, listing_line(year_built="2010年建", elevator_ratio=ratio),
               listing_line(year_built="2010年建", elevator_ratio="1梯2户"))
    out = run_report("year_avg_elevator_ratio", df).collect()
    assert [(r.avg_elevator_ratio, r["count"]) for r in out] == [(0.25, 2)]


def test_year_without_digits_groups_under_empty(spark):
    out = run_report("year_avg_elevator_ratio", lines(spark, listing_line(year_built="未知"))).collect()
    assert out[0]["year_built"] == ""


@pytest.mark.parametrize("focus,expected", [("暂无", 0), ("99999999999", 0), ("12人关注", 12)])
def test_focus_digits_or_zero(spark, focus, expected):
    out = run_report("orientation_focus_count", lines(spark, listing_line(orientation="南", focus=focus)))
    assert collect_map(out, "orientation", "total_focus") == {"南": expected}


def test_thousands_price_strict_vs_stripped(spark):
    df = lines(spark, listing_line(neighborhood="N", unit_price="12,345元/平"))
    with pytest.raises(PySparkException):
        run_report("neighborhood_avg_price", df).collect()
    out = run_report("neighborhood_avg_price", df, strip_thousands=True).collect()
    assert out[0]["avg_price"] == 12345.0


def test_rounding_half_even_on_binary_value(spark):
    # Means 0.125, 1.015 and 2.675 (two rows each) round to 0.12, 1.01, 2.67.
    rows = []
    for name, a, b in [("a", "0.12", "0.13"), ("b", "1.01", "1.02"), ("c", "2.67", "2.68")]:
        rows += [listing_line(neighborhood=name, unit_price=f"{a}元/平"),
                 listing_line(neighborhood=name, unit_price=f"{b}元/平")]
    out = run_report("neighborhood_avg_price", lines(spark, *rows))
    assert collect_map(out, "neighborhood", "avg_price") == {"a": 0.12, "b": 1.01, "c": 2.67}


def test_title_words(spark):
    out = run_report("word_count", lines(spark, listing_line(title="，海景  房\t好，，x,y")))
    assert collect_map(out, "word", "count") == {"海景": 1, "房": 1, "好": 1, "x,y": 1}


def test_title_guard_skips_single_field_rows(spark):
    out = run_report("word_count", lines(spark, "just-one-field", listing_line(title="a b")))
    assert collect_map(out, "word", "count") == {"a": 1, "b": 1}


def test_month_with_only_cancelled_bookings_present_with_zero(spark):
    df = lines(spark, booking_line(arrival_date_month=3, is_canceled=1),
               booking_line(arrival_date_month=4, is_canceled=0))
    out = run_report("monthly_booking_counts", df)
    assert {(r.month, r.booking_count) for r in out.collect()} == {(3, 0), (4, 1)}


def test_control_characters_trimmed(spark):
    out = run_report("orientation_focus_count", lines(spark, listing_line(orientation="\t\x01南 ")))
    assert list(collect_map(out, "orientation", "count")) == ["南"]


def test_bad_row_policies(spark):
    good = listing_line(neighborhood="N", unit_price="10元/平")
    bad = listing_line(neighborhood="N", unit_price="abc元/平")
    short = '"1","t"'
    df = lines(spark, good, bad, short)
    with pytest.raises(PySparkException):
        run_report("neighborhood_avg_price", df).collect()
    q = run_report("neighborhood_avg_price", df, on_bad="quarantine").collect()
    assert [(r.neighborhood, r.avg_price, r["count"]) for r in q] == [("N", 10.0, 1)]
    nulls = parse_listings(df, on_bad="null").select("unit_price").collect()
    assert sorted(r.unit_price is None for r in nulls) == [False, True, True]
    quarantined = bad_rows(df, "listing", ["neighborhood", "unit_price"]).collect()
    assert sorted(r.value for r in quarantined) == sorted([bad, short])


def test_booking_fields_trimmed_and_typed(spark):
    df = lines(spark, booking_line(hotel='" Resort Hotel "', arrival_date_month=" 7", adr=" 12.50"))
    r = parse_bookings(df).collect()[0]
    assert (r.hotel, r.arrival_date_month, float(r.adr)) == ("Resort Hotel", 7, 12.5)


def test_short_row_fails_in_strict_mode(spark):
    with pytest.raises(PySparkException):
        run_report("district_stats", lines(spark, '"1","t","u"')).collect()


def test_unused_bad_fields_do_not_fail(spark):
    # J1 reads only the district: a bad price elsewhere must not fail it.
    df = lines(spark, listing_line(district="D", unit_price="oops"))
    assert collect_map(run_report("district_stats", df), "district", "house_count") == {"D": 1}


def test_display_key_of_hotel_and_method(spark):
    from keyfold.functions import hotel_key
    df = spark.createDataFrame([("City Hotel", "Direct")], "h string, m string")
    assert df.select(hotel_key("h", "m").alias("k")).first().k == "City Hotel-Direct"


def test_parse_plan_reads_each_line_once(spark):
    df = lines(spark, listing_line())
    plan = parse_listings(df).select("neighborhood", "unit_price")._jdf.queryExecution() \
        .executedPlan().toString()
    assert plan.count("from_csv(") == 1 and plan.count("regexp_extract_all(") == 1


def test_exclude_canceled_flags(spark):
    from keyfold.operators.parse import parse_bookings
    from keyfold.plans import country_statistics, hotel_statistics
    df = lines(spark, booking_line(country='"C1"', is_canceled=1, nights=5),
               booking_line(country='"C1"', is_canceled=0, nights=2))
    rows = parse_bookings(df)
    assert hotel_statistics(rows).first()["actual_stay_count"] == 7          # reference rule
    assert hotel_statistics(rows, exclude_canceled=True).first()["actual_stay_count"] == 2
    assert country_statistics(rows).first()["visitor_count"] == 2
    assert country_statistics(rows, exclude_canceled=True).first()["visitor_count"] == 1


def test_booking_quarantine_and_bad_rows(spark):
    good = booking_line(arrival_date_month=5, adr="10.00")
    bad = booking_line(arrival_date_month="May", adr="10.00")
    df = lines(spark, good, bad)
    with pytest.raises(PySparkException):
        run_report("monthly_avg_adr", df).collect()
    out = run_report("monthly_avg_adr", df, on_bad="quarantine").collect()
    assert [(r.month, r.avg_adr) for r in out] == [(5, 10.0)]
    assert [r.value for r in bad_rows(df, "booking", ["arrival_date_month", "adr"]).collect()] == [bad]


def test_named_rows_strict_and_lenient(spark):
    from keyfold.operators.parse import parse_listing_rows
    rows = spark.createDataFrame([("N1", "1,234.50元/平"), (None, "10元/平")],
                                 "neighborhood string, unit_price string")
    with pytest.raises(PySparkException):
        parse_listing_rows(rows).collect()
    got = parse_listing_rows(rows, on_bad="null").select("neighborhood", "unit_price").collect()
    assert [(r.neighborhood, float(r.unit_price)) for r in got] == [("N1", 1234.5), (None, 10.0)]


def test_csv_fast_path_keeps_nul_and_empty_fields(spark):
    df = lines(spark, listing_line(district="\x00", neighborhood=""),
               ",".join(['"x"'] * 25000))  # more fields than the CSV parser allows
    fast = parse_listings(df, on_bad="null").select("district", "neighborhood").collect()
    exact = parse_listings(df, on_bad="null", csv_fast_path=False) \
        .select("district", "neighborhood").collect()
    assert fast == exact and fast[0] == ("\x00", "")
