"""S5 generator properties: row count, domains, weights, determinism."""

from pyspark.sql import functions as F

from keyfold.operators.parse import parse_listings
from keyfold.plans import run_report
from keyfold.sources.synth import DISTRICT_SLOTS, synth_listings_range, to_listing_lines


def test_count_domains_and_determinism(spark):
    a = synth_listings_range(spark, 20_000, seed=7, partitions=3)
    b = synth_listings_range(spark, 20_000, seed=7, partitions=5)
    assert a.count() == 20_000
    assert a.exceptAll(b).count() == 0  # independent of partitioning
    r = a.agg(F.min("focus"), F.max("focus"),
              F.min(F.regexp_extract("unit_price", "^([0-9]+)", 1).cast("int")),
              F.max(F.regexp_extract("unit_price", "^([0-9]+)", 1).cast("int"))).first()
    assert 0 <= r[0] and r[1] <= 999 and 0 <= r[2] and r[3] <= 29_999
    years = {x[0] for x in a.select("year_built").distinct().collect()}
    assert years == {f"20{y}年建" for y in range(10, 20)}


def test_weighted_district_slots(spark):
    df = synth_listings_range(spark, 50_000, seed=1)
    share = {r.district: r["count"] / 50_000 for r in df.groupBy("district").count().collect()}
    for d in set(DISTRICT_SLOTS):
        expected = DISTRICT_SLOTS.count(d) / len(DISTRICT_SLOTS)
        assert abs(share[d] - expected) < 0.02


def test_synthetic_lines_feed_the_reports(spark):
    df = synth_listings_range(spark, 5_000, seed=3)
    lines = to_listing_lines(df)
    assert parse_listings(lines).count() == 5_000
    got = run_report("district_stats", lines)
    want = df.groupBy("district").agg(F.count(F.lit(1)).alias("house_count"))
    assert got.exceptAll(want).count() == 0


def test_today_date_rendering(spark):
    import datetime
    row = synth_listings_range(spark, 1, date=None).first()
    assert row.post_date == row.update_date
    assert abs((datetime.date.fromisoformat(row.post_date) - datetime.date.today()).days) <= 1
