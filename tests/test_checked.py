"""Rejected lines with reasons, from the report's own pass; split plans."""

import datetime

import pytest
from pyspark.sql import functions as F

from keyfold.plans import run_report
from keyfold.plans.checked import checked_report
from keyfold.sources.jdbc import split_predicates
from tests.conftest import booking_line, listing_line


def lines_of(spark, lines):
    return spark.createDataFrame([(x,) for x in lines], "value string")


GOOD = [listing_line(neighborhood="N1", unit_price="10元/平"), listing_line(neighborhood="N1", unit_price="20元/平"), listing_line(neighborhood="", unit_price="5元/平")]
BAD = {listing_line(neighborhood="N1", unit_price="面议"): ["unreadable:unit_price"], '"1","a title","u"': ["missing:neighborhood", "missing:unit_price"],
       "": ["missing:neighborhood", "missing:unit_price"], '"1","t","u","p","7元/平"': ["missing:neighborhood"], '"1","t","u","p","none"': ["missing:neighborhood", "unreadable:unit_price"]}


def test_listing_reasons(spark):
    header = '"id","title"'
    found = checked_report("neighborhood_avg_price", lines_of(spark, [header, *GOOD, *BAD, *BAD]))
    assert sorted((x.value, x.reasons) for x in found.rejects.collect()) == sorted([*BAD.items(), *BAD.items()])
    assert (found.lines, found.rejected) == (len(GOOD) + 2 * len(BAD), 2 * len(BAD))
    assert found.reasons == {"missing:neighborhood": 8, "missing:unit_price": 4, "unreadable:unit_price": 4}
    rows = lambda df: sorted(map(tuple, df.collect()))
    assert rows(found.result) == rows(run_report("neighborhood_avg_price", lines_of(spark, [*GOOD, *BAD]), on_bad="quarantine")) == [("", 5.0, 1), ("N1", 15.0, 2)]


def test_booking_reasons(spark):
    lines = [booking_line(adr="12.5"), booking_line(adr="free"), booking_line(arrival_date_month="May", adr="?"), '"City Hotel",0']
    found = checked_report("monthly_avg_adr", lines_of(spark, lines))
    assert sorted(",".join(x.reasons) for x in found.rejects.collect()) == ["missing:arrival_date_month,missing:adr", "unreadable:adr", "unreadable:arrival_date_month,unreadable:adr"]
    assert [tuple(x) for x in found.result.collect()] == [(1, 12.5)]


def test_no_lines_and_only_good_ones(spark):
    none = checked_report("neighborhood_avg_price", lines_of(spark, ["x"]).limit(0))
    assert (none.lines, none.rejected, none.reasons) == (0, 0, {}) and none.result.collect() == [] and none.rejects.collect() == []
    good = checked_report("neighborhood_avg_price", lines_of(spark, GOOD))
    assert (good.lines, good.rejected, good.reasons) == (3, 0, {}) and good.rejects.collect() == []


def parts_of(rows, plan):
    """Sizes of the parts; every row is in exactly one."""
    held = [F.coalesce(F.expr(p), F.lit(False)).cast("int") for p in plan]
    found = rows.select(F.array(*held).alias("h")).collect()
    assert all(sum(x.h) == 1 for x in found)
    return [n for n in (sum(x.h[i] for x in found) for i in range(len(plan))) if n]


@pytest.mark.parametrize("kind", ["bigint", "string", "date", "timestamp", "decimal(12,2)", "double"])
def test_parts_are_disjoint_complete_and_balanced(spark, kind):
    base = spark.range(6000).withColumn("n", F.pmod(F.xxhash64("id"), F.lit(1500)))
    value = {"date": F.date_add(F.lit(datetime.date(2020, 1, 1)), F.col("n").cast("int")), "timestamp": F.timestamp_seconds(F.col("n") * 1000 + 0.5),
             "string": F.concat(F.lit("it's "), F.col("n").cast("string"))}.get(kind, F.col("n").cast(kind))
    hot = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("n"))
    rows = base.withColumn("n", hot).withColumn("c", F.when(F.col("id") % 4 == 1, F.lit(None)).otherwise(value)).select("id", "c")
    sizes = parts_of(rows, split_predicates(rows, "c", 10, then="id"))
    assert max(sizes) <= 2 * sum(sizes) / len(sizes) and len(sizes) >= 9
    # Complete for rows that the plan has not seen.
    parts_of(base.withColumn("c", value).select("id", "c"), split_predicates(rows.filter("id % 50 = 0"), "c", 10, then="id"))


def test_small_plans(spark):
    rows = spark.createDataFrame([(i, "same") for i in range(20)] + [(None, None)], "id int, c string")
    assert sorted(parts_of(rows, split_predicates(rows, "c", 4))) == [1, 20]
    assert max(parts_of(rows, split_predicates(rows, "c", 4, then="id"))) <= 10
    assert split_predicates(rows.limit(0), "c", 4) == ["1 = 1"]
    assert parts_of(rows.filter("c is null"), split_predicates(rows.filter("c is null"), "c", 3)) == [1]
    with pytest.raises(ValueError):
        split_predicates(rows, "c", 0)
