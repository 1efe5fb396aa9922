"""D1 for every report: the last running row per key equals the batch report."""

import pytest
from pyspark.sql import functions as F

from keyfold.operators.parse import parse_bookings, parse_listings
from keyfold.plans import REPORTS, run_report
from keyfold.plans.running import latest_report, running_report
from keyfold.sources.fixtures import ORDER_COLUMNS, booking_line, listing_line


@pytest.fixture(scope="module")
def rendered(spark, sf_small):
    orders = spark.read.parquet(f"{sf_small}/orders.parquet").select(*ORDER_COLUMNS)
    return {
        "listing": orders.select(listing_line().alias("value"), F.col("o_orderkey").alias("seq")),
        "booking": orders.select(booking_line().alias("value"), F.col("o_orderkey").alias("seq")),
    }


@pytest.mark.parametrize("table", sorted(REPORTS))
@pytest.mark.parametrize("partitions", [None, 15])
def test_last_running_row_is_batch_result(spark, rendered, table, partitions):
    kind = REPORTS[table].kind
    lines = rendered[kind]
    parse = parse_listings if kind == "listing" else parse_bookings
    rows = parse(lines, keep=["seq"])
    run = running_report(table, rows, "seq", partitions=partitions)
    assert run.count() >= lines.count() if table != "word_count" else True
    last = latest_report(run, table, "seq")
    batch = run_report(table, lines.select("value"))
    cols = batch.columns
    assert sorted(last.columns) == sorted(cols)
    last = last.select(*cols)
    assert last.exceptAll(batch).count() == 0 and batch.exceptAll(last).count() == 0


def test_running_values_increase_one_row_at_a_time(spark):
    lines = spark.createDataFrame(
        [(listing_row("A"), 1), (listing_row("B"), 2), (listing_row("A"), 3)], "value string, seq long")
    run = running_report("district_stats", parse_listings(lines, keep=["seq"]), "seq")
    assert [(r.seq, r.district, r.house_count) for r in run.orderBy("seq").collect()] == \
        [(1, "A", 1), (2, "B", 1), (3, "A", 2)]


def listing_row(district):
    from tests.conftest import listing_line as line
    return line(district=district)


def test_stream_with_rocksdb_state(spark, sf_small):
    from keyfold.session import fresh_path
    from keyfold.sinks.batches import read_upserted, upsert_sink
    from keyfold.sources.fixtures import write_lines
    from keyfold.sources.text import read_lines, stream_lines
    from keyfold.streaming.upsert import ROCKSDB_PROVIDER, run_report_stream, use_rocksdb_state
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key, None)
    use_rocksdb_state(spark)
    try:
        assert spark.conf.get(key) == ROCKSDB_PROVIDER
        orders = spark.read.parquet(f"{sf_small}/orders.parquet").select(*ORDER_COLUMNS)
        src = fresh_path(spark, "test-rocks-src")
        write_lines(spark, orders, "listing", src, n_files=2)
        out = fresh_path(spark, "test-rocks")
        q = run_report_stream("orientation_focus_count", stream_lines(spark, src, 1),
                              upsert_sink(out, ["orientation"]), fresh_path(spark, "test-rocks-ckpt"))
        q.awaitTermination()
        batch = run_report("orientation_focus_count", read_lines(spark, src))
        got = read_upserted(spark, out).select(*batch.columns)
        assert got.exceptAll(batch).count() == 0 and batch.exceptAll(got).count() == 0
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


@pytest.mark.parametrize("partitions", [None, 8])
def test_booking_running_report_in_arrival_order(spark, sf_small, partitions):
    from keyfold.session import fresh_path
    from keyfold.sources.fixtures import write_lines
    from keyfold.sources.text import read_lines, with_arrival_order
    orders = spark.read.parquet(f"{sf_small}/orders.parquet").select(*ORDER_COLUMNS)
    src = fresh_path(spark, "test-arrival")
    write_lines(spark, orders, "booking", src, n_files=3)
    lines = with_arrival_order(read_lines(spark, src))
    rows = parse_bookings(lines, keep=["seq"])
    run = running_report("monthly_booking_counts", rows, "seq", partitions=partitions)
    last = latest_report(run, "monthly_booking_counts", "seq")
    batch = run_report("monthly_booking_counts", read_lines(spark, src))
    last = last.select(*batch.columns)
    assert last.exceptAll(batch).count() == 0 and batch.exceptAll(last).count() == 0
    # one running row per booking line, counts step by at most one
    assert run.count() == orders.count()
