"""Stream = batch, restart and replay safety, file-table upsert, sink SQL."""

import pytest
from pyspark.sql import functions as F

from keyfold.plans import run_report
from keyfold.session import fresh_path
from keyfold.sinks.batches import batches, read_upserted, upsert, upsert_sink
from keyfold.sinks.files import bucket_of, read_buckets, upsert_buckets
from keyfold.sinks.jdbc import merge_sql
from keyfold.sinks.kafka import kafka_sink_options
from keyfold.sources.fixtures import write_lines, ORDER_COLUMNS
from keyfold.sources.jdbc import jdbc_options
from keyfold.sources.kafka import kafka_source_options
from keyfold.sources.text import read_lines, stream_lines
from keyfold.streaming.upsert import run_report_stream


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.fixture(scope="module")
def orders(spark, sf_small):
    return spark.read.parquet(f"{sf_small}/orders.parquet").select(*ORDER_COLUMNS)


def test_stream_equals_batch_and_restart_changes_nothing(spark, orders):
    table = "neighborhood_avg_price"
    src = fresh_path(spark, "test-src")
    write_lines(spark, orders, "listing", src, n_files=4)
    out = fresh_path(spark, "test-table")
    ckpt = fresh_path(spark, "test-ckpt")
    q = run_report_stream(table, stream_lines(spark, src, max_files_per_trigger=1),
                          upsert_sink(out, ["neighborhood"]), ckpt)
    q.awaitTermination()
    assert q.exception() is None
    batch = run_report(table, read_lines(spark, src))
    assert same(read_upserted(spark, out), batch)
    from keyfold import fs
    n_files = len([f for f in fs.list_files(spark, src) if not f.startswith(("_", "."))])
    assert n_files == 4 and batches(spark, out)[-1] == n_files - 1  # one micro-batch per file
    # Restart from the checkpoint with no new input: no batch, same table.
    q2 = run_report_stream(table, stream_lines(spark, src, max_files_per_trigger=1),
                           upsert_sink(out, ["neighborhood"]), ckpt)
    q2.awaitTermination()
    assert batches(spark, out)[-1] == n_files - 1 and same(read_upserted(spark, out), batch)


def test_replayed_batch_is_idempotent(spark):
    t = fresh_path(spark, "test-k5")
    sink = upsert_sink(t, ["k"])
    sink(spark.createDataFrame([("a", 1), ("b", 2)], "k string, n long"), 1)
    b2 = spark.createDataFrame([("b", 5), ("c", 7)], "k string, n long")
    sink(b2, 2)
    first = sorted(map(tuple, read_upserted(spark, t).collect()))
    sink(b2, 2)  # replay after a crash between write and commit
    assert sorted(map(tuple, read_upserted(spark, t).collect())) == first == [("a", 1), ("b", 5), ("c", 7)]


def test_upserted_null_keys_and_old_folders(spark):
    t = fresh_path(spark, "test-k5n")
    for rows in ([(None, 1), ("x", 2)], [(None, 3)], [("y", 4)]):
        upsert(spark.createDataFrame(rows, "k string, n long"), t, ["k"])
    assert sorted(map(tuple, read_upserted(spark, t).collect()), key=str) == sorted([(None, 3), ("x", 2), ("y", 4)], key=str)
    assert batches(spark, t) == [1, 2]  # the last, and the one that a replay of it starts from


def test_merge_sql_dialects():
    cols = ["district", "house_count"]
    assert merge_sql("mysql", "district_stats", "s", ["district"], cols) == \
        "REPLACE INTO district_stats (`district`, `house_count`) SELECT `district`, `house_count` FROM s"
    pg = merge_sql("postgres", "t", "s", ["district"], cols)
    assert 'ON CONFLICT ("district") DO UPDATE SET "house_count" = EXCLUDED."house_count"' in pg
    m = merge_sql("derby", "t", "s", ["month", "hotel_type"], ["month", "hotel_type", "booking_count"])
    assert m.startswith('MERGE INTO t t USING s s ON (t."month" = s."month" AND t."hotel_type" = s."hotel_type")')
    assert 'WHEN NOT MATCHED THEN INSERT ("month", "hotel_type", "booking_count")' in m
    with pytest.raises(ValueError):
        merge_sql("nope", "t", "s", ["k"], ["k"])


def test_source_and_sink_options():
    o = kafka_source_options("h:9092", "listings", min_partitions=64)
    assert o["subscribe"] == "listings" and o["startingOffsets"] == "earliest" and o["minPartitions"] == "64"
    assert kafka_sink_options("h:9092", "t")["topic"] == "t"
    j = jdbc_options("jdbc:x", table="listings", partition_column="id", lower_bound=0,
                     upper_bound=100, num_partitions=8, user="u")
    assert j["partitionColumn"] == "id" and j["numPartitions"] == "8" and j["user"] == "u"
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x", query="select 1", partition_column="id", lower_bound=0,
                     upper_bound=1, num_partitions=2)
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x")


def test_source_agreement_text_vs_rows(spark, orders):
    """J2 from text lines equals J2 from named rows with thousands separators (J11 shape)."""
    from keyfold.operators.parse import parse_listing_rows
    from keyfold.plans import neighborhood_avg_price
    from keyfold.sources.fixtures import render
    from keyfold.schema import LISTING_COLUMNS
    lines = render(orders, "listing")
    text = run_report("neighborhood_avg_price", lines)
    parts = F.split(F.col("value"), '","')
    rows = render(orders, "listing_thousands").select(
        *[F.regexp_replace(parts.getItem(i), '"', "").alias(c)
          for i, c in enumerate(LISTING_COLUMNS) if c not in ("id", "title")])
    assert same(text, neighborhood_avg_price(parse_listing_rows(rows)))


def test_bucketed_table_rewrites_touched_buckets_only(spark):
    from keyfold import fs
    plain, bucketed = fresh_path(spark, "test-plain"), fresh_path(spark, "test-bucketed")
    first = spark.range(2000).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("k"),
                                     F.col("id").alias("n"))
    batch = spark.createDataFrame([("k1", -1), ("new", 5), (None, 0)], "k string, n long")
    files = lambda: {b: sorted(fs.list_files(spark, f"{bucketed}/{b}")) for b in fs.list_dirs(spark, bucketed) if b.startswith("_bucket=")}
    upsert_buckets(first, bucketed, ["k"], 16)
    before = files()
    assert len(before) == 16
    upsert_buckets(batch, bucketed, ["k"], 16)
    touched = {f"_bucket={r.b}" for r in batch.select(bucket_of(["k"], 16).alias("b")).collect()}
    after = files()
    assert all((after[b] == before[b]) == (b not in touched) for b in after)
    upsert_buckets(batch, bucketed, ["k"], 16)  # replay
    upsert_buckets(batch.limit(0), bucketed, ["k"], 16)
    for rows in (first, batch):
        upsert(rows, plain, ["k"])
    assert same(read_upserted(spark, plain), read_buckets(spark, bucketed))
    assert read_buckets(spark, bucketed).count() == 2002


def test_crash_after_sink_write_replays_to_same_table(spark, orders):
    """A failure after the batch's folder is written but before the stream
    commits the batch: the restarted query replays that batch, writing the
    same folder from the same base, and the table ends exactly right."""
    table = "orientation_focus_count"
    src = fresh_path(spark, "test-crash-src")
    write_lines(spark, orders, "listing", src, n_files=3)
    out = fresh_path(spark, "test-crash-table")
    ckpt = fresh_path(spark, "test-crash-ckpt")
    real = upsert_sink(out, ["orientation"])
    calls = []

    def crashing(batch, batch_id):
        real(batch, batch_id)
        calls.append(batch_id)
        if batch_id == 1:
            raise RuntimeError("simulated crash after the sink wrote its folder")

    q = run_report_stream(table, stream_lines(spark, src, max_files_per_trigger=1), crashing, ckpt)
    try:
        q.awaitTermination()
    except Exception:
        pass
    assert q.exception() is not None and calls == [0, 1]
    q2 = run_report_stream(table, stream_lines(spark, src, max_files_per_trigger=1), real, ckpt)
    q2.awaitTermination()
    assert q2.exception() is None
    assert same(read_upserted(spark, out), run_report(table, read_lines(spark, src)))
    assert batches(spark, out)[-1] == 2


def test_bad_rows_as_a_side_stream(spark):
    """The quarantine view is a plain transform, so it runs on a stream too."""
    from keyfold.operators.parse import bad_rows
    from tests.conftest import listing_line
    src = fresh_path(spark, "test-bad-src")
    good = listing_line(neighborhood="N", unit_price="10元/平")
    bad = listing_line(neighborhood="N", unit_price="n/a元/平")
    spark.createDataFrame([(good,), (bad,)], "value string").coalesce(1).write.text(src)
    out = fresh_path(spark, "test-bad-out")
    q = (bad_rows(stream_lines(spark, src), "listing", ["neighborhood", "unit_price"])
         .writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", fresh_path(spark, "test-bad-ckpt"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    assert [r.value for r in spark.read.parquet(out).collect()] == [bad]
    good_only = run_report("neighborhood_avg_price", read_lines(spark, src), on_bad="quarantine")
    assert [(r.avg_price, r["count"]) for r in good_only.collect()] == [(10.0, 1)]


def test_repeated_keys_are_refused(spark):
    rows = [(f"k{i}", i) for i in range(200)]
    table = lambda x: spark.createDataFrame(x, "k string, n long")
    plain, bucketed = fresh_path(spark, "test-kept"), fresh_path(spark, "test-kept")
    upsert(table(rows), plain, ["k"])
    upsert_buckets(table(rows), bucketed, ["k"], 4)
    twice = table([("a", 1), ("a", 2)])
    with pytest.raises(ValueError):
        upsert(twice, plain, ["k"])
    with pytest.raises(ValueError):
        upsert_buckets(twice, bucketed, ["k"], 4)
    assert read_upserted(spark, plain).count() == read_buckets(spark, bucketed).count() == 200
    with pytest.raises(FileNotFoundError):
        read_upserted(spark, fresh_path(spark, "test-kept"))
