"""The job runner: report jobs over text (batch and stream) into file sinks."""

from pyspark.sql import functions as F

from keyfold.jobs import main
from keyfold.plans import run_report
from keyfold.session import fresh_path
from keyfold.sinks.batches import read_upserted
from keyfold.sinks.files import read_buckets
from keyfold.sources.text import read_lines


def same(a, b):
    b = b.select(*a.columns)
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_generate_then_batch_and_stream_reports(spark):
    src = fresh_path(spark, "job-src")
    main(["generate", "--rows", "3000", "--date", "2024-12-01", "--path", src, "--files", "3"], spark)
    lines = read_lines(spark, src)
    assert lines.count() == 3003  # one header per file
    want = run_report("district_stats", lines)

    out = fresh_path(spark, "job-parquet")
    main(["report", "--report", "district_stats", "--source", "text", "--path", src,
          "--sink", "parquet", "--target", out], spark)
    assert same(spark.read.parquet(out), want)

    table = fresh_path(spark, "job-table")
    main(["report", "--report", "district_stats", "--source", "text", "--path", src,
          "--sink", "filetable", "--target", table, "--buckets", "4"], spark)
    assert same(read_buckets(spark, table), want)

    st = fresh_path(spark, "job-stream")
    q = main(["report", "--report", "district_stats", "--source", "text", "--path", src,
              "--sink", "filetable", "--target", st, "--stream", "--available-now",
              "--max-files-per-trigger", "1", "--state-partitions", "2"], spark)
    assert q.exception() is None
    assert same(read_upserted(spark, st), want)


def test_booking_job_with_quoted_dialect(spark):
    src = fresh_path(spark, "job-bookings")
    rows = [('"hotel","is_canceled"',), ('"City, Hotel",0,x,x,3,x,x,x,2,"C1","Direct",x,x,x,x,x,x,x,10.50',)]
    spark.createDataFrame(rows, "value string").coalesce(1).write.text(src)
    out = fresh_path(spark, "job-bookings-out")
    main(["report", "--report", "hotel_statistics", "--source", "text", "--path", src,
          "--dialect", "quoted", "--sink", "parquet", "--target", out], spark)
    r = spark.read.parquet(out).first()
    assert (r.hotel_type, r.booking_count, r.actual_stay_count) == ("City, Hotel", 1, 2)


def test_invalid_job_combinations_are_refused(spark):
    import pytest
    with pytest.raises(SystemExit):
        main(["report", "--report", "district_stats", "--source", "jdbc", "--url", "jdbc:x",
              "--sink", "parquet", "--target", "/nonexistent", "--stream"], spark)
    src = fresh_path(spark, "job-invalid")
    spark.createDataFrame([('"id"',)], "value string").write.text(src)
    with pytest.raises(SystemExit):
        main(["report", "--report", "district_stats", "--source", "text", "--path", src,
              "--sink", "parquet", "--target", fresh_path(spark, "x"), "--stream"], spark)
    with pytest.raises(SystemExit):
        main(["report", "--report", "hotel_statistics", "--source", "jdbc", "--url", "jdbc:x",
              "--sink", "parquet", "--target", "/nonexistent"], spark)


def _args(*more):
    from keyfold.jobs import build_parser
    return build_parser().parse_args(["report", "--report", "neighborhood_avg_price", "--sink", "jdbc", *more])


def test_jdbc_reads_in_ranges_when_asked():
    import pytest

    from keyfold.jobs import _jdbc_read
    from keyfold.sources.jdbc import jdbc_options
    base = ("--source", "jdbc", "--url", "jdbc:x", "--source-table", "houses")
    assert jdbc_options("jdbc:x", **_jdbc_read(_args(*base)))["query"].endswith("FROM houses")
    ranged = _args(*base, "--partition-column", "id", "--lower-bound", "0", "--upper-bound", "100", "--num-partitions", "8")
    opts = jdbc_options("jdbc:x", **_jdbc_read(ranged))
    assert opts["numPartitions"] == "8" and opts["partitionColumn"] == "id"
    assert opts["dbtable"].endswith("id FROM houses) listing_rows")
    with pytest.raises(SystemExit):
        main(["report", "--report", "neighborhood_avg_price", "--sink", "jdbc", *base, "--partition-column", "id"], object())


def test_kafka_limits_reach_the_source(spark, monkeypatch):
    from keyfold import jobs
    seen = {}
    monkeypatch.setattr(jobs, "read_kafka_lines", lambda *a, **kw: seen.update(kw))
    args = _args("--source", "kafka", "--bootstrap", "b:1", "--topic", "t", "--min-partitions", "64",
                 "--max-offsets-per-trigger", "1000")
    jobs._source(spark, args, stream=True)
    assert seen["min_partitions"] == 64 and seen["extra"] == {"maxOffsetsPerTrigger": 1000}
    jobs._source(spark, args, stream=False)  # a bounded read takes all
    assert seen["extra"] == {}


def test_every_upsert_has_a_staging_table_of_its_own(spark, monkeypatch):
    from keyfold.sinks import jdbc
    calls = []
    monkeypatch.setattr(jdbc, "append_jdbc", lambda df, url, table, **kw: calls.append(("write", table)))
    monkeypatch.setattr(jdbc, "execute_sql", lambda spark, url, statements, props=None: calls.extend(("sql", s) for s in statements))
    df = spark.createDataFrame([("a", 1)], "k string, n int")
    for _ in range(2):
        jdbc.upsert_jdbc(df, "jdbc:x", "t", ["k"])
    first, second = calls[0][1], calls[3][1]
    assert first != second and first.startswith("t_staging_")
    assert first in calls[1][1] and calls[2][1] == f"DROP TABLE {first}"
    jdbc.upsert_jdbc(df, "jdbc:x", "t", ["k"], staging="mine")
    assert calls[6] == ("write", "mine") and len(calls) == 8


def test_running_job_goes_on_after_a_stop(spark):
    from keyfold.plans.running import latest_report, read_running_report
    src, out, ckpt = (fresh_path(spark, "job-running", x) for x in "soc")
    command = ["running", "--report", "neighborhood_avg_price", "--path", f"{src}/*", "--target", out, "--checkpoint", ckpt, "--available-now"]
    for part, seed in (("a", "1"), ("b", "2")):
        main(["generate", "--rows", "500", "--seed", seed, "--date", "2024-12-01", "--path", f"{src}/part={part}", "--files", "2"], spark)
        assert main(command, spark).exception() is None
    rows = read_running_report(spark, "neighborhood_avg_price", out).withColumn("at", F.struct("batch", "_file", "_line"))
    assert rows.count() == 1000
    assert same(latest_report(rows, "neighborhood_avg_price", "at"), run_report("neighborhood_avg_price", read_lines(spark, f"{src}/*")))


def test_running_bookings_on_a_stream_end_with_the_report(spark):
    from keyfold.plans.running import latest_report, read_running_report, running_report_sink
    from keyfold.sources.text import with_place
    from tests.conftest import booking_line
    src, out = fresh_path(spark, "job-running-bookings"), fresh_path(spark, "job-running-bookings")
    for table in ("monthly_avg_adr", "hotel_statistics", "monthly_booking_counts"):
        for n in range(2):
            lines = [booking_line(hotel=f'"H{i % 3}"', adr=f"{i}.25", is_canceled=str(i % 2), nights=str(n)) for i in range(20)]
            spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("overwrite").text(f"{src}/{table}/{n}")
            running_report_sink(table, f"{out}/{table}")(with_place(spark.read.text(f"{src}/{table}/{n}")), n)
        rows = read_running_report(spark, table, f"{out}/{table}").withColumn("at", F.struct("batch", "_file", "_line"))
        assert rows.count() == 40 and same(latest_report(rows, table, "at"), run_report(table, read_lines(spark, f"{src}/{table}/*")))


def test_all_booking_reports_and_rejects(spark):
    from keyfold.plans.reports import one_report
    from tests.conftest import booking_line
    src, out, bad = (fresh_path(spark, "job-one-scan", x) for x in "sob")
    lines = [booking_line(hotel=f'"H{i % 3}"', country=f'"C{i % 2}"', adr=f"{i}.5") for i in range(30)]
    spark.createDataFrame([(x,) for x in lines], "value string").write.text(src)
    main(["bookings", "--path", src, "--target", out], spark)
    for table in ("hotel_statistics", "country_statistics", "monthly_avg_adr"):
        assert same(one_report(spark.read.parquet(out), table), run_report(table, read_lines(spark, src)))
    spark.createDataFrame([(x,) for x in [*lines, booking_line(adr="free")]], "value string").write.mode("overwrite").text(src)
    main(["report", "--report", "monthly_avg_adr", "--source", "text", "--path", src, "--sink", "parquet", "--target", f"{out}-adr",
          "--on-bad", "quarantine", "--rejects", bad], spark)
    assert [x.reasons for x in spark.read.parquet(bad).collect()] == [["unreadable:adr"]]
    assert same(spark.read.parquet(f"{out}-adr"), run_report("monthly_avg_adr", read_lines(spark, src), on_bad="quarantine"))
