"""Registered queries (one per operator group of the survey) and their oracles.

Every query reads the given tables (or lines Spark renders from them), so its
work grows with them.  Column names match the oracle SQL exactly.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keyfold import fs
from keyfold.functions.text import digits_or_zero, round2
from keyfold.operators.agg import word_count
from keyfold.operators.exact import exact_running_by, exact_sums
from keyfold.operators.parse import bad_rows, parse_bookings, parse_listing_rows, parse_listings
from keyfold.operators.partials import merged, partials
from keyfold.operators.running import latest_by, running_by
from keyfold.plans.checked import checked_report
from keyfold.plans.reports import booking_reports, neighborhood_avg_price, run_report
from keyfold.plans.running import latest_report, read_running_report, running_report, running_report_sink
from keyfold.schema import LISTING_COLUMNS, keys_of
from keyfold.session import ensure_checkpoint_dir, fresh_path
from keyfold.sinks.batches import read_upserted, upsert, upsert_sink
from keyfold.sinks.files import bucket_sink, read_buckets, upsert_buckets, write_parquet
from keyfold.sources.fixtures import (
    ORDER_COLUMNS, fixture_lines, fixture_path, header_for, line_for, listing_rows, with_headers, write_lines, write_with_headers,
)
from keyfold.sources.jdbc import split_predicates
from keyfold.sources.synth import synth_listings
from keyfold.sources.text import FILE, read_lines, read_numbered_lines, stream_lines, with_place
from keyfold.streaming.running import LINE, start_running_stream
from keyfold.streaming.state import carrying, state_totals
from keyfold.streaming.upsert import run_report_stream, start_upsert_stream


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _lines(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    ensure_checkpoint_dir(spark)
    return fixture_lines(spark, sf_dir.rstrip("/"), kind)


def _report(table: str, kind: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return run_report(table, _lines(spark, sf_dir, kind))
    run.__name__ = table
    return run


j1_district_stats = _report("district_stats", "listing")
j2_neighborhood_avg_price = _report("neighborhood_avg_price", "listing")
j3_year_avg_elevator_ratio = _report("year_avg_elevator_ratio", "listing")
j4_orientation_focus = _report("orientation_focus_count", "listing")
j5_title_word_count = _report("word_count", "listing")
j6_hotel_statistics = _report("hotel_statistics", "booking")
j7_monthly_booking_counts = _report("monthly_booking_counts", "booking")
j8_country_statistics = _report("country_statistics", "booking")
j9_booking_method_statistics = _report("booking_method_statistics", "booking")
j10_monthly_avg_adr = _report("monthly_avg_adr", "booking")


def a11_document_word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A11 over whole document texts (high-cardinality word keys)."""
    # Parquet splits by row group; a few big row groups would leave cores idle.
    return word_count(_table(spark, sf_dir, "documents"), "text", spread_input=True)


def _running_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _table(spark, sf_dir, "events").select(
        "event_id", "user_id", F.col("value").cast("decimal(18,2)").alias("v"))
    run = running_by(ev, "user_id", "event_id", sums={"running_sum": F.col("v")},
                     count="running_count")
    return run.select(
        "event_id", "user_id",
        round2(F.col("running_sum").cast("double") / F.col("running_count")).alias("running_mean"),
        "running_count")


def a9_running_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-event running mean and count of the user's values so far."""
    return _running_mean(spark, sf_dir)


def a10_latest_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A10 over A9: the last running row per user equals the plain aggregate."""
    last = latest_by(_running_mean(spark, sf_dir), "user_id", "event_id",
                     ["running_mean", "running_count"])
    return last.select("user_id", F.col("running_mean").alias("avg_value"),
                       F.col("running_count").alias("count"))


def _running_listing(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    rows = parse_listings(_lines(spark, sf_dir, "listing"))
    rows = rows.withColumn("id", F.col("id").cast("bigint"))
    return running_report(table, rows, "id")


def a9_running_neighborhood_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A9 on J2: each listing line's neighborhood mean and count so far (by id)."""
    return _running_listing(spark, sf_dir, "neighborhood_avg_price")


def a10_latest_neighborhood_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A10 on the running J2: the last running row per key is the batch J2."""
    run = _running_listing(spark, sf_dir, "neighborhood_avg_price")
    return latest_report(run, "neighborhood_avg_price", "id")


def a10_latest_title_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A10 on the running J5, stored and read back: the batch word count."""
    path = write_parquet(_running_listing(spark, sf_dir, "word_count"), fresh_path(spark, "results", "a10-words"))
    return latest_report(spark.read.parquet(path), "word_count", "id")


def a9_running_focus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A9 on J4: followers and listings of each line's orientation so far (by id)."""
    return _running_listing(spark, sf_dir, "orientation_focus_count")


def a9_running_year_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A9 on J3: mean ratio and listings of each line's year so far (by id)."""
    return _running_listing(spark, sf_dir, "year_avg_elevator_ratio")


def a9_running_title_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A9 on J5: how often each title word has been seen so far (by id)."""
    return _running_listing(spark, sf_dir, "word_count")


def _running_booking(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    # Booking lines hold no id; the order's key numbers them.
    orders = _table(spark, sf_dir, "orders").select(*ORDER_COLUMNS)
    lines = orders.select(line_for("booking").alias("value"), F.col("o_orderkey").alias("seq"))
    ensure_checkpoint_dir(spark)
    return running_report(table, parse_bookings(lines, keep=["seq"]), "seq")


def a9_running_hotel_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A9 on J6: bookings, cancellations and nights of each line's hotel type so far."""
    return _running_booking(spark, sf_dir, "hotel_statistics")


def a9_running_monthly_bookings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A9 on J7: kept bookings of each line's month and hotel type so far."""
    return _running_booking(spark, sf_dir, "monthly_booking_counts")


def a9_running_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A9 over few keys in many ranges: every key goes on from range to range.

    The order column is a timestamp that several events may share.
    """
    ev = _table(spark, sf_dir, "events").select(
        "event_id", "event_type", "ts", F.col("value").cast("decimal(18,2)").alias("v"))
    run = running_by(ev, "event_type", "ts", sums={"running_sum": F.col("v")}, count="running_count",
                     tiebreak=["event_id"], partitions=64)
    return run.select("event_id", "event_type", F.col("running_sum").cast("double").alias("running_sum"),
                      "running_count")


def _unclean_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing lines, every eleventh with a price that is no number."""
    orders = _table(spark, sf_dir, "orders").select(*ORDER_COLUMNS)
    price = F.when(F.col("o_orderkey") % 11 == 0, F.lit("\"面议\"")).otherwise(F.lit("$0"))
    lines = orders.select(F.regexp_replace(line_for("listing"), F.lit('"[0-9.]+元/平"'), price).alias("value"))
    ensure_checkpoint_dir(spark)
    return read_lines(spark, write_with_headers(spark, lines, header_for("listing"),
                                                fresh_path(spark, "unclean", "listing")))


def p15_quarantined_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J2 with lines left out whose price can't be read."""
    return run_report("neighborhood_avg_price", _unclean_lines(spark, sf_dir), on_bad="quarantine")


def p15_bad_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines that the quarantine leaves out, as written."""
    return bad_rows(_unclean_lines(spark, sf_dir), "listing", ["neighborhood", "unit_price"])


def j6_quoted_hotels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J6 over booking lines whose hotel names hold a comma, ``quoted`` dialect."""
    orders = _table(spark, sf_dir, "orders").select(*ORDER_COLUMNS)
    lines = orders.select(F.regexp_replace(line_for("booking"), " Hotel", ", Hotel").alias("value"))
    return run_report("hotel_statistics", lines, dialect="quoted")


def j11_rows_neighborhood_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J11's path: J2 over named listing rows (a database table's shape) whose
    unit prices carry thousands separators; read here from Spark-derived rows
    instead of a database (none may be started in this environment)."""
    orders = _table(spark, sf_dir, "orders").select(*ORDER_COLUMNS)
    return neighborhood_avg_price(parse_listing_rows(listing_rows(orders)))


def p7_thousands_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unit prices written with thousands separators, parsed back."""
    rows = parse_listings(_lines(spark, sf_dir, "listing_thousands"),
                          strip_thousands=True, price_type="double")
    return rows.select(F.col("id").cast("bigint").alias("o_orderkey"), "unit_price")


def p8_digits_or_zero(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digits of a free-text field as int, 0 when none."""
    ev = _table(spark, sf_dir, "events")
    return ev.select("event_id", digits_or_zero(F.col("props")).alias("k"))


def _state_partitions(spark: SparkSession) -> int:
    # Result tables here have at most a few hundred thousand keys: one state
    # store per core is plenty; a cluster deployment sizes this to its state.
    return spark.sparkContext.defaultParallelism


def _stream_into_table(spark: SparkSession, table: str, source: str, files_per_trigger: int,
                       checkpoint: str, out: str) -> None:
    lines = stream_lines(spark, source, max_files_per_trigger=files_per_trigger)
    q = run_report_stream(table, lines, upsert_sink(out, keys_of(table)), checkpoint, available_now=True,
                          state_partitions=_state_partitions(spark))
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(f"stream {table} failed: {q.exception()}")


def _stream_report(table: str, kind: str) -> Callable[[SparkSession, str], DataFrame]:
    """Report as a stream over the rendered files (one file per micro-batch),
    upserted batch by batch into a table of files; returns the table."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ensure_checkpoint_dir(spark)
        src = fixture_path(spark, sf_dir.rstrip("/"), kind)
        out = fresh_path(spark, "tables", table)
        n_files = len([f for f in fs.list_files(spark, src) if not f.startswith(("_", "."))])
        per_trigger = max(1, n_files // 2)  # two micro-batches: an insert, then an upsert
        _stream_into_table(spark, table, src, per_trigger, fresh_path(spark, "streams", table), out)
        return read_upserted(spark, out)
    run.__name__ = f"{table}_stream"
    return run


j2_stream = _stream_report("neighborhood_avg_price", "listing")
j4_stream = _stream_report("orientation_focus_count", "listing")
j7_stream = _stream_report("monthly_booking_counts", "booking")


def j4_stream_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T4/T5: stream half of the lines, stop, add the rest, resume from the checkpoint."""
    ensure_checkpoint_dir(spark)
    table = "orientation_focus_count"
    orders = _table(spark, sf_dir, "orders").select(*ORDER_COLUMNS)
    src = fresh_path(spark, "stream-input", table)
    ckpt = fresh_path(spark, "streams", table)
    out = fresh_path(spark, "tables", table)
    half = F.pmod(F.col("o_orderkey"), F.lit(2)) == 0
    write_lines(spark, orders, "listing", f"{src}/part=a", where=half)
    per_trigger = 10_000  # one micro-batch per run; the second run resumes the first
    _stream_into_table(spark, table, f"{src}/*", per_trigger, ckpt, out)
    write_lines(spark, orders, "listing", f"{src}/part=b", where=~half)
    _stream_into_table(spark, table, f"{src}/*", per_trigger, ckpt, out)
    return read_upserted(spark, out)


def k5_stream_into_existing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream that goes on from the rows that batch jobs have upserted."""
    ensure_checkpoint_dir(spark)
    table = "orientation_focus_count"
    keys, old, out = keys_of(table), fresh_path(spark, "tables", table), fresh_path(spark, "tables", table)
    stale = run_report(table, _lines(spark, sf_dir, "listing")).withColumn("total_focus", F.lit(-1).cast("long"))
    for _ in range(4):
        upsert(stale, old, keys)
    upsert_sink(out, keys)(read_upserted(spark, old), -1)  # before the stream's first batch
    _stream_into_table(spark, table, fixture_path(spark, sf_dir.rstrip("/"), "listing"), 1_000,
                       fresh_path(spark, "streams", table), out)
    return read_upserted(spark, out)


def j2_fine_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J2 over unit prices with five decimals: summed as written, rounded once."""
    rows = listing_rows(_table(spark, sf_dir, "orders").select(*ORDER_COLUMNS))
    rows = rows.withColumn("unit_price", F.regexp_replace("unit_price", "(?=元)", "125"))
    return neighborhood_avg_price(parse_listing_rows(rows))


def a11_stream_word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T1 on a high-cardinality key: word counts of whole documents as a stream.

    Half of the documents arrive first, the rest later (two runs, one
    checkpoint); changed words are upserted into a table in hash buckets, of
    which a batch replaces only those that its words touch.
    """
    ensure_checkpoint_dir(spark)
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    src = fresh_path(spark, "stream-input", "documents")
    ckpt = fresh_path(spark, "streams", "word_count")
    out = fresh_path(spark, "tables", "word_count")
    half = F.pmod(F.col("doc_id"), F.lit(2)) == 0
    for part, cond in (("a", half), ("b", ~half)):
        # Several files per arrival, as a topic has several partitions.
        (docs.filter(cond).repartition(spark.sparkContext.defaultParallelism)
         .write.mode("overwrite").parquet(f"{src}/part={part}"))
        stream = spark.readStream.schema(docs.schema).parquet(f"{src}/*")
        q = start_upsert_stream(word_count(stream, "text"), bucket_sink(out, ["word"], 8), ckpt,
                                available_now=True, state_partitions=_state_partitions(spark))
        q.awaitTermination()
        if q.exception() is not None:
            raise RuntimeError(f"word count stream failed: {q.exception()}")
    return read_buckets(spark, out)


def k5_upsert_merge_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K5 on a table in hash buckets (only touched ones are replaced)."""
    return _k5(spark, sf_dir, buckets=4)


def k4_parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K4: J1's result written as parquet and read back."""
    path = write_parquet(j1_district_stats(spark, sf_dir), fresh_path(spark, "results", "k4"))
    return spark.read.parquet(path)


def k5_upsert_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K5: a file table holding early counts plus a retired key, upserted with full counts."""
    return _k5(spark, sf_dir, buckets=None)


def _k5(spark: SparkSession, sf_dir: str, buckets: int | None) -> DataFrame:
    ensure_checkpoint_dir(spark)
    ev = _table(spark, sf_dir, "events")
    early = (ev.filter(F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz"))
             .groupBy("event_type").agg(F.count(F.lit(1)).alias("n")))
    retired = spark.createDataFrame([("retired", 9)], "event_type string, n long")
    path, keys = fresh_path(spark, "tables", "k5"), ["event_type"]
    for rows in (early.unionByName(retired), ev.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))):
        if buckets:
            upsert_buckets(rows, path, keys, buckets)
        else:
            upsert(rows, path, keys)
    return read_buckets(spark, path) if buckets else read_upserted(spark, path)


def _running_orders(spark: SparkSession, sf_dir: str, part: int) -> DataFrame:
    """The listing lines of one of three arrivals, in files in the order of their ids."""
    orders = _table(spark, sf_dir, "orders").select(*ORDER_COLUMNS).filter(F.col("o_orderkey") % 3 == part)
    return (orders.repartitionByRange(4, "o_orderkey").sortWithinPartitions("o_orderkey")
            .select(line_for("listing").alias("value")))


def _running_stream(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """Lines arrive in three parts; the stream stops after each and goes on from
    its checkpoint.  A batch's lines count in the order of files and lines."""
    ensure_checkpoint_dir(spark)
    src, ckpt, out = (fresh_path(spark, kind, f"running-{table}") for kind in ("stream-input", "streams", "running"))
    for part in range(3):
        lines = _running_orders(spark, sf_dir, part)
        with_headers(lines, header_for("listing")).write.text(f"{src}/part={part}")
        placed = with_place(spark.readStream.text(f"{src}/*"))
        query = start_running_stream(placed, running_report_sink(table, out), ckpt)
        query.awaitTermination()
        if query.exception() is not None:
            raise RuntimeError(f"running stream {table} failed: {query.exception()}")
    return read_running_report(spark, table, out).withColumn("id", F.col("id").cast("bigint")).drop("batch", FILE, LINE)


def a9_stream_running_focus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T1 with A9 (J4): every line's orientation totals so far, on a stream."""
    return _running_stream(spark, sf_dir, "orientation_focus_count")


def a9_stream_running_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T2 with A9 (J2): every line's neighborhood mean and count so far, on a stream."""
    return _running_stream(spark, sf_dir, "neighborhood_avg_price")


def a9_stream_running_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T1 with A9 (J5): how often each title word has been seen so far, on a stream."""
    return _running_stream(spark, sf_dir, "word_count")


def a10_stream_latest_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T3 with A10: each user's last event by time, while events arrive out of order."""
    ensure_checkpoint_dir(spark)
    events = _table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "value")
    src, ckpt, out = (fresh_path(spark, kind, "latest") for kind in ("stream-input", "streams", "tables"))
    for part in (1, 0, 2):  # every arrival has events of the whole time
        events.filter(F.pmod(F.xxhash64("event_id"), F.lit(3)) == part).write.parquet(f"{src}/part={part}")
        stream = spark.readStream.schema(events.schema).parquet(f"{src}/*")
        latest = latest_by(stream, "user_id", ["ts", "event_id"], ["event_id", "value"])
        query = start_upsert_stream(latest, upsert_sink(out, ["user_id"]), ckpt, available_now=True, state_partitions=_state_partitions(spark))
        query.awaitTermination()
        if query.exception() is not None:
            raise RuntimeError(f"latest stream failed: {query.exception()}")
    return read_upserted(spark, out)


@contextmanager
def _file_splits(spark: SparkSession, size: int) -> Iterator[None]:
    """Text files are read in splits of at most ``size`` bytes meanwhile."""
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, str(size))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def s1_line_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line's number in its file, the same for small and large splits."""
    ensure_checkpoint_dir(spark)
    orders = _table(spark, sf_dir, "orders").select(*ORDER_COLUMNS).withColumn("part", F.floor(F.col("o_orderkey") / 10_000))
    src = fresh_path(spark, "text", "numbered")
    # One file a part: a part's 10,000 keys are in one task, in order.
    (orders.repartition("part").sortWithinPartitions("part", "o_orderkey").select(line_for("listing").alias("value"), "part")
     .write.partitionBy("part").text(src))
    found = []
    for size in (1 << 16, 128 << 20):
        with _file_splits(spark, size):
            lines = read_numbered_lines(spark, f"{src}/part=*")
            ids = lines.select(F.regexp_extract(FILE, "part=([0-9]+)/", 1).cast("bigint").alias("part"), "line", F.regexp_extract("value", '^"([0-9]+)"', 1).cast("bigint").alias("id"))
            found.append(spark.read.parquet(write_parquet(ids, fresh_path(spark, "results", "numbered"))))
    small, large = found
    return small.join(large.withColumnRenamed("line", "line_unsplit"), ["part", "id"], "full").select("part", "id", "line", "line_unsplit")


_FINE = [(0, -60), (1, -40), (2, -20)]


def _fine_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with doubles of very different sizes: whole cents times 2**-60, 2**-40 or 2**-20."""
    scale = F.lit(0.0)
    for rest, power in _FINE:
        scale = F.when(F.col("event_id") % 3 == rest, F.lit(2.0 ** power)).otherwise(scale)
    cents = F.round(F.col("value") * 100).cast("bigint").cast("double")
    return _table(spark, sf_dir, "events").select("event_id", "event_type", "user_id", (cents * scale).alias("x"))


def a5_exact_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5/A6 over doubles: exact sums, rounded once, whatever the order of rows."""
    return exact_sums(_fine_events(spark, sf_dir), "event_type", F.col("x"), total="total")


def a9_exact_running_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A9 over doubles: exact running sums per user, rounded once per row."""
    run = exact_running_by(_fine_events(spark, sf_dir), "user_id", "event_id", F.col("x"), partitions=16)
    return run.select("event_id", "user_id", "running_sum", "running_count")


def j6_j10_one_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J6-J10 from one scan of the booking lines, by grouping sets."""
    return booking_reports(parse_bookings(_lines(spark, sf_dir, "booking")))


def _booking_deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bookings as three deltas: one half, all as kept; the other half; then
    the first half's cancelled ones taken back and put in again as cancelled."""
    rows = parse_bookings(_table(spark, sf_dir, "orders").select(line_for("booking").alias("value"), F.col("o_orderkey").alias("key")), keep=["key"])
    rows = rows.select(F.col("hotel").alias("hotel_type"), F.col("arrival_date_month").alias("month"), "is_canceled", "nights", "key")
    first = F.col("key") % 2 == 0
    kept = rows.withColumn("is_canceled", F.lit(0))
    late = rows.filter(first & (F.col("is_canceled") == 1))
    deltas = [kept.filter(first).withColumn("sign", F.lit(1)), rows.filter(~first).withColumn("sign", F.lit(1)),
              late.withColumn("is_canceled", F.lit(0)).withColumn("sign", F.lit(-1)).unionByName(late.withColumn("sign", F.lit(1)))]
    path = fresh_path(spark, "deltas", "bookings")
    keys = ["hotel_type", "month"]
    for n, delta in enumerate(deltas):
        sums = {"canceled": (F.col("is_canceled") == 1).cast("bigint"), "kept": (F.col("is_canceled") == 0).cast("bigint"), "nights": F.col("nights").cast("bigint")}
        partials(delta, keys, sums, sign=F.col("sign")).write.parquet(f"{path}/batch={n}")
    return spark.read.parquet(path).drop("batch")


def a1_merged_hotel_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J6 from stored partial results, retractions among them (A1, A3, A4)."""
    ensure_checkpoint_dir(spark)
    found = merged(_booking_deltas(spark, sf_dir).drop("month"), "hotel_type")
    return found.select("hotel_type", F.col("rows").alias("booking_count"), F.col("canceled").alias("canceled_count"), F.col("nights").alias("actual_stay_count"))


def a3_merged_monthly_bookings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J7 from stored partial results: a month whose bookings were all cancelled later stays, with 0."""
    ensure_checkpoint_dir(spark)
    found = merged(_booking_deltas(spark, sf_dir), ["month", "hotel_type"])
    return found.select("month", "hotel_type", F.col("kept").alias("booking_count"))


def j4_stream_repartitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T4: a stream with 4 state partitions, taken on by one with 16."""
    ensure_checkpoint_dir(spark)
    table, keys, sums = "orientation_focus_count", ["orientation"], ["total_focus", "count"]
    orders = _table(spark, sf_dir, "orders").select(*ORDER_COLUMNS)
    src, out, first, second = (fresh_path(spark, kind, table) for kind in ("stream-input", "tables", "streams", "streams"))
    half = F.pmod(F.col("o_orderkey"), F.lit(2)) == 0
    for part, cond in (("a", half), ("b", ~half)):
        write_lines(spark, orders, "listing", f"{src}/part={part}", where=cond)
    sink = upsert_sink(f"{out}/first", keys)
    run_report_stream(table, stream_lines(spark, f"{src}/part=a"), sink, first, state_partitions=4).awaitTermination()
    totals = write_parquet(state_totals(spark, first, keys, {"total_focus": 0, "count": 1}), f"{out}/totals")
    # The old stream's rows are where the new one's upserts start.
    begin = upsert_sink(f"{out}/second", keys)
    begin(read_upserted(spark, f"{out}/first"), -1)
    carried = carrying(begin, totals, keys, sums)
    run_report_stream(table, stream_lines(spark, f"{src}/part=b"), carried, second, state_partitions=16).awaitTermination()
    return read_upserted(spark, f"{out}/second")


def _defective_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing lines, some with a price that is no number, some cut off after three fields."""
    orders = _table(spark, sf_dir, "orders").select(*ORDER_COLUMNS)
    line, key = line_for("listing"), F.col("o_orderkey")
    no_price = F.regexp_replace(line, F.lit('"[0-9.]+元/平"'), F.lit('"面议"'))
    cut = F.substring_index(line, ",", 4)  # the title holds a comma
    lines = orders.select(F.when(key % 13 == 0, cut).when(key % 11 == 0, no_price).otherwise(line).alias("value"))
    ensure_checkpoint_dir(spark)
    return read_lines(spark, write_with_headers(spark, lines, header_for("listing"), fresh_path(spark, "defective", "listing")))


def p15_checked_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J2 of the readable lines, from the pass that also counts and keeps the rest."""
    return checked_report("neighborhood_avg_price", _defective_lines(spark, sf_dir)).result


def p15_reason_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many lines lack a value for which reason, counted in the report's own pass."""
    found = checked_report("neighborhood_avg_price", _defective_lines(spark, sf_dir))
    counts = [*found.reasons.items(), ("lines", found.lines), ("rejected", found.rejected)]
    return spark.createDataFrame(counts, "reason string, lines long")


def p15_rejected_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rejected lines as written, with all their reasons."""
    found = checked_report("neighborhood_avg_price", _defective_lines(spark, sf_dir))
    return found.rejects.select("value", F.array_join("reasons", ",").alias("reasons"))


def s4_split_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many parts of a split plan hold each row, of a skewed, textual,
    partly null column, and whether the largest part is at most twice the mean."""
    key = F.col("o_orderkey")
    code = F.when(key % 3 == 0, F.lit("it's hot")).when(key % 5 == 0, F.lit(None)).otherwise(F.concat(F.lit("K"), (F.col("o_custkey") * key).cast("string")))
    rows = _table(spark, sf_dir, "orders").select("o_orderkey", code.alias("code"))
    plan = split_predicates(rows, "code", 12, then="o_orderkey")
    held = [F.coalesce(F.expr(p), F.lit(False)) for p in plan]
    sizes = rows.agg(*[F.count_if(h).alias(f"p{i}") for i, h in enumerate(held)])
    largest = F.greatest(*[F.col(f"p{i}") for i in range(len(plan))]) if len(plan) > 1 else F.col("p0")
    filled = sum((F.col(f"p{i}") > 0).cast("int") for i in range(len(plan)))
    balanced = sizes.select((largest * filled <= 2 * sum(F.col(f"p{i}") for i in range(len(plan)))).alias("balanced"))
    counted = rows.select("o_orderkey", sum(h.cast("int") for h in held).alias("parts"))
    return counted.join(F.broadcast(balanced))  # one row


def s5_synth_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One synthetic listing per order key (deterministic for the seed)."""
    ids = _table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"))
    return synth_listings(ids)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "j1_district_stats": j1_district_stats,
    "j2_neighborhood_avg_price": j2_neighborhood_avg_price,
    "j3_year_avg_elevator_ratio": j3_year_avg_elevator_ratio,
    "j4_orientation_focus": j4_orientation_focus,
    "j5_title_word_count": j5_title_word_count,
    "a11_document_word_count": a11_document_word_count,
    "j6_hotel_statistics": j6_hotel_statistics,
    "j7_monthly_booking_counts": j7_monthly_booking_counts,
    "j8_country_statistics": j8_country_statistics,
    "j9_booking_method_statistics": j9_booking_method_statistics,
    "j10_monthly_avg_adr": j10_monthly_avg_adr,
    "a9_running_mean": a9_running_mean,
    "a10_latest_per_key": a10_latest_per_key,
    "a9_running_neighborhood_price": a9_running_neighborhood_price,
    "a10_latest_neighborhood_price": a10_latest_neighborhood_price,
    "a10_latest_title_words": a10_latest_title_words,
    "a9_running_focus": a9_running_focus,
    "a9_running_year_ratio": a9_running_year_ratio,
    "a9_running_title_words": a9_running_title_words,
    "a9_running_hotel_statistics": a9_running_hotel_statistics,
    "a9_running_monthly_bookings": a9_running_monthly_bookings,
    "a9_running_split": a9_running_split,
    "p15_quarantined_prices": p15_quarantined_prices,
    "p15_bad_rows": p15_bad_rows,
    "j6_quoted_hotels": j6_quoted_hotels,
    "j11_rows_neighborhood_price": j11_rows_neighborhood_price,
    "p7_thousands_price": p7_thousands_price,
    "p8_digits_or_zero": p8_digits_or_zero,
    "j2_stream": j2_stream,
    "j4_stream": j4_stream,
    "j7_stream": j7_stream,
    "j4_stream_resume": j4_stream_resume,
    "k4_parquet_roundtrip": k4_parquet_roundtrip,
    "k5_stream_into_existing": k5_stream_into_existing,
    "j2_fine_prices": j2_fine_prices,
    "k5_upsert_merge": k5_upsert_merge,
    "k5_upsert_merge_bucketed": k5_upsert_merge_bucketed,
    "a11_stream_word_count": a11_stream_word_count,
    "s5_synth_listings": s5_synth_listings,
    "a9_stream_running_focus": a9_stream_running_focus,
    "a9_stream_running_price": a9_stream_running_price,
    "a9_stream_running_words": a9_stream_running_words,
    "a10_stream_latest_value": a10_stream_latest_value,
    "s1_line_numbers": s1_line_numbers,
    "a5_exact_sums": a5_exact_sums,
    "a9_exact_running_sums": a9_exact_running_sums,
    "j6_j10_one_scan": j6_j10_one_scan,
    "a1_merged_hotel_statistics": a1_merged_hotel_statistics,
    "a3_merged_monthly_bookings": a3_merged_monthly_bookings,
    "j4_stream_repartitioned": j4_stream_repartitioned,
    "p15_checked_prices": p15_checked_prices,
    "p15_reason_counts": p15_reason_counts,
    "p15_rejected_lines": p15_rejected_lines,
    "s4_split_plan": s4_split_plan,
}

_HOTEL = "CASE WHEN o_custkey % 2 = 0 THEN 'City Hotel' ELSE 'Resort Hotel' END"
_MEAN2 = "CAST(printf('%.2f', {num} / count(*)) AS DOUBLE)"
_MONEY_SUM = "CAST(sum(CAST({c} AS DECIMAL(18,2))) AS DOUBLE)"

_J1 = "SELECT o_orderpriority AS district, count(*) AS house_count FROM orders GROUP BY 1"

ORACLE_SQL: dict[str, str] = {
    "j1_district_stats": _J1,
    "j2_neighborhood_avg_price":
        "SELECT 'N' || (o_custkey % 25) AS neighborhood, "
        + _MEAN2.format(num=_MONEY_SUM.format(c="o_totalprice")) + " AS avg_price, "
        "count(*) AS \"count\" FROM orders GROUP BY 1",
    "j3_year_avg_elevator_ratio":
        "SELECT CAST(year(o_orderdate) AS VARCHAR) AS year_built, "
        + _MEAN2.format(num="sum(CASE WHEN o_orderkey % 7 = 0 THEN 0.0::DOUBLE "
                            "ELSE (o_custkey % 2 + 1)::DOUBLE / (o_orderkey % 6 + 1) END)")
        + " AS avg_elevator_ratio, count(*) AS \"count\" FROM orders GROUP BY 1",
    "j4_orientation_focus":
        "SELECT (['南','北','东','西','东南','西南','东北','西北'])[CAST(o_custkey % 8 + 1 AS INTEGER)] "
        "AS orientation, CAST(sum(CASE WHEN o_orderkey % 10 = 0 THEN 0 ELSE o_orderkey % 1000 END) "
        "AS BIGINT) AS total_focus, count(*) AS \"count\" FROM orders GROUP BY 1",
    "j5_title_word_count":
        "SELECT w AS word, count(*) AS \"count\" FROM (SELECT unnest(regexp_split_to_array("
        "o_orderpriority || '，st,' || o_orderstatus, '[，\\s]+')) AS w FROM orders) "
        "WHERE w <> '' GROUP BY 1",
    "a11_document_word_count":
        "SELECT w AS word, count(*) AS \"count\" FROM (SELECT unnest(regexp_split_to_array("
        "text, '[，\\s]+')) AS w FROM documents) WHERE w <> '' GROUP BY 1",
    "j6_hotel_statistics":
        f"SELECT {_HOTEL} AS hotel_type, count(*) AS booking_count, "
        "CAST(sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS BIGINT) AS canceled_count, "
        "CAST(sum(o_orderkey % 14) AS BIGINT) AS actual_stay_count FROM orders GROUP BY 1",
    "j7_monthly_booking_counts":
        f"SELECT CAST(month(o_orderdate) AS INTEGER) AS month, {_HOTEL} AS hotel_type, "
        "CAST(sum(CASE WHEN o_orderstatus <> 'F' THEN 1 ELSE 0 END) AS BIGINT) AS booking_count "
        "FROM orders GROUP BY 1, 2",
    "j8_country_statistics":
        "SELECT 'C' || (o_custkey % 25) AS country, count(*) AS visitor_count FROM orders GROUP BY 1",
    "j9_booking_method_statistics":
        f"SELECT {_HOTEL} AS hotel_type, o_orderpriority AS booking_method, "
        "count(*) AS booking_count FROM orders GROUP BY 1, 2",
    "j10_monthly_avg_adr":
        "SELECT CAST(month(o_orderdate) AS INTEGER) AS month, "
        + _MEAN2.format(num=_MONEY_SUM.format(c="o_totalprice")) + " AS avg_adr FROM orders GROUP BY 1",
    "a9_running_mean":
        "SELECT event_id, user_id, CAST(printf('%.2f', CAST(sum(CAST(value AS DECIMAL(18,2))) OVER w "
        "AS DOUBLE) / count(*) OVER w) AS DOUBLE) AS running_mean, count(*) OVER w AS running_count "
        "FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)",
    "a10_latest_per_key":
        "SELECT user_id, " + _MEAN2.format(num=_MONEY_SUM.format(c="value"))
        + " AS avg_value, count(*) AS \"count\" FROM events GROUP BY 1",
    "a9_running_neighborhood_price":
        "SELECT o_orderkey AS id, 'N' || (o_custkey % 25) AS neighborhood, "
        "CAST(printf('%.2f', CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) OVER w AS DOUBLE) "
        "/ count(*) OVER w) AS DOUBLE) AS avg_price, count(*) OVER w AS \"count\" FROM orders "
        "WINDOW w AS (PARTITION BY o_custkey % 25 ORDER BY o_orderkey "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)",
    "p7_thousands_price":
        "SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS unit_price FROM orders",
    "p8_digits_or_zero":
        "SELECT event_id, COALESCE(TRY_CAST(regexp_replace(props, '[^0-9]', '', 'g') AS INTEGER), 0) "
        "AS k FROM events",
    "k4_parquet_roundtrip": _J1,
    "k5_upsert_merge":
        "SELECT event_type, count(*) AS n FROM events GROUP BY 1 "
        "UNION ALL SELECT 'retired', CAST(9 AS BIGINT)",
}
ORACLE_SQL["j2_stream"] = ORACLE_SQL["j2_neighborhood_avg_price"]
ORACLE_SQL["j11_rows_neighborhood_price"] = ORACLE_SQL["j2_neighborhood_avg_price"]
ORACLE_SQL["k5_upsert_merge_bucketed"] = ORACLE_SQL["k5_upsert_merge"]
ORACLE_SQL["a11_stream_word_count"] = ORACLE_SQL["a11_document_word_count"]
ORACLE_SQL["a10_latest_neighborhood_price"] = ORACLE_SQL["j2_neighborhood_avg_price"]
ORACLE_SQL["j4_stream"] = ORACLE_SQL["j4_orientation_focus"]
ORACLE_SQL["j7_stream"] = ORACLE_SQL["j7_monthly_booking_counts"]
ORACLE_SQL["j4_stream_resume"] = ORACLE_SQL["j4_orientation_focus"]
ORACLE_SQL["k5_stream_into_existing"] = ORACLE_SQL["j4_orientation_focus"]
ORACLE_SQL["j2_fine_prices"] = (
    "SELECT 'N' || (o_custkey % 25) AS neighborhood, "
    + _MEAN2.format(num="CAST(sum(CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DECIMAL(18,6)) + 0.00125) AS DOUBLE)")
    + " AS avg_price, count(*) AS \"count\" FROM orders GROUP BY 1")
ORACLE_SQL["a10_latest_title_words"] = ORACLE_SQL["j5_title_word_count"]
ORACLE_SQL["a9_running_focus"] = (
    "SELECT o_orderkey AS id, (['南','北','东','西','东南','西南','东北','西北'])[CAST(o_custkey % 8 + 1 AS INTEGER)] "
    "AS orientation, CAST(sum(CASE WHEN o_orderkey % 10 = 0 THEN 0 ELSE o_orderkey % 1000 END) OVER w "
    "AS BIGINT) AS total_focus, count(*) OVER w AS \"count\" FROM orders "
    "WINDOW w AS (PARTITION BY o_custkey % 8 ORDER BY o_orderkey "
    "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)")
_SO_FAR = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
# Ratios as sixtieths: households are 1 to 6, so the sums are whole numbers.
ORACLE_SQL["a9_running_year_ratio"] = (
    "SELECT id, year_built, CAST(printf('%.2f', CAST(sum(sixtieths) OVER w AS DOUBLE) / 60 / count(*) OVER w) "
    "AS DOUBLE) AS avg_elevator_ratio, count(*) OVER w AS \"count\" FROM (SELECT o_orderkey AS id, "
    "CAST(year(o_orderdate) AS VARCHAR) AS year_built, CASE WHEN o_orderkey % 7 = 0 THEN 0 "
    "ELSE (o_custkey % 2 + 1) * 60 // (o_orderkey % 6 + 1) END AS sixtieths FROM orders) "
    f"WINDOW w AS (PARTITION BY year_built ORDER BY id {_SO_FAR})")
# No title holds a word twice.
ORACLE_SQL["a9_running_title_words"] = (
    "SELECT id, word, count(*) OVER w AS \"count\" FROM (SELECT o_orderkey AS id, unnest(regexp_split_to_array("
    "o_orderpriority || '，st,' || o_orderstatus, '[，\\s]+')) AS word FROM orders) WHERE word <> '' "
    f"WINDOW w AS (PARTITION BY word ORDER BY id {_SO_FAR})")
ORACLE_SQL["a9_running_hotel_statistics"] = (
    "SELECT o_orderkey AS seq, hotel_type, count(*) OVER w AS booking_count, "
    "CAST(sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) OVER w AS BIGINT) AS canceled_count, "
    "CAST(sum(o_orderkey % 14) OVER w AS BIGINT) AS actual_stay_count "
    f"FROM (SELECT *, {_HOTEL} AS hotel_type FROM orders) "
    f"WINDOW w AS (PARTITION BY hotel_type ORDER BY o_orderkey {_SO_FAR})")
ORACLE_SQL["a9_running_monthly_bookings"] = (
    "SELECT o_orderkey AS seq, \"month\", hotel_type, "
    "CAST(sum(CASE WHEN o_orderstatus <> 'F' THEN 1 ELSE 0 END) OVER w AS BIGINT) AS booking_count "
    f"FROM (SELECT *, CAST(month(o_orderdate) AS INTEGER) AS \"month\", {_HOTEL} AS hotel_type FROM orders) "
    f"WINDOW w AS (PARTITION BY \"month\", hotel_type ORDER BY o_orderkey {_SO_FAR})")
ORACLE_SQL["a9_running_split"] = (
    "SELECT event_id, event_type, CAST(sum(CAST(value AS DECIMAL(18,2))) OVER w AS DOUBLE) AS running_sum, "
    "count(*) OVER w AS running_count FROM events "
    f"WINDOW w AS (PARTITION BY event_type ORDER BY ts NULLS FIRST, event_id {_SO_FAR})")
ORACLE_SQL["p15_quarantined_prices"] = ORACLE_SQL["j2_neighborhood_avg_price"].replace(
    "FROM orders", "FROM orders WHERE o_orderkey % 11 <> 0")
_UNCLEAN = {
    "id": "o_orderkey", "title": "o_orderpriority || '，st,' || o_orderstatus", "unit_price": "'面议'",
    "focus": "CASE WHEN o_orderkey % 10 = 0 THEN '暂无' ELSE (o_orderkey % 1000) || '人关注' END",
    "orientation": "(['南','北','东','西','东南','西南','东北','西北'])[CAST(o_custkey % 8 + 1 AS INTEGER)]",
    "year_built": "year(o_orderdate) || '年建'", "district": "o_orderpriority",
    "neighborhood": "'N' || (o_custkey % 25)",
    "elevator_ratio": "CASE WHEN o_orderkey % 7 = 0 THEN '暂无数据' "
                      "ELSE (o_custkey % 2 + 1) || '梯' || (o_orderkey % 6 + 1) || '户' END",
}
ORACLE_SQL["p15_bad_rows"] = (
    "SELECT " + " || ',' || ".join(f"'\"' || ({_UNCLEAN.get(c, chr(39) + 'x' + chr(39))}) || '\"'"
                                   for c in LISTING_COLUMNS)
    + " AS \"value\" FROM orders WHERE o_orderkey % 11 = 0")
ORACLE_SQL["j6_quoted_hotels"] = ORACLE_SQL["j6_hotel_statistics"].replace(" Hotel'", ", Hotel'")


def _synth_sql(seed: int = 42, date: str = "2024-12-01") -> str:
    """The S5 listings of ``orders`` in SQL, with value lists of its own."""
    def mixed(x: str) -> str:
        # Steps: xor with itself shifted by 16, multiply, shifted by 15, multiply, shifted by 15.
        return (f"list_reduce([({x})::BIGINT, 16, 569420461, 15, 1935289751, 15], lambda a, k: CASE WHEN k < 32 THEN xor(a, a >> k) "
                "ELSE (a * k) & 4294967295 END)")

    row = mixed(f"xor({mixed(f'xor(o_orderkey & 4294967295, {seed})')}, (o_orderkey >> 32) & 4294967295)")

    def draw(salt: int, n: int, base: int = 0) -> str:
        return f"({mixed(f'xor(bits, {salt * 2654435769 % 4294967296})')} % {n} + {base})"

    def pick(salt: int, values: str) -> str:
        words = values.split()
        return "([" + ", ".join(f"'{v}'" for v in words) + f"])[{draw(salt, len(words), 1)}]"

    columns = {
        "id": "o_orderkey",
        "title": pick(1, "高层朝南2房，拎包入住，采光充足，进岛首站 精装两室一厅，采光良好，地段优越 南北通透三室两厅，拎包入住 "
                         "两房一厅，经典户型，环境优美 小区绿化好，环境优美，物业管理也很规范 自住装修，采光通风好，视野好，进岛方便，高楼层看海 "
                         "此房朝南通透格局，楼层好视野宽阔，居住环境舒适 高层边套，景观视野良好，格局方正，采光好"),
        "url": f"'https://example.com/listing/' || {draw(2, 1_000_000, 1_000_000_000)}",
        "price": f"{draw(3, 50, 50)} || '万元'",
        "unit_price": f"{draw(4, 30_000)} || '元/平'",
        "focus": f"{draw(5, 1000)}::INTEGER",
        "layout": f"{draw(6, 5, 1)} || '室' || {draw(17, 3, 1)} || '厅'",
        "floor": f"{pick(7, '低楼层 中楼层 高楼层')} || '/共' || {draw(18, 20, 10)} || '层'",
        "orientation": pick(8, "南 北 东 西 东南 西南 东北 西北"),
        "decoration": pick(9, "精装 简装 毛坯"),
        "area": f"{draw(10, 80, 50)} || '平米'",
        "year_built": f"'20' || {draw(11, 10, 10)} || '年建'",
        "community": pick(12, "东坑安居房 禹洲卢卡小镇 东坑安居房 东坑安居房 滨水二里 黄金大厦 禹洲卢卡小镇 禹洲大学城 禹洲大学城 "
                              "桃源大厦 上东美地 恒丰花园 恒丰花园 恒丰花园 海晟维多利亚 厦门中央公园 莲花尚院"),
        "district": pick(13, "海沧 海沧 海沧 翔安 集美 集美 湖里 同安 同安 思明"),
        "neighborhood": pick(14, "滨海社区 滨海社区 滨海社区 新店 集美新城 杏林桥头 杏林桥头 翔安新城 邮轮城 邮轮城 江头 瑞景 南山路"),
        "elevator": pick(15, "有 无"),
        "elevator_ratio": f"{draw(16, 2, 1)} || '梯' || {draw(19, 6, 1)} || '户'",
        "post_date": f"'{date}'",
        "update_date": f"'{date}'",
    }
    return "SELECT " + ", ".join(f'{c} AS "{n}"' for n, c in columns.items()) + f" FROM (SELECT o_orderkey, {row} AS bits FROM orders)"


ORACLE_SQL["s5_synth_listings"] = _synth_sql()

ORACLE_SQL["a9_stream_running_focus"] = (
    "SELECT id, orientation, CAST(sum(focus) OVER w AS BIGINT) AS total_focus, count(*) OVER w AS \"count\" FROM ("
    "SELECT o_orderkey AS id, (['南','北','东','西','东南','西南','东北','西北'])[CAST(o_custkey % 8 + 1 AS INTEGER)] AS orientation, "
    "CASE WHEN o_orderkey % 10 = 0 THEN 0 ELSE o_orderkey % 1000 END AS focus FROM orders) "
    f"WINDOW w AS (PARTITION BY orientation ORDER BY id % 3, id {_SO_FAR})")
ORACLE_SQL["a9_stream_running_price"] = ORACLE_SQL["a9_running_neighborhood_price"].replace(
    "ORDER BY o_orderkey", "ORDER BY o_orderkey % 3, o_orderkey")
ORACLE_SQL["a9_stream_running_words"] = ORACLE_SQL["a9_running_title_words"].replace("ORDER BY id", "ORDER BY id % 3, id")
ORACLE_SQL["a10_stream_latest_value"] = (
    "SELECT user_id, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id "
    "ORDER BY ts DESC NULLS LAST, event_id DESC) AS nth FROM events) WHERE nth = 1")
ORACLE_SQL["s1_line_numbers"] = (
    "SELECT part, id, line, line AS line_unsplit FROM (SELECT o_orderkey // 10000 AS part, o_orderkey AS id, "
    "row_number() OVER (PARTITION BY o_orderkey // 10000 ORDER BY o_orderkey) AS line FROM orders)")
# As whole units of 2**-60: exact in integers, rounded by the one cast to double.
_UNITS = "CAST(round(value * 100) AS HUGEINT) * (CASE event_id % 3 WHEN 0 THEN 1 WHEN 1 THEN 1048576 ELSE 1099511627776 END)"
_EXACT = "CAST(CAST(sum({u}) {over} AS BIGINT) AS DOUBLE) / 1152921504606846976.0"
ORACLE_SQL["a5_exact_sums"] = (
    f"SELECT event_type, {_EXACT.format(u=_UNITS, over='')} AS total, count(*) AS \"count\" FROM events GROUP BY 1")
ORACLE_SQL["a9_exact_running_sums"] = (
    f"SELECT event_id, user_id, {_EXACT.format(u=_UNITS, over='OVER w')} AS running_sum, count(*) OVER w AS running_count "
    f"FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id {_SO_FAR})")
_BOOKED = {
    "hotel_type": f"({_HOTEL})", "month": "CAST(month(o_orderdate) AS INTEGER)",
    "country": "'C' || (o_custkey % 25)", "booking_method": "o_orderpriority",
    "booking_count": "count(*)", "canceled_count": "CAST(sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS BIGINT)",
    "actual_stay_count": "CAST(sum(o_orderkey % 14) AS BIGINT)",
    "kept_count": "CAST(sum(CASE WHEN o_orderstatus <> 'F' THEN 1 ELSE 0 END) AS BIGINT)",
    "visitor_count": "count(*)", "avg_adr": _MEAN2.format(num=_MONEY_SUM.format(c="o_totalprice")),
}


def _booking_sql(report: str, keys: list[str], values: list[str]) -> str:
    shown = ", ".join(f"{x if c in keys + values else 'NULL'} AS {c}" for c, x in _BOOKED.items())
    return f"SELECT '{report}' AS report, {shown} FROM orders GROUP BY " + ", ".join(_BOOKED[k] for k in keys)


ORACLE_SQL["j6_j10_one_scan"] = " UNION ALL ".join([
    _booking_sql("hotel_statistics", ["hotel_type"], ["booking_count", "canceled_count", "actual_stay_count"]),
    _booking_sql("monthly_booking_counts", ["month", "hotel_type"], ["kept_count"]),
    _booking_sql("country_statistics", ["country"], ["visitor_count"]),
    _booking_sql("booking_method_statistics", ["hotel_type", "booking_method"], ["booking_count"]),
    _booking_sql("monthly_avg_adr", ["month"], ["avg_adr"]),
])
ORACLE_SQL["a1_merged_hotel_statistics"] = ORACLE_SQL["j6_hotel_statistics"]
ORACLE_SQL["a3_merged_monthly_bookings"] = ORACLE_SQL["j7_monthly_booking_counts"]
ORACLE_SQL["j4_stream_repartitioned"] = ORACLE_SQL["j4_orientation_focus"]
ORACLE_SQL["p15_checked_prices"] = ORACLE_SQL["j2_neighborhood_avg_price"].replace(
    "FROM orders", "FROM orders WHERE o_orderkey % 11 <> 0 AND o_orderkey % 13 <> 0")
ORACLE_SQL["p15_reason_counts"] = (
    "SELECT reason, lines FROM (SELECT 'missing:neighborhood' AS reason, count(*) AS lines FROM orders WHERE o_orderkey % 13 = 0 "
    "UNION ALL SELECT 'missing:unit_price', count(*) FROM orders WHERE o_orderkey % 13 = 0 "
    "UNION ALL SELECT 'unreadable:unit_price', count(*) FROM orders WHERE o_orderkey % 13 <> 0 AND o_orderkey % 11 = 0) WHERE lines > 0 "
    "UNION ALL SELECT 'lines', count(*) FROM orders "
    "UNION ALL SELECT 'rejected', count(*) FROM orders WHERE o_orderkey % 13 = 0 OR o_orderkey % 11 = 0")
_DEFECTIVE = " || ',' || ".join(f"'\"' || ({_UNCLEAN.get(c, chr(39) + 'x' + chr(39))}) || '\"'" for c in LISTING_COLUMNS)
ORACLE_SQL["p15_rejected_lines"] = (
    "SELECT CASE WHEN o_orderkey % 13 = 0 THEN '\"' || o_orderkey || '\",\"' || o_orderpriority || '，st,' || o_orderstatus || '\",\"x\"' "
    f"ELSE {_DEFECTIVE} END AS \"value\", CASE WHEN o_orderkey % 13 = 0 THEN 'missing:neighborhood,missing:unit_price' "
    "ELSE 'unreadable:unit_price' END AS reasons FROM orders WHERE o_orderkey % 13 = 0 OR o_orderkey % 11 = 0")
ORACLE_SQL["s4_split_plan"] = "SELECT o_orderkey, 1 AS parts, true AS balanced FROM orders"
