"""Job runner: one command per report, source and sink (spark-submit friendly).

    spark-submit --py-files keyfold.zip keyfold/jobs.py report --report district_stats \
        --source text --path hdfs:///in/listings --sink filetable --target hdfs:///out/district_stats
    python -m keyfold.jobs report --report orientation_focus_count --stream \
        --source kafka --bootstrap broker:9092 --topic listings \
        --max-offsets-per-trigger 1000000 --rocksdb --checkpoint hdfs:///streams/focus \
        --sink jdbc --url jdbc:mysql://db/rollups --table orientation_focus_count
    python -m keyfold.jobs running --report neighborhood_avg_price --path hdfs:///in/listings \
        --target hdfs:///out/running --checkpoint hdfs:///streams/running
    python -m keyfold.jobs bookings --path hdfs:///in/bookings --target hdfs:///out/bookings
    python -m keyfold.jobs generate --rows 102400 --path hdfs:///in/listings
    python -m keyfold.jobs lines-to-kafka --path hdfs:///in/listings --bootstrap b:9092 --topic t

Credentials for JDBC come from ``--user`` / the ``KEYFOLD_JDBC_PASSWORD``
environment variable of the submitting process, never from code.
"""

from __future__ import annotations

import argparse
import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from keyfold.operators.parse import apply_on_bad, parse_bookings, parse_listing_rows
from keyfold.plans.checked import checked_report
from keyfold.plans.reports import REPORTS, booking_reports, run_report
from keyfold.plans.running import running_report_sink
from keyfold.schema import LISTING_COLUMNS, keys_of
from keyfold.session import ensure_checkpoint_dir
from keyfold.sinks.batches import upsert, upsert_sink
from keyfold.sinks.files import bucket_sink, upsert_buckets, write_parquet
from keyfold.sinks.jdbc import append_jdbc, jdbc_batch_sink, upsert_jdbc
from keyfold.sinks.kafka import write_kafka_lines
from keyfold.sources.fixtures import header_for, write_with_headers
from keyfold.sources.jdbc import read_jdbc, read_jdbc_split, split_predicates
from keyfold.sources.kafka import read_kafka_lines
from keyfold.sources.synth import synth_listings_range, to_listing_lines
from keyfold.sources.text import read_lines, stream_lines, with_place
from keyfold.streaming.running import start_running_stream
from keyfold.streaming.upsert import start_upsert_stream, use_rocksdb_state


def _jdbc_props(args) -> dict:
    props = {}
    if args.user:
        props["user"] = args.user
    password = os.environ.get("KEYFOLD_JDBC_PASSWORD")
    if password:
        props["password"] = password
    if args.driver:
        props["driver"] = args.driver
    return props


def _jdbc_read(args) -> dict:
    """How a listing table is read: by ranges of ``--partition-column``, one
    connection each, or as one query over one connection."""
    cols = [c for c in LISTING_COLUMNS if c != "id"]
    props = _jdbc_props(args)
    if not args.partition_column:
        return {"query": f"SELECT {', '.join(cols)} FROM {args.source_table}", **props}
    if args.partition_column not in cols:
        cols.append(args.partition_column)
    return {"table": f"(SELECT {', '.join(cols)} FROM {args.source_table}) listing_rows",
            "partition_column": args.partition_column, "lower_bound": args.lower_bound,
            "upper_bound": args.upper_bound, "num_partitions": args.num_partitions, **props}


def _split_rows(spark: SparkSession, args) -> DataFrame:
    """The listing table in parts planned from the values of ``--split-column``."""
    cols = [c for c in dict.fromkeys([args.split_column, args.split_then]) if c]
    props = _jdbc_props(args)
    values = read_jdbc(spark, args.url, query=f"SELECT {', '.join(cols)} FROM {args.source_table}", **props)
    plan = split_predicates(values.persist(), args.split_column, args.num_partitions, then=args.split_then)
    return read_jdbc_split(spark, args.url, args.source_table, plan, props)


def _source(spark: SparkSession, args, stream: bool) -> DataFrame:
    """Raw lines (``value``) or, for a JDBC listing table, typed listing rows."""
    if args.source == "text":
        if stream:
            return stream_lines(spark, args.path, args.max_files_per_trigger)
        return read_lines(spark, args.path)
    if args.source == "kafka":
        limits = {"maxOffsetsPerTrigger": args.max_offsets_per_trigger} if stream and args.max_offsets_per_trigger else {}
        return read_kafka_lines(spark, args.bootstrap, args.topic, stream=stream,
                                min_partitions=args.min_partitions, extra=limits)
    if args.source == "jdbc":
        if stream:
            raise SystemExit("a JDBC table is a bounded source: drop --stream")
        rows = _split_rows(spark, args) if args.split_column else read_jdbc(spark, args.url, **_jdbc_read(args))
        return parse_listing_rows(rows, on_bad=args.on_bad)
    raise SystemExit(f"unknown source {args.source}")


def _result(args, src: DataFrame) -> DataFrame:
    report = REPORTS[args.report]
    if args.source == "jdbc":
        if report.kind != "listing":
            raise SystemExit("the JDBC source holds listings")
        cols = list(report.needed) or ["title"]
        return report.build(apply_on_bad(src.select(*cols), report.needed, args.on_bad))
    return run_report(args.report, src, args.on_bad, **_parse_opts(args))


def _parse_opts(args) -> dict:
    if REPORTS[args.report].kind == "booking":
        return {"dialect": args.dialect}
    return {"strip_thousands": args.strip_thousands}


def _batch_sink(args):
    keys = keys_of(args.report)
    if args.sink == "filetable":
        return bucket_sink(args.target, keys, args.buckets) if args.buckets else upsert_sink(args.target, keys)
    if args.sink == "jdbc":
        return jdbc_batch_sink(args.url, args.table or args.report, keys, dialect=args.dialect_sql,
                               properties=_jdbc_props(args))
    if args.sink == "parquet":
        def sink(batch: DataFrame, batch_id: int) -> None:
            write_parquet(batch, args.target)
        return sink
    raise SystemExit(f"unknown sink {args.sink}")


def run_report_job(spark: SparkSession, args) -> object:
    """Run one report; returns the streaming query (``--stream``) or None."""
    # Refuse impossible combinations before touching any source.
    if args.source == "jdbc" and REPORTS[args.report].kind != "listing":
        raise SystemExit("the JDBC source holds listings")
    if args.stream and args.sink == "parquet":
        raise SystemExit("a stream upserts: use --sink filetable or jdbc")
    if args.stream and not (args.checkpoint or args.target):
        raise SystemExit("a stream without --target needs --checkpoint")
    if args.partition_column and None in (args.lower_bound, args.upper_bound, args.num_partitions):
        raise SystemExit("--partition-column needs --lower-bound, --upper-bound and --num-partitions")
    if args.split_column and (args.source != "jdbc" or args.num_partitions is None):
        raise SystemExit("--split-column needs --source jdbc and --num-partitions")
    if args.rejects and (args.stream or args.source == "jdbc" or args.on_bad != "quarantine"):
        raise SystemExit("--rejects needs lines, a batch and --on-bad quarantine")
    ensure_checkpoint_dir(spark)
    if args.stream and args.rocksdb:
        use_rocksdb_state(spark)
    if args.rejects:
        found = checked_report(args.report, _source(spark, args, False), **_parse_opts(args))
        write_parquet(found.rejects, args.rejects)
        print(f"{found.lines} lines, {found.rejected} rejected: {found.reasons}")
        return _store(args, found.result)
    result = _result(args, _source(spark, args, args.stream))
    if args.stream:
        if args.sink == "parquet":
            raise SystemExit("a stream upserts: use --sink filetable or jdbc")
        checkpoint = args.checkpoint or f"{args.target}/_checkpoint"
        q = start_upsert_stream(result, _batch_sink(args), checkpoint,
                                available_now=args.available_now,
                                processing_time=None if args.available_now else args.trigger,
                                state_partitions=args.state_partitions)
        if args.await_termination:
            q.awaitTermination()
        return q
    return _store(args, result)


def _store(args, result: DataFrame) -> None:
    if args.sink == "parquet":
        write_parquet(result, args.target)
    elif args.sink == "filetable":
        if args.buckets:
            upsert_buckets(result, args.target, keys_of(args.report), args.buckets)
        else:
            upsert(result, args.target, keys_of(args.report))
    elif args.sink == "jdbc":
        upsert_jdbc(result, args.url, args.table or args.report, keys_of(args.report),
                    dialect=args.dialect_sql, properties=_jdbc_props(args))


def running_job(spark: SparkSession, args):
    """A report's running value for every line, as files arrive."""
    ensure_checkpoint_dir(spark)
    placed = with_place(stream_lines(spark, args.path, args.max_files_per_trigger))
    sink = running_report_sink(args.report, args.target, args.on_bad, **_parse_opts(args))
    query = start_running_stream(placed, sink, args.checkpoint, available_now=args.available_now, processing_time=args.trigger)
    if args.available_now:
        query.awaitTermination()
    return query


def bookings_job(spark: SparkSession, args) -> None:
    """All booking reports from one scan, a folder each (``report=<table>``)."""
    rows = parse_bookings(read_lines(spark, args.path), on_bad="fail", dialect=args.dialect)
    write_parquet(booking_reports(rows), args.target, partition_by=["report"])


def generate_job(spark: SparkSession, args) -> None:
    """S5 + K2: synthetic listings as text lines, or appended to a JDBC table."""
    rows = synth_listings_range(spark, args.rows, seed=args.seed, date=args.date)
    if args.url:
        append_jdbc(rows.drop("id"), args.url, args.table or "listings", batchsize=1000,
                    properties=_jdbc_props(args))
    else:
        write_with_headers(spark, to_listing_lines(rows), header_for("listing"), args.path,
                           n_files=args.files)


def lines_to_kafka_job(spark: SparkSession, args) -> None:
    """K3: every line of the files, null key, to a topic (written by the tasks)."""
    write_kafka_lines(read_lines(spark, args.path), args.bootstrap, args.topic)


def build_parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="keyfold.jobs")
    sub = p.add_subparsers(dest="command", required=True)

    r = sub.add_parser("report", help="run one report (J1-J14)")
    r.add_argument("--report", required=True, choices=sorted(REPORTS))
    r.add_argument("--source", required=True, choices=["text", "kafka", "jdbc"])
    r.add_argument("--path")
    r.add_argument("--bootstrap")
    r.add_argument("--topic")
    r.add_argument("--url")
    r.add_argument("--source-table", default="listings")
    r.add_argument("--partition-column", help="JDBC: read the table in ranges of this column")
    r.add_argument("--lower-bound", type=int)
    r.add_argument("--upper-bound", type=int)
    r.add_argument("--num-partitions", type=int, help="JDBC: number of ranges, one connection each")
    r.add_argument("--min-partitions", type=int, help="Kafka: at least so many tasks a batch")
    r.add_argument("--max-offsets-per-trigger", type=int, help="Kafka: most records a micro-batch takes")
    r.add_argument("--rocksdb", action="store_true", help="stream: keep state in RocksDB, not on the heap")
    r.add_argument("--sink", required=True, choices=["parquet", "filetable", "jdbc"])
    r.add_argument("--target", help="output path (parquet / filetable)")
    r.add_argument("--table", help="JDBC result table (default: the report name)")
    r.add_argument("--dialect-sql", default="mysql", help="JDBC merge dialect")
    r.add_argument("--user")
    r.add_argument("--driver")
    r.add_argument("--buckets", type=int, help="filetable: partitions by a hash of the key; an upsert replaces the touched ones only")
    r.add_argument("--on-bad", default="fail", choices=["fail", "null", "quarantine"])
    r.add_argument("--dialect", default="plain", choices=["plain", "quoted"],
                   help="booking line dialect")
    r.add_argument("--strip-thousands", action="store_true")
    r.add_argument("--stream", action="store_true")
    r.add_argument("--available-now", action="store_true",
                   help="stream: process what is there, then stop")
    r.add_argument("--trigger", default="10 seconds")
    r.add_argument("--checkpoint")
    r.add_argument("--state-partitions", type=int)
    r.add_argument("--max-files-per-trigger", type=int)
    r.add_argument("--await-termination", action="store_true", default=True)
    r.add_argument("--no-await", dest="await_termination", action="store_false")

    r.add_argument("--split-column", help="JDBC: plan the parts from this column's values (skewed, text, null)")
    r.add_argument("--split-then", help="JDBC: cuts values of --split-column that have too many rows")
    r.add_argument("--rejects", help="folder for the lines that quarantine leaves out, with reasons")

    n = sub.add_parser("running", help="a report's running value for every line, on a stream of files")
    n.add_argument("--report", required=True, choices=sorted(REPORTS))
    n.add_argument("--path", required=True)
    n.add_argument("--target", required=True)
    n.add_argument("--checkpoint", required=True)
    n.add_argument("--on-bad", default="fail", choices=["fail", "null", "quarantine"])
    n.add_argument("--dialect", default="plain", choices=["plain", "quoted"])
    n.add_argument("--strip-thousands", action="store_true")
    n.add_argument("--available-now", action="store_true")
    n.add_argument("--trigger", default="10 seconds")
    n.add_argument("--max-files-per-trigger", type=int)

    b = sub.add_parser("bookings", help="all booking reports (J6-J10) from one scan")
    b.add_argument("--path", required=True)
    b.add_argument("--target", required=True)
    b.add_argument("--dialect", default="plain", choices=["plain", "quoted"])

    g = sub.add_parser("generate", help="synthetic listings (S5) to text or JDBC")
    g.add_argument("--rows", type=int, default=(200 * 1024 * 1024) // (2 * 1024))
    g.add_argument("--seed", type=int, default=42)
    g.add_argument("--date", default=None, help="yyyy-MM-dd (default: today)")
    g.add_argument("--path")
    g.add_argument("--files", type=int)
    g.add_argument("--url")
    g.add_argument("--table")
    g.add_argument("--user")
    g.add_argument("--driver")

    k = sub.add_parser("lines-to-kafka", help="text lines to a Kafka topic (K3)")
    k.add_argument("--path", required=True)
    k.add_argument("--bootstrap", required=True)
    k.add_argument("--topic", required=True)
    return p


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None):
    args = build_parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName(f"keyfold-{args.command}").getOrCreate()
    if args.command == "report":
        return run_report_job(spark, args)
    if args.command == "running":
        return running_job(spark, args)
    if args.command == "bookings":
        return bookings_job(spark, args)
    if args.command == "generate":
        return generate_job(spark, args)
    return lines_to_kafka_job(spark, args)


if __name__ == "__main__":
    main()
