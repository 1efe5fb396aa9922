"""Streams: a running value per row, order-aware latest values, state taken on by another query."""

import pytest
from pyspark.sql import functions as F

from keyfold import fs
from keyfold.operators.running import latest_by
from keyfold.session import fresh_path
from keyfold.sinks.batches import batch_path, batches, read_upserted, upsert_sink
from keyfold.sources.text import FILE, with_place
from keyfold.streaming.running import LINE, in_arrival_order, read_running, running_sink, start_running_stream
from keyfold.streaming.state import carrying, state_partitions, state_totals
from keyfold.streaming.upsert import start_upsert_stream

SCHEMA = "k string, n long, v long"


def running_in_python(parts):
    sums, out = {}, []
    for part in parts:
        for k, n, v in sorted(part, key=lambda x: x[1]):
            total, rows = sums.get(k, (None, 0))
            total = total if v is None else (total or 0) + v
            sums[k] = total, rows + 1
            out.append((k, n, v, total, rows + 1))
    return sorted(out, key=str)


PARTS = [[("a", 1, 5), (None, 2, 1), ("b", 3, None), ("a", 4, 5)], [("a", 1, -2), ("b", 9, None), (None, 3, 4)], [("c", 1, 1)], [("b", 1, 7), ("a", 2, 0), ("a", 3, None)]]


def sink_of(path):
    return running_sink(path, "k", "n", {"total": F.col("v")}, count="rows_so_far")


def rows_of(spark, path):
    return sorted(map(tuple, read_running(spark, path).select("k", "n", "v", "total", "rows_so_far").collect()), key=str)


def test_every_row_has_its_total_and_replays_change_nothing(spark):
    path, sink = fresh_path(spark, "test-running"), None
    for n, part in enumerate(PARTS):
        sink = sink_of(path)  # a restarted query has a sink of its own
        batch = spark.createDataFrame(part, SCHEMA)
        sink(batch, n)
        sink(batch, n)  # replayed: the batch was complete
    assert rows_of(spark, path) == running_in_python(PARTS)
    assert batches(spark, f"{path}/totals") == [2, 3]
    # Stopped after the rows and before the totals: the marker is missing, the batch comes again.
    fs.delete(spark, batch_path(f"{path}/totals", 3))
    assert rows_of(spark, path) == running_in_python(PARTS[:3])
    sink(spark.createDataFrame(PARTS[3], SCHEMA), 3)
    assert rows_of(spark, path) == running_in_python(PARTS)


def test_empty_batches(spark):
    path = fresh_path(spark, "test-running")
    none = spark.createDataFrame([], SCHEMA)
    for n, part in enumerate((none, spark.createDataFrame(PARTS[0], SCHEMA), none, spark.createDataFrame(PARTS[1], SCHEMA))):
        sink_of(path)(part, n)
    assert rows_of(spark, path) == running_in_python(PARTS[:2])
    with pytest.raises(FileNotFoundError):
        read_running(spark, fresh_path(spark, "test-running"))


def test_lines_count_in_the_order_of_files_and_lines(spark):
    src, ckpt, out = (fresh_path(spark, "test-lines", x) for x in "sco")
    seen, want = 0, []
    for part in range(3):
        lines = [f"{'ab'[i % 3 == 0]},{part * 100 + i}" for i in range(60)]
        spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(f"{src}/part={part}")
        want += lines
        rows = lambda b: in_arrival_order(b).select(F.split("value", ",")[0].alias("k"), F.split("value", ",")[1].cast("long").alias("n"), FILE, LINE)
        sink = running_sink(out, "k", FILE, {"total": F.col("n")}, count="nth", tiebreak=[LINE], prepare=rows)
        q = start_running_stream(with_place(spark.readStream.text(f"{src}/*")), sink, ckpt)
        q.awaitTermination()
        assert q.exception() is None
        seen += 1
    sums, expected = {}, []
    for line in want:
        k, n = line.split(",")
        total, nth = sums.get(k, (0, 0))
        sums[k] = total + int(n), nth + 1
        expected.append((k, int(n), *sums[k]))
    assert sorted(map(tuple, read_running(spark, out).select("k", "n", "total", "nth").collect())) == sorted(expected)


def run(stream, sink, ckpt, partitions=3):
    q = start_upsert_stream(stream, sink, ckpt, available_now=True, state_partitions=partitions)
    q.awaitTermination()
    assert q.exception() is None


def test_late_rows_never_replace_newer_ones(spark):
    src, ckpt, out = (fresh_path(spark, "test-latest", x) for x in "sco")
    schema = "user string, ts long, id long, value string"
    arrivals = [[("u", 50, 1, "new"), ("v", 1, 2, "first"), ("n", None, 9, "untimed")], [("u", 10, 3, "late"), ("v", 1, 4, "tie, larger id"), (None, 5, 5, "no user")], [("v", 0, 6, "late"), (None, 4, 7, "late"), ("u", 50, 1, "new")]]
    for i, rows in enumerate(arrivals):
        spark.createDataFrame(rows, schema).write.parquet(f"{src}/part={i}")
        stream = spark.readStream.schema(schema).parquet(f"{src}/*")
        run(latest_by(stream, "user", ["ts", "id"], ["id", "value"]), upsert_sink(out, ["user"]), ckpt)
    got = {x.user: (x.id, x.value) for x in read_upserted(spark, out).collect()}
    assert got == {"u": (1, "new"), "v": (4, "tie, larger id"), "n": (9, "untimed"), None: (5, "no user")}


def test_upserts_replace_by_key_and_replays_change_nothing(spark):
    path = fresh_path(spark, "test-upsert")
    sink = upsert_sink(path, ["k"])
    first = spark.createDataFrame([("a", 1), (None, 2)], "k string, n long")
    second = spark.createDataFrame([(None, 3), ("b", 4)], "k string, n long")
    for n, batch in ((0, first), (1, second), (1, second), (2, first.limit(0))):
        sink(batch, n)
    assert sorted(map(tuple, read_upserted(spark, path).collect()), key=str) == [("a", 1), ("b", 4), (None, 3)]


def test_state_goes_on_with_other_partitions(spark):
    src, one, two, out = (fresh_path(spark, "test-state", x) for x in "sabo")
    schema = "k string, v long"
    rows = {"a": [(f"k{i % 40}", i) for i in range(400)] + [(None, 1)], "b": [(f"k{i % 50}", -i) for i in range(300)] + [(None, 2)]}
    for part, data in rows.items():
        spark.createDataFrame(data, schema).write.parquet(f"{src}/{part}")
    count = lambda p: spark.readStream.schema(schema).parquet(f"{src}/{p}").groupBy("k").agg(F.sum("v").alias("total"), F.count("*").alias("n"))
    run(count("a"), upsert_sink(f"{out}/one", ["k"]), one, partitions=4)
    totals = state_totals(spark, one, ["k"], {"total": 0, "n": 1})
    totals.write.parquet(f"{out}/totals")
    begin = upsert_sink(f"{out}/two", ["k"])
    begin(read_upserted(spark, f"{out}/one"), -1)
    run(count("b"), carrying(begin, f"{out}/totals", ["k"], ["total", "n"]), two, partitions=16)
    assert state_partitions(spark, one) <= 4 < state_partitions(spark, two) <= 16
    want = spark.createDataFrame(rows["a"] + rows["b"], schema).groupBy("k").agg(F.sum("v").alias("total"), F.count("*").alias("n"))
    assert sorted(map(tuple, read_upserted(spark, f"{out}/two").collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    with pytest.raises(ValueError):
        state_totals(spark, one, ["k"], {"total": 5})
