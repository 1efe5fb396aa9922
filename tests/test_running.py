"""Running aggregates: equal to a plain window, also when hot keys are split,
and the last running row per key equals the batch aggregate (D1)."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from keyfold.functions.text import elevator_ratio
from keyfold.operators.running import in_ranges, latest_by, running_by


@pytest.fixture(scope="module")
def skewed(spark):
    # key 0 holds about a third of the rows; order ids are unique.
    n = 30_000
    return spark.range(n).select(
        F.col("id").alias("seq"),
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 97 + 1).alias("k"),
        ((F.col("id") * 7919) % 1000 / F.lit(100)).cast("decimal(18,2)").alias("v"),
    )


def _plain(df):
    w = Window.partitionBy("k").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    return df.select("seq", "k", "v", F.sum("v").over(w).alias("s"), F.count(F.lit(1)).over(w).alias("c"))


@pytest.mark.parametrize("partitions", [None, 1, 30, 90])
def test_running_equals_plain_window(spark, skewed, partitions):
    got = running_by(skewed, "k", "seq", sums={"s": F.col("v")}, count="c",
                     partitions=partitions)
    assert got.columns == ["seq", "k", "v", "s", "c"]
    assert got.exceptAll(_plain(skewed)).count() == 0
    assert _plain(skewed).exceptAll(got).count() == 0


def test_latest_equals_batch(spark, skewed):
    run = running_by(skewed, "k", "seq", sums={"s": F.col("v")}, count="c", partitions=30)
    last = latest_by(run, "k", "seq", ["s", "c"])
    batch = skewed.groupBy("k").agg(F.sum("v").alias("s"), F.count(F.lit(1)).alias("c"))
    assert last.exceptAll(batch).count() == 0 and batch.exceptAll(last).count() == 0


def test_null_keys_and_timestamp_order(spark):
    df = spark.createDataFrame(
        [(None, "2024-01-01 00:00:01", 1), (None, "2024-01-01 00:00:02", 2), ("a", "2024-01-01 00:00:03", 5)],
        "k string, ts string, v int").withColumn("ts", F.col("ts").cast("timestamp"))
    got = running_by(df, "k", "ts", sums={"s": F.col("v")}, count=None, partitions=3)
    assert sorted((r.k, r.s) for r in got.collect() if r.k is None) == [(None, 1), (None, 3)]


def test_split_keeps_plain_schema_and_null_order_first(spark):
    rows = [("h", None, 5)] + [("h", i, 1) for i in range(40)] + [("c", i, 2) for i in range(3)]
    df = spark.createDataFrame(rows, "k string, seq long, v int") \
        .withColumn("d", F.col("v").cast("decimal(18,2)"))
    split = running_by(df, "k", "seq", sums={"s": F.col("d")}, count="c", partitions=8)
    w = Window.partitionBy("k").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    plain = df.select(*df.columns, F.sum("d").over(w).alias("s"), F.count(F.lit(1)).over(w).alias("c"))
    assert [(f.name, f.dataType) for f in split.schema] == [(f.name, f.dataType) for f in plain.schema]
    _same(split, plain)
    first = split.filter(F.col("seq").isNull()).first()
    assert (first.c, float(first.s)) == (1, 5.0)


def _same(got, want):
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


N = 20_000
ORDERS = {
    # 90 % of the rows in the first 10 % of the range
    "bunched": "if(id < 18000, id, id * 10)",
    "outlier": "if(id = 7, 4611686018427387904, id)",
    "fractional": "id / 20000D",
    "hashed": "xxhash64(id)",
    "text": "sha1(string(id))",
    # every minute from an hour that New York's clocks repeat
    "clock_change": "timestamp_ntz'2024-11-03 00:00:00' + make_dt_interval(0, 0, int(id))",
}


@pytest.mark.parametrize("kind", sorted(ORDERS))
def test_any_order_is_exact_and_evenly_split(spark, kind):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.range(N).select(
            F.expr(ORDERS[kind]).alias("seq"),
            F.when(F.col("id") % 5 == 0, F.lit("cold")).otherwise(F.lit("hot")).alias("k"),
            (F.col("id") % 7).alias("v"))
        got = running_by(df, "k", "seq", sums={"s": F.col("v")}, count="c", partitions=40)
        w = Window.partitionBy("k").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
        _same(got, df.select("seq", "k", "v", F.sum("v").over(w).alias("s"), F.count(F.lit(1)).over(w).alias("c")))
        sizes = [r["count"] for r in in_ranges(df, ["k", "seq"], 40).groupBy("_range").count().collect()]
        assert max(sizes) < 3 * N / 40
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_tied_and_null_orders_are_split(spark):
    df = spark.range(N).select(F.lit(None).cast("long").alias("seq"), F.lit("h").alias("k"), "id")
    got = running_by(df, "k", "seq", sums={"s": F.col("id")}, count="c", partitions=20)
    r = got.agg(F.count_distinct("c"), F.max("c"), F.max("s")).first()
    assert tuple(r) == (N, N, N * (N - 1) // 2)
    again = running_by(df.repartition(7), "k", "seq", sums={"s": F.col("id")}, count="c", partitions=11)
    _same(got, again)  # ties have one order, however the rows are spread


def test_null_values_and_empty_input(spark):
    df = spark.createDataFrame([("a", i, None if i > 1 else i) for i in range(30)], "k string, seq int, v int")
    got = running_by(df, "k", "seq", sums={"s": F.col("v")}, count="c", partitions=10)
    assert [(r.s, r.c) for r in got.orderBy("seq").collect()] == [(min(i, 1), i + 1) for i in range(30)]
    assert running_by(df.filter("false"), "k", "seq", sums={"s": F.col("v")}).count() == 0


def test_ratio_sums_do_not_depend_on_the_cut(spark):
    df = spark.range(5_000).select(F.col("id").alias("seq"), (F.col("id") % 3).alias("k"), elevator_ratio(
        F.concat((F.col("id") % 4 + 1).cast("string"), F.lit("梯"), (F.col("id") % 7 + 1).cast("string"),
                 F.lit("户"))).alias("v"))
    runs = [running_by(df.repartition(p), "k", "seq", sums={"s": F.col("v")}, partitions=p) for p in (1, 13)]
    _same(*runs)
    w = Window.partitionBy("k").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    _same(runs[0].select("seq", "s"), df.select("seq", F.sum("v").over(w).alias("s")))
