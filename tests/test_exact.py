"""Exact double sums: equal bits for any partitions, equal to rational arithmetic."""

import math
import random
import struct
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from keyfold.operators.agg import mean_by
from keyfold.operators.exact import exact_mean_by, exact_running_by, exact_sums, rounded

ODD = [5e-324, -5e-324, 1e-310, 2.0 ** -1022, 0.0, -0.0, 2.0 ** 32, 2.0 ** 31, 2.0 ** -32, 1 - 2.0 ** -53, 2.0 ** 64 - 2048, 2.0 ** -400, -2.0 ** -401, 1.3 * 2.0 ** -1000]


def values(n=1500):
    r, rows = random.Random(1), []
    for i in range(n):
        any_bits = struct.unpack("d", struct.pack("Q", r.getrandbits(64)))[0]
        v = [r.uniform(-1, 1) * 10 ** r.uniform(-12, 15), any_bits if math.isfinite(any_bits) and abs(any_bits) < 1e300 else 1.5,
             r.choice(ODD), r.choice([0.1, 0.2, -0.3, 1e15, 1e-12, None]), r.randint(-10**6, 10**6) / 100][i % 5]
        rows.append((None if i % 5 == 4 else i % 5, i, v))
    return rows + rows[:50]  # repeated rows count


@pytest.fixture(scope="module")
def rows():
    return values()


@pytest.fixture(scope="module")
def df(spark, rows):
    return spark.createDataFrame(rows, "k int, i int, v double")


def bits(x):
    return None if x is None else struct.pack("d", x)


def test_sums_and_means_are_exact_and_the_same_bits(df, rows):
    want = {}
    for k, _, v in rows:
        want.setdefault(k, []).extend([] if v is None else [Fraction(v)])
    for n in (1, 7, 200):
        got = {x.k: x for x in exact_sums(df.repartition(n), "k", F.col("v"), mean="mean").collect()}
        assert set(got) == set(want)
        for k, own in want.items():
            assert bits(got[k].total) == bits(float(sum(own))) and bits(got[k].mean) == bits(float(sum(own) / len(own))) and got[k]["count"] == len(own)


def test_running_sums_are_exact_and_the_same_bits(df, rows):
    want, sums = [], {}
    for k, i, v in sorted(set(rows), key=lambda r: r[1]):
        total, some = sums.get(k, (Fraction(0), False))
        total, some = total + Fraction(v or 0), some or v is not None
        sums[k] = total, some
        want.append((i, bits(float(total)) if some else None))
    for n in (1, 7, 200):
        got = exact_running_by(df.distinct(), "k", "i", F.col("v"), partitions=n).collect()
        assert sorted((x.i, bits(x.running_sum)) for x in got) == sorted(want)


def test_no_numbers(spark):
    inf, nan = float("inf"), float("nan")
    rows = [("a", inf), ("a", 1.0), ("b", nan), ("b", 2.0), ("c", None), ("d", 1.7e308), ("d", 1.7e308), ("e", inf), ("e", -inf), ("f", -inf), ("g", 0.0), ("g", -0.0)]
    got = {x.k: (x.total, x["count"]) for x in exact_sums(spark.createDataFrame(rows, "k string, v double"), "k", F.col("v")).collect()}
    assert got["a"] == (inf, 2) and math.isnan(got["b"][0]) and got["c"] == (None, 0) and got["d"] == (inf, 2)
    assert math.isnan(got["e"][0]) and got["f"] == (-inf, 1) and got["g"] == (0.0, 2)


def test_empty(spark):
    none = spark.createDataFrame([], "k int, i int, v double")
    assert exact_sums(none, "k", F.col("v")).collect() == [] and exact_running_by(none, "k", "i", F.col("v")).collect() == []
    only_null = spark.createDataFrame([(1, 1, None), (1, 2, 0.0)], "k int, i int, v double")
    assert [x.running_sum for x in sorted(exact_running_by(only_null, "k", "i", F.col("v")).collect(), key=lambda x: x.i)] == [None, 0.0]


def test_mean_by_exact_has_mean_bys_columns(spark):
    rows = [("a", 0.1)] * 10 + [("a", None), ("b", 2.675), (None, 1.0), ("c", None)]
    df = spark.createDataFrame(rows, "k string, v double")
    exact, plain = (sorted(map(tuple, f(df, "k", F.col("v"), "m", count="n").collect()), key=str) for f in (exact_mean_by, mean_by))
    assert exact == plain == [("a", 0.1, 11), ("b", 2.67, 1), ("c", None, 1), (None, 1.0, 1)]
    assert exact_mean_by(df, "k", F.col("v"), "m").columns == ["k", "m"]


def test_rounded_once():
    # A sum half way between two doubles, and just above it.
    half = {0: 1, 1: 0}
    assert rounded({0: (1 << 53) + 1}) == float(1 << 53)
    assert rounded({-2: 1, 0: (1 << 53) + 1}) == float((1 << 53) + 2)
    assert rounded(half) == 1.0 and rounded({}) == 0.0 and rounded({31: 1 << 40}) == float("inf")
