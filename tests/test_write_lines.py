"""Lines written as text files, each starting with a header."""

import pytest

from keyfold.session import fresh_path
from keyfold.sources.fixtures import with_headers, write_with_headers


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("n_files", [None, 3])
def test_every_file_starts_with_its_only_header(spark, n_files):
    lines = spark.range(0, 1000, 1, 5).selectExpr("string(id) AS value")
    path = write_with_headers(spark, lines, "head", fresh_path(spark, "test-lines"), n_files)
    files = [text.splitlines() for text in
             [r.value for r in spark.read.text(path, wholetext=True).collect()]]
    assert len(files) == (n_files or 5)
    assert all(f[0] == "head" and "head" not in f[1:] for f in files)
    assert sorted(int(x) for f in files for x in f[1:]) == list(range(1000))


def test_headers_need_no_shuffle_and_no_sort(spark):
    plan = _plan(with_headers(spark.range(0, 10, 1, 2).selectExpr("string(id) AS value"), "head"))
    assert "Exchange" not in plan and "Sort" not in plan


def test_no_lines_no_header(spark):
    lines = spark.range(0).selectExpr("string(id) AS value")
    assert with_headers(lines, "head").count() == 0
