"""Every registered query against its DuckDB oracle (section 5, group 1)."""

import duckdb
import pytest

import __spark_entry__ as E
from keyfold import queries as library
from tools_check import TABLES, digest

QUERIES = E.queries()
ORACLES = E.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_small):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    return con


def test_every_query_is_registered_with_oracle_or_listed():
    # Optional parts list theirs in their own tests.
    assert not set(library.QUERIES) - set(ORACLES)
    assert set(library.QUERIES) <= set(QUERIES)
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, sf_small, duck, name):
    df = QUERIES[name](spark, sf_small)
    rows = [tuple(r) for r in df.collect()]
    res = duck.execute(ORACLES[name])
    cols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(cols)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows) == digest(cols, orows)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["neighborhood", "avg_price", "count"]
    assert df.count() > 0
