"""Every query with an oracle equals DuckDB on the same tables, value for value."""

import duckdb
import pytest

import __spark_entry__ as entry_point
from tools.check import TABLES, table_of

ORACLES = {n: sql for n, sql in entry_point.oracle_sql().items() if not n.startswith("op")}  # corpus queries: tests/llm


@pytest.fixture(scope="module")
def duck(small):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{small}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_oracle(spark, duck, small, name):
    df = entry_point.queries()[name](spark, small)
    got = table_of(df.columns, df.collect())
    duck.execute(ORACLES[name])
    want = table_of([c[0] for c in duck.description], duck.fetchall())
    assert got[0] == want[0]
    assert got[1] == want[1]


def test_entry_is_the_flagship(spark):
    df = entry_point.entry(spark)
    assert df.columns == ["date", "trips", "weekday", "month", "lag_1", "lag_7", "past_7_day_mean"]
    assert df.count() == 23


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(entry_point.queries())
