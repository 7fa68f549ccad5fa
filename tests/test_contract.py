"""Every registered query against its SQL, on the smallest data set."""

from pathlib import Path

import pytest

import __spark_entry__ as contract
from registry import oracle, queries

duckdb = pytest.importorskip("duckdb")
SF = Path(contract.SMOKE)


@pytest.fixture(scope="module")
def database():
    if not SF.exists():
        pytest.skip("no test data")
    con = duckdb.connect()
    for file in SF.glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS FROM '{file}'")
    return con


def order(row):
    return [(v is None, v) for v in row]


def test_entry(spark):
    assert contract.entry(spark).count() == 78


def test_every_query_has_sql():
    assert set(queries.all_queries()) == set(oracle.all_sql())
    assert set(contract.queries()) >= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(queries.all_queries()))
def test_query(spark, database, name):
    df = queries.all_queries()[name](spark, str(SF))
    columns = sorted(df.columns)
    want = database.sql(oracle.all_sql()[name])
    assert sorted(want.columns) == columns
    expected = want.select(*[f'"{c}"' for c in columns]).fetchall()
    assert sorted(map(tuple, df.select(columns).collect()), key=order) == sorted(expected, key=order)


def test_stored_events_have_no_limit(spark):
    df = queries.latest_events_stored(spark, str(SF))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "Limit" not in plan and "Sort" not in plan
