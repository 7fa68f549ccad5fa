"""Every registered query of this folder on the smallest tables; SQL where it can express it."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from beatline.llm import registry

SF = Path(contract.SMOKE)


@pytest.fixture(scope="module")
def database():
    con = duckdb.connect()
    for file in SF.glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS FROM '{file}'")
    return con


@pytest.mark.parametrize("name", sorted(registry.sql()))
def test_query_equals_sql(spark, database, name):
    df = registry.queries()[name](spark, str(SF))
    columns = sorted(df.columns)
    want = database.sql(registry.sql()[name])
    assert sorted(want.columns) == columns
    expected = want.select(*[f'"{c}"' for c in columns]).fetchall()
    order = lambda row: [(v is None, v) for v in row]
    assert sorted(map(tuple, df.select(columns).collect()), key=order) == sorted(expected, key=order)


def test_names():
    found = contract.queries()
    assert {f"op{n}" for n in range(1, 14)} == {n.split("_")[0] for n in registry.queries()}
    assert set(registry.queries()) <= set(found) and "pipeline" in found
    assert set(registry.sql()) <= set(contract.oracle_sql())
