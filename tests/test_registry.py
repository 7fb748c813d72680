"""Every registered query against its SQL on the smallest tables."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent / "tools"))

duckdb = pytest.importorskip("duckdb")
check = pytest.importorskip("check")

import __spark_entry__ as contract

TINY = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(TINY).exists(), reason="tables are not here")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for table in check.TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{TINY}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_query_matches_sql(spark, db, name):
    df = contract.queries()[name](spark, TINY)
    got, columns = check.table_of(df.columns, [tuple(r) for r in df.collect()])
    if name not in contract.oracle_sql():
        assert got
        return
    cursor = db.execute(contract.oracle_sql()[name])
    want, want_columns = check.table_of([d[0] for d in cursor.description], cursor.fetchall())
    assert columns == want_columns
    assert got == want


def test_contract_covers_the_oracle():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).columns == ["label", "predicted", "n"]
