"""Every registered query against its SQL, run by DuckDB on the same files."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as contract
from ledgerloom.plans import catalog, oracle
from ledgerloom.sources import retail

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")
ROWS_ONLY: set[str] = set()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return connection


def canonical(rows, names):
    def text(value):
        if value is None or (isinstance(value, float) and math.isnan(value)):
            return "null"
        return repr(float(value)) if isinstance(value, float) else str(value)

    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(text(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", sorted(oracle.oracle_sql()))
def test_matches_sql(spark, database, name):
    result = contract.queries()[name](spark, SF_DIR)
    answer = database.execute(contract.oracle_sql()[name])
    names = [column[0] for column in answer.description]
    assert sorted(result.columns) == sorted(names)
    assert canonical([tuple(r) for r in result.collect()], result.columns) == canonical(answer.fetchall(), names)


@pytest.mark.parametrize("name", sorted(ROWS_ONLY))
def test_rows_only(spark, name):
    assert contract.queries()[name](spark, SF_DIR).count() > 0


def test_every_query_is_checked():
    assert set(catalog.QUERIES) - set(oracle.oracle_sql()) == ROWS_ONLY
    assert set(oracle.oracle_sql()) <= set(catalog.QUERIES)
    assert set(catalog.QUERIES) <= set(contract.queries())


def test_entry(spark):
    fact = contract.entry(spark)
    assert "net_revenue" in fact.columns
    assert fact.limit(1).count() == 1


@pytest.mark.parametrize("name", sorted(retail.INPUTS))
def test_inputs_load(spark, name):
    assert retail.Tables(spark, SF_DIR).load(name).columns
