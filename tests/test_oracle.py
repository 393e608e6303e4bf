"""Every registered query against DuckDB on the smallest benchmark tables."""

import pytest
from compare import compare, connect

import __spark_entry__ as entry
from touchledger.plans import queries

FOLDER = "/root/testdata/sf0.001"
SQL = entry.oracle_sql()
#: Queries that also run with a warehouse of their own; the others share one, whose early layers are written once.
COLD = ("channel_summary", "batch_ids", "contract_gate")


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.fixture(scope="module")
def shared(spark):
    return queries.warehouse(spark, FOLDER)


@pytest.fixture
def shared_warehouse(shared, monkeypatch):
    monkeypatch.setattr(queries, "warehouse", lambda spark, folder: shared)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_duckdb(spark, duck, shared_warehouse, name):
    assert compare(entry.queries()[name](spark, FOLDER), duck.execute(SQL[name])) == []


@pytest.mark.parametrize("name", COLD)
def test_query_matches_duckdb_from_the_raw_feeds(spark, duck, name):
    assert compare(entry.queries()[name](spark, FOLDER), duck.execute(SQL[name])) == []


def test_entry_returns_rows(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "share_of_won_revenue" in df.columns
