"""Every registered query against its SQL on the smallest data set."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as contract
from checks import oracle, registry
from verify import compare

FOLDER = "/root/testdata/sf0.001"
ORACLES = oracle.oracle_sql()


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        connection.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return connection


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")
@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_equals_its_sql(spark, db, name):
    outcome = compare(registry.QUERIES[name](spark, FOLDER), db, ORACLES[name])
    assert outcome.same, outcome.difference


def test_every_query_has_sql():
    assert set(registry.QUERIES) == set(ORACLES)
    assert set(registry.QUERIES) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_arrival_numbers_follow_time(db):
    """The observation log is folded by event id; that is its order in time."""
    assert db.execute("""
        SELECT count(*) FROM (SELECT ts, lag(ts) OVER (ORDER BY event_id) AS before FROM events) WHERE ts < before
    """).fetchone()[0] == 0
