"""Every registered query against the same query in DuckDB, exact to the last bit."""

import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as contract

DATA = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
# Queries of the training-data subpackage have tests of their own.
QUERIES, SQL = contract.registry.queries(), contract.oracle.oracle_sql()


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    return connection


def _canonical(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)].copy()
    for name in frame:
        if frame[name].dtype.kind == "M":
            frame[name] = frame[name].astype("datetime64[us]")
    return frame.sort_values(list(frame.columns), ignore_index=True)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches(spark, database, name):
    ours = _canonical(QUERIES[name](spark, DATA).toPandas())
    theirs = _canonical(database.execute(SQL[name]).df())
    assert len(ours) > 0
    pd.testing.assert_frame_equal(ours, theirs, check_exact=True)
