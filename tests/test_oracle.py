"""Every registered query against its SQL, on whole tables of the smallest scale."""

import os

import pytest

import __spark_entry__ as entry
from sluiceway.starschema import oracle
from sluiceway.starschema import queries as catalogue

duckdb = pytest.importorskip("duckdb")

FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr(tuple(row[i] for i in order)) for row in rows)


def test_every_query_has_sql():
    # Those of the optional subpackage have tests of their own.
    assert catalogue.queries().keys() == oracle.oracle_sql().keys()
    assert entry.queries().keys() >= entry.oracle_sql().keys() >= catalogue.queries().keys()


# Whole runs take longest; test_runs.py covers them on small tables, and
# tools/check.py compares all of them. ALL_QUERIES=1 runs them here too.
WHOLE_RUNS = ("run_", "sync_", "settle_", "drain_", "payload_positions", "payload_sink", "written_state",
              "payload_docs_limited_", "log_")
NAMES = [
    name
    for name in sorted(catalogue.queries())
    if os.environ.get("ALL_QUERIES") or not name.startswith(WHOLE_RUNS)
]


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, con, name):
    df = entry.queries()[name](spark, FOLDER)
    expected = con.sql(entry.oracle_sql()[name])
    assert sorted(df.columns) == sorted(expected.columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(
        expected.columns, expected.fetchall()
    )


def test_entry_gives_documents(spark):
    df = entry.entry(spark)
    assert df.columns == [
        "entity", "run_id", "payload_id", "unique_project_key", "chunk", "n_items", "body",
    ]
    assert df.count() > 0
