"""Every registered query against its SQL twin on the smallest tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from starloom.queries import REGISTRY

FOLDER = "/root/testdata/sf0.001"
QUERIES = {name: q.run for name, q in REGISTRY.items()}
SQL = {name: q.sql for name, q in REGISTRY.items() if q.sql is not None}

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        connection.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return connection


def plain(field_type):
    return str(field_type).replace("large_", "").replace("_view", "")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, database, name):
    got = QUERIES[name](spark, FOLDER).toArrow()
    wanted = database.execute(SQL[name]).to_arrow_table()
    columns = sorted(got.column_names)
    assert columns == sorted(wanted.column_names)
    assert [plain(got.schema.field(c).type) for c in columns] == [plain(wanted.schema.field(c).type) for c in columns]
    listed = [sorted(zip(*[t.column(c).to_pylist() for c in columns]), key=repr) for t in (got, wanted)]
    assert listed[0] == listed[1]


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_query_has_a_twin():
    assert set(SQL) == set(QUERIES)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())
