"""Every query against its DuckDB counterpart on the smallest test tables."""

import datetime as dt

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import TESTDATA

TABLES = """region nation customer supplier part orders lineitem events documents embeddings
    pages benchmark labels conversations""".split()
ORACLES = entry.oracle_sql()
QUERIES = {n: q for n, q in entry.queries().items() if not n.startswith(("op", "pipeline"))}
TYPES = {"string": "VARCHAR", "date": "DATE", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS FROM '{TESTDATA}/{table}.parquet'")
    return con


def test_every_query_has_a_counterpart():
    assert set(QUERIES) <= set(ORACLES)


def sort_key(row):
    return [(v is not None, v.isoformat() if isinstance(v, dt.date) else v) for v in row]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, TESTDATA)
    result = duck.execute(ORACLES[name])
    types = {column[0]: str(column[1]) for column in result.description}
    assert {f.name: TYPES[f.dataType.simpleString()] for f in df.schema.fields} == types
    columns = sorted(types)
    order = [list(types).index(c) for c in columns]
    expected = [tuple(row[i] for i in order) for row in result.fetchall()]
    found = [tuple(row) for row in df.select(*columns).collect()]
    assert sorted(found, key=sort_key) == sorted(expected, key=sort_key)
