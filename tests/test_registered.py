"""Every registered query against its SQL, on the given tables."""

import math
import os

import duckdb
import pytest

from chartmill.catalog import QUERIES, SQL

FOLDER = os.environ.get("CHARTMILL_TEST_DIR", "/root/testdata/sf0.01")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES.split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    yield con
    con.close()


def cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 9))
    return repr(value)


def normal(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(cell(row[i]) for i in order) for row in rows)


KINDS = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "timestamp_ntz": "TIMESTAMP",
         "boolean": "BOOLEAN", "date": "DATE", "float": "FLOAT"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, duck, name):
    got = QUERIES[name](spark, FOLDER)
    want = duck.sql(SQL[name])
    assert sorted(got.columns) == sorted(want.columns)
    kinds = {column: KINDS.get(kind, kind) for column, kind in got.dtypes}
    assert kinds == {c: str(t) for c, t in zip(want.columns, want.types)}
    got_rows = [tuple(r) for r in got.collect()]
    want_rows = want.fetchall()
    assert len(got_rows) == len(want_rows)
    assert normal(got_rows, got.columns) == normal(want_rows, want.columns)
    assert got_rows, "a query without rows checks nothing"
