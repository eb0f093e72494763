"""Every registered query against its SQL, on the given tables."""

import datetime
import glob
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, SQL = entry.catalogue_queries(), entry.SQL


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def normal(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted([tuple(normal(row[i]) for i in order) for row in rows], key=repr)


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    got = table(df.columns, [tuple(row) for row in df.collect()])
    result = duck.execute(SQL[name])
    columns = [c[0] for c in result.description]
    expected = table(columns, result.fetchall())
    assert sorted(df.columns) == sorted(columns)
    assert len(got) == len(expected)
    assert got == expected
    assert got, "a query that finds nothing proves nothing"
