"""Every registered query against its SQL on the smallest data set."""

import math

import duckdb
import pytest

import __spark_entry__ as entry_points
from corpusloom.plans.catalog import QUERIES, SQL

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

TYPES = {
    "BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double", "BOOLEAN": "boolean",
    "TIMESTAMP": "timestamp_ntz",
}


@pytest.fixture(scope="module")
def duck(folder):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return repr(value)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry_points.queries()) and set(entry_points.oracle_sql()) <= set(entry_points.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, folder, duck, name):
    frame = QUERIES[name](spark, folder)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    expected = duck.sql(SQL[name])
    columns = sorted(expected.columns)
    assert sorted(frame.columns) == columns
    types = dict(zip(expected.columns, map(str, expected.types)))
    assert {c: frame.schema[c].dataType.simpleString() for c in columns} == {c: TYPES[types[c]] for c in columns}
    table = frame.select(*[f"`{c}`" for c in columns]).toArrow().to_pylist()
    found = sorted(tuple(plain(row[c]) for c in columns) for row in table)
    wanted = sorted(tuple(map(plain, row)) for row in expected.select(*[f'"{c}"' for c in columns]).fetchall())
    assert found == wanted


def test_entry(spark, folder):
    frame = entry_points.entry(spark)
    assert frame.count() > 0
    assert "chunk_content" in frame.columns
