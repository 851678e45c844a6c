"""Every registered query against DuckDB on the same tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from workloads.registry import ORACLES, QUERIES

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()

FAMILY = {
    "tinyint": "int", "smallint": "int", "int": "int", "bigint": "int",
    "TINYINT": "int", "SMALLINT": "int", "INTEGER": "int", "BIGINT": "int",
    "double": "float", "float": "float", "DOUBLE": "float", "FLOAT": "float",
    "string": "text", "VARCHAR": "text", "boolean": "bool", "BOOLEAN": "bool",
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def comparable(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.9g}"
    return "null" if value is None else str(value)


def test_every_query_has_an_oracle():
    assert set(ORACLES) == set(QUERIES)
    assert QUERIES.items() <= entry.queries().items() and ORACLES.items() <= entry.oracle_sql().items()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_duckdb(name, spark, duck):
    result = QUERIES[name](spark, SF_DIR)
    columns = sorted(result.columns)
    found = sorted(tuple(comparable(r[c]) for c in columns) for r in result.collect())

    cursor = duck.execute(ORACLES[name])
    described = {d[0]: str(d[1]) for d in cursor.description}
    assert sorted(described) == columns
    at = [list(described).index(c) for c in columns]
    wanted = sorted(tuple(comparable(r[i]) for i in at) for r in cursor.fetchall())

    for c in columns:
        assert FAMILY[result.schema[c].dataType.simpleString()] == FAMILY[described[c]], c
    assert len(found) > 0
    assert found == wanted


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0
