"""The corpus queries against DuckDB on the same tables, where SQL can express them."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from strata.llm.queries import ORACLES, QUERIES

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in ("documents", "pages", "benchmark", "labels", "embeddings"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def comparable(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.9g}"
    return "null" if value is None else str(value)


def test_one_query_for_each_operator_and_the_pipeline():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, 14)) and QUERIES.items() <= entry.queries().items()
    assert entry.queries()["pipeline"] is corpus_pipeline.run


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_duckdb(name, spark, duck):
    result = QUERIES[name](spark, SF_DIR)
    columns = sorted(result.columns)
    found = sorted(tuple(comparable(r[c]) for c in columns) for r in result.collect())
    cursor = duck.execute(ORACLES[name])
    described = [d[0] for d in cursor.description]
    assert sorted(described) == columns
    at = [described.index(c) for c in columns]
    assert found and found == sorted(tuple(comparable(r[i]) for i in at) for r in cursor.fetchall())
