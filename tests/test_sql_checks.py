import pytest
from pyspark.sql import functions as F

from strata.operators import checks
from strata.plans import sql_checks
from tests.support import plan, rows


def declared():
    return [checks.unique("id"), checks.required("name"), checks.in_range("x", 0, 10), checks.total_records()]


@pytest.fixture
def names(spark, folder):
    given = [(1, "a", 5.0), (1, None, 11.0), (2, "c", -1.0), (None, "d", 3.0)]
    spark.createDataFrame(given, "id int, name string, x double").write.parquet(f"{folder}/t")
    return sql_checks.register(spark, spark.read.parquet(f"{folder}/t"), declared(), "silver", "My shops")


def test_checks_of_each_severity_by_name(spark, folder, names):
    every = rows(checks.evaluate(spark.read.parquet(f"{folder}/t"), declared(), "silver", "My shops").drop("layer", "dataset"))
    assert rows(spark.sql("SELECT * FROM my_shops_checks()")) == every
    one = {c.metric: spark.sql(f"SELECT * FROM my_shops_{c.metric}()").collect() for c in declared()}
    assert sorted((tuple(r) for found in one.values() for r in found), key=str) == every
    assert {r.severity for found in one.values() for r in found} == {"error", "warning", "info"}
    assert [r.observed for r in one["duplicate_count"]] == [1.0] and [r.observed for r in one["total_records"]] == [4.0]
    assert set(names) == {f"my_shops_{n}" for n in ("checks", "failed", *one)}


def test_calls_within_other_sql(spark, names):
    failed = spark.sql("SELECT s.col1 AS wanted, count(*) AS n FROM VALUES ('error'), ('warning'), ('info') s, LATERAL my_shops_failed(s.col1) GROUP BY ALL")
    counted = {r.wanted: r.n for r in failed.collect()}
    every = spark.sql("SELECT severity, count(*) AS n FROM my_shops_checks() WHERE NOT passed GROUP BY severity")
    assert counted == {r.severity: r.n for r in every.collect()} and counted["error"] == 2
    total = spark.sql("SELECT o.observed / t.observed AS share FROM my_shops_name_null_count() o, my_shops_total_records() t")
    assert total.first().share == 0.25


def test_a_call_scans_once(spark, names):
    assert plan(spark.sql("SELECT * FROM my_shops_name_null_count()")).count("FileScan") == 1
    assert plan(spark.sql("SELECT * FROM my_shops_checks()").filter(~F.col("passed"))).count("FileScan") == 2
