"""The same results with ANSI mode off, where casts, sizes and divisions are laxer."""

import pytest

from strata.operators import conform, pages, records
from strata.sources import landing
from tests.support import rows
from tests.test_storage import DAY, land_file


@pytest.fixture(params=["true", "false"])
def ansi(spark, request):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", request.param)
    yield spark
    spark.conf.set("spark.sql.ansi.enabled", before)


def test_unreadable_files_count_no_records(ansi, folder):
    land_file(folder, f"t_bronze_api_{DAY}_20260126_000001.json", "{bad")
    land_file(folder, f"t_bronze_api_{DAY}_20260126_000002.json", {"a": 1})
    land_file(folder, f"t_bronze_api_{DAY}_20260126_000003.json", [{"a": 1}, {}])
    found = landing.inventory(ansi, folder, DAY).drop("path")
    assert rows(found) == [(False, False, 0, 0), (True, False, 0, 0), (True, True, 2, 1)]


def test_pages_without_records(ansi):
    df = ansi.createDataFrame(
        [(1, 2, ["a", "b"], 2), (2, 2, None, 2)],
        "page int, per_page int, records array<string>, reported_total int",
    )
    assert rows(pages.reconcile_pages(df)) == [(2, 2, 1, 1, 0, True)]
    assert rows(pages.page_records(df)) == [(1, 0, "a"), (1, 1, "b")]


def test_bad_numbers_are_null(ansi):
    df = ansi.createDataFrame([("x",), ("1e30",), ("42.7",)], "c string")
    assert [r.c for r in records.convert_fields_to_int(df, ["c"]).collect()] == [None, None, 42]
    fields = [{"name": "c", "type": "double"}]
    assert [r.c for r in conform.enforce_types(df, fields).collect()] == [None, 1e30, 42.7]
    strict = records.convert_fields_to_float(df, ["c"], "raise")
    with pytest.raises(Exception, match="c is no .*: x"):
        strict.collect()
