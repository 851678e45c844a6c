import pytest
from pyspark.sql import functions as F

from strata.operators import alerts, checks, pages
from strata.plans.specs import QualitySpec
from tests.support import plan, rows

SPEC = QualitySpec(
    required=("id", "name"),
    ranges={"latitude": (-90, 90), "longitude": (-180, 180)},
    allowed={"kind": ("micro", "nano")},
)
PLACE = "id string, name string, kind string, latitude double, longitude double, data_quality_score int"


def silver(spark, *records):
    return checks.check_silver(spark.createDataFrame(records, PLACE), SPEC, "places")


def verdict(results):
    (entry,) = checks.summary(results).values()
    return entry


def test_clean_table_passes(spark):
    out = verdict(silver(spark, ("1", "a", "micro", 1.0, 1.0, 100), ("2", "b", None, None, None, 80)))
    assert out["passed"] and out["errors"] == [] and out["warnings"] == []
    assert out["metrics"]["total_records"] == 2
    assert out["metrics"]["avg_quality_score"] == 90.0


def test_duplicate_and_null_keys(spark):
    out = verdict(silver(spark, ("1", "a", None, 0.0, 0.0, 100), ("1", "b", None, 0.0, 0.0, 100)))
    assert not out["passed"]
    assert out["errors"] == ["duplicate_count is 1.00, limit 0.00 (id)"]
    out = verdict(silver(spark, *[(k, "a", None, 0.0, 0.0, 100) for k in (None, None, "1")]))
    assert out["metrics"]["duplicate_count"] == 1  # null is one value
    assert out["metrics"]["id_null_count"] == 2


def test_null_required_field(spark):
    out = verdict(silver(spark, ("1", None, None, 0.0, 0.0, 100)))
    assert not out["passed"] and out["errors"] == ["name_null_count is 1.00, limit 0.00 (name)"]


def test_ranges_and_values_only_warn(spark):
    out = verdict(silver(spark, ("1", "a", "pub", 200.0, float("nan"), 100)))
    assert out["passed"] and len(out["warnings"]) == 3
    assert out["metrics"]["latitude_out_of_range"] == 1
    assert out["metrics"]["longitude_out_of_range"] == 1
    assert out["metrics"]["kind_invalid_values"] == 1


def test_low_mean_score_warns_and_no_rows_do_not(spark):
    out = verdict(silver(spark, ("1", "a", None, 0.0, 0.0, 50)))
    assert out["warnings"] == ["avg_quality_score is 50.00, limit 80.00 (data_quality_score)"]
    empty = verdict(checks.check_silver(spark.createDataFrame([], PLACE), SPEC, "places"))
    assert empty["passed"] and empty["warnings"] == []
    assert empty["metrics"]["avg_quality_score"] is None


def test_absent_columns_are_not_checked(spark):
    results = checks.check_silver(spark.createDataFrame([("1",)], "id string"), SPEC, "places")
    assert {r.metric for r in results.collect()} == {"total_records", "duplicate_count", "id_null_count"}


def test_one_scan_for_counters_and_a_narrow_one_for_keys(spark, folder):
    spark.createDataFrame([("1", "a", "micro", 1.0, 1.0, 1)], PLACE).write.parquet(f"{folder}/t")
    results = checks.check_silver(spark.read.parquet(f"{folder}/t"), SPEC, "places")
    scans = [line for line in plan(results).splitlines() if "FileScan" in line]
    assert len(scans) == 2
    assert "struct<id:string>" in [s.split("ReadSchema: ")[1].strip() for s in scans]


def test_gold_checks(spark):
    good = spark.createDataFrame([("US", 3, 60.0)], "country string, record_count long, percentage_of_total double")
    assert verdict(checks.check_gold(good, QualitySpec(), "t"))["passed"]
    bad = spark.createDataFrame([("US", -3, 160.0)], good.schema)
    out = verdict(checks.check_gold(bad, QualitySpec(), "t"))
    assert not out["passed"]
    assert out["errors"] == ["t.record_count_negative is 1.00, limit 0.00 (record_count)"]
    assert out["warnings"] == ["t.percentage_of_total_invalid is 1.00, limit 0.00 (percentage_of_total)"]
    out = verdict(checks.check_gold(good.limit(0), QualitySpec(), "t"))
    assert out["passed"] and out["warnings"] == ["t_count is 0.00"]


def test_declared_count_columns(spark):
    df = spark.createDataFrame([(-1, -1)], "a_count int, b_count int")
    out = verdict(checks.check_gold(df, QualitySpec(count_columns=["b_count", "absent"]), "t"))
    assert out["errors"] == ["t.b_count_negative is 1.00, limit 0.00 (b_count)"]


INVENTORY = "path string, valid boolean, is_array boolean, records int, empty_records int"


@pytest.mark.parametrize(
    "files, errors, warnings",
    [
        ([("a", True, True, 100, 0)], 0, 0),
        ([("a", True, True, 99, 0)], 1, 0),
        ([("a", True, True, 100, 1)], 0, 1),
        ([("a", True, True, 100, 100)], 1, 1),
        ([("a", True, True, 100, 0), ("b", False, False, 0, 0)], 1, 0),
        ([("a", True, True, 100, 0), ("b", True, False, 0, 0)], 0, 1),
        ([("b", True, False, 0, 0)], 2, 1),
    ],
)
def test_landed(spark, files, errors, warnings):
    out = verdict(checks.check_landed(spark.createDataFrame(files, INVENTORY), SPEC, "places"))
    assert (len(out["errors"]), len(out["warnings"])) == (errors, warnings)
    assert out["passed"] == (errors == 0)
    assert out["metrics"]["file_count"] == len(files)


def test_landed_fields(spark):
    df = spark.createDataFrame([('{"id": 1, "name": null}',), ("{}",)], "payload string")
    out = verdict(checks.check_landed_fields(df, ["id", "name"], "places"))
    assert (out["metrics"]["id_null_count"], out["metrics"]["name_null_count"]) == (1, 2)


def test_cross_table(spark):
    source = spark.createDataFrame([("a", None), ("a", "x"), ("b", None)], "g string, h string")
    gold = spark.createDataFrame([("a", None, 1), ("a", "x", 1)], "g string, h string, record_count long")
    out = verdict(checks.check_sum_matches_source(gold, source, "t"))
    assert out["errors"] == ["record_count_difference is -1.00, limit 0.00 (record_count)"]
    assert rows(checks.missing_dimensions(gold, source, ["g", "h"])) == [("b", None)]
    out = verdict(checks.check_dimensions_present(gold, source, ["g", "h"], "t"))
    assert out["errors"] == ["missing_dimensions is 1.00, limit 0.00 (g,h)"]
    assert verdict(checks.check_sum_matches_source(gold, source.filter("g = 'a'"), "t"))["passed"]


def test_presence(spark):
    found = spark.createDataFrame([("t", "2026-01-25")], "dataset string, date string")
    expected = spark.createDataFrame([("t", "2026-01-25"), ("t", "2026-01-26")], found.schema)
    out = verdict(checks.check_presence(found, expected, "gold"))
    assert out["errors"] == ["present is 0.00, limit 1.00 (2026-01-26)"]


def test_quarantine(spark):
    df = spark.createDataFrame(
        [("1", "a", "micro", 1.0, 1.0, 1), (None, None, "pub", 99.0, 1.0, 1), ("3", "c", None, None, None, 1)], PLACE
    )
    valid, rejected = checks.quarantine(df, checks.row_rules(df, SPEC))
    assert [r.id for r in valid.orderBy("id").collect()] == ["1", "3"]
    assert valid.columns == df.columns
    (row,) = rejected.collect()
    assert row._reasons == ["id_missing", "name_missing", "latitude_out_of_range", "kind_not_allowed"]


def test_gate(spark):
    bad = silver(spark, ("1", None, None, 0.0, 0.0, 100))
    with pytest.raises(checks.QualityGateError, match="name"):
        checks.assert_passed(bad)
    warned = silver(spark, ("1", "a", "pub", 0.0, 0.0, 100))
    assert checks.assert_passed(warned)["silver"]["warnings"]
    missing = checks.failed_row(spark, "gold", "t", "present", "Missing aggregation: t")
    with pytest.raises(checks.QualityGateError, match="Missing aggregation: t"):
        checks.assert_passed(missing)


def test_alert_rows(spark):
    results = silver(spark, ("1", None, "pub", 0.0, 0.0, 100))
    (alert,) = alerts.alert_rows(results).collect()
    assert alert.channels == ["email", "slack"]
    assert alert.failed_checks == ["kind_invalid_values.kind", "name_null_count.name"]
    assert alert.metrics["total_records"] == 1.0
    assert alert.message.startswith(":warning: *HIGH* Alert\n")
    (alert,) = alerts.alert_rows(results, "MEDIUM").collect()
    assert alert.channels == ["email"]
    assert alerts.alert_rows(results, "LOW", {"slack": ("LOW",)}).first().channels == ["slack"]
    clean = silver(spark, ("1", "a", None, 0.0, 0.0, 100))
    assert alerts.alert_rows(clean).count() == 0


def test_kpi_limits(spark):
    values = [("bronze_record_count", 99.0), ("avg_quality_score", 70.0), ("invalid_coordinate_pct", 5.1),
              ("duplicate_count", None), ("unlisted", 1.0)]
    out = alerts.kpi_alerts(spark.createDataFrame(values, "metric string, value double"))
    assert {r.metric: r.alert for r in out.collect()} == {
        "bronze_record_count": True, "avg_quality_score": False, "invalid_coordinate_pct": True,
        "duplicate_count": False,
    }
    assert "BroadcastHashJoin" in plan(out)


# --- paged downloads ---------------------------------------------------------------------

PAGES = "page int, per_page int, records array<string>, reported_total int"


def test_complete_download(spark):
    df = spark.createDataFrame([(1, 2, ["a", "b"], 3), (2, 2, ["c"], 3), (3, 2, [], 3)], PAGES)
    assert rows(pages.reconcile_pages(df)) == [(3, 3, 2, 2, 0, True)]
    assert rows(pages.page_records(df)) == [(1, 0, "a"), (1, 1, "b"), (2, 0, "c")]


def test_download_stops_at_the_first_empty_page(spark):
    df = spark.createDataFrame([(1, 2, ["a", "b"], 4), (2, 2, [], 4), (3, 2, ["c"], 4)], PAGES)
    assert rows(pages.reconcile_pages(df)) == [(4, 2, 2, 1, 0, False)]
    assert rows(pages.page_records(df)) == [(1, 0, "a"), (1, 1, "b")]


def test_gap_and_unknown_total(spark):
    df = spark.createDataFrame([(1, 2, ["a", "b"], None), (3, 2, ["c"], None)], PAGES)
    assert rows(pages.reconcile_pages(df)) == [(None, 3, None, 2, 1, True)]
