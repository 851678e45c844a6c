import json
import os
from dataclasses import replace
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from strata.operators import checks
from strata.operators.parse import parse_payload
from strata.plans import daily
from strata.plans.daily import Layout
from strata.plans.specs import FieldSpec, place_dataset
from strata.sources import landing, storage, tables
from strata.streaming.arrivals import follow_landed
from tests.support import plan, rows

DAY, NEXT = "2026-01-25", "2026-01-26"
RECORDS = [{"id": "1", "name": "a", "value": 10}, {"id": "2", "name": "b", "value": None}, {"id": "3", "name": "ü", "value": 1}]


def land_file(folder, name, content):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w", encoding="utf-8") as f:
        f.write(content if isinstance(content, str) else json.dumps(content, indent=2, ensure_ascii=False))


# --- landing -----------------------------------------------------------------------------


def test_append_and_scan(spark, folder):
    df = spark.createDataFrame(RECORDS, "id string, name string, value int")
    first = landing.append_records(df, folder, "things", DAY)
    second = landing.append_records(df, folder, "things", DAY, "batch")
    landing.append_records(df, folder, "things", NEXT)
    assert first["record_count"] == 3 and first["path"] != second["path"]
    scanned = landing.scan(spark, folder, DAY)
    assert scanned.count() == 6  # reruns of a date add up
    assert rows(scanned.select("_source", "_ingestion_date").distinct()) == [("api", DAY), ("batch", DAY)]
    assert landing.scan(spark, folder, DAY, "batch").count() == 3
    assert landing.scan(spark, folder).count() == 9
    payloads = [json.loads(r.payload) for r in landing.scan(spark, folder, NEXT).collect()]
    assert sorted(payloads, key=lambda r: r["id"]) == RECORDS  # nulls and text survive


def test_runs_are_immutable_and_never_empty(spark, folder):
    df = spark.createDataFrame(RECORDS, "id string, name string, value int")
    at = datetime(2026, 1, 25, 3)
    landing.append_records(df, folder, "things", DAY, now=at)
    with pytest.raises(FileExistsError):
        landing.append_records(df.limit(1), folder, "things", DAY, now=at)
    assert landing.scan(spark, folder, DAY).count() == 3
    with pytest.raises(ValueError, match="empty"):
        landing.append_records(df.limit(0), folder, "things", NEXT)
    with pytest.raises(FileNotFoundError):
        landing.scan(spark, folder, NEXT)


def test_array_files(spark, folder):
    land_file(folder, f"things_bronze_api_{DAY}_20260126_193015.json", RECORDS)
    land_file(folder, f"things_bronze_api_{DAY}_20260126_193016.json", [{"id": "4"}, {}])
    land_file(folder, f"things_bronze_api_{DAY}_20260126_193017.json", {"id": "not a list"})
    land_file(folder, f"things_bronze_api_{NEXT}_20260126_193018.json", [1])
    scanned = landing.scan(spark, folder, DAY)
    assert scanned.count() == 5
    times = {r._ingest_ts for r in scanned.collect()}
    assert times == {datetime(2026, 1, 26, 19, 30, 15), datetime(2026, 1, 26, 19, 30, 16)}
    parsed = parse_payload(scanned, [{"name": "id"}], keep=["_position"])
    assert rows(parsed) == sorted([("1", 0), ("2", 1), ("3", 2), ("4", 0), (None, 1)], key=str)


def test_each_array_file_is_parsed_once(spark, folder):
    land_file(folder, f"things_bronze_api_{DAY}_20260126_193015.json", RECORDS)
    assert plan(landing.scan(spark, folder, DAY)).count("from_json") == 1


def test_missing_folder_and_date(spark, folder):
    with pytest.raises(FileNotFoundError, match="does not exist"):
        landing.scan(spark, f"{folder}/absent", DAY)
    with pytest.raises(FileNotFoundError, match=NEXT):
        land_file(folder, f"things_bronze_api_{DAY}_20260126_193015.json", RECORDS)
        landing.scan(spark, folder, NEXT)


def test_broken_file(spark, folder):
    land_file(folder, f"t_bronze_api_{DAY}_20260126_000001.json", RECORDS)
    land_file(folder, f"t_bronze_api_{DAY}_20260126_000002.json", "{bad")
    with pytest.raises(Exception, match="Invalid JSON in"):
        landing.scan(spark, folder, DAY).collect()
    assert landing.scan(spark, folder, DAY, on_invalid="skip").count() == 3
    with pytest.raises(ValueError):
        landing.scan(spark, folder, DAY, on_invalid="ignore")


def test_inventory(spark, folder):
    name = f"t_bronze_api_{DAY}_20260126_00000{{}}.json"
    land_file(folder, name.format(1), [{"a": 1}, {}, None, [], "", 0, False])
    land_file(folder, name.format(2), "[{}] trailing")
    land_file(folder, name.format(3), {"a": 1})
    land_file(folder, name.format(4), [])
    df = spark.createDataFrame([(1,), (2,)], "a int")
    landing.append_records(df, folder, "t", DAY)
    found = landing.inventory(spark, folder, DAY).drop("path")
    assert rows(found) == sorted(
        [(True, True, 7, 6), (False, False, 0, 0), (True, False, 0, 0), (True, True, 0, 0),
         (True, True, 1, 0), (True, True, 1, 0)], key=str,
    )


def test_lines_split_and_arrays_do_not(spark, folder):
    df = spark.range(1000).select(F.col("id").cast("string").alias("id"))
    landing.append_records(df.coalesce(1), folder, "t", DAY)
    assert landing.scan(spark, folder, DAY).select("payload").count() == 1000
    assert "WholeText" not in plan(landing.scan(spark, folder, DAY))


def test_latest_run_wins(spark, folder):
    land_file(folder, f"t_bronze_api_{DAY}_20260126_000001.json", [{"id": "1", "name": "old"}, {"id": "2", "name": "x"}, {"id": "2", "name": "y"}])
    land_file(folder, f"t_bronze_api_{DAY}_20260126_000002.json", [{"id": "1", "name": "new"}])
    spec = place_dataset("t", [FieldSpec("id"), FieldSpec("name")], "kind", [])
    latest = daily.load_latest(spark, spec, Layout(folder, "", ""), DAY)
    assert latest.columns == ["id", "name", "_ingest_ts"]
    assert rows(latest.drop("_ingest_ts")) == [("1", "new"), ("2", "y")]


# --- dated tables ------------------------------------------------------------------------

CELLS = "id string, country string, state string, v int"


def test_write_and_read(spark, folder):
    df = spark.createDataFrame([("1", "US", "01", 1), ("2", None, "CA", 2)], CELLS)
    written = tables.write_dated(df, f"{folder}/t", DAY, ["country", "state"])
    assert written == {
        "records_written": 2, "partitions": ["_processing_date", "country", "state"],
        "processing_date": DAY, "path": f"{folder}/t",
    }
    back = tables.read_dated(spark, f"{folder}/t")
    assert rows(back.select("id", "country", "state", "v", "_processing_date")) == [
        ("1", "US", "01", 1, DAY), ("2", None, "CA", 2, DAY),
    ]
    assert back.schema["_processing_date"].dataType.simpleString() == "string"
    assert not [n for n in os.listdir(f"{folder}/t") if n.startswith("_staging")]


def test_rerun_replaces_the_date_only(spark, folder):
    path, cells = f"{folder}/t", ["country"]
    df = spark.createDataFrame([("1", "US", "", 1), ("2", "CA", "", 1)], CELLS)
    tables.write_dated(df, path, DAY, cells)
    tables.write_dated(df, path, NEXT, cells)
    tables.write_dated(df.filter("country = 'US'"), path, DAY, cells)
    assert rows(tables.read_dated(spark, path, DAY).select("id")) == [("1",)]
    assert tables.read_dated(spark, path, NEXT).count() == 2
    tables.write_dated(df.filter("country = 'US'"), path, NEXT, cells, replace="cells")
    assert tables.read_dated(spark, path, NEXT).count() == 2  # the other cell stays
    tables.write_dated(df.limit(0), path, NEXT, cells, replace="cells")
    assert tables.read_dated(spark, path, NEXT).count() == 2  # no cells, nothing to replace
    tables.write_dated(df.limit(0), path, NEXT, cells)
    assert tables.read_dated(spark, path, NEXT).count() == 0  # the date itself is replaced
    with pytest.raises(ValueError):
        tables.write_dated(df, path, DAY, replace="everything")


def test_rerun_can_read_the_date_it_replaces(spark, folder):
    path = f"{folder}/t"
    tables.write_dated(spark.createDataFrame([("1", "US", "", 1)], CELLS), path, DAY, ["country"])
    doubled = tables.read_dated(spark, path, DAY).withColumn("v", F.col("v") * 2)
    tables.write_dated(doubled, path, DAY, ["country"])
    assert tables.read_dated(spark, path, DAY).first().v == 2


def test_default_date_is_today(spark, folder):
    df = spark.createDataFrame([("1", "US", "", 1)], CELLS)
    assert tables.write_dated(df, f"{folder}/t")["processing_date"] == date.today().isoformat()


def test_read_of_a_date_lists_one_folder(spark, folder):
    df = spark.createDataFrame([("1", "US", "", 1)], CELLS)
    for day in (DAY, NEXT):
        tables.write_dated(df, f"{folder}/t", day, ["country"])
    one = tables.read_dated(spark, f"{folder}/t", DAY)
    assert len(one.inputFiles()) == 1 and DAY in one.inputFiles()[0]


def test_date_the_table_lacks(spark, folder):
    df = spark.createDataFrame([("1", "US", "01", 1)], CELLS)
    tables.write_dated(df, f"{folder}/t", DAY, ["country", "state"])
    absent = tables.read_dated(spark, f"{folder}/t", NEXT)
    assert absent.count() == 0 and set(absent.columns) == {*df.columns, "_processing_date"}
    with pytest.raises(tables.AnalysisException):
        tables.read_dated(spark, f"{folder}/absent", NEXT)


def test_hot_cell_is_split(spark, folder):
    """A cell with most of the rows is written as several files, small cells as one each."""
    df = spark.range(0, 400000, 1, 8).select(
        F.when(F.col("id") % 4 > 0, F.lit("hot"))
        .otherwise(F.concat(F.lit("c"), F.col("id") % 5))
        .alias("country"),
        F.sha2(F.col("id").cast("string"), 256).alias("text"),
    )
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(size)
    spark.conf.set(size, "4m")
    try:
        tables.write_dated(df, f"{folder}/t", DAY, ["country"])
    finally:
        spark.conf.set(size, before)
    files = lambda cell: os.listdir(f"{folder}/t/_processing_date={DAY}/country={cell}")
    written = lambda cell: len([f for f in files(cell) if f.endswith(".parquet")])
    assert written("hot") > 1
    assert written("c0") <= 2


# --- snapshots and metrics ---------------------------------------------------------------


def test_snapshots(spark, folder):
    df = spark.createDataFrame([("a", 1)], "k string, record_count long")
    for day, hour, n in ((DAY, 1, 1), (DAY, 2, 2), (NEXT, 1, 3)):
        written = tables.write_snapshot(df.withColumn("v", F.lit(n)), folder, "by_k", day, now=datetime(2026, 1, 27, hour))
        assert written["record_count"] == 1
    tables.write_snapshot(df, folder, "by_k_more", NEXT)
    assert tables.read_snapshot(spark, folder, "by_k").first().v == 3
    latest = tables.read_snapshot(spark, folder, "by_k", DAY).first()
    assert (latest.v, latest._execution_date, latest._processing_timestamp) == (2, DAY, "20260127_020000_000000")
    assert tables.find_snapshot(spark, folder, "by") is None
    with pytest.raises(FileNotFoundError):
        tables.read_snapshot(spark, folder, "by_k", "2020-01-01")
    assert tables.find_snapshot(spark, f"{folder}/absent", "by_k") is None
    assert rows(tables.found_snapshots(spark, folder)) == [("by_k", DAY), ("by_k", NEXT), ("by_k_more", NEXT)]


def test_names_to_the_second_are_read_too(spark, folder):
    df = spark.createDataFrame([("a", 1)], "k string, v long")
    df.write.parquet(f"{folder}/by_k_gold_{DAY}_20260127_054115")
    assert tables.read_snapshot(spark, folder, "by_k").first().v == 1


def test_half_written_snapshot_is_not_found(spark, folder):
    df = spark.createDataFrame([("a",)], "k string").withColumn("v", F.raise_error("lost"))
    with pytest.raises(Exception, match="lost"):
        tables.write_snapshot(df, folder, "by_k", DAY)
    assert tables.find_snapshot(spark, folder, "by_k") is None


def test_metrics_log(spark, folder):
    tables.append_metrics(spark, f"{folder}/m", {"stage": "a", "n": 1}, datetime(2026, 1, 1))
    tables.append_metrics(spark, f"{folder}/m", {"stage": "b", "detail": {"n": 2}})
    log = tables.read_metrics(spark, f"{folder}/m", "stage string, n long, detail string, timestamp string")
    found = {r.stage: r for r in log.collect()}
    assert found["a"].n == 1 and found["a"].timestamp == "2026-01-01T00:00:00"
    assert json.loads(found["b"].detail) == {"n": 2}


def test_workspace_is_under_the_shared_folder(spark):
    assert storage.workspace(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


# --- the day -----------------------------------------------------------------------------

PLACE_FIELDS = [FieldSpec(n) for n in ("id", "name", "kind", "street", "city", "state", "country", "postal_code", "phone", "website_url")] + [
    FieldSpec("latitude", "double"), FieldSpec("longitude", "double"),
]
SPEC = place_dataset("places", PLACE_FIELDS, "kind", ["micro", "nano"], min_landed=3)


def place(i, **changes):
    record = {
        "id": str(i), "name": f" Place {i} ", "kind": "micro", "street": "1 Main", "city": "Denver",
        "state": "co", "country": "usa", "postal_code": "80202-", "phone": "303 555 1234",
        "website_url": "http://x", "latitude": "39.7", "longitude": -104.9,
    }
    return {**record, **changes}


DAY_RECORDS = [place(1), place(2, country="England", state=None, kind="nano"), place(3, latitude=None, street=""), place(3, name="newer")]


@pytest.fixture
def layout(folder):
    return Layout.under(folder, "places")


def land_day(layout, records, day=DAY, second=1):
    land_file(layout.landing, f"places_bronze_api_{day}_20260126_00000{second}.json", records)


def test_whole_day(spark, layout):
    land_day(layout, DAY_RECORDS)
    day = daily.run_day(spark, SPEC, layout, DAY)
    assert day["silver"]["records_written"] == 3
    silver = {r.id: r for r in daily.read_silver(spark, layout, DAY).collect()}
    assert silver["1"].country == silver["3"].country == "United States"
    assert (silver["2"].country, silver["2"].state, silver["1"].state) == ("United Kingdom", "Unknown", "CO")
    assert (silver["1"].name, silver["3"].name) == ("Place 1", "newer")
    assert (silver["1"].phone, silver["1"].postal_code) == ("(303) 555-1234", "80202")
    assert silver["1"].data_quality_score == 100 and silver["1"]._layer == "silver"
    gold = tables.read_snapshot(spark, layout.gold, "places_by_type", DAY)
    assert rows(gold.select("kind", "record_count", "percentage_of_total")) == [("micro", 2, 66.67), ("nano", 1, 33.33)]
    assert day["gold"]["places_data_quality_metrics"]["record_count"] == 1
    reported = day["gold_checks"]["gold"]["metrics"]
    assert reported["places_by_type_count"] == 2
    assert reported["places_by_type_path"] == os.path.basename(day["gold"]["places_by_type"]["path"])
    log = tables.read_metrics(spark, layout.metrics, "run_date string, bronze_record_count double")
    assert rows(log) == [(DAY, 4.0)]


def test_rerun_gives_the_same_day(spark, layout):
    land_day(layout, DAY_RECORDS)
    daily.run_day(spark, SPEC, layout, DAY)
    first = rows(daily.read_silver(spark, layout, DAY).drop("_processing_timestamp"))
    daily.run_day(spark, SPEC, layout, DAY)
    assert rows(daily.read_silver(spark, layout, DAY).drop("_processing_timestamp")) == first


def test_silver_with_quarantine(spark, layout, folder):
    land_day(layout, [*DAY_RECORDS, place(8, name=None), place(9, latitude=95, kind="pub")])
    written = daily.build_silver(spark, SPEC, layout, DAY, quarantine=f"{folder}/rejected")
    assert (written["records_written"], written["quarantined"]) == (3, 2)
    assert {r.id for r in daily.read_silver(spark, layout, DAY).collect()} == {"1", "2", "3"}
    rejected = tables.read_dated(spark, f"{folder}/rejected", DAY)
    assert {r.id: r._reasons for r in rejected.collect()} == {
        "8": ["name_missing"], "9": ["latitude_out_of_range", "kind_not_allowed"],
    }
    assert not [n for n in os.listdir(layout.silver) if n.startswith("_staging")]
    checks.assert_passed(daily.check_silver(spark, SPEC, layout, DAY))


def test_gold_counts_one_date_or_all(spark, layout):
    for day in (DAY, NEXT):
        land_day(layout, DAY_RECORDS, day)
        daily.build_silver(spark, SPEC, layout, day)
    total = lambda: tables.read_snapshot(spark, layout.gold, "places_data_quality_metrics").first().total_records
    daily.build_gold(spark, SPEC, layout, NEXT)
    assert total() == 3
    daily.build_gold(spark, SPEC, layout, NEXT, source_date=None)
    assert total() == 6
    assert not [n for n in os.listdir(layout.gold) if n.startswith("_staging")]


def test_failed_layer_stops_the_day(spark, layout):
    land_day(layout, DAY_RECORDS[:2])
    with pytest.raises(checks.QualityGateError, match=r"bronze.*record_count is 2\.00, limit 3\.00"):
        daily.run_day(spark, SPEC, layout, DAY)
    assert not os.path.exists(layout.silver)
    land_day(layout, [place(9, name=None)], second=2)
    with pytest.raises(checks.QualityGateError, match=r"silver.*name_null_count is 1\.00, limit 0\.00"):
        daily.run_day(spark, SPEC, layout, DAY)
    assert not os.path.exists(layout.gold)


def test_checks_of_missing_layers(spark, layout):
    results = checks.summary(daily.check_all(spark, SPEC, layout, DAY))
    assert [results[k]["passed"] for k in ("bronze", "silver", "gold")] == [False] * 3
    assert len(results["gold"]["errors"]) == len(SPEC.rollups)
    nothing = daily.check_gold(spark, SPEC, layout, DAY, expected=[])
    assert "does not exist" in nothing.first().message
    os.makedirs(layout.gold)
    assert daily.check_gold(spark, SPEC, layout, DAY, expected=[]).count() == 0


def test_unreadable_snapshot(spark, layout):
    os.makedirs(f"{layout.gold}/t_gold_{DAY}_20260126_000000")
    (row,) = daily.check_gold(spark, SPEC, layout, DAY, expected=["t"]).collect()
    assert not row.passed and row.message.startswith("Cannot read table t")


def test_kpis_of_a_day(spark, layout):
    land_day(layout, DAY_RECORDS)
    spec = replace(SPEC, quality=replace(SPEC.quality, min_landed=1))
    daily.run_day(spark, spec, layout, DAY)
    silver = daily.read_silver(spark, layout, DAY)
    metrics = daily.kpi_metrics(spark, daily.check_all(spark, spec, layout, DAY), spec, silver)
    values = {r.metric: r.value for r in metrics.collect()}
    assert values["bronze_record_count"] == 4 and values["silver_bronze_delta_pct"] == 25.0
    assert values["gold_row_count"] == 2 and values["duplicate_count"] == 0


def test_following_arrivals_rebuilds_only_dates_with_news(spark, layout, folder):
    def follow():
        follow_landed(spark, replace(SPEC, quality=replace(SPEC.quality, min_landed=1)), layout, f"{folder}/seen").awaitTermination()

    def built(day):
        return daily.read_silver(spark, layout, day).first()._processing_timestamp

    land_day(layout, DAY_RECORDS)
    land_day(layout, DAY_RECORDS[:1], NEXT)
    follow()
    assert daily.read_silver(spark, layout, DAY).count() == 3
    before = built(DAY), built(NEXT)
    landing.append_records(spark.createDataFrame([place(7)]), layout.landing, "places", NEXT)
    follow()
    assert daily.read_silver(spark, layout, NEXT).count() == 2
    assert built(DAY) == before[0] and built(NEXT) > before[1]


def test_a_broken_off_replacement_still_reads_the_old_date(spark, folder, monkeypatch):
    path, rows_of = f"{folder}/t", lambda v: spark.createDataFrame([(v, "x")], "v int, country string")
    tables.write_dated(rows_of(1), path, DAY, ["country"])
    real = storage.move

    def dies(spark_, source, target):
        if "_retired_" not in target and target.endswith(DAY):
            raise KeyboardInterrupt
        real(spark_, source, target)

    # The process ends between the two moves: nothing cleans up.
    monkeypatch.setattr(storage, "move", dies)
    monkeypatch.setattr(tables, "restore_dates", lambda *a: None)
    monkeypatch.setattr(storage, "delete", lambda *a: None)
    with pytest.raises(KeyboardInterrupt):
        tables.write_dated(rows_of(2), path, DAY, ["country"])
    monkeypatch.undo()
    assert [r.v for r in tables.read_dated(spark, path, DAY).collect()] == [1]
    tables.write_dated(rows_of(3), path, DAY, ["country"])
    assert [r.v for r in tables.read_dated(spark, path).collect()] == [3]


def test_a_failed_replacement_leaves_the_old_date_and_no_staging(spark, folder, monkeypatch):
    path = f"{folder}/t"
    tables.write_dated(spark.range(1), path, DAY)
    real = storage.move

    def fails(spark_, source, target):
        if "_retired_" not in target and "_staging_" in source and "_retired_" not in source:
            raise OSError("no")
        real(spark_, source, target)

    monkeypatch.setattr(storage, "move", fails)
    with pytest.raises(OSError):
        tables.write_dated(spark.range(5), path, DAY)
    monkeypatch.undo()
    assert tables.read_dated(spark, path, DAY).count() == 1
    assert storage.names(spark, f"{path}/_staging_*") == []


def test_an_empty_first_day_can_be_read(spark, folder):
    path = f"{folder}/t"
    tables.write_dated(spark.createDataFrame([], "v int, country string"), path, DAY, ["country"])
    for df in (tables.read_dated(spark, path), tables.read_dated(spark, path, DAY)):
        assert df.collect() == [] and df.columns == ["v", "_processing_date", "country"]


def test_only_given_or_defaulted_dates_are_emptied(spark, folder):
    path = f"{folder}/t"
    both = spark.createDataFrame([(1, DAY), (2, NEXT)], f"v int, {tables.DATE_COLUMN} string")
    tables.write_dated(both, path)
    tables.write_dated(both.filter("v = 2"), path)
    assert sorted(r.v for r in tables.read_dated(spark, path).collect()) == [1, 2]
    tables.write_dated(both.filter("v = 3"), path, DAY)
    assert [r.v for r in tables.read_dated(spark, path).collect()] == [2]


def test_columns_of_earlier_writes_stay_readable(spark, folder):
    path = f"{folder}/t"
    tables.write_dated(spark.createDataFrame([(1, "a")], "v int, old string"), path, DAY)
    tables.write_dated(spark.createDataFrame([(2, "b")], "v int, new string"), path, NEXT)
    found = tables.read_dated(spark, path)
    assert sorted((r.v, r.old, r.new) for r in found.collect()) == [(1, "a", None), (2, None, "b")]


def damage(folder, page):
    """Breaks the footer of every parquet file below a folder, or the data before it."""
    for base, _, files in os.walk(folder):
        for name in files:
            if name.endswith(".parquet"):
                with open(f"{base}/{name}", "r+b") as f:
                    size = f.seek(0, 2)
                    f.seek(size - 8)
                    footer = int.from_bytes(f.read(4), "little")
                    start, stop = (4, size - 8 - footer) if page else (size - 12, size)
                    f.seek(start)
                    f.write(b"\xff" * (stop - start))
            elif name.endswith(".crc"):
                os.remove(f"{base}/{name}")


@pytest.mark.parametrize("page", [False, True])
def test_damaged_tables_become_error_rows(spark, layout, page):
    spec = replace(SPEC, quality=replace(SPEC.quality, min_landed=1))
    land_day(layout, DAY_RECORDS)
    daily.run_day(spark, spec, layout, DAY)
    bad = tables.find_snapshot(spark, layout.gold, "places_by_type", DAY)
    damage(bad, page)
    found = daily.check_gold(spark, spec, layout, DAY).collect()
    assert [r.dataset for r in found if r.metric == "readable" and not r.passed] == ["places_by_type"]
    assert {r.dataset for r in found} == {r.name for r in spec.rollups}
    damage(layout.silver, page)
    (row,) = daily.check_silver(spark, spec, layout, DAY).collect()
    assert (row.metric, row.passed) == ("readable", False)


def test_broken_lines_are_an_error(spark, folder):
    name = f"{folder}/places_bronze_api_{DAY}_20260125_010000.jsonl"
    spark.createDataFrame([('{"id": "1"}',), ("{broken",), ("",)], "value string").write.text(name)
    with pytest.raises(Exception, match="Invalid JSON line"):
        landing.scan(spark, folder, DAY).collect()
    assert landing.scan(spark, folder, DAY, on_invalid="skip").count() == 1


def test_the_result_of_silver_counts_what_was_left_out(spark, layout):
    records = [*DAY_RECORDS, DAY_RECORDS[0], {**DAY_RECORDS[1], "id": None}]
    land_day(layout, records)
    written = daily.build_silver(spark, replace(SPEC, required=()), layout, DAY)
    assert written["records_read"] == len(records) and written["null_keys"] == 1
    assert written["duplicates_removed"] == len(records) - written["records_written"]


def test_a_failed_day_leaves_a_line_in_the_log(spark, layout):
    layout = replace(layout, metrics=f"{layout.gold}_log")
    land_day(layout, DAY_RECORDS)
    with pytest.raises(checks.QualityGateError):
        daily.run_day(spark, replace(SPEC, quality=replace(SPEC.quality, min_landed=10**6)), layout, DAY)
    (line,) = tables.read_metrics(spark, layout.metrics, "run_date string, failure string, alerts array<struct<layer:string>>").collect()
    assert line.run_date == DAY and "Validation failed" in line.failure and line.alerts[0].layer == "bronze"


def test_following_passes_over_runs_of_others(spark, layout, folder):
    land_day(layout, DAY_RECORDS)
    frame = spark.createDataFrame([("x",)], "id string")
    landing.append_records(frame, layout.landing, "places", NEXT, "feed")
    landing.append_records(frame, layout.landing, "others", NEXT, "api")
    follow_landed(spark, SPEC, layout, f"{folder}/seen").awaitTermination()
    assert daily.read_silver(spark, layout, DAY).count() == 3
    assert daily.read_silver(spark, layout, NEXT).count() == 0
    assert tables.find_snapshot(spark, layout.gold, SPEC.rollups[0].name, DAY)
