import pytest
from pyspark.sql import functions as F

from strata.operators import rollup
from strata.plans.specs import RollupSpec, place_rollups
from tests.support import plan, rows

PLACES = [
    ("1", "micro", "Denver", "CO", "US", 100.0, True, True, "1", "u"),
    ("2", "micro", "Boulder", "CO", "US", 75.0, True, False, None, "u"),
    ("3", "micro", "Austin", "TX", "US", 50.0, False, False, "3", None),
    ("4", "nano", "Austin", "TX", "US", None, None, True, "4", None),
    ("5", None, "Leeds", None, "UK", 25.0, True, True, "5", None),
]
SCHEMA = (
    "id string, kind string, city string, state string, country string, data_quality_score double, "
    "is_valid_location boolean, has_complete_address boolean, phone string, website_url string"
)


@pytest.fixture(scope="module")
def places(spark):
    return spark.createDataFrame(PLACES, SCHEMA)


def test_counts_and_null_group(places):
    out = rollup.aggregate_by_dimensions(places, ["kind"])
    assert out.columns == ["kind", "record_count", "_created_at"]
    assert rows(out.drop("_created_at")) == sorted([("micro", 3), ("nano", 1), (None, 1)], key=str)


def test_percentages(places):
    out = rollup.aggregate_by_dimensions(places, ["country"], include_percentage=True)
    assert rows(out.drop("_created_at")) == [("UK", 1, 20.0), ("US", 4, 80.0)]
    thirds = places.limit(3).withColumn("n", F.col("id").cast("int"))
    out = rollup.aggregate_by_dimensions(thirds, ["n"], include_percentage=True)
    assert {r.percentage_of_total for r in out.collect()} == {33.33}


def test_percentage_needs_the_count(places):
    out = rollup.aggregate_by_dimensions(
        places, ["kind"], include_count=False, include_percentage=True, additional_aggs={"n": "count"}
    )
    assert out.columns == ["kind", "n", "_created_at"]


def test_every_function(places):
    score = "data_quality_score"
    out = rollup.aggregate_by_dimensions(
        places,
        ["country"],
        include_percentage=True,
        additional_aggs={
            "n": "count",
            "mean": (score, "avg"),
            "mean2": (score, "avg_2dp"),
            "total": (score, "sum"),
            "low": (score, "min"),
            "high": (score, "max"),
            "cities": ("city", "count_distinct"),
            "kinds": ("kind", "collect_set"),
            "located": ("is_valid_location", "count_true"),
            "phones": ("phone", "count_present"),
        },
    ).drop("_created_at")
    us = out.filter("country = 'US'").first()
    assert us.asDict() == {
        "country": "US", "record_count": 4, "n": 4, "mean": 75.0, "mean2": 75.0, "total": 225.0,
        "low": 50.0, "high": 100.0, "cities": 3, "kinds": ["micro", "nano"], "located": 2,
        "phones": 3, "percentage_of_total": 80.0,
    }
    uk = out.filter("country = 'UK'").first()
    assert (uk.cities, uk.kinds, uk.mean) == (1, [], 25.0)


def test_unknown_function_and_dimension(places):
    with pytest.raises(ValueError, match="Unknown aggregate for 'x'"):
        rollup.aggregate_by_dimensions(places, ["kind"], additional_aggs={"x": ("id", "median")})
    with pytest.raises(ValueError, match="no such columns.*planet"):
        rollup.aggregate_by_dimensions(places, ["planet"])
    with pytest.raises(ValueError, match="nothing to aggregate"):
        rollup.aggregate_by_dimensions(places, ["kind"], include_count=False)


def test_place_rollups(places):
    by_type, by_location, by_both, health = place_rollups("p", "kind")
    ordered = rollup.aggregate(places, by_type).drop("_created_at").collect()
    assert [tuple(r) for r in ordered][0] == ("micro", 3, 60.0)
    location = rollup.aggregate(places, by_location).filter("state = 'TX'").first()
    assert (location.city_count, location.kinds, location.record_count) == (1, ["micro", "nano"], 2)
    assert rollup.aggregate(places, by_both).count() == 5
    summary = rollup.aggregate(places, health).drop("_created_at").first().asDict()
    assert summary == {
        "total_records": 5, "country_count": 2, "state_count": 2, "city_count": 4, "kind_count": 2,
        "avg_quality_score": 62.5, "min_quality_score": 25.0, "max_quality_score": 100.0,
        "valid_location_count": 3, "complete_address_count": 3, "records_with_phone": 4,
        "records_with_website": 2,
    }


def test_summary_of_nothing(places):
    empty = rollup.aggregate(places.limit(0), place_rollups("p", "kind")[3]).first()
    assert (empty.total_records, empty.avg_quality_score, empty.valid_location_count) == (0, None, None)


def test_summary_skips_absent_columns(places):
    summary = rollup.aggregate(places.drop("phone", "is_valid_location"), place_rollups("p", "kind")[3])
    assert "records_with_phone" not in summary.columns
    assert "valid_location_count" not in summary.columns
    assert "records_with_website" in summary.columns


def test_one_base_serves_all_place_rollups():
    plans = rollup.plan_bases(place_rollups("p", "kind"))
    assert [(set(grain), len(covered)) for grain, covered in plans] == [
        ({"country", "state", "city", "kind"}, 4)
    ]
    plans = rollup.plan_bases([RollupSpec("a", ["x", "y"]), RollupSpec("b", ["z"]), RollupSpec("c", ["x"])])
    assert [[s.name for s in covered] for _, covered in plans] == [["a", "c"], ["b"]]


def test_shared_base_gives_the_same_tables(places):
    specs = place_rollups("p", "kind")
    (grain, covered), = rollup.plan_bases(specs)
    base = rollup.base_for(places, covered, grain)
    for spec in specs:
        alone = rollup.aggregate(places, spec).drop("_created_at")
        assert rows(rollup.rollup(base, spec).drop("_created_at")) == rows(alone)


def test_share_reuses_the_shuffle_and_needs_no_single_task_window(spark, tmp_path):
    path = str(tmp_path / "p")
    spark.createDataFrame(PLACES, SCHEMA).write.parquet(path)
    spec = place_rollups("p", "kind")[1]
    base = rollup.base_for(spark.read.parquet(path), [spec], ["country", "state", "city", "kind"])
    text = plan(rollup.rollup(base, spec), run=True)
    assert "ReusedExchange" in text and "Window" not in text
    assert text.count("FileScan") == 1
    numeric = {"mean": ("data_quality_score", "avg"), "cities": ("city", "count_distinct")}
    out = rollup.aggregate_by_dimensions(
        spark.read.parquet(path), ["country"], include_percentage=True, additional_aggs=numeric
    )
    text = plan(out, run=True)
    assert "ReusedExchange" in text and text.count("FileScan") == 1
    assert "id:string" not in text.split("ReadSchema: ")[1].splitlines()[0]


def test_hot_group(spark):
    """One group holds most rows; its rows are combined before any shuffle."""
    df = spark.range(0, 20000, 1, 8).select(
        F.when(F.col("id") % 10 < 7, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("g"),
        (F.col("id") % 50).alias("v"),
    )
    out = rollup.aggregate_by_dimensions(df, ["g"], additional_aggs={"d": ("v", "count_distinct")})
    hot = out.filter("g = 'hot'").first()
    assert (hot.record_count, hot.d) == (14000, 35)
    assert "partial_count" in plan(out)


def test_wide_distinct_columns_are_never_shuffled_together(spark):
    df = spark.range(0, 3000, 1, 4).select(
        (F.col("id") % 3).alias("g"), F.col("id").alias("a"), (F.col("id") % 700).alias("b"), (-F.col("id")).alias("c")
    )
    measures = {f"n_{x}": (x, "count_distinct") for x in "abc"}
    out = rollup.aggregate_by_dimensions(df, ["g"], True, True, measures)
    text = plan(out, run=True)
    keys = [line for line in text.splitlines() if "Exchange hashpartitioning" in line]
    assert keys and not any("a#" in line and "b#" in line for line in keys) and "Expand" not in text
    assert rows(out.drop("_created_at")) == [(g, 1000, 1000, 700, 1000, 33.33) for g in (0, 1, 2)]
    total = rollup.aggregate_by_dimensions(df, [], True, True, measures).first()
    assert (total.record_count, total.n_a, total.n_b, total.n_c, total.percentage_of_total) == (3000, 3000, 700, 3000, 100.0)


def test_distinct_columns_share_a_base_only_with_dimensions():
    wide = RollupSpec("wide", ["x"], {"p": ("a", "count_distinct"), "q": ("b", "count_distinct")})
    assert rollup.plan_bases([wide]) == [(None, [wide])]
    fine = RollupSpec("fine", ["x", "a", "b"])
    ((grain, covered),) = rollup.plan_bases([wide, fine])
    assert set(grain) == {"x", "a", "b"} and len(covered) == 2


def test_share_of_nothing(places):
    out = rollup.aggregate_by_dimensions(places.limit(0), [], True, True).first()
    assert (out.record_count, out.percentage_of_total) == (0, None)
