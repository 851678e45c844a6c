import pytest

from strata.plans.specs import RollupSpec, dataset_from_config, place_dataset, place_rollups

SETTINGS = {
    "schemas": {
        "silver": {
            "fields": [
                {"name": "id", "type": "string", "nullable": False, "description": "key"},
                {"name": "latitude", "type": "double"},
                {"name": "shop_type"},
            ],
            "required_fields": ["id"],
            "valid_shop_types": ["big", "small"],
        }
    },
    "storage": {"layers": {"silver": {"partition_by": ["country"]}}},
    "data_quality": {
        "thresholds": {"bronze_min_records": 7, "silver_quality_score": 0.5, "gold_completeness": 0.9},
        "validations": {
            "bronze": [{"check": "schema_valid", "required_fields": ["id", "shop_type"]}, {"check": "other"}],
            "silver": {
                "unique_key": "id",
                "required_fields": ["id"],
                "value_ranges": {"latitude": [-90, 90], "broken": [1]},
                "allowed_values": {"shop_type": ["big", "small"], "none": []},
            },
            "gold": {"count_columns": ["record_count"], "percentage_columns": ["percentage_of_total"]},
        },
    },
    "transformations": {
        "silver": {
            "deduplication": {"key": "id"},
            "standardization": {
                "country": {"usa": "United States"},
                "state": {"normalize": True},
                "phone": {"format": "us", "strip_non_digits": True},
                "postal_code": {"strip_trailing_dash": True},
            },
            "null_handling": {"default_values": {"country": "Unknown"}},
        },
        "gold": {
            "aggregations": [
                {"name": "by_type", "group_by": ["shop_type"], "metrics": ["record_count", "percentage_of_total"]},
                {
                    "name": "health",
                    "metrics": ["total", "mean"],
                    "measures": {"total": "count", "mean": ["data_quality_score", "avg"]},
                },
            ]
        },
    },
}


def test_settings_mapping():
    spec = dataset_from_config("shops", SETTINGS)
    assert [f.name for f in spec.fields] == ["id", "latitude", "shop_type"]
    assert not spec.fields[0].nullable and spec.fields[2].type == "string"
    assert spec.domains == {"shop_type": ("big", "small")}
    assert spec.partition_by == ("country",)
    assert spec.standardize.value_maps == {"country": {"usa": "United States"}}
    assert spec.standardize.upper == ("state",) and spec.standardize.us_phone == ("phone",)
    assert spec.standardize.digits_only == ("phone",) and spec.standardize.trailing_dash == ("postal_code",)
    assert spec.defaults == {"country": "Unknown"}
    assert spec.quality.min_landed == 7 and spec.quality.landed_fields == ("id", "shop_type")
    assert spec.quality.ranges == {"latitude": (-90, 90)}
    assert spec.quality.allowed == {"shop_type": ("big", "small")}
    assert spec.quality.mean_score == 0.5 and spec.quality.completeness == 0.9
    assert spec.rollups == (
        RollupSpec("by_type", ("shop_type",), {}, True, True, ("-record_count",)),
        RollupSpec("health", (), {"total": "count", "mean": ("data_quality_score", "avg")}, False, False),
    )


def test_empty_settings_have_defaults():
    spec = dataset_from_config("x", {})
    assert (spec.key, spec.partition_by, spec.rollups) == ("id", ("country", "state"), ())
    assert spec.quality.min_landed == 100 and spec.standardize.value_maps == {}


def test_undefined_metric_is_rejected():
    settings = {"transformations": {"gold": {"aggregations": [{"name": "a", "metrics": ["mystery"]}]}}}
    with pytest.raises(ValueError, match="a: no definition for metric.*mystery"):
        dataset_from_config("x", settings)
    given = place_rollups("x", "kind")
    assert dataset_from_config("x", settings, given).rollups == tuple(given)


def test_place_dataset_tables():
    spec = place_dataset("shops", [], "shop_type", ["big"])
    assert [r.name for r in spec.rollups] == [
        "shops_by_type", "shops_by_location", "shops_by_type_location", "shops_data_quality_metrics",
    ]
    assert "shop_types" in spec.rollups[1].measures and "shop_type_count" in spec.rollups[3].measures


def test_metrics_by_name_and_orders():
    settings = {
        "schemas": {"silver": {"fields": [{"name": n, "type": "string"} for n in ("code", "city", "kind", "state")]}},
        "transformations": {
            "silver": {"deduplication": {"key": "code"}},
            "gold": {
                "aggregations": [
                    {"name": "places", "group_by": ["state"], "metrics": ["record_count", "city_count", "kinds"]},
                    {"name": "fine", "group_by": ["state", "city"], "metrics": ["record_count"]},
                    {"name": "health", "metrics": ["total_records", "avg_quality_score"]},
                ]
            },
        },
    }
    spec = dataset_from_config("p", settings)
    assert spec.score.present == ("code", "name") and spec.quality.unique_key == "code"
    measures = {"city_count": ("city", "count_distinct"), "kinds": ("kind", "collect_set")}
    assert spec.rollups == (
        RollupSpec("places", ("state",), measures, True, False, ("-record_count",)),
        RollupSpec("fine", ("state", "city"), {}, True, False, ("state", "city")),
        RollupSpec("health", (), {"total_records": "count", "avg_quality_score": ("data_quality_score", "avg_2dp")}, False),
    )


def test_the_key_earns_points():
    assert place_dataset("p", ["code"], "kind", [], key="code").score.present == ("code", "name")
