from dataclasses import replace

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators import conform, dedup, preview, schema
from strata.operators.parse import parse_payload
from strata.plans.specs import COUNTRY_NAMES, DatasetSpec, ScoreSpec, StandardizeSpec
from strata.functions.text import MAX_LITERAL_MAPPING
from tests.support import plan, rows

FIELDS = [
    {"name": "id", "type": "string", "nullable": False},
    {"name": "name"},
    {"name": "latitude", "type": "double"},
    {"name": "count", "type": "LONG"},
]


# --- schema ------------------------------------------------------------------------------


def test_schema_types_and_nullability():
    built = schema.build_schema(FIELDS, audit_fields=[{"name": "_at", "type": "timestamp"}])
    assert built == T.StructType(
        [
            T.StructField("id", T.StringType(), False),
            T.StructField("name", T.StringType(), True),
            T.StructField("latitude", T.DoubleType(), True),
            T.StructField("count", T.LongType(), True),
            T.StructField("_at", T.TimestampType(), True),
        ]
    )


@pytest.mark.parametrize("name", sorted(schema.TYPES))
def test_every_type_name(name):
    assert schema.spark_type(name.upper()) == schema.TYPES[name]


def test_unknown_type_becomes_string():
    with pytest.warns(UserWarning, match="money"):
        assert schema.spark_type("money") == T.StringType()


def test_text_schema_required_and_types():
    assert {f.dataType for f in schema.build_text_schema(FIELDS)} == {T.StringType()}
    assert all(f.nullable for f in schema.build_text_schema(FIELDS))
    assert schema.required_fields(FIELDS) == ["id"]
    assert schema.required_fields([]) == []
    assert schema.field_types(FIELDS) == {
        "id": "string", "name": "string", "latitude": "double", "count": "LONG",
    }


# --- parsing -----------------------------------------------------------------------------


def test_parse_keeps_everything_as_text(spark):
    payloads = [
        '{"id": 1, "name": "a", "latitude": 40.5, "extra": 1}',
        '{"id": "2", "name": {"x": [1]}, "latitude": null}',
        "{bad",
        None,
    ]
    df = spark.createDataFrame([(p, i) for i, p in enumerate(payloads)], "payload string, n int")
    parsed = parse_payload(df, FIELDS, keep=["n"])
    assert [tuple(r) for r in parsed.orderBy("n").collect()] == [
        ("1", "a", "40.5", None, 0),
        ("2", '{"x":[1]}', None, None, 1),
        (None, None, None, None, 2),
        (None, None, None, None, 3),
    ]


# --- typing ------------------------------------------------------------------------------


def test_only_floats_are_cast_by_default(spark):
    df = spark.createDataFrame([("1", "x", "40.5", "7"), ("2", "y", "bad", "z")], "id string, name string, latitude string, count string")
    assert rows(conform.enforce_types(df, FIELDS)) == [("1", "x", 40.5, "7"), ("2", "y", None, "z")]
    cast = conform.enforce_types(df, FIELDS, conform.ALL_TYPES)
    assert rows(cast) == [("1", "x", 40.5, 7), ("2", "y", None, None)]


def test_missing_required_column(spark):
    df = spark.createDataFrame([("1",)], "id string")
    with pytest.raises(ValueError, match="name.*are required and absent"):
        conform.require_columns(df, ["id", "name"])


def test_audits_are_one_pass(spark):
    df = spark.createDataFrame([("1", None, "a"), (None, None, "z"), ("3", "n", None)], "id string, name string, kind string")
    nulls = conform.required_null_audit(df, ["id", "name"])
    assert rows(nulls) == [("id", 1), ("name", 2)]
    assert plan(nulls).count("Scan ExistingRDD") == 1
    assert rows(conform.domain_audit(df, {"kind": ["a", "b"], "absent": ["x"]})) == [("kind", 1)]


# --- standardising -----------------------------------------------------------------------

RULES = StandardizeSpec(
    value_maps={"country": COUNTRY_NAMES},
    upper=("state",),
    digits_only=("phone",),
    us_phone=("phone",),
    trailing_dash=("postal_code",),
)


def test_standardize(spark):
    df = spark.createDataFrame(
        [(" usa ", "ca", "303 555 1234", "123-", " x "), ("", " ", "N/A", "", "")],
        "country string, state string, phone string, postal_code string, _system string",
    )
    assert rows(conform.standardize(df, RULES)) == sorted(
        [("United States", "CA", "(303) 555-1234", "123", " x "), (None, None, "", None, None)], key=str
    )


def test_blank_results_can_become_null(spark):
    df = spark.createDataFrame([("N/A", "-")], "phone string, postal_code string")
    assert rows(conform.standardize(df, RULES)) == [("", "")]
    assert rows(conform.standardize(df, replace(RULES, blank_results_to_null=True))) == [(None, None)]


def test_steps_can_be_replaced(spark):
    df = spark.createDataFrame([(" a ",)], "id string")
    spec = DatasetSpec("t", (), required=("id",))
    assert conform.conform(df, spec).columns == ["id", "data_quality_score", "_processing_timestamp", "_layer"]
    steps = (lambda rows, spec: conform.standardize(rows, spec.standardize), lambda rows, spec: rows.withColumn("n", F.lit(1)))
    assert rows(conform.conform(df, spec, steps)) == [("a", 1)]


def test_standardize_skips_absent_columns(spark):
    df = spark.createDataFrame([(" a ", 1)], "name string, n int")
    assert rows(conform.standardize(df, RULES)) == [("a", 1)]


def test_long_mapping_is_a_broadcast_join(spark):
    rules = {f"K{i}": f"v{i}" for i in range(MAX_LITERAL_MAPPING + 1)}
    df = spark.createDataFrame([("k7",), ("other",), (None,)], "country string")
    mapped = conform.map_values(df, "country", rules)
    assert rows(mapped) == sorted([("v7",), ("other",), (None,)], key=str)
    assert "BroadcastHashJoin" in plan(mapped)
    assert mapped.columns == ["country"]


def test_defaults(spark):
    df = spark.createDataFrame([(None, "CA"), ("X", None)], "country string, state string")
    filled = conform.fill_defaults(df, {"country": "Unknown", "state": "Unknown", "absent": "?"})
    assert rows(filled) == [("Unknown", "CA"), ("X", "Unknown")]


# --- scoring -----------------------------------------------------------------------------

PLACE = "id string, name string, latitude double, longitude double, street string, city string, state string, postal_code string"


def test_full_and_partial_score(spark):
    df = spark.createDataFrame(
        [
            ("1", "a", 40.0, -74.0, "s", "c", "st", "1"),
            ("2", "b", None, -74.0, None, "c", "st", "1"),
            (None, None, 200.0, 0.0, "s", "c", "st", None),
        ],
        PLACE,
    )
    scored = conform.add_quality(df).select("is_valid_location", "has_complete_address", "data_quality_score")
    assert [tuple(r) for r in scored.collect()] == [(True, True, 100), (False, False, 50), (False, False, 0)]


def test_absent_columns_earn_nothing(spark):
    df = spark.createDataFrame([("1",)], "id string")
    scored = conform.add_quality(df)
    assert scored.columns == ["id", "data_quality_score"]
    assert scored.first().data_quality_score == 25
    other = conform.add_quality(df, ScoreSpec(present=("id",), points=10))
    assert other.first().data_quality_score == 10


# --- de-duplication ----------------------------------------------------------------------


def test_latest_row_per_key(spark):
    df = spark.createDataFrame([("1", 1), ("1", 2), (" 1", 3), (None, 1), (None, 5)], "id string, v int")
    latest = dedup.keep_latest(df, "id", [F.desc("v")])
    assert rows(latest) == sorted([("1", 2), (" 1", 3), (None, 5)], key=str)
    trimmed = dedup.keep_latest(df, "id", [F.desc("v")], normalize_key=True)
    assert rows(trimmed) == sorted([(" 1", 3), (None, 5)], key=str)
    assert rows(dedup.dedup_report(df, "id")) == [(5, 3, 2)]
    assert rows(dedup.dedup_report(df.limit(0), "id")) == [(0, 0, 0)]


def test_hot_key_is_cut_before_the_shuffle(spark):
    """A third of the rows share one key: each task sends one of them."""
    df = spark.range(0, 30000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"),
        F.col("id").alias("v"),
    )
    latest = dedup.keep_latest(df, "k", [F.desc("v")])
    text = plan(latest)
    assert text.count("WindowGroupLimit") == 2
    exchange, partial = text.index("Exchange hashpartitioning"), text.rindex("WindowGroupLimit")
    assert exchange < partial  # printed top down: the partial limit runs below the shuffle
    assert latest.count() == 20001
    assert latest.filter("k = 'hot'").first().v == 29997


def test_previews(spark):
    df = spark.range(20)
    assert [r.id for r in preview.head(df, ["id"]).collect()] == [0, 1, 2, 3, 4]
    assert [r.id for r in preview.tail(df, ["id"], 2).collect()] == [19, 18]


def test_short_and_long_mappings_agree(spark, monkeypatch):
    import random

    from strata.functions import text

    rng = random.Random(3)
    rules = {f"{rng.choice('aA')}{i}": f"a{rng.randrange(40)}" for i in rng.sample(range(40), 30)}
    columns = ["v", "_from", "_to", "_mapped_from", "__mapped_to"]
    df = spark.createDataFrame([(f"A{i}", "f", "t", "m", "n") for i in range(45)] + [(None,) * 5], ", ".join(f"{c} string" for c in columns))
    short = conform.map_values(df, "v", rules)
    monkeypatch.setattr(text, "MAX_LITERAL_MAPPING", 0)
    long = conform.map_values(df, "v", rules)
    assert short.columns == long.columns == columns
    assert sorted(map(str, short.collect())) == sorted(map(str, long.collect()))
