"""Plain declarations that drive the operators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

# An aggregate is "count" or (column, function); see strata.operators.rollup.FUNCTIONS.
Measure = str | tuple[str, str]


@dataclass(frozen=True)
class FieldSpec:
    name: str
    type: str = "string"
    nullable: bool = True
    description: str = ""

    @classmethod
    def of(cls, declared: FieldSpec | Mapping[str, Any]) -> FieldSpec:
        if isinstance(declared, FieldSpec):
            return declared
        return cls(
            declared["name"],
            declared.get("type", "string"),
            declared.get("nullable", True),
            declared.get("description", ""),
        )


@dataclass(frozen=True)
class StandardizeSpec:
    """Which columns get which clean-up rule; columns that are absent are skipped.

    A phone or postal code can come out of its rule empty ("N/A" has no digits). It stays an
    empty string, hence present, unless ``blank_results_to_null``.
    """

    value_maps: Mapping[str, Mapping[str, str]] = field(default_factory=dict)
    upper: Sequence[str] = ()
    digits_only: Sequence[str] = ()
    us_phone: Sequence[str] = ()
    trailing_dash: Sequence[str] = ()
    blank_results_to_null: bool = False


@dataclass(frozen=True)
class ScoreSpec:
    """Quality flags and the points each passed test earns."""

    present: Sequence[str] = ("id", "name")
    latitude: str = "latitude"
    longitude: str = "longitude"
    address: Sequence[str] = ("street", "city", "state", "postal_code")
    points: int = 25


@dataclass(frozen=True)
class RollupSpec:
    """One aggregate table. ``order_by`` names columns; a leading ``-`` means descending."""

    name: str
    dimensions: Sequence[str] = ()
    measures: Mapping[str, Measure] = field(default_factory=dict)
    record_count: bool = True
    percentage: bool = False
    order_by: Sequence[str] = ()


@dataclass(frozen=True)
class QualitySpec:
    """Rules and limits the layer checks are built from."""

    min_landed: int = 100
    landed_fields: Sequence[str] = ()
    unique_key: str | None = "id"
    required: Sequence[str] = ()
    ranges: Mapping[str, tuple[float, float]] = field(default_factory=dict)
    allowed: Mapping[str, Sequence[str]] = field(default_factory=dict)
    mean_score: float = 0.80
    completeness: float = 0.95
    count_columns: Sequence[str] | None = None
    percentage_columns: Sequence[str] = ("percentage_of_total",)


@dataclass(frozen=True)
class DatasetSpec:
    """Everything the daily run needs to know about one dataset."""

    name: str
    fields: Sequence[FieldSpec]
    key: str = "id"
    source: str | None = "api"
    required: Sequence[str] = ()
    domains: Mapping[str, Sequence[str]] = field(default_factory=dict)
    standardize: StandardizeSpec = StandardizeSpec()
    defaults: Mapping[str, str] = field(default_factory=dict)
    score: ScoreSpec = ScoreSpec()
    partition_by: Sequence[str] = ("country", "state")
    quality: QualitySpec = QualitySpec()
    rollups: Sequence[RollupSpec] = ()


# Country spellings, applied in this order.
COUNTRY_NAMES = {
    "united states": "United States",
    "usa": "United States",
    "us": "United States",
    "u.s.a.": "United States",
    "u.s.": "United States",
    "england": "United Kingdom",
    "scotland": "United Kingdom",
    "wales": "United Kingdom",
    "northern ireland": "United Kingdom",
    "isle of man": "United Kingdom",
    "republic of ireland": "Ireland",
    "south korea": "South Korea",
    "republic of korea": "South Korea",
}
# What a missing location part is called.
LOCATION_DEFAULTS = {"country": "Unknown", "state": "Unknown"}
# Coordinate limits.
COORDINATE_RANGES = {"latitude": (-90, 90), "longitude": (-180, 180)}


def place_rollups(prefix: str, kind: str) -> list[RollupSpec]:
    """The four aggregate tables of a dataset of places that each have a ``kind``."""
    return [
        RollupSpec(f"{prefix}_by_type", [kind], percentage=True, order_by=["-record_count"]),
        RollupSpec(
            f"{prefix}_by_location",
            ["country", "state"],
            {"city_count": ("city", "count_distinct"), f"{kind}s": (kind, "collect_set")},
            percentage=True,
            order_by=["-record_count"],
        ),
        RollupSpec(
            f"{prefix}_by_type_location",
            ["country", "state", "city", kind],
            percentage=True,
            order_by=["country", "state", "city", kind],
        ),
        quality_rollup(f"{prefix}_data_quality_metrics", kind),
    ]


def quality_rollup(name: str, kind: str) -> RollupSpec:
    """One-row health summary of a conformed dataset of places. Its column names are fixed
    values: readers of the table expect them."""
    return RollupSpec(
        name,
        measures={
            "total_records": "count",
            "country_count": ("country", "count_distinct"),
            "state_count": ("state", "count_distinct"),
            "city_count": ("city", "count_distinct"),
            f"{kind}_count": (kind, "count_distinct"),
            "avg_quality_score": ("data_quality_score", "avg_2dp"),
            "min_quality_score": ("data_quality_score", "min"),
            "max_quality_score": ("data_quality_score", "max"),
            "valid_location_count": ("is_valid_location", "count_true"),
            "complete_address_count": ("has_complete_address", "count_true"),
            "records_with_phone": ("phone", "count_present"),
            "records_with_website": ("website_url", "count_present"),
        },
        record_count=False,
    )


def place_dataset(
    name: str,
    fields: Sequence[FieldSpec],
    kind: str,
    kinds: Sequence[str],
    min_landed: int = 100,
    key: str = "id",
) -> DatasetSpec:
    """Dataset of places with an address, coordinates, a phone number and a ``kind``."""
    return DatasetSpec(
        name=name,
        fields=tuple(fields),
        key=key,
        required=(key, "name"),
        domains={kind: tuple(kinds)},
        standardize=StandardizeSpec(
            value_maps={"country": COUNTRY_NAMES},
            upper=("state",),
            digits_only=("phone",),
            us_phone=("phone",),
            trailing_dash=("postal_code",),
        ),
        defaults=LOCATION_DEFAULTS,
        score=ScoreSpec(present=(key, "name")),
        quality=QualitySpec(
            min_landed=min_landed,
            landed_fields=(key, "name", kind),
            unique_key=key,
            required=(key, "name"),
            ranges=COORDINATE_RANGES,
            allowed={kind: tuple(kinds)},
        ),
        rollups=tuple(place_rollups(name, kind)),
    )


def dataset_from_config(
    name: str, config: Mapping[str, Any], rollups: Sequence[RollupSpec] = ()
) -> DatasetSpec:
    """Read a nested settings mapping (``schemas``, ``data_quality``, ``transformations``...)."""
    schema = config.get("schemas", {}).get("silver", {})
    silver = config.get("transformations", {}).get("silver", {})
    quality = config.get("data_quality", {})
    limits = quality.get("thresholds", {})
    rules = quality.get("validations", {})
    silver_rules, gold_rules = rules.get("silver", {}), rules.get("gold", {})
    landed = [r for r in rules.get("bronze", []) if r.get("required_fields")]
    std = silver.get("standardization", {})
    phone = std.get("phone", {})
    domains = {
        key[len("valid_"):-1]: tuple(values)
        for key, values in schema.items()
        if key.startswith("valid_") and key.endswith("s")
    }
    key = silver.get("deduplication", {}).get("key", "id")
    return DatasetSpec(
        name=name,
        fields=tuple(FieldSpec.of(f) for f in schema.get("fields", [])),
        key=key,
        score=ScoreSpec(present=(key, "name")),
        required=tuple(schema.get("required_fields", [])),
        domains=domains,
        standardize=StandardizeSpec(
            value_maps={"country": std["country"]} if "country" in std else {},
            upper=("state",) if std.get("state", {}).get("normalize") else (),
            digits_only=("phone",) if phone.get("strip_non_digits") else (),
            us_phone=("phone",) if phone.get("format") == "us" else (),
            trailing_dash=(
                ("postal_code",) if std.get("postal_code", {}).get("strip_trailing_dash") else ()
            ),
        ),
        defaults=dict(silver.get("null_handling", {}).get("default_values", {})),
        partition_by=tuple(
            config.get("storage", {})
            .get("layers", {})
            .get("silver", {})
            .get("partition_by", ("country", "state"))
        ),
        quality=QualitySpec(
            min_landed=limits.get("bronze_min_records", 100),
            landed_fields=tuple(landed[0]["required_fields"]) if landed else (),
            unique_key=silver_rules.get("unique_key", key),
            required=tuple(silver_rules.get("required_fields", [])),
            ranges={k: tuple(v) for k, v in silver_rules.get("value_ranges", {}).items() if len(v) == 2},
            allowed={k: tuple(v) for k, v in silver_rules.get("allowed_values", {}).items() if v},
            mean_score=limits.get("silver_quality_score", 0.80),
            completeness=limits.get("gold_completeness", 0.95),
            count_columns=gold_rules.get("count_columns"),
            percentage_columns=tuple(gold_rules.get("percentage_columns", [])),
        ),
        rollups=tuple(rollups) or tuple(_declared_rollups(config)),
    )


# Metric names of settings that stand for a measure of their own.
KNOWN_METRICS: Mapping[str, Measure] = {
    "total_records": "count",
    "avg_quality_score": ("data_quality_score", "avg_2dp"),
    "min_quality_score": ("data_quality_score", "min"),
    "max_quality_score": ("data_quality_score", "max"),
    "valid_location_count": ("is_valid_location", "count_true"),
    "complete_address_count": ("has_complete_address", "count_true"),
    "records_with_phone": ("phone", "count_present"),
    "records_with_website": ("website_url", "count_present"),
}


def _measure_of(metric: str, columns: set[str]) -> Measure | None:
    """What a metric name means: a known one, ``<column>_count`` (distinct values) or
    ``<column>s`` (the set of values) of a declared column."""
    if metric in KNOWN_METRICS:
        return KNOWN_METRICS[metric]
    for suffix, function in (("_count", "count_distinct"), ("s", "collect_set")):
        if metric.endswith(suffix) and metric.removesuffix(suffix) in columns:
            return metric.removesuffix(suffix), function
    return None


def _declared_rollups(config: Mapping[str, Any]) -> list[RollupSpec]:
    """Aggregations listed in the settings. A metric is a count, a share, one that its name
    explains, or one with a ``measures`` entry (``alias: [column, function]``) beside it.

    Tables with shares are ordered by size if they have one dimension or measures of their own,
    all others by their dimensions; ``order_by`` says otherwise.
    """
    fields = config.get("schemas", {}).get("silver", {}).get("fields", [])
    columns = {FieldSpec.of(f).name for f in fields}
    specs = []
    for entry in config.get("transformations", {}).get("gold", {}).get("aggregations", []):
        metrics, dimensions = entry.get("metrics", []), tuple(entry.get("group_by", ()))
        measures = {
            alias: m if isinstance(m, str) else tuple(m)
            for alias, m in entry.get("measures", {}).items()
        }
        for metric in metrics:
            if metric not in ("record_count", "percentage_of_total") and metric not in measures:
                measure = _measure_of(metric, columns | set(dimensions))
                if measure is None:
                    raise ValueError(f"{entry['name']}: no definition for metric '{metric}'")
                measures[metric] = measure
        by_size = "record_count" in metrics and (len(dimensions) == 1 or bool(measures))
        order = ("-record_count",) if by_size and dimensions else dimensions
        specs.append(
            RollupSpec(
                entry["name"],
                dimensions,
                measures,
                record_count="record_count" in metrics,
                percentage="percentage_of_total" in metrics,
                order_by=tuple(entry.get("order_by", order)),
            )
        )
    return specs
