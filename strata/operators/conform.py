"""Typing, standardising, defaulting and scoring of parsed records."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions import quality, text
from strata.operators import mappings
from strata.operators.schema import TYPES, Declared, field_types, spark_type
from strata.plans.specs import DatasetSpec, ScoreSpec, StandardizeSpec

FLOATING = ("double", "float")
ALL_TYPES = tuple(t for t in TYPES if t != "string")


def require_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"columns {missing} are required and absent")
    return df


def enforce_types(df: DataFrame, fields: Declared, types: Sequence[str] = FLOATING) -> DataFrame:
    """Cast declared columns whose type is in ``types``; unparsable text becomes null.

    By default only floating-point declarations are cast and everything else stays text;
    pass ``ALL_TYPES`` to cast every declared type.
    """
    declared = field_types(fields)
    return df.withColumns(
        {
            name: F.col(name).try_cast(spark_type(declared_type))
            for name, declared_type in declared.items()
            if name in df.columns and declared_type.lower() in types
        }
    )


def _tall(df: DataFrame, counts: Mapping[str, Column], value: str) -> DataFrame:
    """One pass over ``df``; each named aggregate becomes a row ``(field, value)``."""
    wide = df.agg(*[c.alias(f"_{i}") for i, c in enumerate(counts.values())])
    rows = [
        F.struct(F.lit(name).alias("field"), F.col(f"_{i}").alias(value))
        for i, name in enumerate(counts)
    ]
    return wide.select(F.inline(F.array(*rows)))


def required_null_audit(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Rows ``(field, null_count)`` for all required columns in one pass."""
    require_columns(df, names)
    return _tall(df, {n: F.count_if(F.col(n).isNull()) for n in names}, "null_count")


def domain_audit(df: DataFrame, domains: Mapping[str, Sequence[str]]) -> DataFrame:
    """Rows ``(field, invalid_count)``: non-null values outside the closed list."""
    counts = {
        n: F.count_if(F.col(n).isNotNull() & ~F.col(n).isin(list(values)))
        for n, values in domains.items()
        if n in df.columns and values
    }
    return _tall(df, counts, "invalid_count")


def clean_strings(df: DataFrame) -> DataFrame:
    """Trim string columns (system columns ``_*`` exempt), then turn empty strings into null."""
    cleaned = {}
    for f in df.schema.fields:
        if isinstance(f.dataType, T.StringType):
            c = F.col(f.name)
            cleaned[f.name] = text.empty_to_null(c if f.name.startswith("_") else text.trimmed(c))
    return df.withColumns(cleaned)


def map_values(df: DataFrame, name: str, mapping: Mapping[str, str] | DataFrame) -> DataFrame:
    """Replace values of one column.

    A long mapping becomes a local lookup table and a join, broadcast up to a fixed number
    of entries; beyond that Spark picks the join by the table's size. A mapping that is a table
    (``position``, ``source``, ``target``) is resolved by joins and never collected.
    """
    if isinstance(mapping, DataFrame):
        return _map_by_table(df, name, mapping)
    if len(mapping) <= text.MAX_LITERAL_MAPPING:
        return df.withColumn(name, text.mapped(F.col(name), mapping))
    pairs = text.resolve_mapping(mapping)
    lookup = df.sparkSession.createDataFrame(
        pa.table({"source": list(pairs.keys()), "target": list(pairs.values())})
    )
    return _replaced(df, name, lookup, len(pairs))


def _map_by_table(df: DataFrame, name: str, rules: DataFrame) -> DataFrame:
    lookup = mappings.resolve_rules(rules)
    return _replaced(df, name, lookup, lookup.count())


def _replaced(df: DataFrame, name: str, lookup: DataFrame, entries: int) -> DataFrame:
    taken = {c.lower() for c in df.columns}
    source, target = "_mapped_from", "_mapped_to"
    while {source, target} & taken:
        source, target = f"_{source}", f"_{target}"
    lookup = lookup.withColumnsRenamed({"source": source, "target": target})
    if entries <= text.MAX_BROADCAST_MAPPING:
        lookup = F.broadcast(lookup)
    joined = df.join(lookup, F.lower(df[name]) == lookup[source], "left")
    return joined.withColumn(name, F.coalesce(target, name)).select(*df.columns)


def standardize(df: DataFrame, spec: StandardizeSpec) -> DataFrame:
    df = clean_strings(df)
    present = set(df.columns)
    for name, mapping in spec.value_maps.items():
        if name in present:
            df = map_values(df, name, mapping)
    for names, rule in (
        (spec.upper, F.upper),
        (spec.digits_only, text.digits_only),
        (spec.us_phone, text.us_phone),
        (spec.trailing_dash, text.without_trailing_dash),
    ):
        df = df.withColumns({n: rule(F.col(n)) for n in names if n in present})
    if spec.blank_results_to_null:
        ruled = {*spec.digits_only, *spec.us_phone, *spec.trailing_dash} & present
        df = df.withColumns({n: text.empty_to_null(F.col(n)) for n in sorted(ruled)})
    return df


def fill_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    return df.withColumns(
        {n: F.coalesce(F.col(n), F.lit(v)) for n, v in defaults.items() if n in df.columns}
    )


def add_quality(df: DataFrame, spec: ScoreSpec = ScoreSpec()) -> DataFrame:
    """Flags ``is_valid_location`` and ``has_complete_address`` and ``data_quality_score``.

    A flag whose columns are absent is not added and earns no points.
    """
    have = set(df.columns)
    flags: dict[str, Column] = {}
    if {spec.latitude, spec.longitude} <= have:
        flags["is_valid_location"] = quality.valid_coordinates(
            F.col(spec.latitude).try_cast("double"), F.col(spec.longitude).try_cast("double")
        )
    if set(spec.address) <= have:
        flags["has_complete_address"] = quality.all_present([F.col(n) for n in spec.address])
    parts = [(F.col(n).isNotNull(), spec.points) for n in spec.present if n in have]
    parts += [(F.col(flag), spec.points) for flag in flags]
    return df.withColumns(flags).withColumn("data_quality_score", quality.weighted_score(parts))


def stamp(df: DataFrame, layer: str = "silver") -> DataFrame:
    return df.withColumns({"_processing_timestamp": F.current_timestamp(), "_layer": F.lit(layer)})


def row_audits(df: DataFrame, spec: DatasetSpec) -> dict[str, Column]:
    """Counters of a conformed table that can be observed while it is written: null values of
    each required column and values outside each declared domain."""
    have = set(df.columns)
    counters = {f"{n}_null_count": F.count_if(F.col(n).isNull()) for n in spec.required if n in have}
    for n, values in spec.domains.items():
        if n in have and values:
            outside = F.col(n).isNotNull() & ~F.col(n).isin(list(values))
            counters[f"{n}_invalid_count"] = F.count_if(outside)
    return counters


# A step of the chain: (rows, declaration) -> rows.
Step = Callable[[DataFrame, DatasetSpec], DataFrame]

# Flags come after the defaults, so a defaulted value counts as present.
STEPS: tuple[Step, ...] = (
    lambda df, spec: enforce_types(df, spec.fields),
    lambda df, spec: require_columns(df, spec.required),
    lambda df, spec: standardize(df, spec.standardize),
    lambda df, spec: fill_defaults(df, spec.defaults),
    lambda df, spec: add_quality(df, spec.score),
    lambda df, spec: stamp(df),
)


def conform(df: DataFrame, spec: DatasetSpec, steps: Sequence[Step] = STEPS) -> DataFrame:
    """Parsed, de-duplicated text columns -> typed, standardised, scored rows.

    Pass other ``steps`` to replace or extend the chain for a dataset.
    """
    for step in steps:
        df = step(df, spec)
    return df
