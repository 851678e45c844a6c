"""Struct types from field declarations."""

from __future__ import annotations

import warnings
from collections.abc import Iterable, Mapping
from typing import Any

from pyspark.sql import types as T

from strata.plans.specs import FieldSpec

# The type names a field may declare.
TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "integer": T.IntegerType(),
    "long": T.LongType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "bool": T.BooleanType(),
    "timestamp": T.TimestampType(),
    "date": T.DateType(),
}

Declared = Iterable[FieldSpec | Mapping[str, Any]]


def spark_type(name: str) -> T.DataType:
    """Unknown names are lenient: a warning, then string."""
    known = TYPES.get(name.lower())
    if known is None:
        warnings.warn(f"Unknown type '{name}', using string", stacklevel=2)
    return known or T.StringType()


def build_schema(fields: Declared, audit_fields: Declared = ()) -> T.StructType:
    declared = [FieldSpec.of(f) for f in [*fields, *audit_fields]]
    return T.StructType([T.StructField(f.name, spark_type(f.type), f.nullable) for f in declared])


def build_text_schema(fields: Declared) -> T.StructType:
    """All fields as nullable strings: JSON numbers are not consistent enough to type early."""
    names = [FieldSpec.of(f).name for f in fields]
    return T.StructType([T.StructField(name, T.StringType(), True) for name in names])


def required_fields(fields: Declared) -> list[str]:
    return [f.name for f in map(FieldSpec.of, fields) if not f.nullable]


def field_types(fields: Declared) -> dict[str, str]:
    return {f.name: f.type for f in map(FieldSpec.of, fields)}
