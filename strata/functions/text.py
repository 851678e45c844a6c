"""Text standardising expressions. All are built-in functions, so they stay in codegen."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# A literal map is searched linearly per row, so longer mappings go through a join
# (see strata.operators.conform.map_values).
MAX_LITERAL_MAPPING = 200
# Longest mapping that is broadcast for that join; at some 100 bytes an entry, 10 MB.
MAX_BROADCAST_MAPPING = 100_000


def empty_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def trimmed(c: Column) -> Column:
    """Strip spaces only; tabs and newlines stay."""
    return F.trim(c)


def resolve_mapping(mapping: Mapping[str, str]) -> dict[str, str]:
    """Flatten an ordered mapping into one lookup keyed by lower-cased value.

    The rules apply one after the other, so a later rule also sees what an earlier rule
    produced: ``{"a": "b", "b": "c"}`` sends ``a`` to ``c``.
    """
    # From the last rule back: what a value becomes from this rule on.
    resolved: dict[str, str] = {}
    for source, target in reversed(mapping.items()):
        resolved[source.lower()] = resolved.get(target.lower(), target)
    return resolved


def mapped(c: Column, mapping: Mapping[str, str]) -> Column:
    """Case-insensitive value replacement; values without a rule pass through."""
    resolved = resolve_mapping(mapping)
    if not resolved:
        return c
    lookup = F.create_map(*[F.lit(part) for pair in resolved.items() for part in pair])
    return F.coalesce(F.try_element_at(lookup, F.lower(c)), c)


def digits_only(c: Column) -> Column:
    return F.regexp_replace(c, r"[^\d]", "")


def us_phone(c: Column) -> Column:
    """Ten digits become ``(XXX) XXX-XXXX``; anything else is left alone."""
    return F.regexp_replace(c, r"^(\d{3})(\d{3})(\d{4})$", "($1) $2-$3")


def without_trailing_dash(c: Column) -> Column:
    return F.regexp_replace(c, "-$", "")


def is_json(c: Column) -> Column:
    """True when the text is exactly one JSON value.

    The value is wrapped once as an array element and once as an object field: trailing
    text breaks at least one of the two, which a plain parse would overlook.
    """
    as_element = F.json_array_length(F.concat(F.lit("["), c, F.lit("]"))) == 1
    as_field = F.json_object_keys(F.concat(F.lit('{"v":'), c, F.lit("}"))).isNotNull()
    return F.coalesce(as_element & as_field, F.lit(False))
