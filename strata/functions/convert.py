"""Lenient numeric conversion that behaves the same with ANSI mode on or off."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ON_ERROR = ("null", "skip", "raise")


def check_on_error(on_error: str) -> None:
    if on_error not in ON_ERROR:
        raise ValueError(f"on_error is one of {ON_ERROR}, not {on_error!r}")


def _guarded(original: Column, converted: Column, name: str, kind: str) -> Column:
    failed = original.isNotNull() & converted.isNull()
    reason = F.concat(F.lit(f"{name} is no {kind}: "), original.cast("string"))
    return F.when(failed, F.raise_error(reason)).otherwise(converted)


def to_float(name: str, strict: bool = False) -> Column:
    """``name`` as double; unparsable text is null, or an error when ``strict``."""
    c = F.col(name)
    converted = c.try_cast("double")
    return _guarded(c, converted, name, "float") if strict else converted


def to_int(name: str, strict: bool = False) -> Column:
    """``name`` as bigint through double, truncating toward zero ("42.7" -> 42)."""
    c = F.col(name)
    converted = c.try_cast("double").try_cast("bigint")
    return _guarded(c, converted, name, "int") if strict else converted
