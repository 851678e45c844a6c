"""Column-wise clean-up of raw records (before or without a declared schema)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.convert import check_on_error, to_float, to_int
from strata.functions.text import empty_to_null


def _convert(df: DataFrame, names: Sequence[str], on_error: str, convert) -> DataFrame:
    check_on_error(on_error)
    present = [n for n in names if n in df.columns]
    if on_error == "skip":
        # A column has one type: the original stays and the number goes beside it.
        return df.withColumns({f"{n}_num": convert(n) for n in present})
    return df.withColumns({n: convert(n, strict=on_error == "raise") for n in present})


def convert_fields_to_float(
    df: DataFrame, names: Sequence[str], on_error: str = "null"
) -> DataFrame:
    return _convert(df, names, on_error, to_float)


def convert_fields_to_int(df: DataFrame, names: Sequence[str], on_error: str = "null") -> DataFrame:
    return _convert(df, names, on_error, to_int)


def normalize_empty_strings(df: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """Exactly empty strings become null; no names (or an empty list) means every string column."""
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    chosen = [n for n in text if not names or n in names]
    return df.withColumns({n: empty_to_null(F.col(n)) for n in chosen})
