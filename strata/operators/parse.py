"""JSON payload -> flat text columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators.schema import Declared, build_text_schema


def parse_payload(
    df: DataFrame, fields: Declared, payload: str = "payload", keep: Sequence[str] = ("_ingest_ts",)
) -> DataFrame:
    """Flatten ``payload`` into one string column per field, beside the ``keep`` columns.

    A payload that is not an object gives a row of nulls; nested values stay JSON text.
    """
    parsed = F.from_json(F.col(payload), build_text_schema(fields))
    return df.select(parsed.alias("_parsed"), *keep).select("_parsed.*", *keep)
