"""Small previews in an explicit order (a distributed frame has no order of its own)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def head(df: DataFrame, order_by: Sequence[str], n: int = 5) -> DataFrame:
    return df.orderBy(*order_by).limit(n)


def tail(df: DataFrame, order_by: Sequence[str], n: int = 5) -> DataFrame:
    """The last ``n`` rows of the order, last one first."""
    return df.orderBy(*[F.desc(name) for name in order_by]).limit(n)
