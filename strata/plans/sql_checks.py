"""Declared checks as SQL table functions, for SQL that wants to ask for a check by name.

    sql_checks.register(spark, silver, checks, "silver", "shops")
    spark.sql("SELECT * FROM shops_duplicate_count()")
    spark.sql("SELECT c.* FROM shops_failed('error') c")
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from strata.operators import checks

#: What a call returns: a result row without the layer and dataset it is registered for.
COLUMNS = "metric STRING, field STRING, severity STRING, observed DOUBLE, bound DOUBLE, passed BOOLEAN, message STRING"


def _name(text: str) -> str:
    return re.sub(r"\W", "_", text).lower()


def register(
    spark: SparkSession, df: DataFrame, declared: Sequence[checks.Check], layer: str, dataset: str
) -> list[str]:
    """Registers table functions for the session and returns their names.

    ``<dataset>_<metric>()`` gives the rows of a metric, one for each of its fields;
    ``<dataset>_checks()`` all rows; ``<dataset>_failed(severity)`` the failed ones of a severity.
    Nothing is computed before a call. A call scans the table once, or once more for each
    distinct check among those it asks for; functions of the same names are replaced.
    """
    prefix = _name(dataset)
    names = []

    def function(name: str, parameters: str, body: str) -> None:
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS TABLE({COLUMNS}) RETURN {body}")
        names.append(name)

    def view(name: str, some: Sequence[checks.Check]) -> str:
        checks.evaluate(df, some, layer, dataset).drop("layer", "dataset").createOrReplaceTempView(name)
        return name

    every = view(f"_{prefix}_every_check", declared)
    function(f"{prefix}_checks", "", f"SELECT * FROM {every}")
    function(
        f"{prefix}_failed",
        "wanted STRING",
        f"SELECT * FROM {every} WHERE NOT passed AND severity = {prefix}_failed.wanted",
    )
    for metric in dict.fromkeys(c.metric for c in declared):
        # A view of its own, so that a call computes no other check.
        own = view(f"_{prefix}_check_{_name(metric)}", [c for c in declared if c.metric == metric])
        function(f"{prefix}_{_name(metric)}", "", f"SELECT * FROM {own}")
    return names
