"""Quantiles of numeric fields from mergeable sketches, and drift between dates.

A sketch has a size of about its ``k`` whatever the rows, is built below the shuffle and merges
without its rows: a date leaves one, and any dates together have the quantiles of all their rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The larger, the more exact; with so many values or fewer a sketch holds them all.
K = 800
#: Ranks at which two distributions are compared.
POINTS = 256


def rank_error(k: int = K) -> float:
    """A quantile's true rank is that near the asked one in 99 of 100 cases (the published bound of
    the sketch), about 0.55 % of the rows for the default."""
    return 2.296 / k**0.9021


def quantile_states(df: DataFrame, fields: Sequence[str], by: Sequence[str] = ("_processing_date",), k: int = K) -> DataFrame:
    """One row per group of ``by`` and field: ``by``, field, n, sketch. Nulls and NaN do not count;
    a group without values has n = 0 and a null sketch."""
    values = df.select(*by, *[F.nanvl(F.col(f).cast("double"), F.lit(None).cast("double")).alias(f) for f in fields])
    sketches = [
        F.struct(
            F.lit(f).alias("field"),
            F.count(f).alias("n"),
            F.when(F.count(f) > 0, F.kll_sketch_agg_double(f, F.lit(k))).alias("sketch"),
        )
        for f in fields
    ]
    grouped = values.groupBy(*by).agg(F.array(*sketches).alias("s"))
    return grouped.select(*by, F.explode("s").alias("s")).select(*by, "s.*")


def merge_states(states: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The states of all groups of ``by`` (none: of all rows) as one per field."""
    merged = states.filter("n > 0").groupBy(*by, "field")
    return merged.agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch").alias("sketch"))


def quantiles(states: DataFrame, probabilities: Sequence[float]) -> DataFrame:
    """``states`` with a row per probability, its quantile as ``value``, instead of the sketch."""
    ranks = F.array(*[F.lit(float(p)) for p in probabilities])
    others = [c for c in states.columns if c != "sketch"]
    found = F.arrays_zip(ranks.alias("probability"), F.kll_sketch_get_quantile_double("sketch", ranks).alias("value"))
    placed = states.filter("n > 0").select(*others, F.explode(found).alias("q"))
    return placed.select(*others, F.col("q.probability").alias("probability"), F.col("q.value").alias("value"))


def quantile_drift(before: DataFrame, after: DataFrame, limit: float = 0.1) -> DataFrame:
    """One row per field that both states have: field, n_before, n_after, distance, passed.

    ``distance`` is the largest difference of the two ranks of a value (Kolmogorov-Smirnov), taken
    at POINTS quantiles of each, so off by no more than 2 rank errors and 2 / POINTS; ``passed``
    says that it is not over ``limit``.
    """
    old = before.filter("n > 0").select("field", F.col("n").alias("n_before"), F.col("sketch").alias("old"))
    new = after.filter("n > 0").select("field", F.col("n").alias("n_after"), F.col("sketch").alias("new"))
    ranks = F.array(*[F.lit((i + 0.5) / POINTS) for i in range(POINTS)])
    both = old.join(new, "field").select(
        "field", "n_before", "n_after", *[F.kll_sketch_get_quantile_double(s, ranks).alias(s) for s in ("old", "new")]
    )

    def rank(side: str, value: Column) -> Column:
        return F.size(F.filter(side, lambda x: x <= value)) / F.lit(POINTS)

    apart = F.transform(F.concat("old", "new"), lambda v: F.abs(rank("old", v) - rank("new", v)))
    return both.select("field", "n_before", "n_after", F.array_max(apart).alias("distance")).withColumn(
        "passed", F.col("distance") <= limit
    )
