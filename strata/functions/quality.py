"""Record-level quality flags and scores."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The two documented score ladders, best label first.
BANDS_80_60_40 = (("Excellent", 80), ("Good", 60), ("Fair", 40))
BANDS_90_75_50 = (("Excellent", 90), ("Good", 75), ("Fair", 50))
LOWEST_BAND = "Poor"


def valid_coordinates(latitude: Column, longitude: Column) -> Column:
    """Both present and on the globe. NaN sorts above every number, so it is invalid."""
    inside = latitude.between(-90, 90) & longitude.between(-180, 180)
    return F.coalesce(inside, F.lit(False))


def all_present(columns: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a & b, [c.isNotNull() for c in columns])


def weighted_score(parts: Sequence[tuple[Column, int]]) -> Column:
    """Sum of the weights whose predicate holds; a null predicate earns nothing."""
    earned = [F.when(predicate, F.lit(weight)).otherwise(F.lit(0)) for predicate, weight in parts]
    return reduce(lambda a, b: a + b, earned, F.lit(0))


def score_band(score: Column, bands: Sequence[tuple[str, int]] = BANDS_80_60_40) -> Column:
    ladder = F.when(score.isNull(), F.lit(None).cast("string"))
    for label, floor in bands:
        ladder = ladder.when(score >= floor, F.lit(label))
    return ladder.otherwise(F.lit(LOWEST_BAND))
