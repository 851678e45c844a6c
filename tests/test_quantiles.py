import bisect
import math
import random

import pytest

from strata.operators.quantiles import K, merge_states, quantile_drift, quantile_states, quantiles, rank_error
from strata.sources import tables

SCHEMA = "_processing_date string, x double, y int"


def frame(spark, days, seed=1, n=6000, shift=0.0):
    rng = random.Random(seed)
    given = [(d, rng.choice([None, float("nan")]) if i % 50 == 0 else rng.gauss(shift, 1), rng.randrange(10)) for d in days for i in range(n)]
    return given, spark.createDataFrame(given, SCHEMA)


def test_merged_quantiles_lie_within_the_stated_rank_error(spark):
    given, df = frame(spark, ["a", "b", "c", "d"])
    values = sorted(x for _, x, _ in given if x is not None and not math.isnan(x))
    states = quantile_states(df, ["x", "y"])
    assert states.count() == 8 and states.selectExpr("max(length(sketch))").first()[0] < 40 * K
    merged = merge_states(states)
    probabilities = [i / 50 for i in range(1, 50)]
    found = quantiles(merged.filter("field = 'x'"), probabilities).collect()
    assert len(found) == 49 and {r.n for r in found} == {len(values)}
    off = [abs(bisect.bisect_right(values, r.value) / len(values) - r.probability) for r in found]
    assert max(off) <= 1.5 * rank_error() and sum(o <= rank_error() for o in off) >= 45
    assert rank_error() < 0.006


def test_drift_between_dates(spark):
    same, moved = frame(spark, ["a"], 1)[1].union(frame(spark, ["b"], 2)[1]), frame(spark, ["c"], 3, shift=0.5)[1]
    states = quantile_states(same.union(moved), ["x", "y"])
    of = lambda day: states.filter(f"_processing_date = '{day}'").drop("_processing_date")
    still = {r.field: r for r in quantile_drift(of("a"), of("b"), 0.1).collect()}
    assert still["x"].passed and still["y"].passed and still["x"].distance < 0.05
    gone = {r.field: r for r in quantile_drift(of("a"), of("c"), 0.1).collect()}
    # Two normal distributions half a deviation apart: 2 * Phi(0.25) - 1.
    assert not gone["x"].passed and abs(gone["x"].distance - 0.197) < 0.04 and gone["y"].passed


def test_groups_without_values(spark):
    df = spark.createDataFrame([("a", None, 1), ("a", float("nan"), 2), ("b", 5.0, None)], SCHEMA)
    states = quantile_states(df, ["x", "y"])
    assert {(r._processing_date, r.field): r.n for r in states.collect()} == {("a", "x"): 0, ("a", "y"): 2, ("b", "x"): 1, ("b", "y"): 0}
    assert quantiles(merge_states(states), [0.5]).count() == 2
    assert quantile_states(df.limit(0), ["x"]).count() == 0
    assert quantile_drift(states.filter("_processing_date = 'a'"), states.filter("_processing_date = 'b'")).count() == 0


def test_a_format_without_its_package_is_named(spark, folder):
    for call in (
        lambda: tables.write_dated(spark.range(1), f"{folder}/t", "2026-01-25", fmt="delta"),
        lambda: tables.read_dated(spark, f"{folder}/t", fmt="delta"),
    ):
        with pytest.raises(ValueError, match="Delta Lake package"):
            call()
