"""Random inputs against straightforward Python."""

import random
from collections import defaultdict

from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.functions.text import resolve_mapping
from strata.operators import checks, dedup, rollup

WORDS = st.sampled_from(["a", "A", "b", "B", "c", "Ab", "aB", ""])


@given(st.dictionaries(WORDS, WORDS, max_size=6), WORDS)
def test_resolved_mapping_equals_rule_after_rule(mapping, value):
    expected = value
    for source, target in mapping.items():
        if expected.lower() == source.lower():
            expected = target
    assert resolve_mapping(mapping).get(value.lower(), value) == expected


def random_rows(seed, n=5000):
    """A third of the rows share one key and one group; some keys and values are null."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        hot = rng.random() < 1 / 3
        key = "hot" if hot else rng.choice([None, *map(str, range(800))])
        group = "G0" if hot else rng.choice([None, "G0", "G1", "G2"])
        out.append((i, key, group, rng.choice([None, *range(40)]), rng.randrange(1000)))
    return out


SCHEMA = "n int, k string, g string, v int, t int"


def test_keep_latest_against_a_dictionary(spark):
    data = random_rows(1)
    best = {}
    for row in data:
        if row[1] not in best or (row[4], row[0]) > (best[row[1]][4], best[row[1]][0]):
            best[row[1]] = row
    df = spark.createDataFrame(data, SCHEMA).repartition(8)
    latest = dedup.keep_latest(df, "k", [F.desc("t"), F.desc("n")])
    assert sorted(tuple(r) for r in latest.collect()) == sorted(best.values())
    (duplicates,) = checks.evaluate(df, [checks.unique("k")], "silver", "t").collect()
    assert duplicates.observed == len(data) - len(best)


def test_rollup_against_a_dictionary(spark):
    data = random_rows(2)
    groups = defaultdict(list)
    for row in data:
        groups[row[2]].append(row)
    expected = {}
    for group, members in groups.items():
        values = [r[3] for r in members if r[3] is not None]
        expected[group] = (
            len(members), round(sum(values) / len(values), 6), sum(values), min(values), max(values),
            len(set(values)), sorted({r[1] for r in members if r[1] is not None}),
            len(values), round(len(members) / len(data) * 100, 2),
        )
    out = rollup.aggregate_by_dimensions(
        spark.createDataFrame(data, SCHEMA).repartition(8),
        ["g"],
        include_percentage=True,
        additional_aggs={
            "mean": ("v", "avg"), "total": ("v", "sum"), "low": ("v", "min"), "high": ("v", "max"),
            "distinct": ("v", "count_distinct"), "keys": ("k", "collect_set"),
            "present": ("v", "count_present"),
        },
    )
    found = {
        r.g: (r.record_count, round(r.mean, 6), r.total, r.low, r.high, r.distinct, r["keys"],
              r.present, r.percentage_of_total)
        for r in out.collect()
    }
    assert found == expected
