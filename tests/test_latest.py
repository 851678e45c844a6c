import random

import pytest
from pyspark.sql import functions as F

from strata.operators.dedup import keep_latest
from strata.sources import landing, latest
from tests.support import plan, rows

SCHEMA = "id string, v int, _ingest_ts timestamp, _position int, _record_hash bigint"


def records(spark, seed, day, n=200):
    rng = random.Random(seed)
    given = [
        (rng.choice([None, *map(str, range(60))]), i, f"2026-01-{day:02} 00:00:0{rng.randrange(3)}", rng.choice([None, rng.randrange(5)]), 1000 * seed + i)
        for i in range(n)
    ]
    frame = spark.createDataFrame(given, "id string, v int, ts string, _position int, _record_hash bigint")
    return frame.select("id", "v", F.to_timestamp("ts").alias("_ingest_ts"), "_position", "_record_hash")


@pytest.fixture
def name(spark):
    found = f"latest_{random.randrange(10**9)}"
    yield found
    spark.sql(f"DROP TABLE IF EXISTS {found}")


def test_refreshes_give_the_newest_of_all(spark, folder, name):
    days = [records(spark, 1, 10), records(spark, 2, 12), records(spark, 3, 11), records(spark, 2, 12)]
    latest.create(days[0], name, folder, "id", buckets=4)
    for k in range(1, len(days)):
        latest.refresh(spark, days[k], name, folder, "id")
        every = days[0]
        for d in days[1 : k + 1]:
            every = every.union(d)
        assert rows(spark.table(name)) == rows(keep_latest(every, "id", landing.latest_first()))


def test_the_stored_side_is_not_shuffled(spark, folder, name):
    latest.create(records(spark, 1, 10), name, folder, "id", buckets=4)
    found = plan(latest.merged(spark, records(spark, 2, 12), name, "id"))
    lines = found[found.index("SortMergeJoin") :].splitlines()
    scan = next(i for i, line in enumerate(lines) if "FileScan" in line)
    # From the join down to the stored files: buckets as they are, and nothing moves.
    assert "Bucketed: true" in lines[scan] and not any("Exchange" in line for line in lines[:scan])


def test_empty_sides(spark, folder, name):
    some = records(spark, 1, 10)
    latest.create(some.limit(0), name, folder, "id", buckets=4)
    latest.refresh(spark, some, name, folder, "id")
    latest.refresh(spark, some.limit(0), name, folder, "id")
    assert rows(spark.table(name)) == rows(keep_latest(some, "id", landing.latest_first()))
