import json
import os
import shutil

import pytest

from strata.plans import daily
from strata.plans.specs import FieldSpec, place_dataset
from strata.sources import tables
from strata.streaming.newest import CELL, follow_newest
from tests.support import rows

DAY, NEXT = "2026-01-25", "2026-01-26"
SPEC = place_dataset("spots", [FieldSpec("id", nullable=False), FieldSpec("kind"), FieldSpec("v")], kind="kind", kinds=["a"])


@pytest.fixture
def rocks(spark):
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    yield
    spark.conf.set(name, before)


def land(layout, day, second, records, lines=False):
    path = f"{layout.landing}/spots_bronze_api_{day}_20260125_0000{second:02}.json{'l' if lines else ''}"
    os.makedirs(path if lines else layout.landing, exist_ok=True)
    with open(f"{path}/part-0" if lines else path, "w", encoding="utf-8") as file:
        file.write("\n".join(map(json.dumps, records)) if lines else json.dumps(records))


def batch_result(spark, layout, day):
    return rows(daily.load_latest(spark, SPEC, layout, day).select("id", "kind", "v", "_ingest_ts"))


def test_three_batches_one_repeated(spark, folder, rocks):
    layout, target, seen = daily.Layout.under(folder, "spots"), f"{folder}/newest", f"{folder}/seen"
    os.makedirs(layout.landing)

    def follow():
        follow_newest(spark, SPEC, layout, target, seen, cells=3).awaitTermination()
        for day in (DAY, NEXT):
            try:
                wanted = batch_result(spark, layout, day)
            except FileNotFoundError:
                wanted = []
            table = tables.read_dated(spark, target, day)
            assert rows(table.select("id", "kind", "v", "_ingest_ts")) == wanted

    record = lambda i, v: {"id": i, "kind": "a", "v": v}
    land(layout, DAY, 1, [record("1", 1), record("2", 1), record("1", 2), record(None, 1), "text"])
    follow()
    before = {f: os.path.getmtime(f"{target}/{f}") for f in os.listdir(target)}
    land(layout, DAY, 3, [record("2", 3), record(None, 3), record("4", 3)], lines=True)
    land(layout, NEXT, 2, [record("1", 9)])
    # An older run that arrives late changes only what is not newer.
    land(layout, DAY, 2, [record("2", 2), record("5", 2)])
    follow()
    # The last batch again: its commit is lost, as after a failure behind the write.
    last = max(os.listdir(f"{seen}/commits"), key=lambda f: (f.isdigit(), int(f) if f.isdigit() else 0))
    os.remove(f"{seen}/commits/{last}")
    if os.path.exists(f"{seen}/commits/.{last}.crc"):
        os.remove(f"{seen}/commits/.{last}.crc")
    follow()
    land(layout, DAY, 4, [record("1", 4)])
    cells = {r[CELL] for r in tables.read_dated(spark, target, DAY).select(CELL).collect()}
    follow()
    assert cells <= {"0", "1", "2"} and before
    assert not [f for f in os.listdir(folder) if f.startswith("_staging")]
    shutil.rmtree(seen)
    follow()  # everything anew over a table that has it: the same
