import json
import os
import random

import pytest
from pyspark.sql import functions as F

from strata.sources import arrays, landing

DAY = "2026-01-25"


@pytest.fixture
def small_ranges(spark, monkeypatch):
    """Ranges of a few bytes, chunks of fewer."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum")
    before = {n: spark.conf.get(n, None) for n in names}

    def set_to(n):
        spark.conf.set(names[0], str(n))
        spark.conf.set(names[1], "0")
        spark.conf.set(names[2], "1")

    monkeypatch.setattr(arrays, "CHUNK", 64)
    set_to(150)
    yield set_to
    for n, value in before.items():
        spark.conf.set(n, value) if value is not None else spark.conf.unset(n)


def land(folder, *texts):
    for i, text in enumerate(texts):
        path = f"{folder}/places_bronze_api_{DAY}_20260125_{i:06}.json"
        with open(path, "w", encoding="utf-8") as file:
            file.write(text)


def scanned(spark, folder, split, **options):
    found = landing.scan(spark, folder, DAY, split_arrays=split, **options)
    return sorted(tuple(r) for r in found.select(F.date_format("_ingest_ts", "HHmmss"), "_position", "payload").collect())


def value(rng, depth):
    kind = rng.randrange(9 if depth else 6)
    if kind < 3:
        return "".join(rng.choice('{}[],:"\\\n\t aé中😀}') for _ in range(rng.randrange(12)))
    if kind < 6:
        return rng.choice([None, True, 1, -2.5, 10**12, ""])
    if kind == 6:
        return [value(rng, depth - 1) for _ in range(rng.randrange(4))]
    return {f"k{i}{rng.choice('},')}": value(rng, depth - 1) for i in range(rng.randrange(5))}


def test_ranges_give_the_rows_of_whole_files(spark, folder, small_ranges):
    rng = random.Random(1)
    for size in (90, 400):
        small_ranges(size)
        os.makedirs(root := f"{folder}/{size}")
        texts = []
        for _ in range(5):
            records = [{"id": i, "v": value(rng, 3)} for i in range(rng.randrange(15))]
            texts.append(json.dumps(records, ensure_ascii=rng.random() < 0.5, indent=rng.choice([None, 1]), separators=rng.choice([None, (",", ":")])))
        land(root, *texts)
        found = scanned(spark, root, True)
        assert found and found == scanned(spark, root, False)


def test_odd_arrays(spark, folder, small_ranges):
    small_ranges(20)
    texts = [
        "[]", " \n[ ]\n", "[1, 2,3]", '["a", "}", "[", "\\"}", null, true, [1, {"a": [2]}], {}]', '[{"a": {"b": {"c": "}}}"}}}]',
        '[{"a":1}] trailing {"x": [1', '{"not": ["an", "array"]}', '"text"', "[[[]]]", "[" + ",".join(['{"a":"' + "x" * 90 + '"}'] * 3) + "]",
    ]
    land(folder, *texts)
    assert scanned(spark, folder, True) == scanned(spark, folder, False)


@pytest.mark.parametrize("text", ["{bad", '[{"a": 1}', '[{"a": 1},', '["a', "[", '[{"a": 1}, {"b": }]', '[{"a": 1},,{"b": 2}]', "[1,]"])
def test_broken_files(spark, folder, small_ranges, text):
    small_ranges(12)
    land(folder, '[{"a": 1}, {"b": 2}]', text)
    for split in (True, False):
        with pytest.raises(Exception, match="Invalid JSON"):
            scanned(spark, folder, split)
    kept = scanned(spark, folder, True, on_invalid="skip")
    assert kept == scanned(spark, folder, False, on_invalid="skip") and len(kept) == 2


def test_one_file_is_the_work_of_many_tasks(spark, folder, small_ranges):
    small_ranges(100_000)
    records = [{"id": i, "text": "x" * (i % 500)} for i in range(2500)]
    land(folder, json.dumps(records))
    path = f"{folder}/{os.listdir(folder)[0]}"
    assert arrays._fragments(spark, [path]).rdd.getNumPartitions() == -(-os.path.getsize(path) // 100_000) >= 7
    found = landing.scan(spark, folder, DAY, split_arrays=True)
    assert [r._position for r in found.orderBy("_position").select("_position").collect()] == list(range(2500))


def test_many_ranges_are_read_in_groups(spark, folder, small_ranges, monkeypatch):
    monkeypatch.setattr(arrays, "MAX_RANGES", 3)
    land(folder, *[json.dumps([{"id": i}] * 20) for i in range(4)])
    assert scanned(spark, folder, True) == scanned(spark, folder, False)
