import math

import pytest

from strata.llm.mixing import CAP, apply_mix, balance, mix_sources, source_targets, word_count
from tests.llm.support import WORDS, documents, no_documents, odd_documents, odd_rows, prose


def plain_targets(sizes):
    """{source: target}, by the rule as it is worded."""
    names = sorted(s for s in sizes if s is not None) + ([None] if None in sizes else [])
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    total, full = 1.5 * sum(sizes.values()), set()
    while True:
        rest = total - sum(2 * sizes[s] for s in full)
        active = sum(weight[s] for s in names if s not in full)
        target = {s: 2 * sizes[s] if s in full else rest * weight[s] / active for s in names}
        above = {s for s in names if s not in full and target[s] > 2 * sizes[s]}
        if not above:
            return target
        full |= above


def source_sizes(given):
    sizes = {}
    for row in given:
        source = row[3] if len(row) > 3 else "src1"
        sizes[source] = sizes.get(source, 0) + len(WORDS.findall(row[1] or ""))
    return sizes


@pytest.mark.parametrize(
    "sizes",
    [
        {"a": 100, "b": 100, "c": 100}, {"b": 10, "a": 1000, None: 500, "ä": 3, "Z": 70}, {"a": 0, "b": 10, "c": 90},
        {None: 5}, {"a": 0}, {f"s{i:03}": (i * 37) % 101 + 1 for i in range(60)},
    ],
)
def test_targets(spark, sizes):
    frame = spark.createDataFrame(list(sizes.items()), "source string, source_size bigint")
    found = {r.source: r.target for r in source_targets(frame).collect()}
    wanted = plain_targets(sizes)
    assert found.keys() == wanted.keys()
    assert all(abs(found[s] - wanted[s]) <= 1e-9 * max(1, wanted[s]) for s in wanted)


def test_words(spark):
    texts = ["a b", "", None, " \x0b\x0c x\x00y \x1c ", "é ß"]
    frame = spark.createDataFrame([(t,) for t in texts], "text string")
    found = frame.select("text", word_count("text").alias("n")).collect()
    assert {r.text: r.n for r in found} == {t: len(WORDS.findall(t or "")) for t in texts}


def mixed(given, spark, docs=None):
    return mix_sources(documents(spark, given) if docs is None else docs).collect()


def check(given, found):
    sizes = source_sizes(given)
    targets = plain_targets(sizes)
    taken, smallest = dict.fromkeys(sizes, 0), {}
    by_id = {}
    for row in given:
        by_id.setdefault(row[0], []).append(row)
    assert sorted((r.doc_id for r in found), key=str) == sorted((r[0] for r in given), key=str)
    for r in found:
        assert r.taken == r.copies * r.size and 0 <= r.copies <= 2
        assert any(len(WORDS.findall(row[1] or "")) == r.size for row in by_id[r.doc_id])
    for row in given:
        s = row[3] if len(row) > 3 else "src1"
        n = len(WORDS.findall(row[1] or ""))
        smallest[s] = min(smallest.get(s, 10**9), n or 10**9)
    for r in found:
        match = [s for s in sizes if sizes[s] == r.source_size and abs(targets[s] - r.target) <= 1e-9 * max(1, r.target)]
        assert match
        taken[match[0]] += r.taken
    return taken, targets, smallest


def test_sources_meet_their_targets(spark):
    given = [(i, prose(i, 1 + (i * 13) % 70), "en", f"s{i % 5}") for i in range(600)]
    taken, targets, smallest = check(given, mixed(given, spark))
    assert all(abs(taken[s] - targets[s]) <= 1 for s in targets)


def test_awkward_rows(spark):
    check(odd_rows(), mixed(None, spark, odd_documents(spark)))


def test_reruns_and_other_partitions_agree(spark):
    given = [(i, prose(i % 40, 20), "en", f"s{i % 3}") for i in range(300)]
    docs = documents(spark, given)
    once = sorted(map(tuple, mix_sources(docs).collect()))
    assert once == sorted(map(tuple, mix_sources(docs.repartition(7, "text")).collect()))


def test_a_large_class_is_ranked_in_parts(spark):
    given = [(i, "two words", "en", "s0") for i in range(10_000)] + [(20_000, prose(1, 7000), "en", "s1")]
    found = mixed(given, spark)
    taken, targets, _ = check(given, found)
    assert abs(taken["s0"] - targets["s0"]) <= 2


def test_the_mix_repeats_documents(spark):
    given = [(i, prose(i, 1 + i % 9), "en", f"s{i % 4}") for i in range(80)]
    docs = documents(spark, given)
    copies = {r.doc_id: r.copies for r in mix_sources(docs).collect()}
    found = apply_mix(docs)
    assert found.columns == [*docs.columns, "copy_"]
    counted = {}
    for r in found.collect():
        counted[r.doc_id] = counted.get(r.doc_id, 0) + 1
    assert counted == {d: n for d, n in copies.items() if n}


def test_rates_tilt_by_size_under_the_cap(spark):
    sizes = {"few": [1, 2, 3, 400, 5000], "many": [7] * 50 + [1], "full": [3, 9], "one": [20_000], None: [1, 10**6]}
    classes = [(s, z, found.count(z)) for s, found in sizes.items() for z in sorted(set(found))]
    targets = [("few", 5406, 3000.0), ("many", 351, 500.0), ("full", 12, 24.0), ("one", 20_000, 31_000.0), (None, 10**6 + 1, 5.5)]
    found = balance(
        spark.createDataFrame(classes, "source string, size bigint, n bigint"),
        spark.createDataFrame(targets, "source string, source_size bigint, target double"),
    )
    tilt = {r.source: r.tilt for r in found.collect()}
    for s, _, target in targets:
        rates = {z: min(CAP, math.exp(min(tilt[s] * z, 1.0))) for z in sizes[s]}
        assert abs(sum(z * rates[z] for z in sizes[s]) - target) <= 1e-6 * target
    assert tilt["few"] < 0 < tilt["many"] and tilt[None] < 0


def test_rows_that_agree_come_as_often_as_all_of_them(spark):
    given = [(1, "a b c", "en", "s0")] * 6 + [(2, "d e", "en", "s1"), (3, "f", "en", "s2")]
    docs = documents(spark, given)
    wanted = sum(r.copies for r in mix_sources(docs).collect() if r.doc_id == 1)
    assert sum(r.doc_id == 1 for r in apply_mix(docs).collect()) == wanted >= 6


def test_empty_table(spark):
    assert mix_sources(no_documents(spark)).collect() == []
    assert apply_mix(no_documents(spark)).collect() == []
