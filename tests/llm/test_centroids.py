import hashlib
import math
import random

import numpy as np
import pytest

from strata.llm import centroids
from strata.llm.centroids import Heaps, cluster_vectors

SCHEMA = "vec_id bigint, embedding array<float>, cluster int, row string, v int, distance string, moved int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 7, "r", 1, "d", 2) for i, v in rows], SCHEMA)


def clustered(spark, rows, **options):
    found = cluster_vectors(frame(spark, rows), **options).collect()
    key = lambda r: (r.vec_id is None, r.vec_id or 0, r.cluster, r.distance)
    return [(r.vec_id, r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid) for r in sorted(found, key=key)]


def brute_force(rows, k=8, rounds=10, dims=64):
    """Every vector against every centroid in every round, in whole numbers."""
    kept = [
        (i, [math.floor(1024 * float(np.float32(x))) for x in v])
        for i, v in rows
        if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)
    ]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), r[1]))
    middle = [v for _, v in order[:k]]
    nearest = lambda v: min((sum((x - y) ** 2 for x, y in zip(v, m)), c) for c, m in enumerate(middle))
    for _ in range(rounds):
        own = [nearest(v)[1] for _, v in kept]
        middle = [
            [sum(x) // own.count(c) for x in zip(*[v for (_, v), o in zip(kept, own) if o == c])] if c in own else m
            for c, m in enumerate(middle)
        ]
    last = [(i, *nearest(v)) for i, v in kept]
    inertia = [sum(d for _, d, o in last if o == c) for c in range(len(middle))]
    found = [(i, c, d, inertia[c], sum(inertia), middle[c]) for i, d, c in last]
    return sorted(found, key=lambda r: (r[0] is None, r[0] or 0, r[1], r[2]))


def vectors(seed, n, dims=64, spread=0.15):
    rng = random.Random(seed)
    middle = [[rng.gauss(0, 0.2) for _ in range(dims)] for _ in range(5)]
    return [(i, [m + rng.gauss(0, spread) for m in rng.choice(middle)]) for i in range(n)]


@pytest.mark.parametrize("block", [1024, 17])
def test_matches_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(centroids, "BLOCK", block)
    rows = vectors(1, 400)
    assert clustered(spark, rows) == brute_force(rows)


def test_ties_and_copies(spark):
    # A small grid: many vectors lie exactly between centroids, and a third are the same vector.
    rng = random.Random(2)
    rows = [(i, [0.0] * 3 if i % 3 == 0 else [rng.randrange(-3, 4) / 1024 for _ in range(3)]) for i in range(300)]
    for k in (1, 2, 8):
        assert clustered(spark, rows, dims=3, k=k) == brute_force(rows, dims=3, k=k)


def test_only_expired_vectors_are_scanned_again(spark):
    rows, report = vectors(3, 600, spread=0.05), []
    assert clustered(spark, rows, report=report) == brute_force(rows)
    assert report[0] == 600 and len(report) == 11 and report[-1] < 60 and sum(report) < 11 * 600 / 2


def test_awkward_rows(spark):
    rows = vectors(4, 40)
    v = rows[0][1]
    odd = [
        (100, None), (101, [None, *v[1:]]), (102, [float("nan"), *v[1:]]), (103, [*v[1:], float("-inf")]), (104, v[1:]),
        (105, [*v, 0.5]), (106, []), (None, v), (3, rows[3][1]), (3, rows[4][1]),
    ]
    assert clustered(spark, [*rows, *odd]) == brute_force([*rows, *odd])
    assert clustered(spark, []) == [] and clustered(spark, [(1, None)]) == []
    few = rows[:3]
    assert clustered(spark, few) == brute_force(few)
    same = [(i, v) for i in range(20)]
    assert {r[1] for r in clustered(spark, same)} == {0} and clustered(spark, same) == brute_force(same)


def test_heaps_keep_their_order_when_stored():
    rng = random.Random(5)
    heaps = Heaps(3)
    for at in range(200):
        heaps.push(rng.randrange(3), rng.random(), at)
    again = Heaps(3, *heaps.columns())
    drift = np.array([0.2, 0.0, 0.7])
    keys = {(c, at): key for c, heap in enumerate(again.heaps) for key, at in heap}
    assert sorted(again.expired(drift)) == sorted(at for (c, at), key in keys.items() if key <= drift[c])
    assert all(key > drift[c] for c, heap in enumerate(again.heaps) for key, _ in heap)
