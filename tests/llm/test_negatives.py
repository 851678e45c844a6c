import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import negatives
from strata.llm.negatives import mine_hard_negatives

SCHEMA = "vec_id bigint, embedding array<float>, label int, row string, score int, dims int, block int, anchor int, text string"
CLASHING = ("r", 1, 2, 3, 4, "x")


def frame(spark, rows):
    return spark.createDataFrame([(i, v, y, *CLASHING) for i, v, y in rows], SCHEMA)


def mined(spark, rows):
    return sorted(tuple(r) for r in mine_hard_negatives(frame(spark, rows), F.col("vec_id") % 10 == 0).collect())


def brute_force(rows, every=10):
    kept = [
        (i, [math.floor(256 * float(np.float32(x))) for x in v], y)
        for i, v, y in rows
        if None not in (i, v, y) and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for a, (anchor, va, ya) in enumerate(kept):
        if anchor % every:
            continue
        scored = [
            (-sum(x * y for x, y in zip(va, v)), i, y) for b, (i, v, y) in enumerate(kept) if b != a and len(v) == len(va)
        ]
        for s, positive, _ in sorted(r for r in scored if r[2] == ya)[:5]:
            fit = sorted(r for r in scored if r[2] != ya and 80 * -s <= 100 * -r[0] <= 100 * -s)[:5]
            out += [(anchor, positive, k, i, -s, -t) for k, (t, i, _) in enumerate(fit, 1)]
    return sorted(out)


def vectors(seed, n, dims=12, labels=3, near=0.3):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 0.3) for _ in range(dims)] for _ in range(4)]
    return [
        (i, [c + rng.gauss(0, near) for c in rng.choice(centres)], rng.choices(range(labels), range(1, labels + 1))[0])
        for i in range(n)
    ]


@pytest.mark.parametrize("sizes", [(2048, 1024), (40, 7)])
def test_matches_brute_force(spark, monkeypatch, sizes):
    monkeypatch.setattr(negatives, "BLOCK", sizes[0])
    monkeypatch.setattr(negatives, "CHUNK", sizes[1])
    for seed in (1, 2):
        rows = vectors(seed, 300)
        wanted = brute_force(rows)
        assert len(wanted) > 200 and mined(spark, rows) == wanted


def test_ties_and_copies(spark, monkeypatch):
    monkeypatch.setattr(negatives, "BLOCK", 20)
    # Few different vectors: nearly all scores tie; one vector holds a third of the rows.
    rng = random.Random(3)
    pool = [[rng.choice([0.0, 0.25, -0.5]) for _ in range(10)] for _ in range(6)]
    rows = [(i, pool[0] if i % 3 == 0 else rng.choice(pool), rng.randrange(3)) for i in range(150)]
    assert mined(spark, rows) == brute_force(rows)


def test_awkward_rows(spark):
    rows = vectors(4, 60)
    odd = [
        (100, None, 1), (110, [None, *rows[0][1][1:]], 1), (120, [float("nan")] * 12, 1), (130, [float("inf")] * 12, 1),
        (140, rows[0][1], None), (None, rows[0][1], 1), (150, [], 1), (151, [], 1), (152, [], 0), (160, [1.0, 2.0], 2),
        (161, [1.0, 2.0], 2), (162, [0.9, 2.0], 1), (10, rows[10][1], rows[10][2]), (170, rows[10][1], 99),
    ]
    found = mined(spark, [*rows, *odd])
    assert found == brute_force([*rows, *odd])
    assert (150, 151, 1, 152, 0, 0) in found and any(r[0] == 160 for r in found) and not any(r[0] == 170 for r in found)
    assert mined(spark, []) == []
    assert mined(spark, [(1, [0.5], 1), (3, [0.5], 2)]) == []


def test_too_large_components_are_an_error(spark):
    with pytest.raises(Exception, match="component too large"):
        mined(spark, [(10, [1e30], 1)])


def test_rows_leave_the_candidates_before_the_last_dimension():
    rng = np.random.default_rng(1)
    import pyarrow as pa

    n, dims = 500, 64
    near = rng.normal(0, 20, (n, dims)).astype(int)
    near[:5] *= 8
    block = negatives.Block(pa.table({"vec_id": range(n), "row": range(n), "v": near.tolist()}))
    seen = []

    def prune(lowest, highest):
        assert (lowest <= highest).all()
        seen.append(len(lowest))
        return highest >= np.partition(lowest, -5)[-5]

    live, score = block.scan(near[0], np.arange(n), prune)
    assert (score == near[live] @ near[0]).all() and seen[-1] < n
    assert set(np.argsort(-(near @ near[0]))[:5]) <= set(live)
