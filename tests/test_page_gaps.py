import random

from strata.operators import pages
from tests.support import rows

SCHEMA = "page int, per_page int, records array<string>, reported_total int"


def frame(spark, sizes, total, per_page=2):
    return spark.createDataFrame([(p, per_page, None if n is None else ["{}"] * n, total) for p, n in sizes], SCHEMA)


def brute_force(sizes, total, per_page=2):
    landed = {}
    for page, n in sizes:
        landed.setdefault(page, []).append(n or 0)
    stop = min((p for p, found in landed.items() if not any(found)), default=10**9)
    counts = {p: sum(n > 0 for n in found) for p, found in landed.items() if p < stop and any(found)}
    last = max([-(-total // per_page) if total is not None else 0, *counts])
    out, begin = [], None
    for page in range(1, last + 2):
        if page <= last and page not in counts:
            begin = page if begin is None else begin
        elif begin is not None:
            out.append(("missing", begin, page - 1, page - begin))
            begin = None
    return sorted([*out, *(("repeated", p, p, n) for p, n in counts.items() if n > 1)], key=str)


def test_gaps_match_an_enumeration(spark, monkeypatch):
    rng = random.Random(1)
    for stretch, total in ((1 << 16, 60), (4, 41), (1, 20)):
        monkeypatch.setattr(pages, "STRETCH", stretch)
        sizes = [(rng.randrange(1, 40), rng.choice([1, 2, 2])) for _ in range(25)]
        assert rows(pages.page_gaps(frame(spark, sizes, total))) == brute_force(sizes, total)
        stopped = [*sizes, (33, 0), (33, None)]
        assert rows(pages.page_gaps(frame(spark, stopped, total))) == brute_force(stopped, total)


def test_ends_and_empty_landings(spark):
    assert rows(pages.page_gaps(frame(spark, [(2, 2)], 7))) == [("missing", 1, 1, 1), ("missing", 3, 4, 2)]
    assert rows(pages.page_gaps(frame(spark, [(1, 2), (2, 2), (3, 0)], 4))) == []
    assert rows(pages.page_gaps(frame(spark, [], None))) == []
    assert rows(pages.page_gaps(frame(spark, [(10**6, 1)], 2))) == [("missing", 1, 10**6 - 1, 10**6 - 1)]
