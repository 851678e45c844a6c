import random

import pytest

from strata.llm import near_dedup
from strata.llm.near_dedup import drop_near_duplicates, near_duplicates
from tests.llm.support import documents, no_documents, odd_documents, odd_rows, prose, words_of


def shingles(text, n):
    words = words_of(text)
    if len(words) < n:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1))


def brute_force(given, n):
    """{position: (set size, component id)} by comparing all pairs."""
    sets = [shingles(t, n) for _, t, *_ in given]
    parent = list(range(len(given)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            common = len(a & b)
            if a and b and 100 * common >= 80 * (len(a) + len(b) - common):
                parent[root(i)] = root(j)
    ids = {}
    for i, (d, *_) in enumerate(given):
        ids.setdefault(root(i), []).append(d)
    out = []
    for i, (d, *_) in enumerate(given):
        known = [x for x in ids[root(i)] if x is not None]
        out.append((d, len(sets[i]), min(known) if known else None))
    return sorted(out, key=str)


def edited(text, n, seed):
    rng, words = random.Random(seed), text.split()
    for _ in range(n):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


def varied(seed=1, families=12, size=6):
    given = []
    for f in range(families):
        base = prose(100 + f, 120 + 20 * f, 10**6)
        given += [(f * 100 + k, edited(base, k + f % 4, seed + f * 50 + k)) for k in range(size)]
    random.Random(seed).shuffle(given)
    return given


def result(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=str)


@pytest.mark.parametrize("n", [4, 5])
def test_matches_brute_force(spark, n):
    given = varied(n)
    assert result(near_duplicates(documents(spark, given), n=n)) == brute_force(given, n)


def test_awkward_rows(spark):
    found = near_duplicates(odd_documents(spark))
    assert result(found) == brute_force(odd_rows(), 5)
    stay = {}
    for r in found.collect():
        stay.setdefault((r.component_id, r.n_shingles if r.component_id is None else 0), []).append(r.kept)
    assert all(sum(v) >= 1 for v in stay.values())
    assert sum(r.kept for r in found.collect() if r.component_id == 7) == 1


def test_large_nodes_branch_and_meet_in_blocks(spark, monkeypatch):
    """With tiny nodes every path of the algorithm is taken: leaders, branching, cells."""
    monkeypatch.setattr(near_dedup, "SMALL_NODE", 12)
    monkeypatch.setattr(near_dedup, "BLOCK", 3)
    monkeypatch.setattr(near_dedup, "LEVELS", 1)
    passage = prose(7, 60, 10**6)
    given = varied(3, families=4, size=12)
    given += [(5000 + i, passage + " " + prose(900 + i, 60, 10**6)) for i in range(40)]
    given += [(6000 + i, edited(passage + " " + prose(31, 300, 10**6), 8, 40 + i)) for i in range(30)]
    assert result(near_duplicates(documents(spark, given), n=4)) == brute_force(given, 4)


def test_one_document_of_each_component_stays(spark):
    docs = documents(spark, varied(2, families=5))
    left = drop_near_duplicates(docs)
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.collect()) == sorted(
        {r.component_id for r in near_duplicates(docs).collect()}
    )


def test_empty_table(spark):
    assert near_duplicates(no_documents(spark)).collect() == []
    assert drop_near_duplicates(no_documents(spark)).collect() == []
