import random

import numpy as np

from strata.llm import suffix_dedup
from strata.llm.shared import NOT_SPACE, Words
from strata.llm.suffix_dedup import anchors, repeated_passages, shared_words
from tests.llm.support import documents, no_documents, odd_documents, prose, words_of


def repeated_words(given, n=50):
    """{doc_id: words covered by a run of n words that occurs elsewhere}."""
    places = {}
    texts = [words_of(t) for _, t, *_ in given]
    for (d, *_), words in zip(given, texts):
        for i in range(len(words) - n + 1):
            places.setdefault(tuple(words[i : i + n]), []).append((d, i))
    covered = {}
    for found in places.values():
        if len(found) > 1:
            for d, i in found:
                covered.setdefault(d, set()).update(range(i, i + n))
    return covered


def planted(seed=1):
    rng = random.Random(seed)
    passages = [prose(900 + k, 51 + 17 * k, 10**6).split() for k in range(6)]
    given = []
    for d in range(120):
        words = []
        for k in range(rng.randrange(1, 4)):
            words += prose(1000 * k + d, rng.randrange(1, 100), 10**6).split()
            words += rng.choice(passages) if d % 3 else []
        given.append((d, " ".join(words)))
    return given


def check(spark, given):
    wanted = repeated_words(given)
    found = {}
    for r in repeated_passages(documents(spark, given)).collect():
        assert r.n_words == r.end_word - r.start_word >= 50
        found.setdefault(r.doc_id, set()).update(range(r.start_word, r.end_word))
    # Nothing is reported that does not repeat.
    assert all(found[d] <= wanted.get(d, set()) for d in found)
    # Every document with a repeat is found but for those that hold only first occurrences.
    left = [(d, " ".join(w for i, w in enumerate(words_of(t)) if i not in found.get(d, ()))) for d, t in given]
    assert repeated_words(left) == {}
    return found


def test_planted_passages(spark):
    assert len(check(spark, planted())) > 20


def test_a_passage_that_very_many_share(spark):
    passage = prose(5, 60, 10**6)
    given = [(i, f"{prose(i, 20, 10**6)} {passage} {prose(10**6 + i, 20, 10**6)}") for i in range(1500)]
    found = check(spark, given)
    assert set(found) == set(range(1, 1500))


def test_copies_and_repeats_within_a_text(spark):
    text, part = prose(1, 400, 10**6), prose(2, 70, 10**6)
    given = [(1, text), (2, text), (3, f"{part} x {part}"), (4, prose(3, 100, 10**6)), (5, text.upper())]
    found = check(spark, given)
    assert set(found) == {2, 3, 5} and len(found[2]) == 400


def test_awkward_rows(spark):
    found = repeated_passages(odd_documents(spark)).collect()
    assert {r.doc_id for r in found} <= {6, 7, None} and (6, 0, 40_000, 40_000, 5) in [tuple(r) for r in found]
    assert repeated_passages(no_documents(spark)).collect() == []
    flat = documents(spark, [(1, "a " * 3000), (2, "b")])
    assert {r.doc_id for r in repeated_passages(flat).collect()} == {1}


def test_anchors_depend_on_the_text_only():
    text = prose(4, 500, 10**6).encode()
    alone = set(anchors(Words([text], NOT_SPACE))[0].tolist())
    other = prose(5, 300, 10**6).encode()
    shifted = anchors(Words([other, text], NOT_SPACE))[0] - 300
    assert alone >= {a for a in shifted.tolist() if a >= 0} or len(alone ^ set(shifted[shifted >= 0].tolist())) <= 2
    gaps = np.diff(sorted(alone))
    assert gaps.max() <= suffix_dedup.WINDOW


def test_shared_words():
    assert shared_words(b"aaaabbbb", b"aaaabbbc") == 1
    assert shared_words(b"aaaabbbb", b"aaaabbbbcccc") == 2
    assert shared_words(b"", b"aaaa") == 0


def keepers(given, n=50):
    """{doc_id: words to remove}: all occurrences of a run of n words but the first go."""
    first, gone = {}, {}
    for d, t in sorted(given):
        words = words_of(t)
        for i in range(len(words) - n + 1):
            if first.setdefault(tuple(words[i : i + n]), (d, i)) != (d, i):
                gone.setdefault(d, set()).update(range(i, i + n))
    return gone


def check_keepers(spark, given):
    """Exactly the later occurrences go, and each removed run of words occurs once in what is left."""
    found = {}
    for r in repeated_passages(documents(spark, given)).collect():
        found.setdefault(r.doc_id, set()).update(range(r.start_word, r.end_word))
    assert found == keepers(given)
    left = "".join(
        "".join(f" {w}" if i not in found.get(d, ()) else "\n" for i, w in enumerate(words_of(t))) + " \n" for d, t in given
    )
    for d, gone in found.items():
        words = words_of(dict(given)[d])
        for i in gone:
            if set(range(i, i + 50)) <= gone:
                assert left.count(" " + " ".join(words[i : i + 50]) + " ") == 1


def test_each_passage_keeps_one_copy_though_all_share_a_line(spark):
    line = prose(1, 40, 10**6)
    given = []
    for k in range(20):
        passage = f"{prose(10 + k, 60, 10**6)} {line} {prose(50 + k, 60, 10**6)}"
        for copy in range(3):
            given.append((len(given), f"{prose(1000 + len(given), 30, 10**6)} {passage} {prose(2000 + len(given), 30, 10**6)}"))
    check_keepers(spark, given)


def test_partners_that_stand_behind_thousands_of_others(spark):
    line = prose(1, 42, 10**6)
    given = [(i, f"{prose(10**4 + i, 30, 10**6)} {line} {prose(2 * 10**4 + i, 30, 10**6)}") for i in range(2000)]
    for k in range(40):
        own = prose(5 * 10**4 + k, 10, 10**6)
        for copy in (0, 1):
            given.append((3000 + 2 * k + copy, f"{prose(6 * 10**4 + 2 * k + copy, 9, 10**6)} {own} {line} {prose(7 * 10**4 + 2 * k + copy, 30, 10**6)}"))
    check_keepers(spark, given)


def test_a_run_that_overlaps_itself_keeps_its_first_occurrence(spark):
    found = repeated_passages(documents(spark, [(1, "a " * 3000), (2, "b " * 70)])).collect()
    assert sorted(map(tuple, found)) == [(1, 50, 3000, 2950, 1), (2, 50, 70, 20, 2)]
