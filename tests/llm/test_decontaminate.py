import hashlib
import re

import pytest

from strata.llm import decontaminate
from strata.llm.decontaminate import contamination_report, find_contamination, remove_contamination
from tests.llm.support import documents, lower_ascii, no_documents, odd_documents, odd_rows, prose

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall(lower_ascii(text or ""))


def brute_force(given, items, n=10):
    windows = {}
    for item, text in items:
        words = words_of(text)
        size = min(n, len(words))
        for i in range(len(words) - size + 1 if words else 0):
            windows.setdefault(tuple(words[i : i + size]), set()).add(item)
    out = []
    for d, text, *_ in given:
        words, hit, found = words_of(text), set(), set()
        for w, owners in windows.items():
            for i in range(len(words) - len(w) + 1):
                if tuple(words[i : i + len(w)]) == w:
                    hit |= set(range(i, i + len(w)))
                    found |= owners
        names = ",".join(sorted(str(i) for i in found if i is not None))
        n_items = len({i for i in found if i is not None})
        out.append((d, len(words), len(hit), n_items, hashlib.sha256(names.encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


ITEMS = [
    (1, prose(50, 30)), (2, prose(51, 30)), (10, "Tiny item"), (3, None), (4, "..."), (5, ""), (1, prose(50, 30)),
    (None, prose(52, 12)), (6, "ÉTÉ chaud à Paris"), (7, prose(50, 30) + " more"), (8, "a-b c_d 9x"),
]
GIVEN = [
    (1, "before " + prose(50, 30).upper().replace(" ", ", ") + " after"),
    (2, " ".join(prose(50, 30).split()[3:13])),
    (3, " ".join(prose(50, 30).split()[3:12])),
    (4, "tiny\nitem, and TINY item tiny"),
    (5, prose(52, 12)),
    (6, "l'ÉTé Chaud à paris"),
    (7, prose(51, 30) + prose(51, 30)),
    (8, "A B C D 9x; a b c d 9x"),
    (9, "clean words only"),
]


def benchmark(spark, items=ITEMS):
    return spark.createDataFrame([(*i, "x") for i in items], "item_id bigint, text string, n_words string")


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_matches_brute_force(spark):
    docs, items = documents(spark, GIVEN), benchmark(spark)
    assert result(contamination_report(docs, items)) == brute_force(GIVEN, ITEMS)


@pytest.mark.parametrize("max_words", [80, 200])
def test_a_benchmark_in_parts_gives_the_same(spark, max_words):
    docs, items = documents(spark, GIVEN), benchmark(spark)
    whole = find_contamination(docs, items).select("doc_id", "n_words", "hit_spans", "hit_items")
    parts = find_contamination(docs, items, max_words=max_words).select("doc_id", "n_words", "hit_spans", "hit_items")
    assert result(whole) == result(parts)


def test_awkward_rows(spark):
    items = [(1, odd_rows()[7][1]), (2, "one"), (3, "é ß"), (4, "中文")]
    assert result(contamination_report(odd_documents(spark), benchmark(spark, items))) == brute_force(odd_rows(), items)


def test_empty_tables(spark):
    assert result(contamination_report(no_documents(spark), benchmark(spark))) == []
    assert result(contamination_report(documents(spark, GIVEN), benchmark(spark, []))) == brute_force(GIVEN, [])


def test_documents_or_spans_go(spark):
    docs, items = documents(spark, GIVEN), benchmark(spark)
    dirty = {d for d, *_, bad in brute_force(GIVEN, ITEMS) if bad}
    left = remove_contamination(docs, items)
    assert left.columns == docs.columns
    assert {r.doc_id for r in left.collect()} == {d for d, _ in GIVEN} - dirty
    cut = remove_contamination(docs, items, spans_only=True)
    assert cut.columns == docs.columns
    texts = {r.doc_id: r.text for r in cut.collect()}
    assert words_of(texts[1]) == ["before", "after"] and texts[9] == "clean words only"
    assert all(not bad for *_, bad in brute_force(texts.items(), ITEMS))


def test_equal_hashes_are_told_apart(spark, monkeypatch):
    """Hits are compared word by word: with all window hashes equal only real ones remain."""
    import numpy as np

    texts = [t.encode() for _, t in GIVEN]
    real = decontaminate.Windows([i for i in ITEMS if i[1]], 10).scan(texts)
    monkeypatch.setattr(decontaminate, "rolling", lambda h, n: np.zeros(max(0, len(h) - n + 1), np.uint64))
    forced = decontaminate.Windows([i for i in ITEMS if i[1]], 10).scan(texts)
    assert [s.tolist() for s in real[1]] == [s.tolist() for s in forced[1]] and real[2] == forced[2]
