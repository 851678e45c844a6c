import hashlib
import re

import pytest

from strata.llm import exact_dedup
from strata.llm.exact_dedup import cut_points, drop_exact_duplicates, exact_duplicates, normalise
from tests.llm.support import documents, no_documents, odd_documents, odd_rows, prose


def plain(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def test_normalise_is_the_pattern():
    for text in ("", " ", "a", " a", "a\t\nb ", "\x0b\x0ca\x00b\x1cc d  "):
        assert normalise(text.encode()).decode() == plain(text)


def test_chunks_cover_the_text_and_follow_its_content():
    text = prose(5, 5000).encode()
    for ends in cut_points([text, b"", b"x", b"a" * 200_000]):
        assert ends == sorted(set(ends))
    first, none, one, flat = cut_points([text, b"", b"x", b"a" * 200_000])
    assert first[-1] == len(text) and none == [] and one == [1] and flat[-1] == 200_000
    assert max(b - a for a, b in zip([0, *flat], flat)) <= exact_dedup.MAX_CHUNK
    # A text cut elsewhere in a block is cut the same, and later chunks survive an insertion.
    assert cut_points([b"other words", text])[1] == first
    moved = cut_points([b"inserted " + text])[0]
    assert len({c - 9 for c in moved} & set(first)) > len(first) // 2


def expected(given):
    groups = {}
    for d, t, *_ in given:
        groups.setdefault(plain(t), []).append(d)
    out = []
    for d, t, *_ in given:
        ids = groups[plain(t)]
        known = [i for i in ids if i is not None]
        out.append((d, min(known) if known else None, len(ids), hashlib.sha256(plain(t).encode()).hexdigest()))
    return sorted(out, key=str)


def test_awkward_rows(spark):
    found = exact_duplicates(odd_documents(spark)).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in found), key=str) == expected(odd_rows())
    kept = {}
    for r in found:
        kept[r.text_sha256] = kept.get(r.text_sha256, 0) + r.kept
    assert set(kept.values()) == {1}
    assert all(r.doc_id == r.keep_id for r in found if r.kept)


def test_rows_that_stay_keep_all_columns(spark):
    docs = odd_documents(spark)
    left = drop_exact_duplicates(docs)
    assert left.columns == docs.columns
    assert len({plain(r.text) for r in left.collect()}) == left.count() == len({plain(t) for _, t, *_ in odd_rows()})


def test_empty_table(spark):
    assert exact_duplicates(no_documents(spark)).collect() == []
    assert drop_exact_duplicates(no_documents(spark)).collect() == []


def test_digests_that_collide_do_not_join_texts(spark, monkeypatch):
    """With one digest for all chunks of a length, texts still count as equal only if they are."""
    given = [(1, prose(1, 50)), (2, prose(1, 50)), (3, prose(2, 50)), (4, "ab cd"), (5, "ab ce"), (6, "ab  cd")]
    monkeypatch.setattr(exact_dedup, "_recipes", _colliding(exact_dedup._recipes))
    monkeypatch.setattr(exact_dedup, "_chunks", _colliding(exact_dedup._chunks))
    found = exact_duplicates(documents(spark, given)).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in found), key=str) == expected(given)


def _colliding(make):
    def run(batches):
        from strata.llm import exact_dedup as inside

        inside._digest = lambda chunk: len(chunk).to_bytes(16, "big")
        try:
            yield from make(batches)
        finally:
            inside._digest = lambda chunk: hashlib.blake2b(chunk, digest_size=16).digest()

    return run


@pytest.mark.parametrize("copies", [3000])
def test_one_large_group(spark, copies):
    found = exact_duplicates(documents(spark, [(i, "same  text") for i in range(copies)]))
    assert found.filter("kept").count() == 1
    assert {tuple(r) for r in found.select("keep_id", "group_size").distinct().collect()} == {(0, copies)}
