import os
import zlib

import numpy as np
import pytest

from strata.llm import language_id as li
from tests.llm.support import documents, no_documents, odd_documents, prose

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
SAMPLES = {"en": ["the cat sat on the mat and the dog"], "de": ["der hund und die katze sind im haus"]}


def phrases(text, sample):
    """Greedy phrases of ``text`` that occur in ``sample``, both as words joined by spaces."""
    normal = "".join(c.lower() if c.isalpha() else " " for c in text)
    squeezed = [c for i, c in enumerate(normal) if c != " " or i == 0 or normal[i - 1] != " "]
    n = 0
    for at in range(0, len(squeezed), li.SEGMENT):
        part, i = "".join(squeezed[at : at + li.SEGMENT]), 0
        n += 1
        k = 0
        while i < len(part):
            if part[k : i + 1] not in sample:
                n += 1
                k = i
                if part[i] not in sample:
                    k = i + 1
            i += 1
    return n


@pytest.mark.parametrize("text", ["the dog", "Der Hund!", "katze the katze", "xyz", "a", "the cat sat " * 40])
def test_phrases_match_a_plain_parse(text):
    model = li.build_model(SAMPLES)
    found, letters = li.count_phrases(model, ["", text, "und"])
    for j, lang in enumerate(model.languages):
        assert found[1, j] == phrases(text, " " + SAMPLES[lang][0] + " "), lang
    assert letters[0] == 0 and letters[1] == sum(c.isalpha() for c in text)


def test_a_text_is_judged_alone():
    model = li.build_model(SAMPLES)
    texts = ["the cat", "", "und die", "  sat on  ", "1 2 3"]
    together, _ = li.count_phrases(model, texts)
    alone = np.concatenate([li.count_phrases(model, [t])[0] for t in texts])
    assert (together == alone).all()


def test_awkward_rows(spark):
    found = li.detect_languages(odd_documents(spark))
    assert found.columns == ["doc_id", "held_out", "lang_pred", "score"]
    got = found.collect()
    assert len(got) == 14
    assert all(0 <= r.score <= 1 for r in got)
    assert all(r.lang_pred == "und" and r.score == 0 for r in got if r.doc_id in (1, 2, 3))
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)


def test_without_documents_or_labels(spark):
    assert li.detect_languages(no_documents(spark)).collect() == []
    unlabelled = documents(spark, [(1, "some words", None, None)])
    assert [tuple(r) for r in li.detect_languages(unlabelled).collect()] == [(1, False, "und", 0.0)]


def test_labels_of_held_out_rows_are_not_used(spark):
    ids = [i for i in range(200) if zlib.crc32(str(i).encode()) % 5 == 0][:3]
    docs = documents(spark, [(i, "secret words", "xx", "s") for i in ids] + [(1001, "plain words", "en", "s")])
    assert {r.lang_pred for r in li.detect_languages(docs).collect()} == {"en"}


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    found = li.detect_languages(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in found) >= 0.97 * len(found)


def ideographs(first, seed, n, kinds=900):
    rng = np.random.default_rng(seed)
    words = ["".join(chr(first + int(i)) for i in rng.integers(0, kinds, 3)) for _ in range(300)]
    order = np.random.default_rng(10**6 + n + seed).integers(0, 300, n)
    return words, " ".join(words[int(i)] for i in order)


def test_letters_beyond_the_most_frequent_count():
    latin = "the cat sat on the mat and the dog " * 100
    samples = {"en": [latin]}
    words = {}
    for lang, first, seed in (("zh", 0x4E00, 1), ("ja", 0x4E00, 2), ("xx", 0x7000, 3)):
        words[lang], text = ideographs(first, seed, 1500)
        samples[lang] = [text]
    model = li.build_model(samples)
    assert len(model.codes[model.codes > 0]) and model.n_codes > 1000
    for lang, known in words.items():
        text = " ".join(known[::7])
        found, _ = li.count_phrases(model, [text])
        for j, name in enumerate(model.languages):
            assert found[0, j] == phrases(text, " " + samples[name][0].strip() + " "), (lang, name)
        assert model.languages[int((found * model.bits)[0].argmin())] == lang


def test_languages_of_long_texts_only_are_learned(spark):
    long_aa = "12 " + " ".join(f"ba{w}" for w in prose(1, 5000, 50).replace("w", "x").split())
    rest = [(i, f"the cat sat on mat number {'abcdefghij'[i % 10]}", "en", "s") for i in range(1, 60)]
    given = rest + [(1000 + i, long_aa.replace("1", "abc"[i % 3]).replace("2", "k"), "aa", "s") for i in range(6)]
    assert min(len(t) for _, t, lang, _ in given if lang == "aa") > li.SAMPLE_CHARS
    found = {r.doc_id: r.lang_pred for r in li.detect_languages(documents(spark, given)).collect()}
    assert {found[d] for d, _, lang, _ in given if lang == "aa"} == {"aa"}
    assert {found[d] for d, _, lang, _ in given if lang == "en"} == {"en"}


def test_a_kept_text_is_sent_once_and_comes_back_in_blocks(spark, monkeypatch):
    given = [(i, prose(i, 400), "en", "s") for i in range(900)] + [(900, None), (901, "1 2"), (902, "the cat")]
    docs = documents(spark, given).select("doc_id", "text", "lang")
    model = li.build_model(SAMPLES)
    sent, send = [], type(docs).mapInArrow
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, f, schema: sent.append((self, f)) or send(self, f, schema))
    found = li.predict_language(docs, model)
    source, predict = sent[0]
    size = docs.toArrow().nbytes
    assert size > 2 * li.BLOCK_BYTES and source.toArrow().nbytes < 1.2 * size
    whole = source.toArrow().combine_chunks().to_batches()
    assert max(b.nbytes for b in predict(iter(whole))) < 1.2 * li.BLOCK_BYTES
    kept = {r.doc_id: tuple(r) for r in found.collect()}
    alone = li.predict_language(docs, model, keep=["doc_id"]).collect()
    assert [r[:3] for r in sorted(kept.values())] == [(*r, "en")[:3] for r in given]
    assert {r.doc_id: tuple(r)[1:] for r in alone} == {d: r[3:] for d, r in kept.items()}
    assert kept[900][3:] == kept[901][3:] == ("und", 0.0) and kept[902][3] == "en"
