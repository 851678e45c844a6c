import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from strata.llm import packing
from strata.llm.packing import Encoder, Limits, pack, pack_documents, padding, powers, sequences
from strata.llm.queries import QUERIES
from tests.llm.support import documents, no_documents, odd_documents, odd_rows, prose

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    found = Tokenizer.from_file(PATH)
    found.encode_special_tokens = True
    return found


def ids_of(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


def test_words_give_the_ids_of_the_whole_text(tokenizer):
    encoder = Encoder(open(PATH, encoding="utf-8").read())
    assert encoder.by_word
    rng = random.Random(1)
    bits = [
        " ", "  ", "\n", "\n\n", "\t", "\r\n", "\x0b", "\x1c", "\x85", "\xa0", " ", "　", "​", "a", "the",
        "Straße", "été", "don't", "'s", "'", ".", ",", "...", "!?", "%%", "12", "3,4", "²", "½", "Ⅷ", "ª", "中文", "😀", "é",
        "_", "€", "<|endoftext|>", "\x00", "Ǆ", "ɏ", "ɐ",
    ]
    for _ in range(3000):
        text = "".join(rng.choice(bits) for _ in range(rng.randrange(30)))
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == ids_of(tokenizer, text), repr(text)
    # What is remembered does not change what comes later, nor does a full memory.
    for text in (prose(1, 300), prose(1, 300), "x" * 5000, "a " * 3000):
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == ids_of(tokenizer, text)


def check_bins(tokens, silent, limits, bins):
    seen = [[] for _ in tokens]
    for pieces in bins:
        assert 0 < len(pieces) <= limits.segments and sum(n for _, _, n in pieces) <= limits.tokens
        loss = sum(max(0, s + n - max(s, silent[i])) for i, s, n in pieces)
        assert loss <= limits.loss
        for i, s, n in pieces:
            assert n > 0
            seen[i].append((s, n))
    for total, found in zip(tokens, seen):
        at = 0
        for s, n in sorted(found):
            assert s == at
            at += n
        assert at == total


@pytest.mark.parametrize("limits", [Limits(64, 4, 64), Limits(64, 64, 20), Limits(7, 1, 3), Limits(1, 1, 1)])
@pytest.mark.parametrize("cut", [True, False])
def test_every_bin_keeps_all_limits(limits, cut):
    rng = random.Random(3)
    tokens = [rng.choice([1, 2, 5, 9, 30, 63, 64, 65, 200]) for _ in range(150)]
    silent = [rng.randrange(n + 1) for n in tokens]
    bins = list(pack(tokens, silent, limits, cut))
    check_bins(tokens, silent, limits, bins)
    if not cut:
        whole = [i for i, n in enumerate(tokens) if n <= limits.tokens and n - silent[i] <= limits.loss]
        pieces = [i for b in bins for i, _, _ in b]
        assert all(pieces.count(i) == 1 for i in whole)


def test_the_heuristic_takes_the_largest_product():
    # (6, 6) first; then room is (4, 4), and (3, 3) gives 24 where the longer (4, 1) gives 20.
    bins = list(pack([6, 4, 3], [0, 3, 0], Limits(10, 5, 10), cut=False))
    assert bins == [[(0, 0, 6), (2, 0, 3)], [(1, 0, 4)]]
    # Without the loss limit the longest that fits comes first.
    assert list(pack([5, 7, 3, 5], [0] * 4, Limits(10, 5, 10), cut=False)) == [
        [(1, 0, 7), (2, 0, 3)], [(3, 0, 5), (0, 0, 5)],
    ]
    # Nothing fits whole: the largest is cut.
    assert list(pack([7, 7], [0, 0], Limits(10, 5, 10))) == [[(1, 0, 7), (0, 0, 3)], [(0, 3, 4)]]


def test_only_the_last_bin_is_open():
    rng = random.Random(5)
    tokens = [rng.randrange(1, 5000) for _ in range(400)]
    bins = list(pack(tokens, [0] * 400, Limits(2048, 256, 2048)))
    assert [sum(n for _, _, n in b) < 2048 for b in bins].count(True) <= 1


def test_powers():
    for bin_ in ([(0, 5, 7), (1, 0, 6)], [(0, 0, 16)], [(0, 0, 1)]):
        parts = list(powers(bin_, 16))
        assert all(sum(n for _, _, n in p).bit_count() == 1 for p in parts)
        check_bins([sum(n for i, _, n in bin_ if i == k) for k in {i for i, _, _ in bin_}], [0, 0], Limits(16, 9, 16),
                   [[(i, s - bin_[0][1] * (i == 0), n) for i, s, n in p] for p in parts])


def check(tokenizer, given, pieces, max_tokens=2048):
    """Every document's ids once, in order, and gapless sequences; no padding but at the rule."""
    wanted = sorted((d is None, d or 0, [*ids_of(tokenizer, t), 1]) for d, t, *_ in given)
    by_sequence, by_document = {}, {}
    for r in pieces:
        ids = np.frombuffer(bytes(r.ids), "<u4").tolist()
        assert len(ids) == r.length == r.loss_tokens
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
        by_document.setdefault(r.doc_id, []).append((r.doc_tokens, r.start, ids))
    for found in by_sequence.values():
        at = 0
        for offset, length in sorted(found):
            assert offset == at
            at += length
        assert at == max_tokens or at.bit_count() == 1
    # Ids that several rows share hold the pieces of all of them.
    for d, found in by_document.items():
        rows = [ids for null, k, ids in wanted if (None if null else k) == d]
        assert sum(len(x) for _, _, x in found) == sum(map(len, rows))
        for ids in rows:
            for total, start, part in found:
                if len(rows) == 1:
                    assert total == len(ids) and part == ids[start : start + len(part)]
    assert len(by_document) == len({d for d, *_ in given})


def test_awkward_rows(spark, tokenizer):
    found = pack_documents(odd_documents(spark), PATH).collect()
    check(tokenizer, odd_rows(), found)
    assert pack_documents(no_documents(spark), PATH).collect() == []
    assert padding(pack_documents(no_documents(spark), PATH)).first() == (0, 0, 0)
    assert [r.doc_tokens for r in found if r.doc_id == 2] == [1]


def test_groups_and_padding(spark, tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "GROUP_TOKENS", 3000)
    given = [(i, prose(i, 1 + i * 7 % 900)) for i in range(60)]
    pieces = pack_documents(documents(spark, given).coalesce(1), PATH)
    check(tokenizer, given, pieces.collect())
    assert padding(pieces).first().n_padding == 0


def test_ids_are_little_endian_and_their_checksum_unsigned(spark, tokenizer):
    found = QUERIES["op11_packing"](spark, "/root/testdata/sf0.001").collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    for r in found:
        ids = [*ids_of(tokenizer, texts[r.doc_id]), 1]
        own = np.array(ids[r.start : r.start + r.length], dtype="<u4")
        assert r.ids_crc32 == zlib.crc32(own.tobytes()) and r.doc_tokens == len(ids)


def test_prompts_bear_no_loss(spark, tokenizer):
    rows = [(i, prose(i, 40 + i), prose(1000 + i, 10 + i) if i % 5 else None, i) for i in range(50)]
    frame = spark.createDataFrame(rows, "k bigint, prompt string, answer string, length int")
    pieces = pack_documents(
        frame, PATH, "prompt", "k", response="answer", max_tokens=512, max_segments=3, max_loss_tokens=200, powers_of_two=False
    )
    whole = sequences(pieces).collect()
    assert all(r.n_tokens <= 512 and r.n_segments <= 3 and r.loss_tokens <= 200 for r in whole)
    assert all(len(r.ids) == 4 * r.n_tokens and sum(r.lengths) == r.n_tokens for r in whole)
    loss = {k: len(ids_of(tokenizer, a)) + 1 for k, _, a, _ in rows}
    found = {}
    for r in pieces.collect():
        found[r.doc_id] = found.get(r.doc_id, 0) + r.loss_tokens
    assert found == loss
