"""Packing of tokenised examples into sequences by vector bin packing.

A bin is a sequence with limits on tokens, segments and loss-bearing tokens. Bins are filled one
after the other: of the examples that still fit, the one whose vector (tokens, one segment, loss)
has the largest dot product with what is left of the bin, each in shares of its limit, goes in.
When none fits whole, the piece of the largest that does is cut off and fills the bin to its end.

A task packs the documents of its input in groups of about ``GROUP_TOKENS`` as it reads them, so
nothing is shuffled and no task holds more than a group; a text longer than that is a group alone.
"""

from __future__ import annotations

import os
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.shared import text_blocks

MAX_TOKENS = 2048
#: Segments of a sequence at most; attention masks of packed sequences hold one entry for each.
MAX_SEGMENTS = 256
END_ID = 1
#: Tokens that are packed together: about a thousand sequences.
GROUP_TOKENS = 1 << 21
#: Words, and what follows them, whose ids a worker remembers; the ones beyond are encoded each time.
MAX_WORDS, MAX_WORD_CHARS = 1 << 20, 64

#: White space, and letters and punctuation that every byte-level pre-tokenizer keeps apart.
SPACE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
LETTER = "A-Za-zÀ-ÖØ-öø-ɏ"
PUNCTUATION = r"!-&(-/:-@\[-`{-~"
#: Before a space that a word follows every byte-level pre-tokenizer cuts, whatever stands before.
WORD_START = re.compile(rf" (?=[^{SPACE}])")
#: It also cuts between letters and punctuation behind them, and before white space behind anything else.
LETTERS, BEHIND_LETTERS = re.compile(f"[{LETTER}]*"), re.compile(f"[{PUNCTUATION}]")
PARTS = re.compile(f"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")
ID_BYTES = 4


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit bytes, each word encoded once.

    ``vocabulary`` is the content of a tokenizer file. A byte-level pre-tokenizer never joins
    anything across the start of a space-led word, so texts are encoded word by word; with any
    other kind they are encoded whole. Strings of special tokens are ordinary text.
    """

    def __init__(self, vocabulary: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_str(vocabulary)
        self.tokenizer.encode_special_tokens = True
        self.model = self.tokenizer.model
        kind = self.tokenizer.pre_tokenizer
        self.by_word = (
            isinstance(kind, pre_tokenizers.ByteLevel)
            and kind.use_regex
            and not kind.add_prefix_space
            and self.tokenizer.normalizer is None
        )
        self.words, self.tails = _Known(self.word), _Known(self.tail)

    def whole(self, text: str) -> bytes:
        return _id_bytes(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def word(self, text: str) -> bytes:
        """Ids of a space and the word."""
        letters = LETTERS.match(text).end()
        if letters == len(text):
            mapped = text if text.isascii() else text.encode().decode("latin-1").translate(BYTE_LETTERS)
            return _id_bytes([token.id for token in self.model.tokenize(BYTE_LETTERS[32] + mapped)])
        if letters and BEHIND_LETTERS.match(text, letters):
            return self.words[text[:letters]] + self.tails[text[letters:]]
        return self.whole(f" {text}")

    def tail(self, text: str) -> bytes:
        """Ids of what follows a word: punctuation, and the next word behind other white space."""
        parts = PARTS.findall(text)
        return self.whole(text) if len(parts) == 1 else b"".join(map(self.tails.__getitem__, parts))

    def encode(self, text: str) -> bytes:
        if not self.by_word:
            return self.whole(text)
        first, *others = WORD_START.split(text)
        return self.whole(first) + b"".join(map(self.words.__getitem__, others))


def _id_bytes(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class _Known(dict):
    """What ``find`` gives for strings, remembered for the first MAX_WORDS short ones."""

    def __init__(self, find):
        self.find = find

    def __missing__(self, text: str) -> bytes:
        ids = self.find(text)
        if len(text) <= MAX_WORD_CHARS and len(self) < MAX_WORDS:
            self[text] = ids
        return ids


def _byte_letters() -> dict[int, str]:
    """Byte-level vocabularies write printable bytes as themselves, the others from U+0100 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in printable]
    return {b: chr(256 + n) for n, b in enumerate(others)}


BYTE_LETTERS = _byte_letters()
_encoders: dict[int, Encoder] = {}


def encoder_of(vocabulary: str) -> Encoder:
    """The encoder of a vocabulary; a worker keeps the last one for its next tasks."""
    if hash(vocabulary) not in _encoders:
        _encoders.clear()
        _encoders[hash(vocabulary)] = Encoder(vocabulary)
    return _encoders[hash(vocabulary)]


class Limits:
    """What a sequence may hold: tokens, segments, loss-bearing tokens."""

    def __init__(self, tokens: int, segments: int, loss: int):
        if min(tokens, segments, loss) < 1:
            raise ValueError("limits must be positive")
        self.tokens, self.segments, self.loss = tokens, segments, loss


def pack(tokens: list[int], silent: list[int], limits: Limits, cut: bool = True) -> Iterator[list[tuple[int, int, int]]]:
    """Bins of (example, start, length) for examples of so many ``tokens``, of which the first
    ``silent`` bear no loss.

    Examples too large for a bin are cut in any case; others only with ``cut``, where they fill a
    bin that nothing fits whole. Every token lies in exactly one piece.
    """
    shapes: dict[tuple[int, int], int] = {}
    held: list[list[tuple[int, int, int]]] = []
    size = np.zeros((2, 64))  # tokens and loss of each shape
    count = np.zeros(64, dtype=np.int64)

    def add(i: int, start: int) -> None:
        nonlocal size, count
        length = tokens[i] - start
        while length and (length > limits.tokens or _loss(start, length, silent[i]) > limits.loss):
            piece = _longest(start, length, silent[i], limits.tokens, limits.loss)
            put(i, start, piece)
            start, length = start + piece, length - piece
        if length:
            put(i, start, length)

    def put(i: int, start: int, length: int) -> None:
        nonlocal size, count
        shape = (length, _loss(start, length, silent[i]))
        if shape not in shapes:
            if len(held) == len(count):
                size = np.concatenate((size, np.zeros_like(size)), axis=1)
                count = np.concatenate((count, np.zeros_like(count)))
            shapes[shape] = len(held)
            size[:, len(held)] = shape
            held.append([])
        held[shapes[shape]].append((i, start, length))
        count[shapes[shape]] += 1

    for i in range(len(tokens)):
        add(i, 0)
    unit = np.array([[limits.tokens], [limits.loss]], dtype=np.float64)
    left = int(count.sum())
    while left:
        room = np.array([[limits.tokens], [limits.loss]], dtype=np.float64)
        pieces: list[tuple[int, int, int]] = []
        while len(pieces) < limits.segments and room[0, 0] > 0:
            n = len(held)
            # A segment adds the same to every product, so it decides nothing but the limit.
            product = ((size[:, :n] / unit) * (room / unit)).sum(axis=0)
            product[count[:n] == 0] = -1
            whole = np.where((size[:, :n] <= room).all(axis=0), product, -1)
            best = int(whole.argmax())
            if whole[best] >= 0:
                piece = held[best].pop()
                count[best] -= 1
                left -= 1
            else:
                best = int(product.argmax())
                if not cut or product[best] < 0:
                    break
                i, start, length = held[best][-1]
                part = _longest(start, length, silent[i], int(room[0, 0]), int(room[1, 0]))
                if not part:
                    break
                held[best].pop()
                count[best] -= 1
                put(i, start + part, length - part)
                piece = (i, start, part)
            pieces.append(piece)
            room -= [[piece[2]], [_loss(piece[1], piece[2], silent[piece[0]])]]
        yield pieces


def _loss(start: int, length: int, silent: int) -> int:
    return max(0, start + length - max(start, silent))


def _longest(start: int, length: int, silent: int, tokens: int, loss: int) -> int:
    """Tokens of the longest piece from ``start`` within the two limits."""
    return min(length, tokens, max(0, silent - start) + loss)


def powers(pieces: list[tuple[int, int, int]], full: int) -> Iterator[list[tuple[int, int, int]]]:
    """A bin that is not full as bins whose lengths are powers of two, largest first."""
    length = sum(n for _, _, n in pieces)
    if length == full:
        yield pieces
        return
    rest = [*reversed(pieces)]
    for bit in reversed(range(length.bit_length())):
        room, out = length & (1 << bit), []
        while room:
            i, start, n = rest.pop()
            if n > room:
                rest.append((i, start + room, n - room))
                n = room
            out.append((i, start, n))
            room -= n
        if out:
            yield out


def _packer(vocabulary, end_id: int, limits: Limits, cut: bool, exact: bool, key_type: pa.DataType):
    end = _id_bytes([end_id])

    def packed(group: list, number: int) -> tuple[pa.RecordBatch, int]:
        """The pieces of a group of (id, prompt ids, ids) and the number of the next sequence."""
        tokens = [len(ids) // ID_BYTES for _, _, ids in group]
        at, start, length, sequence, offset, loss, parts = [], [], [], [], [], [], []
        silent = [n for _, n, _ in group]
        for pieces in pack(tokens, silent, limits, cut):
            for bin_ in powers(pieces, limits.tokens) if exact else [pieces]:
                used = 0
                for i, s, n in bin_:
                    at.append(i)
                    start.append(s)
                    length.append(n)
                    sequence.append(number)
                    offset.append(used)
                    loss.append(_loss(s, n, silent[i]))
                    parts.append(group[i][2][ID_BYTES * s : ID_BYTES * (s + n)])
                    used += n
                number += 1
        columns = [
            pa.array([group[i][0] for i in at], key_type),
            *(pa.array(x, pa.int64()) for x in (start, length, [tokens[i] for i in at], loss, sequence, offset)),
            pa.array(parts, pa.binary()),
        ]
        names = ["doc_id", "start", "length", "doc_tokens", "loss_tokens", "sequence_id", "offset", "ids"]
        return pa.RecordBatch.from_arrays(columns, names=names), number

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(vocabulary.value)
        number = TaskContext.get().partitionId() << 40
        group, held = [], 0
        for batch in batches:
            keys = batch.column(0)
            for first, _, block in text_blocks(batch.column(1)):
                for k, raw in enumerate(block):
                    ids, prompt = encoder.encode(raw.decode("utf-8", "replace")), 0
                    if batch.num_columns > 2:
                        prompt, answer = len(ids) // ID_BYTES, batch.column(2)[first + k].as_py()
                        ids += encoder.encode(answer or "")
                    group.append((keys[first + k].as_py(), prompt, ids + end))
                    held += len(ids) // ID_BYTES + 1
                    if held >= GROUP_TOKENS:
                        out, number = packed(group, number)
                        yield out
                        group, held = [], 0
        if group:
            yield packed(group, number)[0]

    return run


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str,
    text: str = "text",
    key: str = "doc_id",
    response: str | None = None,
    max_tokens: int = MAX_TOKENS,
    max_segments: int = MAX_SEGMENTS,
    max_loss_tokens: int | None = None,
    end_id: int = END_ID,
    cut: bool = True,
    powers_of_two: bool = True,
) -> DataFrame:
    """One row per piece: doc_id, start, length, doc_tokens, loss_tokens, sequence_id, offset, ids.

    An example is the ids of ``text``, then of ``response`` if such a column is named, then
    ``end_id``. ``ids`` holds those of the piece as little-endian unsigned 32-bit numbers. With a
    response the ids of the text bear no loss; without, all do. ``max_loss_tokens`` is
    ``max_tokens`` unless given. A piece begins ``start`` ids into its example and stands at
    ``offset`` in its sequence, without gaps; every id lies in exactly one piece, and no sequence
    is over a limit. ``cut`` lets examples be cut to fill a sequence; examples beyond the limits
    are cut always. With ``powers_of_two`` a sequence that cannot be filled becomes some whose
    lengths are powers of two, which need no padding.

    Null and empty texts give ``end_id`` alone; repeated rows and ids are examples of their own; a
    null id stays null; an empty table gives no rows. The file at ``tokenizer_path`` is read on the
    driver and sent to the tasks: its size is that of a vocabulary, whatever the data.
    """
    with open(tokenizer_path, encoding="utf-8") as file:
        vocabulary = docs.sparkSession.sparkContext.broadcast(file.read())
    limits = Limits(max_tokens, max_segments, max_loss_tokens or max_tokens)
    names = [text] if response is None else [text, response]
    source = docs.select(
        F.col(key).alias("doc_id"), *[F.col(c).cast("string").alias(f"text_{i}") for i, c in enumerate(names)]
    )
    kind = docs.schema[key].dataType
    key_type = docs.sparkSession.createDataFrame([], docs.select(F.col(key).alias("k")).schema).toArrow().schema[0].type
    return source.mapInArrow(
        _packer(vocabulary, end_id, limits, cut, powers_of_two, key_type),
        f"doc_id {kind.simpleString()}, start bigint, length bigint, doc_tokens bigint, loss_tokens bigint, "
        "sequence_id bigint, offset bigint, ids binary",
    )


def sequences(pieces: DataFrame) -> DataFrame:
    """One row per sequence: sequence_id, n_tokens, n_segments, loss_tokens, ids (all its pieces
    in order), lengths (of the pieces). A group is a sequence, so its size has a limit."""
    ordered = F.array_sort(F.collect_list(F.struct("offset", "length", "ids")))
    joined = pieces.groupBy("sequence_id").agg(
        F.sum("length").alias("n_tokens"),
        F.count("*").alias("n_segments"),
        F.sum("loss_tokens").alias("loss_tokens"),
        ordered.alias("parts"),
    )
    ids = F.aggregate("parts", F.lit(b""), lambda found, part: F.concat(found, part["ids"]))
    lengths = F.col("parts.length")
    return joined.select("sequence_id", "n_tokens", "n_segments", "loss_tokens", ids.alias("ids"), lengths.alias("lengths"))


def padding(pieces: DataFrame, max_tokens: int = MAX_TOKENS) -> DataFrame:
    """One row: n_sequences, n_tokens, n_padding. Sequences are padded to ``max_tokens``, except
    where their length is a power of two."""
    lengths = pieces.groupBy("sequence_id").agg(F.sum("length").alias("n"))
    pad = F.when(F.bit_count("n") == 1, F.lit(0)).otherwise(F.lit(max_tokens) - F.col("n"))
    return lengths.agg(
        F.count("*").alias("n_sequences"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_tokens"),
        F.coalesce(F.sum(pad), F.lit(0)).alias("n_padding"),
    )
