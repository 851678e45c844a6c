"""Language identification by cross-parsing against suffix automata.

For each language a suffix automaton of labelled text is built. A text is parsed greedily into
the longest phrases that occur in that text; each phrase costs log2 of the size of the labelled
text, and the language that needs the fewest bits per letter wins. The automata are small and
of bounded size, so they go to every task; texts are read where they lie, without a shuffle.
"""

from __future__ import annotations

import math
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.shared import single_column, text_blocks

UNDETERMINED = "und"

#: Phrases end at every SEGMENT-th character of a normalised text, for all languages alike:
#: the segments are parsed side by side.
SEGMENT = 128

#: Text parsed together in a task.
BLOCK_BYTES = 1 << 19

#: The sample of labelled texts per language: at most so many rows, and of them, in the order of
#: their hashes, those that fit into so many characters. A longer text gives an excerpt.
SAMPLE_ROWS, SAMPLE_CHARS = 200, 20_000

#: Characters that a text of more than SAMPLE_CHARS gives, from its first letter on.
EXCERPT_CHARS = 2_000

#: Letters with a column of their own in the table, the most frequent of the sample; the moves by
#: the other letters of the sample stand in a sorted list.
LETTERS = 62


@dataclass
class LanguageModel:
    """``table[state + code]`` holds twice the next state plus 1 where a phrase ends before this
    character. States count in steps of ``width``; ``roots`` are those of the languages. Codes from
    ``width - 1`` on are of rare letters: ``rare_keys`` (state times ``n_codes`` plus code, sorted)
    has their moves, to the states ``rare_targets``."""

    languages: list[str]
    codes: np.ndarray
    table: np.ndarray
    roots: np.ndarray
    bits: np.ndarray
    width: int
    n_codes: int
    rare_keys: np.ndarray
    rare_targets: np.ndarray

    def moves(self, state: np.ndarray, code: np.ndarray) -> np.ndarray:
        """Entries as in ``table`` for states (a row for each language) and codes."""
        found = self.table[state + np.minimum(code, self.width - 1)]
        rare = np.flatnonzero(code >= self.width - 1)
        if len(rare) and len(self.rare_keys):
            numbers = code[rare].astype(np.int64)
            target, known = self._rare(state[:, rare], numbers)
            roots = np.broadcast_to(self.roots[:, None], target.shape)
            again, from_root = self._rare(roots, numbers)
            target = np.where(known, target, np.where(from_root, again, roots))
            found[:, rare] = target * 2 + ~known
        return found

    def _rare(self, state: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = state.astype(np.int64) * self.n_codes + code
        at = np.minimum(np.searchsorted(self.rare_keys, key), len(self.rare_keys) - 1)
        return self.rare_targets[at], self.rare_keys[at] == key


def letter_table() -> np.ndarray:
    """The lower-case letter of every code point, 0 where it is no letter."""
    out = np.zeros(0x110000, dtype=np.int32)
    for point in range(0x110000):
        char = chr(point)
        if char.isalpha() or unicodedata.category(char) in ("Mn", "Mc"):
            low = char.lower()
            out[point] = ord(low) if len(low) == 1 else point
    return out


def _automaton(codes: list[int]) -> list[dict[int, int]]:
    """Transitions of the suffix automaton of the codes, by state; three for a code at most."""
    nexts: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in codes:
        current = len(nexts)
        nexts.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p != -1 and c not in nexts[p]:
            nexts[p][c] = current
            p = link[p]
        if p != -1:
            q = nexts[p][c]
            if length[q] == length[p] + 1:
                link[current] = q
            else:
                clone = len(nexts)
                nexts.append(dict(nexts[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p != -1 and nexts[p].get(c) == q:
                    nexts[p][c] = clone
                    p = link[p]
                link[q] = link[current] = clone
        last = current
    return nexts


def build_model(samples: dict[str, list[str]]) -> LanguageModel:
    """The automata of the sampled texts; languages in the given order (ties go to the first)."""
    letters = letter_table()
    points = {lang: [_letters(t, letters) for t in texts] for lang, texts in samples.items()}
    everything = np.concatenate([p for ps in points.values() for p in ps] or [np.zeros(0, np.int32)])
    kinds, counts = np.unique(everything[everything > 0], return_counts=True)
    ordered = kinds[np.lexsort((kinds, -counts))]
    width = min(len(ordered), LETTERS) + 2
    # 0: between words, then the letters by frequency; the last: a letter that the sample has not.
    n_codes = len(ordered) + 2
    codes_of = np.full(0x110000, n_codes - 1, dtype=np.uint8 if n_codes <= 256 else np.uint16 if n_codes <= 65_536 else np.int32)
    codes_of[letters == 0] = 0
    own = np.zeros(0x110000, dtype=codes_of.dtype)
    own[ordered] = np.arange(1, len(ordered) + 1)
    mapped = own[letters]
    codes_of[mapped > 0] = mapped[mapped > 0]

    tables, roots, bits, base = [], [], [], 0
    keys, targets = [], []
    for lang in samples:
        text: list[int] = []
        for p in points[lang]:
            text += [0, *codes_of[p].tolist()]
        text.append(0)
        nexts = _automaton(text)
        n = len(nexts)
        moves = np.full((n, width), -1, dtype=np.int64)
        for state, by_code in enumerate(nexts):
            for c, target in by_code.items():
                if c < width - 1:
                    moves[state, c] = target
                else:
                    keys.append((base + state) * width * n_codes + c)
                    targets.append((base + target) * width)
        fallback = np.where(moves[0] >= 0, moves[0], 0)
        ends = moves < 0
        target = np.where(ends, fallback[None, :], moves)
        tables.append(((base + target) * width) * 2 + ends)
        roots.append(base * width)
        bits.append(math.log2(max(2, len(text))))
        base += n
    whole = np.concatenate(tables) if tables else np.zeros((1, width), np.int64)
    kind = np.int32 if whole.max(initial=0) < 2**31 else np.int64
    rare_keys = np.array(keys, dtype=np.int64)
    order = np.argsort(rare_keys)
    return LanguageModel(
        list(samples), codes_of, whole.astype(kind).ravel(), np.array(roots, dtype=kind), np.array(bits),
        width, n_codes, rare_keys[order], np.array(targets, dtype=kind)[order],
    )


def _letters(text: str, letters: np.ndarray) -> np.ndarray:
    """The code points of the text as letters, runs of others as one 0."""
    low = letters[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)]
    keep = np.ones(len(low), dtype=bool)
    keep[1:] = (low[1:] != 0) | (low[:-1] != 0)
    return low[keep]


def count_phrases(model: LanguageModel, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(phrases per text and language, letters per text)."""
    # A separator stands before each text, the first too, and takes in what is no letter after it.
    points = np.frombuffer("\x00".join(["", *texts]).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    starts = 1 + np.concatenate(([0], np.cumsum(lengths + 1)[:-1]))
    codes = model.codes[points]
    keep = np.ones(len(codes), dtype=bool)
    keep[1:] = (codes[1:] != 0) | (codes[:-1] != 0)
    kept_before = np.concatenate(([0], np.cumsum(keep)))
    codes = codes[keep]
    begin = kept_before[starts]
    size = kept_before[starts + lengths] - begin
    n_letters = np.add.reduceat(np.concatenate((codes != 0, [False])).astype(np.int64), begin)
    n_letters[size == 0] = 0

    per_text = -(-size // SEGMENT)
    owner = np.repeat(np.arange(len(texts)), per_text)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(per_text) - per_text, per_text)
    at = begin[owner] + nth * SEGMENT
    left = np.minimum(SEGMENT, size[owner] - nth * SEGMENT)
    order = np.argsort(-left, kind="stable")
    at, left, owner = at[order], left[order], owner[order]

    n_langs = len(model.languages)
    state = np.repeat(model.roots[:, None], len(at), axis=1)
    ended = np.ones((n_langs, len(at)), dtype=np.int32)
    for step in range(int(left[0]) if len(left) else 0):
        live = int(np.searchsorted(-left, -step, side="left"))
        found = model.moves(state[:, :live], codes[at[:live] + step])
        ended[:, :live] += found & 1
        state[:, :live] = found >> 1
    phrases = np.zeros((len(texts), n_langs))
    for i in range(n_langs):
        phrases[:, i] = np.bincount(owner, weights=ended[i], minlength=len(texts))
    return phrases, n_letters


def _predictor(model, text_at: int, n_kept: int):
    """Of batches with the text in column ``text_at`` and, in the last, whether it has a letter: the
    first ``n_kept`` columns, the language and the score, one batch for each block of texts."""

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = model.value
        names = np.array([*known.languages, UNDETERMINED], dtype=object)
        for batch in batches:
            lettered = batch.column(batch.num_columns - 1).to_pylist()
            for start, stop, block in text_blocks(batch.column(text_at), BLOCK_BYTES):
                texts = [
                    raw.decode("utf-8", "surrogatepass") if has else "" for raw, has in zip(block, lettered[start:stop])
                ]
                phrases, n_letters = count_phrases(known, texts)
                bits = phrases * known.bits[None, :]
                best = bits.argmin(axis=1)
                low = bits[np.arange(len(bits)), best]
                rest = bits.copy()
                rest[np.arange(len(bits)), best] = np.inf
                second = rest.min(axis=1)
                with np.errstate(invalid="ignore", divide="ignore"):
                    score = np.where(np.isinf(second), 1.0, second / (low + second))
                none = n_letters == 0
                langs = names[np.where(none, len(known.languages), best)].tolist()
                scores = np.where(none, 0.0, score)
                rows = batch.slice(start, stop - start)
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns[:n_kept], pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                    names=[*batch.schema.names[:n_kept], "lang_pred", "score"],
                )

    return predict


def sample_texts(
    labelled: DataFrame, text: str, lang: str, rows: int = SAMPLE_ROWS, chars: int = SAMPLE_CHARS
) -> dict[str, list[str]]:
    """Texts for the automata: for each language at most ``rows`` of its texts, those of the
    smallest hashes, and of them those that fit into ``chars``. Texts without a letter are left
    out; of a text of more than ``chars`` characters an excerpt counts, the EXCERPT_CHARS from its
    first letter on, so every language with a letter in a labelled text has a sample. Languages by
    how many labelled texts they have, then by name.

    The order comes from the texts alone. Each task sends at most ``rows`` hashes per language.
    """
    named = labelled.select(
        F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text")
    ).filter("lang is not null and text is not null")
    hashed = named.filter(F.col("text").rlike(r"\p{L}")).select("lang", F.xxhash64("text").alias("h"))
    nth = Window.partitionBy("lang").orderBy("h")
    chosen = hashed.withColumn("nth", F.row_number().over(nth)).filter(F.col("nth") <= rows).select("lang", "h")
    counts = {r["lang"]: r["n"] for r in named.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    excerpt = F.substring(F.regexp_replace("text", r"^\P{L}+", ""), 1, min(chars, EXCERPT_CHARS))
    found = (
        named.withColumn("h", F.xxhash64("text"))
        .withColumn("text", F.when(F.length("text") <= chars, F.col("text")).otherwise(excerpt))
        .join(F.broadcast(chosen.distinct()), ["lang", "h"], "left_semi")
        .distinct()
        .collect()
    )
    samples: dict[str, list[str]] = {}
    for name in sorted(counts, key=lambda k: (-counts[k], k)):
        left, texts = chars, []
        for row in sorted((r for r in found if r["lang"] == name), key=lambda r: (r["h"], r["text"])):
            if len(row["text"]) <= left:
                left -= len(row["text"])
                texts.append(row["text"])
        if texts:
            samples[name] = texts
    return samples


def held_out(key: str) -> Column:
    """Every fifth document by the checksum of its id is kept out of the labelled texts."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id") -> LanguageModel:
    """The model of the labelled rows that are not held out."""
    return build_model(sample_texts(docs.filter(~held_out(key)), text, lang))


def predict_language(docs: DataFrame, model: LanguageModel, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``keep``) with lang_pred and score.

    Null texts, texts without a letter and every text under a model without languages give
    ``und`` with score 0. The score is the second-best language's bits over the sum of both
    (0.5: a tie, which the more frequent language wins; 1: the model has one language).
    Columns of ``docs`` named lang_pred or score make way for the new ones.
    """
    columns = [c for c in (docs.columns if keep is None else keep) if c.lower() not in ("lang_pred", "score")]
    if not model.languages:
        return docs.select(*columns, F.lit(UNDETERMINED).alias("lang_pred"), F.lit(0.0).alias("score"))
    body = F.col(text).cast("string")
    flag, own = single_column("_lettered", *columns), single_column("_text", *columns)
    lettered = F.coalesce(body.rlike(r"\p{L}"), F.lit(False)).alias(flag)
    # A text that is kept anyway goes to the tasks once: a second copy doubles their memory.
    whole = text in columns and dict(docs.dtypes)[text] == "string"
    source = docs.select(*columns, *([] if whole else [body.alias(own)]), lettered)
    at = columns.index(text) if whole else len(columns)
    schema = docs.select(*columns).schema.add("lang_pred", "string").add("score", "double")
    sent = docs.sparkSession.sparkContext.broadcast(model)
    return source.mapInArrow(_predictor(sent, at, len(columns)), schema)


def detect_languages(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id") -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row; an empty table gives no rows."""
    model = train(docs, text, lang, key)
    source = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"), held_out(key).alias("held_out"))
    return predict_language(source, model, "text", ["doc_id", "held_out"])
