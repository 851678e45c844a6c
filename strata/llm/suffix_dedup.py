"""Repeated passages by anchors and exact runs of words.

Anchors are minimisers: positions that the text itself selects, at least one in any
``WINDOW + GRAM - 1`` words, and the same ones wherever the passage occurs. A count of the words
at the anchors gives a table of those that repeat. A run of ``MIN_WORDS`` words can only repeat if
all anchors chosen within it do; these runs are grouped by their words, so no occurrence is out of
reach of another, and each run has its keeper among its own occurrences.

Runs are counted by one aggregation that combines before its shuffle, so a passage that very many
documents share costs one row per task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.shared import NOT_SPACE, Words, mixed, rolling, stored, text_blocks

#: Words of the anchors, and how many consecutive ones choose the smallest among them.
GRAM, WINDOW = 8, 24
#: Words that a repeated passage has at least.
MIN_WORDS = 50
#: Changes the word hashes for the second hash of a run.
CHECK = np.uint64(0xA0761D6478BD642F)
FILTER_BITS = 25


def anchors(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """(word position, hash of GRAM words) of the minimisers of a block of texts."""
    grams = rolling(words.hash, GRAM)
    if not len(grams):
        return np.zeros(0, np.int64), grams
    whole = words.text[: len(grams)] == words.text[GRAM - 1 :]
    grams = np.where(whole, grams, np.uint64(2**64 - 1))
    if len(grams) < WINDOW:
        grams_padded = np.concatenate((grams, np.full(WINDOW - len(grams), 2**64 - 1, dtype=np.uint64)))
    else:
        grams_padded = grams
    views = np.lib.stride_tricks.sliding_window_view(grams_padded, WINDOW)
    chosen = np.unique(views.argmin(axis=1) + np.arange(len(views)))
    # Windows that reach into the next text, and texts shorter than a window, still choose.
    chosen = chosen[chosen < len(grams)]
    return chosen[whole[chosen]], grams[chosen[whole[chosen]]]


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, _, block in text_blocks(batch.column(0)):
            _, grams = anchors(Words(block, NOT_SPACE).lower_ascii())
            yield pa.RecordBatch.from_arrays([pa.array(grams.view(np.int64))], names=["gram"])


def candidates(words: Words, bits: np.ndarray, n: int) -> np.ndarray:
    """Positions of the runs of ``n`` words whose anchors all may repeat.

    Only the anchors chosen within the run count: wherever the run occurs, it has the same.
    """
    last = len(words.text) - n
    if last < 0:
        return np.zeros(0, np.int64)
    inside = words.text[: last + 1] == words.text[n - 1 :]
    views = n - (WINDOW + GRAM - 1) + 1
    if views > 0:
        grams = rolling(words.hash, GRAM)
        whole = words.text[: len(grams)] == words.text[GRAM - 1 :]
        grams = np.where(whole, grams, np.uint64(2**64 - 1))
        smallest = np.lib.stride_tricks.sliding_window_view(grams, WINDOW).min(axis=1)
        low = smallest & np.uint64((1 << FILTER_BITS) - 1)
        known = (bits[(low >> np.uint64(3)).astype(np.int64)] >> (low & np.uint64(7)).astype(np.uint8)) & 1
        upto = np.concatenate(([0], np.cumsum(known, dtype=np.int64)))
        inside &= (upto[views:] - upto[:-views])[: last + 1] == views
    return np.flatnonzero(inside)


def _runs(sent, n: int):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(id, row, text) -> (run, check, id, row, at) of the runs of words that may repeat; run
        and check are 96 bits of hashes of the words."""
        for batch in batches:
            for start, _, block in text_blocks(batch.column(2)):
                words = Words(block, NOT_SPACE).lower_ascii()
                at = candidates(words, sent.value, n)
                if not len(at):
                    continue
                run = rolling(words.hash, n)[at]
                check = (rolling(mixed(words.hash ^ CHECK), n)[at] >> np.uint64(32)).astype(np.uint32)
                first = np.concatenate(([0], np.cumsum(words.counts)))
                text = words.text[at]
                rows = pa.array(text + start)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(run.view(np.int64)),
                        pa.array(check.view(np.int32)),
                        batch.column(0).take(rows),
                        batch.column(1).take(rows),
                        pa.array((at - first[text]).astype(np.int32)),
                    ],
                    names=["run", "check", "doc_id", "row", "at"],
                )

    return emit


def shared_words(one: bytes, other: bytes) -> int:
    """Words that both begin with; four bytes each."""
    n = min(len(one), len(other)) // 4
    if one[: 4 * n] == other[: 4 * n]:
        return n
    low, high = 0, n
    while low < high:
        middle = (low + high + 1) // 2
        if one[: 4 * middle] == other[: 4 * middle]:
            low = middle
        else:
            high = middle - 1
    return low


def _bit_table(grams: DataFrame) -> np.ndarray:
    """2 ** FILTER_BITS bits, set for the low bits of the hashes: a fixed size for any input."""
    at = F.col("gram").bitwiseAND(F.lit((1 << FILTER_BITS) - 1))
    words = (
        grams.select(at.alias("at"))
        .groupBy(F.shiftright("at", 5).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(at & 31 as int))")).alias("bits"))
        .toArrow()
    )
    table = np.zeros(1 << (FILTER_BITS - 5), dtype=np.uint32)
    table[words.column("word").to_numpy()] = words.column("bits").to_numpy().astype(np.uint32)
    return table.view(np.uint8)


def candidate_runs(docs: DataFrame, min_words: int, text: str, key: str) -> DataFrame:
    """run, check, doc_id, row, at of the runs of ``min_words`` words that may repeat."""
    kind = docs.schema[key].dataType.simpleString()
    body = F.col(text).cast("string").alias("text")
    several = (
        docs.select(body).mapInArrow(_hashes, "gram bigint").groupBy("gram").count().filter("count > 1").select("gram")
    )
    sent = docs.sparkSession.sparkContext.broadcast(_bit_table(several))
    source = docs.select(F.col(key).alias("doc_id"), F.monotonically_increasing_id().alias("row"), body)
    return source.mapInArrow(
        _runs(sent, min_words), f"run bigint, check int, doc_id {kind}, row bigint, at int"
    )


def repeated_passages(
    docs: DataFrame, min_words: int = MIN_WORDS, text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """One row per passage to remove: doc_id, start_word, end_word (words of the text, counted
    from 0, end not included), n_words, keep_id (the document in which its first ``min_words``
    words occur first).

    Words are runs of anything but white space, A-Z as a-z. Every run of ``min_words`` words that
    occurs more than once, in one or several documents, is found; of each run the first occurrence
    (smallest doc_id, null last, then table order, then place) stays and all others go. Overlapping
    runs of a document are one passage. A run that overlaps its own first occurrence loses only
    what lies behind that, so such a passage may have fewer words. Where a kept run overlaps a
    removed one, the words that both hold go, for they stay elsewhere. Null, empty and short texts
    have none; repeated rows are occurrences like others; an empty table gives no rows.
    """
    runs = stored(candidate_runs(docs, min_words, text, key))
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row", "at")
    first = stored(
        runs.groupBy("run", "check").agg(F.count("*").alias("n"), F.min(place).alias("first")).filter("n > 1").drop("n")
    )
    later = runs.join(first, ["run", "check"]).filter((F.col("first.row") != F.col("row")) | (F.col("first.at") != F.col("at")))
    kept_to = F.when(F.col("first.row") == F.col("row"), F.col("first.at") + min_words)
    spans = later.select(
        "doc_id",
        "row",
        F.col("first.doc_id").alias("keep_id"),
        F.greatest(F.col("at"), kept_to).cast("long").alias("start_word"),
        (F.col("at") + min_words).cast("long").alias("end_word"),
    )
    in_text = Window.partitionBy("row").orderBy("start_word", "end_word")
    reach = F.max("end_word").over(in_text.rowsBetween(Window.unboundedPreceding, -1))
    islands = spans.withColumn("new", (reach.isNull() | (F.col("start_word") > reach)).cast("int")).withColumn(
        "island", F.sum("new").over(in_text.rowsBetween(Window.unboundedPreceding, 0))
    )
    return (
        islands.groupBy("row", "island")
        .agg(
            F.min("doc_id").alias("doc_id"),
            F.min("start_word").alias("start_word"),
            F.max("end_word").alias("end_word"),
            F.min(F.struct("start_word", "end_word", "keep_id")).alias("head"),
        )
        .select(
            "doc_id",
            "start_word",
            "end_word",
            (F.col("end_word") - F.col("start_word")).alias("n_words"),
            F.col("head.keep_id").alias("keep_id"),
        )
    )
