"""Benchmark decontamination by a broadcast set of word windows.

The benchmark's windows of ``n`` consecutive words (the whole item if it is shorter) go to every
task as a sorted table of hashes with the words behind them; tasks slide over the words of their
documents, look window hashes up and compare the words of each hit. Documents are read where
they lie. The table's size is checked: a larger benchmark is looked up in parts of at most
``MAX_WORDS`` words, each document meeting one part after the other, with the same result.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.shared import ALNUM, Words, rolling, single_column, stored, text_blocks

#: Words of the benchmark looked up together, which bounds what is broadcast (about 60 MB).
MAX_WORDS = 2_000_000


class Windows:
    """The windows of benchmark items: per length a sorted table of hashes, the words of each
    window and the items that have it."""

    def __init__(self, items: list[tuple[str | None, str]], n: int):
        found: dict[int, dict[tuple[bytes, ...], set]] = defaultdict(lambda: defaultdict(set))
        for item, text in items:
            words = Words([text.encode("utf-8", "surrogatepass")], ALNUM).lower_ascii()
            row = [words.word(i) for i in range(len(words.start))]
            size = min(n, len(row))
            for i in range(len(row) - size + 1 if row else 0):
                found[size][tuple(row[i : i + size])].add(item)
        self.tables = {}
        for size, windows in found.items():
            texts = list(windows)
            flat = Words([b" ".join(w) for w in texts], ALNUM)
            hashes = rolling(flat.hash, size)[np.concatenate(([0], np.cumsum(flat.counts)))[:-1]]
            order = np.argsort(hashes, kind="stable")
            self.tables[size] = (
                hashes[order],
                [texts[i] for i in order],
                [windows[texts[i]] for i in order],
                _bitmap(hashes),
            )

    def scan(self, texts: list[bytes]) -> tuple[np.ndarray, list[np.ndarray], list[set]]:
        """(words per text, hit words of each text as (start byte, end byte) rows, items)."""
        words = Words(texts, ALNUM).lower_ascii()
        hit = np.zeros(len(words.start), dtype=bool)
        items: list[set] = [set() for _ in texts]
        hashes = words.hash
        for size, (table, windows, owners, bitmap) in self.tables.items():
            runs = rolling(hashes, size)
            whole = words.text[: len(runs)] == words.text[size - 1 :] if len(runs) else np.zeros(0, bool)
            low = runs & np.uint64((1 << BITMAP_BITS) - 1)
            maybe = np.flatnonzero(whole & ((bitmap[(low >> np.uint64(3)).astype(np.int64)] >> (low & np.uint64(7)).astype(np.uint8)) & 1 > 0))
            left = np.searchsorted(table, runs[maybe], side="left")
            for at, k in zip(maybe.tolist(), left.tolist()):
                while k < len(table) and table[k] == runs[at]:
                    if all(words.word(at + i) == w for i, w in enumerate(windows[k])):
                        hit[at : at + size] = True
                        items[words.text[at]] |= owners[k]
                    k += 1
        first = np.concatenate(([0], np.cumsum(words.counts)))
        spans = []
        for i, (a, b) in enumerate(zip(first[:-1], first[1:])):
            own = np.flatnonzero(hit[a:b]) + a
            spans.append(np.stack((words.start[own], words.end[own]), axis=1) - words.offsets[i])
        return words.counts, spans, items


BITMAP_BITS = 22


def _bitmap(hashes: np.ndarray) -> np.ndarray:
    bits = np.zeros(1 << BITMAP_BITS, dtype=bool)
    bits[(hashes & np.uint64((1 << BITMAP_BITS) - 1)).astype(np.int64)] = True
    return np.packbits(bits, bitorder="little")


def _span_lists(spans: list[np.ndarray]) -> pa.Array:
    flat = np.concatenate([*spans, np.zeros((0, 2), np.int64)])
    pairs = pa.StructArray.from_arrays([pa.array(flat[:, 0]), pa.array(flat[:, 1])], names=["start", "end"])
    ends = np.cumsum([0, *map(len, spans)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pairs)


def _scanner(sent):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(..., found so far: spans and items, text) with the spans and items of this part."""
        windows = sent.value
        for batch in batches:
            n_words, spans, items = [], [], []
            for _, _, block in text_blocks(batch.column(batch.num_columns - 1)):
                counts, hits, names = windows.scan(block)
                n_words += counts.tolist()
                spans += hits
                items += [[i for i in s if i is not None] for s in names]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:-1],
                    pa.array(n_words, pa.int64()),
                    _span_lists(spans),
                    pa.array(items, pa.list_(pa.string())),
                ],
                names=[*batch.schema.names[:-1], "n_words", "hit_spans", "hit_items"],
            )

    return scan


def benchmark_parts(benchmark: DataFrame, item: str, text: str, max_words: int):
    """(number of parts, function that fetches one): the distinct items in parts of about
    ``max_words`` words or less. The number of parts follows the benchmark's words."""
    items = benchmark.select(
        F.col(item).cast("string").alias("item"), F.col(text).cast("string").alias("text")
    ).filter("text is not null").distinct()
    # Words are counted from above: no text has more words than half its characters and one.
    sized = stored(items.withColumn("n", F.length("text") / 2 + 1))
    total = sized.agg(F.sum("n")).first()[0] or 0
    n_parts = max(1, -(-int(total) // max_words))
    placed = sized.withColumn("part", F.pmod(F.xxhash64("item", "text"), F.lit(n_parts)))
    def fetch(i: int) -> list[tuple[str | None, str]]:
        return [(r["item"], r["text"]) for r in placed.filter(F.col("part") == i).select("item", "text").collect()]

    return n_parts, fetch


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    n: int = 10,
    text: str = "text",
    item: str = "item_id",
    max_words: int = MAX_WORDS,
    keep: list[str] | None = None,
) -> DataFrame:
    """``docs`` (or its columns ``keep``) with n_words, hit_spans (start and end bytes of the hit
    words in the UTF-8 text) and hit_items (distinct item ids as strings, sorted, without null).

    Words are runs of letters and digits, and of everything beyond ASCII; A-Z count as a-z. A
    window is ``n`` consecutive words of an item, or all of them if they are fewer; a document
    word inside an occurrence of a window is hit. Null and wordless texts have no words and no
    hits; without items nothing is hit. Columns of ``docs`` of these names make way.
    """
    columns = docs.columns if keep is None else keep
    columns = [c for c in columns if c.lower() not in ("n_words", "hit_spans", "hit_items")]
    own = single_column("_text", *docs.columns)
    frame = docs.select(*columns, F.col(text).cast("string").alias(own))
    spans, items, keep = [], [], [*columns]
    n_parts, fetch = benchmark_parts(benchmark, item, "text", max_words)
    for number in range(n_parts):
        sent = docs.sparkSession.sparkContext.broadcast(Windows(fetch(number), n))
        names = [single_column(f"_{x}_{number}", *docs.columns) for x in ("words", "spans", "items")]
        carried = [*keep] if number == n_parts - 1 else [*keep, own]
        source = frame.select(*carried, F.col(own).alias(single_column("_scan", *docs.columns)))
        schema = source.select(*carried).schema
        schema = (
            schema.add("n_words", T.LongType())
            .add("hit_spans", T.ArrayType(T.StructType().add("start", T.LongType()).add("end", T.LongType())))
            .add("hit_items", T.ArrayType(T.StringType()))
        )
        frame = source.mapInArrow(_scanner(sent), schema).withColumnsRenamed(
            dict(zip(("n_words", "hit_spans", "hit_items"), names))
        )
        keep += names
        spans.append(names[1])
        items.append(names[2])
    return frame.select(
        *columns,
        F.col(keep[len(columns)]).alias("n_words"),
        F.array_sort(F.array_distinct(F.flatten(F.array(*spans)))).alias("hit_spans"),
        F.array_sort(F.array_distinct(F.flatten(F.array(*items)))).alias("hit_items"),
    )


def contamination_report(docs: DataFrame, benchmark: DataFrame, n: int = 10) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256 (of the comma-joined ids), contaminated."""
    found = find_contamination(docs, benchmark, n, keep=["doc_id"])
    return found.select(
        "doc_id",
        "n_words",
        F.size("hit_spans").cast("long").alias("n_hit"),
        F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("hit_items", ","), 256).alias("items_sha256"),
        (F.size("hit_spans") > 0).alias("contaminated"),
    )


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(..., text, spans) -> (..., text without the spans)."""
    for batch in batches:
        texts = []
        for value, spans in zip(batch.column(batch.num_columns - 2), batch.column(batch.num_columns - 1)):
            if not value.is_valid or not len(spans):
                texts.append(value.as_py())
                continue
            raw, out, at = value.as_buffer().to_pybytes(), [], 0
            for span in spans.as_py():
                gap = raw[at : span["start"]]
                out.append(gap if at == 0 or any(ALNUM[b] for b in gap) else b"")
                at = span["end"]
            texts.append(b"".join([*out, raw[at:]]).decode("utf-8", "surrogatepass"))
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:-2], pa.array(texts, pa.string())], names=[*batch.schema.names[:-2], "_cleaned"]
        )


def remove_contamination(
    docs: DataFrame, benchmark: DataFrame, n: int = 10, text: str = "text", spans_only: bool = False
) -> DataFrame:
    """``docs`` without its contaminated rows, or with the hit words cut out of their texts."""
    found = find_contamination(docs, benchmark, n, text)
    if not spans_only:
        return found.filter(F.size("hit_spans") == 0).select(*docs.columns)
    others = [c for c in docs.columns if c != text]
    source = found.select(*others, F.col(text), "hit_spans")
    schema = source.select(*others).schema.add("_cleaned", "string")
    return source.mapInArrow(_cut, schema).withColumnRenamed("_cleaned", text).select(*docs.columns)
