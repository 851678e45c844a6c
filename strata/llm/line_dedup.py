"""Repeated lines, clauses or paragraphs: the earliest occurrence stays, the others go.

Passages that documents share often begin and end within lines, so lines can be cut further at
the ends of their clauses. Units are hashed where their text lies; only digests, ranks and offsets move. The earliest
occurrence of each digest comes from an aggregation that combines before its shuffle, so a line
that most documents share costs one row per task.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.shared import single_column, stored, text_hash

#: What separates units.
LINES, PARAGRAPHS = r"\n", r"\n[ \t\r]*\n\s*"
#: Lines, and clauses within them: white space behind a punctuation mark separates too.
CLAUSES = r"\n|(?<=[.!?,;:])[ \t\r\x0b\x0c]+"
#: Words that a run of repeated units has at least, for it to go.
MIN_WORDS = 30

_UPPER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
_WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def units_of(text: str, separator: re.Pattern) -> Iterator[tuple[int, int, int, bytes]]:
    """(start, end, words, digest) of the units that have words; offsets in code points.

    Units are equal by their words: white space and the case of A-Z make no difference.
    """
    at = 0
    for end, following in [*(m.span() for m in separator.finditer(text)), (len(text), len(text))]:
        words = _WORDS.findall(text, at, end)
        if words:
            normal = " ".join(words).translate(_UPPER).encode("utf-8", "surrogatepass")
            yield at, end, len(words), hashlib.blake2b(normal, digest_size=16).digest()
        at = following


def _units(separator: str):
    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(id, text hash, text) -> (id, text hash, array of units)."""
        pattern = re.compile(separator)
        kind = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("words", pa.int32()), ("digest", pa.binary())])
        for batch in batches:
            found, ends = [], [0]
            for text in batch.column(2):
                found += units_of(text.as_py() or "", pattern)
                ends.append(len(found))
            columns = list(zip(*found)) or [()] * 4
            units = pa.StructArray.from_arrays([pa.array(x, t.type) for x, t in zip(columns, kind)], fields=list(kind))
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), units)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), lists], names=["doc_id", "text_hash", "units"]
            )

    return split


def _repeated(docs: DataFrame, separator: str, min_words: int, text: str, key: str) -> DataFrame:
    kind = docs.schema[key].dataType.simpleString()
    source = docs.select(F.col(key).alias("doc_id"), text_hash(text).alias("text_hash"), F.col(text).cast("string").alias("text"))
    split = source.mapInArrow(
        _units(separator),
        f"doc_id {kind}, text_hash bigint, units array<struct<start:int,end:int,words:int,digest:binary>>",
    )
    units = stored(
        split.withColumn("row", F.monotonically_increasing_id()).select(
            "doc_id", "text_hash", "row", F.posexplode("units").alias("unit", "u")
        ).select("doc_id", "text_hash", "row", "unit", "u.*")
    )
    rank = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row", "unit")
    repeated = stored(
        units.groupBy("digest").agg(F.count("*").alias("n"), F.min(rank).alias("first")).filter("n > 1")
    )
    later = units.join(repeated, "digest").filter(
        (F.col("first.row") != F.col("row")) | (F.col("first.unit") != F.col("unit"))
    )
    # A run of repeated units counts as one passage.
    in_text = Window.partitionBy("row").orderBy("unit")
    run = later.withColumn("run", F.col("unit") - F.row_number().over(in_text))
    passage = F.sum("words").over(Window.partitionBy("row", "run"))
    return run.withColumn("passage_words", passage).filter(F.col("passage_words") >= min_words)


def repeated_units(
    docs: DataFrame,
    separator: str = CLAUSES,
    min_words: int = MIN_WORDS,
    text: str = "text",
    key: str = "doc_id",
) -> DataFrame:
    """One row per unit to remove: doc_id, unit (its number among the units with words), start,
    end (code points of the original text), n_words, keep_id, keep_unit (where it stays),
    passage_words (of the run of removed units it stands in).

    Occurrences rank by doc_id (null last), then by the row of the table, then by place in the
    text. All but the first of a digest go, if the run of such units they stand in has
    ``min_words`` words or more; shorter runs stay. Null, empty and wordless texts have no
    units; repeated rows are occurrences like others; an empty table gives no rows.
    """
    return _repeated(docs, separator, min_words, text, key).select(
        "doc_id",
        F.col("unit").cast("long"),
        F.col("start").cast("long"),
        F.col("end").cast("long"),
        F.col("words").cast("long").alias("n_words"),
        F.col("first.doc_id").alias("keep_id"),
        F.col("first.unit").cast("long").alias("keep_unit"),
        F.col("passage_words").cast("long"),
    )


def without(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the spans (start, end), and without what separated them from the rest: the
    line end behind a whole line, the white space behind a part of a line."""
    kept, at = [], 0
    for start, end in sorted(spans):
        kept.append(text[at:start])
        at = max(at, end)
        line_start = not any(kept) or next(k for k in reversed(kept) if k)[-1] == "\n"
        if text[at : at + 1] == "\n":
            at += line_start
        else:
            while at < len(text) and text[at] in " \t\r\x0b\x0c":
                at += 1
    return "".join([*kept, text[at:]])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(..., text, spans) -> (..., spans, text without them)."""
    for batch in batches:
        texts = []
        for text, spans in zip(batch.column(batch.num_columns - 2).to_pylist(), batch.column(batch.num_columns - 1).to_pylist()):
            if text is not None and spans:
                text = without(text, [(span["start"], span["end"]) for span in spans])
            texts.append(text)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:-2], batch.columns[-1], pa.array(texts, pa.string())],
            names=[*batch.schema.names[:-2], batch.schema.names[-1], "_cleaned"],
        )


def drop_repeated_units(
    docs: DataFrame, separator: str = CLAUSES, min_words: int = MIN_WORDS, text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """``docs`` with the repeated units cut out of its texts and ``removed_spans`` (offsets in
    the original texts). Rows that agree in id and text lose the same units."""
    found = _repeated(docs, separator, min_words, text, key)
    id_, own, other = (single_column(n, *docs.columns) for n in ("_id", "_hash", "_other"))
    spans = stored(
        found.groupBy(F.col("doc_id").alias(id_), F.col("text_hash").alias(other)).agg(
            F.array_sort(F.collect_set(F.struct("start", "end"))).alias("removed_spans")
        )
    )
    others = [c for c in docs.columns if c != text and c.lower() != "removed_spans"]
    source = (
        docs.withColumn(own, text_hash(text))
        .join(spans, F.col(key).eqNullSafe(F.col(id_)) & (F.col(own) == F.col(other)), "left")
        .select(*others, F.col(text).cast("string").alias(text), spans["removed_spans"])
    )
    schema = source.select(*others, "removed_spans").schema.add("_cleaned", T.StringType())
    return source.mapInArrow(_cut, schema).withColumnRenamed("_cleaned", text)
