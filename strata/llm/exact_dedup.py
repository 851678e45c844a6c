"""Exact duplicates by content-defined chunk recipes.

Every text is cut where its own content says so, each chunk gets a digest as identifier, and
texts are compared by their ordered lists of identifiers: a long text moves once, as chunks of
which each task sends one copy, and from then on only its recipe moves.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.shared import byte_powers, keep_rows, mixed, stored, text_blocks, text_hash

#: A cut follows a window of WINDOW bytes whose hash ends in CUT_BITS zero bits (1 KB on
#: average); chunks have MIN_CHUNK to MAX_CHUNK bytes, but for the last of a text.
WINDOW, CUT_BITS, MIN_CHUNK, MAX_CHUNK = 16, 10, 256, 1 << 16
DIGEST_BYTES = 16

def normalise(raw: bytes) -> bytes:
    """Every run of white space (space, tab to carriage return) becomes one space."""
    out = b" ".join(raw.split())
    lead, tail = raw[:1].isspace(), raw[-1:].isspace()
    return b" " if lead and not out else (b" " if lead else b"") + out + (b" " if tail else b"")


def cut_points(texts: list[bytes]) -> list[list[int]]:
    """For each text the ends of its chunks, the last being its length; none if empty.

    A cut depends on the bytes before it and on the cut before, so equal texts get equal cuts.
    """
    buffer = np.frombuffer(b"".join(texts), dtype=np.uint8)
    n = len(buffer)
    found = np.zeros(0, dtype=np.int64)
    if n >= WINDOW:
        up, down = byte_powers.get(n + 1)
        total = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum((buffer.astype(np.uint64) + np.uint64(1)) * up[:-1], out=total[1:])
        hashes = mixed((total[WINDOW:] - total[:-WINDOW]) * down[: n - WINDOW + 1])
        found = np.flatnonzero((hashes & np.uint64((1 << CUT_BITS) - 1)) == 0) + WINDOW
    out, start = [], 0
    for text in texts:
        stop = start + len(text)
        first, last = np.searchsorted(found, (start + WINDOW, stop))
        ends, at = [], 0
        for cut in (*(found[first:last] - start).tolist(), len(text)):
            while cut - at > MAX_CHUNK:
                at += MAX_CHUNK
                ends.append(at)
            if cut - at >= MIN_CHUNK or (cut == len(text) and cut > at):
                ends.append(cut)
                at = cut
        out.append(ends)
        start = stop
    return out


def _digest(chunk: bytes) -> bytes:
    return hashlib.blake2b(chunk, digest_size=DIGEST_BYTES).digest()


def _recipes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, shas, recipes = batch.column(batch.num_columns - 1), [], []
        for _, _, block in text_blocks(texts):
            block = [normalise(raw) for raw in block]
            for raw, ends in zip(block, cut_points(block)):
                shas.append(hashlib.sha256(raw).hexdigest())
                recipes.append(b"".join(_digest(raw[a:b]) for a, b in zip([0, *ends], ends)))
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:-1], pa.array(shas, pa.string()), pa.array(recipes, pa.binary())],
            names=[*batch.schema.names[:-1], "text_sha256", "recipe"],
        )


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, _, block in text_blocks(batch.column(0)):
            block = [normalise(raw) for raw in block]
            seen: dict[bytes, bytes] = {}
            clashes: list[tuple[bytes, bytes]] = []
            for raw, ends in zip(block, cut_points(block)):
                for a, b in zip([0, *ends], ends):
                    chunk = raw[a:b]
                    digest = _digest(chunk)
                    if seen.setdefault(digest, chunk) != chunk:
                        clashes.append((digest, chunk))
            pairs = [*seen.items(), *clashes]
            yield pa.RecordBatch.from_arrays(
                [pa.array([p[0] for p in pairs], pa.binary()), pa.array([p[1] for p in pairs], pa.binary())],
                names=["digest", "chunk"],
            )


def recipes(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """doc_id, text_hash (of the text as it is), text_sha256 (of the normalised text) and recipe:
    the chunk digests, in order."""
    kind = docs.schema[key].dataType.simpleString()
    source = docs.select(
        F.col(key).alias("doc_id"), text_hash(text).alias("text_hash"), F.col(text).cast("string").alias("text")
    )
    return source.mapInArrow(_recipes, f"doc_id {kind}, text_hash bigint, text_sha256 string, recipe binary")


def chunk_dictionary(docs: DataFrame, text: str = "text") -> DataFrame:
    """digest, chunk: every distinct chunk of the texts once."""
    chunks = docs.select(F.col(text).cast("string").alias("text")).mapInArrow(
        _chunks, "digest binary, chunk binary"
    )
    return chunks.distinct()


def unverified(dictionary: DataFrame) -> DataFrame:
    """The digests that stand for more than one chunk."""
    return dictionary.groupBy("digest").count().filter("count > 1").select("digest")


def exact_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are identical after every run of white space became one space;
    null counts as empty. Of a group the row with the smallest id stays (null ids last; of
    repeated rows with that id one). Chunk identifiers are verified: a digest that stands for
    two chunks makes the recipes that contain it count with the text's own digest.
    An empty table gives no rows; further columns of the input play no part.
    """
    return _grouped(docs, text, key).drop("text_hash")


def _grouped(docs: DataFrame, text: str, key: str) -> DataFrame:
    rows = stored(recipes(docs, text, key).withColumn("row", F.monotonically_increasing_id()))
    bad = stored(unverified(chunk_dictionary(docs, text)))
    identity = F.col("recipe")
    if not bad.isEmpty():
        parts = F.transform(
            F.sequence(F.lit(0), F.floor(F.length("recipe") / DIGEST_BYTES).cast("int") - 1),
            lambda i: F.substring("recipe", i * DIGEST_BYTES + 1, F.lit(DIGEST_BYTES)),
        )
        used = rows.filter(F.length("recipe") > 0).select("row", F.explode(parts).alias("digest"))
        marked = used.join(bad, "digest", "left_semi").select("row").distinct()
        rows = rows.join(marked.withColumn("marked", F.lit(True)), "row", "left")
        identity = F.when(F.col("marked"), F.concat("recipe", F.to_binary("text_sha256", F.lit("hex")))).otherwise(
            F.col("recipe")
        )
    rows = rows.select("doc_id", "row", "text_hash", "text_sha256", identity.alias("identity"))
    groups = rows.groupBy("identity").agg(
        F.count("*").alias("group_size"),
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("first"),
    )
    # Stored, so that the join can split the rows of a very large group.
    several = stored(groups.filter("group_size > 1"))
    return rows.join(several, "identity", "left").select(
        "doc_id",
        F.when(F.col("first").isNull(), F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        (F.col("first").isNull() | (F.col("first.row") == F.col("row"))).alias("kept"),
        "text_sha256",
        "text_hash",
    )


def drop_exact_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    return keep_rows(docs, _grouped(docs, text, key).filter("kept"), text, key)
