"""What several operators share: stored intermediates, scans of words in byte buffers, ranks.

Text work inside tasks runs on numpy arrays over blocks of about ``BLOCK_BYTES`` of text, so
memory per task does not depend on the number of rows in an Arrow batch. One text is never cut:
a text longer than a block makes a block of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.sources import storage

BLOCK_BYTES = 1 << 20

#: Odd multipliers; products wrap around at 64 bits.
BYTE_FACTOR = np.uint64(0x9E3779B97F4A7C15)
WORD_FACTOR = np.uint64(0xD6E8FEB86659FD93)
MIX_1 = np.uint64(0xBF58476D1CE4E5B9)
MIX_2 = np.uint64(0x94D049BB133111EB)


def stored(df: DataFrame) -> DataFrame:
    """The frame as a table in the shared folder: its lineage is cut, a lost executor repeats
    nothing before it, and every reader sees the same rows."""
    spark = df.sparkSession
    path = storage.workspace(spark, "llm")
    df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table.stored_at = path
    return table


def reread(table: DataFrame) -> DataFrame:
    """A stored table as a frame of its own, to be joined or grouped with the first."""
    return table.sparkSession.read.schema(table.schema).parquet(table.stored_at)


def discard(*tables: DataFrame) -> None:
    """Deletes tables that nothing reads any more: what was made of them is stored itself."""
    for table in tables:
        storage.delete(table.sparkSession, table.stored_at)


def single_column(name: str, *taken: str) -> str:
    """A column name that none of ``taken`` equals, whatever the case."""
    used = {t.lower() for t in taken}
    while name.lower() in used:
        name += "_"
    return name


def mixed(values: np.ndarray) -> np.ndarray:
    """A well spread 64-bit hash of 64-bit values."""
    values = values ^ (values >> np.uint64(30))
    values = values * MIX_1
    values = values ^ (values >> np.uint64(27))
    values = values * MIX_2
    return values ^ (values >> np.uint64(31))


def _powers(factor: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, factor, dtype=np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


class _Powers:
    """Powers of a factor and of its inverse at 2**64, grown as needed."""

    def __init__(self, factor: np.uint64):
        self.factor = factor
        self.inverse = np.uint64(pow(int(factor), -1, 1 << 64))
        self.up = self.down = np.ones(0, dtype=np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = 1 << max(16, (n - 1).bit_length())
            self.up, self.down = _powers(self.factor, size), _powers(self.inverse, size)
        return self.up[:n], self.down[:n]


byte_powers, word_powers = _Powers(BYTE_FACTOR), _Powers(WORD_FACTOR)


def text_blocks(texts: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int, list[bytes]]]:
    """(first row, row after the last, UTF-8 texts) for runs of rows; null counts as empty."""
    start, size, block = 0, 0, []
    for i, value in enumerate(texts):
        raw = value.as_buffer().to_pybytes() if value.is_valid else b""
        if block and size + len(raw) > limit:
            yield start, i, block
            start, size, block = i, 0, []
        block.append(raw)
        size += len(raw)
    if block:
        yield start, start + len(block), block


class Words:
    """The words of a block of texts: ``text`` holds the index of the text of each word,
    ``start`` and ``end`` its bytes in ``buffer``, ``hash`` its hash, ``counts`` words per text."""

    def __init__(self, texts: list[bytes], is_word: np.ndarray):
        raw = b"\x00".join(texts) + b"\x00"
        self.buffer = np.frombuffer(raw, dtype=np.uint8)
        self.raw = raw
        lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        self.offsets = np.concatenate(([0], np.cumsum(lengths + 1)))
        inside = np.empty(len(raw) + 1, dtype=np.int8)
        inside[0] = 0
        inside[1:] = is_word[self.buffer]
        inside[self.offsets[1:]] = 0
        change = np.flatnonzero(inside[1:] != inside[:-1])
        self.start, self.end = change[0::2], change[1::2]
        self.text = np.searchsorted(self.offsets, self.start, side="right") - 1
        self.counts = np.bincount(self.text, minlength=len(texts))

    def lower_ascii(self) -> "Words":
        """A-Z count as a-z from now on."""
        low = self.buffer.copy()
        low[(low >= 65) & (low <= 90)] += 32
        self.buffer = low
        return self

    @property
    def hash(self) -> np.ndarray:
        up, down = byte_powers.get(len(self.buffer) + 1)
        total = np.zeros(len(self.buffer) + 1, dtype=np.uint64)
        np.cumsum((self.buffer.astype(np.uint64) + np.uint64(1)) * up[:-1], out=total[1:])
        return mixed((total[self.end] - total[self.start]) * down[self.start])

    def word(self, i: int) -> bytes:
        return self.buffer[self.start[i] : self.end[i]].tobytes()


def rolling(hashes: np.ndarray, n: int) -> np.ndarray:
    """The hash of each run of ``n`` consecutive values."""
    if len(hashes) < n:
        return np.zeros(0, dtype=np.uint64)
    up, down = word_powers.get(len(hashes) + 1)
    total = np.zeros(len(hashes) + 1, dtype=np.uint64)
    np.cumsum(hashes * up[:-1], out=total[1:])
    return mixed((total[n:] - total[:-n]) * down[: len(hashes) - n + 1] + np.uint64(n))


def byte_table(*ranges: tuple[int, int]) -> np.ndarray:
    """1 for the bytes in the ranges (both ends included), 0 for the others."""
    table = np.zeros(256, dtype=np.int8)
    for low, high in ranges:
        table[low : high + 1] = 1
    return table


#: Everything but white space, as in `[^\x20\x09-\x0D]+`.
NOT_SPACE = byte_table((0, 8), (14, 31), (33, 255))
#: Letters, digits and everything beyond ASCII.
ALNUM = byte_table((48, 57), (65, 90), (97, 122), (128, 255))


def global_rank(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` with ``rank``: the position, from 0, in the order of the keys over the whole frame.

    A range sort and a sum of the counts of its partitions (as many numbers as partitions); no
    task gets all rows. Rows that agree in all keys share an arbitrary order.
    """
    placed = stored(
        df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn(
            "rank", F.monotonically_increasing_id()
        )
    )
    number, first = single_column("_part", *df.columns), single_column("_first", *df.columns)
    placed_in = placed.withColumn(number, F.shiftright("rank", 33))
    offsets, total = [], 0
    for part, n in sorted(tuple(r) for r in placed_in.groupBy(number).count().collect()):
        offsets.append((part, total))
        total += n
    # As many rows as partitions.
    starts = df.sparkSession.createDataFrame(offsets, f"{number} bigint, {first} bigint")
    within = F.col("rank").bitwiseAND(F.lit((1 << 33) - 1))
    ranked = placed_in.join(F.broadcast(starts), number).withColumn("rank", within + F.col(first))
    return ranked.select(*df.columns, "rank")


def text_hash(text: str) -> Column:
    return F.xxhash64(F.col(text).cast("string"))


def keep_rows(docs: DataFrame, ids: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` named by ``ids`` (doc_id, text_hash), one row for each.

    Rows are named by id and text, so that texts that share an id are told apart; of repeated
    rows one stays, and no more than one of them leaves each task.
    """
    id_, own, other, nth = (single_column(n, *docs.columns) for n in ("_kept_id", "_hash", "_kept_hash", "_nth"))
    wanted = ids.select(F.col("doc_id").alias(id_), F.col("text_hash").alias(other)).distinct()
    found = docs.withColumn(own, text_hash(text)).join(
        wanted, F.col(key).eqNullSafe(F.col(id_)) & (F.col(own) == F.col(other)), "left_semi"
    )
    one = Window.partitionBy(key, own).orderBy(own)
    return found.withColumn(nth, F.row_number().over(one)).filter(F.col(nth) == 1).select(*docs.columns)
