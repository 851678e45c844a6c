"""Array files read by byte ranges: one large JSON array becomes the work of many tasks.

Spark's text reader splits a file at any separator; with ``}`` as the separator a range begins
behind the end of some object, at any depth and perhaps within a string. Two scans make that
exact, without guessing where records begin:

1. Each range is summed up for both cases, beginning outside and inside a string: the change of
   depth, the commas per depth, the lowest depth that a ``]`` reaches. Quotes alternate whatever
   the case, so sums over the ranges of a file, in order, say in which state each range begins.
2. Each range is cut at the commas of depth 1. A record belongs to the range in which it begins;
   what later ranges hold of it (their text up to the first cut) is joined to it.

A task holds about ``CHUNK`` bytes and one record, never a file.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from urllib.parse import unquote

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.sources import storage

#: Bytes that are looked at together.
CHUNK = 1 << 20
#: Ranges of one plan (their states go to all tasks, about 100 bytes each); more make several plans.
MAX_RANGES = 100_000
#: Up to so many bytes of beginnings are broadcast to the records they belong to.
MAX_BROADCAST_BYTES = 32 << 20

_ESCAPED = re.compile(rb"\\.", re.DOTALL)
#: What each byte does to the depth.
_STEP = np.zeros(256, dtype=np.int8)
_STEP[[ord("["), ord("{")]] = 1
_STEP[[ord("]"), ord("}")]] = -1


def _fragments(spark: SparkSession, paths: list[str]) -> DataFrame:
    """path, start (of the range), value: the text between one ``}`` and the next, in order."""
    text = spark.read.option("lineSep", "}").text(paths)
    return text.select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"), "value"
    )


def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], bytes]]:
    """((path, start), bytes) of chunks of whole fragments; a range comes in consecutive chunks.

    Every fragment gets its ``}`` back; the last of a file gets one that it does not have, which
    stands behind the end of the array.
    """
    key, held, size = None, [], 0
    for batch in batches:
        starts = batch.column(1).to_numpy()
        changes = [0, *(np.flatnonzero(np.diff(starts)) + 1).tolist(), len(starts)] if len(starts) else [0]
        for low, high in zip(changes[:-1], changes[1:]):
            paths = batch.column(0)
            for i in range(low, high):
                # Neighbouring ranges of different files can begin at the same place.
                own = key if key and i > low and paths[i] == paths[i - 1] else (paths[i].as_py(), int(starts[i]))
                if own != key or size >= CHUNK:
                    if held:
                        yield key, b"".join(held)
                    key, held, size = own, [], 0
                raw = batch.column(2)[i].as_buffer().to_pybytes()
                held += (raw, b"}")
                size += len(raw) + 1
    if held:
        yield key, b"".join(held)


class Chunk:
    """Bytes with their structure: quotes, brackets and commas that no escape hides."""

    def __init__(self, raw: bytes):
        self.raw = raw
        plain = _ESCAPED.sub(b"__", raw) if b"\\" in raw else raw
        self.bytes = np.frombuffer(plain, dtype=np.uint8)
        self.quotes = np.cumsum(self.bytes == ord('"'), dtype=np.int64)

    @property
    def parity(self) -> int:
        return int(self.quotes[-1]) & 1

    def depths(self, inside: bool) -> tuple[np.ndarray, np.ndarray]:
        """(outside of strings, depth behind each byte relative to the beginning)."""
        outside = (self.quotes & 1) == inside
        return outside, np.cumsum(np.where(outside, _STEP[self.bytes], 0), dtype=np.int64)


def _sum_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per range: path, start, first byte, parity of quotes, and for both cases the change
    of depth, the lowest depth behind a ``]`` and the commas by depth."""
    rows: dict[tuple[str, int], dict] = {}

    def done(key, row) -> pa.RecordBatch:
        case = lambda i: [row["change"][i], row["lowest"][i], [*row["commas"][i].items()]]
        flat = [key[0], key[1], row["first"], row["parity"], *case(0), *case(1)]
        return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(flat, SUMMARY.types)], schema=SUMMARY)

    last = None
    for key, raw in _ranges(batches):
        if key != last and last is not None:
            yield done(last, rows.pop(last))
        last = key
        row = rows.setdefault(
            key, {"first": "", "parity": 0, "change": [0, 0], "lowest": [1 << 40] * 2, "commas": [{}, {}]}
        )
        if not row["first"]:
            row["first"] = raw.lstrip()[:1].decode("latin-1")
        chunk = Chunk(raw)
        for case in (0, 1):
            outside, depth = chunk.depths(bool(case ^ row["parity"]))
            depth += row["change"][case]
            ends = depth[outside & (chunk.bytes == ord("]"))]
            row["lowest"][case] = min(row["lowest"][case], int(ends.min(initial=1 << 40)))
            for d, n in zip(*np.unique(depth[outside & (chunk.bytes == ord(","))], return_counts=True)):
                row["commas"][case][int(d)] = row["commas"][case].get(int(d), 0) + int(n)
            row["change"][case] = int(depth[-1])
        row["parity"] ^= chunk.parity
    if last is not None:
        yield done(last, rows.pop(last))


_COMMAS = pa.map_(pa.int64(), pa.int64())
SUMMARY = pa.schema(
    [
        ("path", pa.string()), ("start", pa.int64()), ("first", pa.string()), ("parity", pa.int64()),
        ("change_0", pa.int64()), ("lowest_0", pa.int64()), ("commas_0", _COMMAS),
        ("change_1", pa.int64()), ("lowest_1", pa.int64()), ("commas_1", _COMMAS),
    ]
)
_SUMMARY_SQL = (
    "path string, start bigint, first string, parity bigint, change_0 bigint, lowest_0 bigint, "
    "commas_0 map<bigint,bigint>, change_1 bigint, lowest_1 bigint, commas_1 map<bigint,bigint>"
)


def states(spark: SparkSession, paths: list[str]) -> DataFrame:
    """One row per range: path, start, first (byte of the file that is no white space), inside (a
    string at its beginning), depth there, position (of the record it begins in or with), ended
    (the array ended before it), ends (it ends here or ended before)."""
    found = _fragments(spark, paths).mapInArrow(_sum_up, _SUMMARY_SQL)
    order = Window.partitionBy("path").orderBy("start")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    upto = order.rowsBetween(Window.unboundedPreceding, 0)

    def so_far(value: Column, window=before) -> Column:
        return F.coalesce(F.sum(value).over(window), F.lit(0))

    inside = found.withColumn("inside", so_far(F.col("parity")) % 2 == 1)
    case = lambda name: F.when(F.col("inside"), F.col(f"{name}_1")).otherwise(F.col(f"{name}_0"))
    deep = inside.select(
        "path", "start", "first", "inside", *[case(n).alias(n) for n in ("change", "lowest", "commas")]
    ).withColumn("depth", so_far(F.col("change")))
    here = F.coalesce(F.element_at("commas", 1 - F.col("depth")), F.lit(0).cast("long"))
    reach = F.col("depth") + F.col("lowest")
    return deep.select(
        "path",
        "start",
        F.first("first").over(order).alias("first"),
        "inside",
        "depth",
        so_far(here).alias("position"),
        F.coalesce(F.min(reach).over(before) <= 0, F.lit(False)).alias("ended"),
        (F.min(reach).over(upto) <= 0).alias("ends"),
    )


def _cut(known: dict[tuple[str, int], tuple[bool, int, int]], beginnings: bool):
    """(path, position, start, text): with ``beginnings`` what each range holds of the record
    that began before it, else the records that begin in it, as far as it goes."""

    def emit(rows: list) -> pa.RecordBatch:
        columns = list(zip(*rows)) or [()] * 4
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)], names=["path", "position", "start", "text"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, []
        inside = depth = position = 0
        first = ended = True
        for key, raw in _ranges(batches):
            if key != last:
                if last and held and first == beginnings:
                    yield emit([(*last[:1], position, last[1], b"".join(held).decode("utf-8", "replace"))])
                last, held = key, []
                ended = key not in known
                inside, depth, position = known.get(key, (False, 0, 0))
                # Of a range that begins within the array, the first cut ends a record of another.
                first = depth > 0
            if ended or beginnings and not first:
                continue
            chunk = Chunk(raw)
            outside, deep = chunk.depths(bool(inside))
            deep += depth
            at = chunk.bytes
            opens = outside & (at == ord("[")) & (deep == 1) if not depth else np.zeros(len(at), bool)
            commas = outside & (at == ord(",")) & (deep == 1)
            ends = outside & (at == ord("]")) & (deep == 0)
            begin, rows = 0, []
            for cut in np.flatnonzero(opens | commas | ends).tolist():
                if opens[cut]:
                    held, begin = [], cut + 1
                    continue
                held.append(raw[begin:cut])
                text = b"".join(held).decode("utf-8", "replace")
                if first == beginnings:
                    # An empty array has no record; anything else between commas must be one.
                    if not (ends[cut] and not text.strip() and position == 0 and not first):
                        rows.append((key[0], position, key[1], text))
                held, begin, first = [], cut + 1, False
                position += 1
                ended = bool(ends[cut])
                if ended or beginnings:
                    break
            if rows:
                yield emit(rows)
            if not ended:
                held.append(raw[begin:])
                inside, depth = inside ^ chunk.parity, int(deep[-1])
        if last and held and not ended and first == beginnings:
            yield emit([(last[0], position, last[1], b"".join(held).decode("utf-8", "replace"))])

    return run


_PIECE = "path string, position bigint, start bigint, text string"


def elements(spark: SparkSession, paths: list[str], strict: bool, whole: Callable[[list[str]], DataFrame]) -> DataFrame:
    """_path, _position, payload: the elements of the array files, as ``whole`` gives them.

    ``whole`` reads files that begin with no ``[``; these cannot be told apart from broken ones by
    ranges. A record that is no JSON, or an array without an end, is an error, or with ``strict``
    off its file is left out. A range without any ``}`` (arrays of plain values) is one fragment.
    """
    parts = []
    for group in _groups(spark, paths):
        ranges = states(spark, group).collect()
        arrays = [r for r in ranges if r["first"] == "["]
        others = sorted({r["path"] for r in ranges if r["first"] != "["})
        if others:
            parts.append(whole([unquote(path) for path in others]))
        last = {}
        for r in arrays:
            last[r["path"]] = max(last.get(r["path"], (-1, False)), (r["start"], r["ends"]))
        open_ended = sorted(path for path, (_, ends) in last.items() if not ends)
        if open_ended and strict:
            raise ValueError(f"Invalid JSON in {open_ended[0]}")
        known = {
            (r["path"], r["start"]): (r["inside"], r["depth"], r["position"])
            for r in arrays
            if not r["ended"] and r["path"] not in set(open_ended)
        }
        if known:
            parts.append(_records(spark, group, known, strict))
    if not parts:
        return spark.createDataFrame([], "_path string, _position int, payload string")
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return found


def _groups(spark: SparkSession, paths: list[str]) -> list[list[str]]:
    """The paths in groups of about MAX_RANGES ranges; a path by itself is never split."""
    largest = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(
        spark.conf.get("spark.sql.files.maxPartitionBytes")
    )
    groups, room = [], 0
    for path in paths:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        size = p.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(p)
        n = size.getFileCount() + size.getLength() // largest
        if not groups or n > room:
            groups.append([])
            room = MAX_RANGES
        groups[-1].append(path)
        room -= n
    return groups


def _records(spark: SparkSession, paths: list[str], known: dict, strict: bool) -> DataFrame:
    fragments = _fragments(spark, paths)
    records = fragments.mapInArrow(_cut(known, False), _PIECE)
    later = fragments.mapInArrow(_cut(known, True), _PIECE).filter("text <> ''")
    pieces = F.array_sort(F.collect_list(F.struct("start", "text")))
    rest = later.groupBy(F.col("path").alias("r_path"), F.col("position").alias("r_position")).agg(
        F.array_join(F.transform(pieces, lambda x: x["text"]), "").alias("rest")
    )
    if len(known) > 1:
        # At most a row per range; stored, for it is measured and joined.
        aside = storage.workspace(spark, "ranges")
        rest.write.parquet(aside)
        rest = spark.read.schema(rest.schema).parquet(aside)
        size = rest.agg(F.sum(F.length("rest"))).first()[0] or 0
        small = F.broadcast(rest) if size <= MAX_BROADCAST_BYTES else rest
        whole = records.join(
            small, (F.col("path") == F.col("r_path")) & (F.col("position") == F.col("r_position")), "left"
        ).select("path", "position", F.concat("text", F.coalesce("rest", F.lit(""))).alias("text"))
    else:
        whole = records.select("path", "position", "text")
    # Parsed as the one element of an array, so that it reads as it does in its own.
    parsed = F.from_json(F.concat(F.lit("["), "text", F.lit("]")), "array<string>").alias("one")
    found = whole.select("path", "position", parsed)
    broken = F.col("one").isNull() | (F.size("one") != 1)
    if strict:
        reason = F.concat(F.lit("Invalid JSON in "), F.col("path"))
        found = found.withColumn("one", F.when(broken, F.raise_error(reason)).otherwise(F.col("one")))
    else:
        bad = found.filter(broken).select(F.col("path").alias("b_path")).distinct()
        found = found.join(bad, F.col("path") == F.col("b_path"), "left_anti")
    return found.select(
        F.col("path").alias("_path"),
        F.col("position").cast("int").alias("_position"),
        F.element_at("one", 1).alias("payload"),
    )
