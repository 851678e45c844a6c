"""Landed raw records: immutable runs named
``<dataset>_bronze_<source>_<date>_<yyyyMMdd_HHmmss[_ffffff]>``.

Two layouts, told apart by extension:

* ``.json``: a file (or a folder of files) that each hold one JSON *array* of records, as
  fetchers write them. One file is one task, unless ``split_arrays`` has large files read by
  ranges.
* ``.jsonl``: a folder of text files with one record per line, as ``append_records`` writes
  them. These split at any line.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from strata.functions.text import is_json
from strata.operators.dedup import keep_latest
from strata.sources import arrays, storage

RUN_PATTERN = r"(.+?)_bronze_(.+)_(\d{4}-\d{2}-\d{2})_(\d{8})_(\d{6})(?:_(\d{6}))?\.jsonl?"

# JSON text of values that count as an empty record.
EMPTY_RECORDS = ("", "{}", "[]", "null", "false", "0", "0.0", "-0", "-0.0")


# About 100 bytes a run.
MAX_BROADCAST_RUNS = 100_000

# What a parser must pass through for the newest record to be told apart.
RUN_COLUMNS = ("_ingest_ts", "_position", "_record_hash")


def latest_first() -> list[Column]:
    """Order for ``keep_latest``: newest run, then last position in its file. Lines of a
    split folder have no position; the record's hash then makes the order total."""
    return [F.desc("_ingest_ts"), F.desc_nulls_last("_position"), F.desc("_record_hash")]


def envelope(df: DataFrame, source: str, ingestion_date: str) -> DataFrame:
    """Wrap each row as ``(_ingest_ts, _source, _ingestion_date, payload)``."""
    return df.select(
        F.current_timestamp().alias("_ingest_ts"),
        F.lit(source).alias("_source"),
        F.lit(ingestion_date).alias("_ingestion_date"),
        as_json(df).alias("payload"),
    )


def as_json(df: DataFrame) -> Column:
    """Whole row as JSON text, keeping nulls and microseconds."""
    options = {
        "ignoreNullFields": "false",
        "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
        "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    }
    return F.to_json(F.struct(*[F.col(c) for c in df.columns]), options)


def append_records(
    df: DataFrame,
    landing: str,
    dataset: str,
    execution_date: str,
    source: str = "api",
    now: datetime | None = None,
) -> dict:
    """Land a new run. Runs are never overwritten; an empty input is an error.

    The run is written aside and moved into place when complete, so readers never see half
    of it.
    """
    spark = df.sparkSession
    run = f"{dataset}_bronze_{source}_{execution_date}_{storage.run_timestamp(now)}.jsonl"
    target, aside = f"{landing.rstrip('/')}/{run}", storage.staging(landing)
    rows = Observation()
    lines = df.select(as_json(df).alias("value")).observe(rows, F.count(F.lit(1)).alias("n"))
    lines.write.mode("errorifexists").text(aside)
    written = rows.get["n"]
    if not written:
        storage.delete(spark, aside)
        raise ValueError("Cannot land an empty set of records")
    storage.move(spark, aside, target)
    return {"path": target, "record_count": written}


def runs(
    spark: SparkSession,
    landing: str,
    date: str | None = None,
    source: str | None = None,
    dataset: str | None = None,
) -> list[Run]:
    """The runs of one date, source and dataset (None: of all). Only names that can match are
    listed, so a scan of one date does not fetch the names of all dates."""
    if not storage.exists(spark, landing):
        raise FileNotFoundError(f"Landing folder does not exist: {landing}")
    known = [x if x and re.fullmatch(r"[\w.-]+", x) else "*" for x in (dataset, source, date)]
    names = storage.names(spark, "{}/{}_bronze_{}_{}_*.json*".format(landing.rstrip("/"), *known))
    every = [run for run in map(Run.named, names) if run]
    found = [
        r
        for r in every
        if date in (None, r.date) and source in (None, r.source) and dataset in (None, r.dataset)
    ]
    if not found:
        raise FileNotFoundError(f"No landed data for {date or 'any date'} in {landing}")
    return found


def _paths_of(landing: str, found: list[Run]) -> dict[str, list[str]]:
    """Per layout, the paths of the runs."""
    paths = {e: [f"{landing.rstrip('/')}/{r.name}" for r in found if r.name.endswith(e)] for e in (".json", ".jsonl")}
    return {extension: some for extension, some in paths.items() if some}


def _text(spark: SparkSession, paths: list[str], whole: bool) -> DataFrame:
    """The raw text of files or lines with its file path."""
    return spark.read.text(paths, wholetext=whole).select("value", F.col("_metadata.file_path").alias("_path"))


def _text_of(spark: SparkSession, landing: str, found: list[Run]) -> dict[str, DataFrame]:
    """Per layout, the raw text of the runs."""
    return {e: _text(spark, paths, e == ".json") for e, paths in _paths_of(landing, found).items()}


@dataclass(frozen=True)
class Run:
    """What the name of a run says about it."""

    name: str
    dataset: str
    source: str
    date: str
    landed_at: datetime

    @classmethod
    def named(cls, name: str) -> Run | None:
        match = re.fullmatch(RUN_PATTERN, name)
        if match is None:
            return None
        dataset, source, date, day, time, micros = match.groups()
        landed_at = datetime.strptime(f"{day}{time}{micros or '000000'}", "%Y%m%d%H%M%S%f")
        return cls(name, dataset, source, date, landed_at)


def _with_run(spark: SparkSession, records: DataFrame, landing: str, found: list[Run]) -> DataFrame:
    """Add the run columns: one hash lookup per record instead of several regular
    expressions. The table has a row per run, so it is broadcast while it has few rows."""
    root = storage.url_path(spark, landing).rstrip("/") + "/"
    name = F.substring_index(F.substring_index("_path", root, -1), "/", 1)
    known = pa.table(
        {
            "_run": [r.name for r in found],
            "_landed_at": [r.landed_at.isoformat(sep=" ") for r in found],
            "_source": [r.source for r in found],
            "_ingestion_date": [r.date for r in found],
        }
    )
    described = spark.createDataFrame(known).withColumn(
        "_ingest_ts", F.col("_landed_at").cast("timestamp")
    )
    if len(found) <= MAX_BROADCAST_RUNS:
        described = F.broadcast(described)
    return records.withColumn("_run", name).join(described, "_run", "left")


def _elements(text: DataFrame, strict: bool) -> DataFrame:
    """``_path`` and the elements of each array file as JSON text; null if not an array.

    The parsed column is made first, so that the test and the explode share one parse.
    """
    parsed = text.select("value", "_path", F.from_json("value", "array<string>").alias("_elements"))
    if not strict:
        return parsed.select("_path", "_elements")
    broken = F.col("_elements").isNull() & ~is_json(F.col("value"))
    reason = F.concat(F.lit("Invalid JSON in "), F.col("_path"))
    checked = F.when(broken, F.raise_error(reason)).otherwise(F.col("_elements"))
    return parsed.select("_path", checked.alias("_elements"))


def _lines(text: DataFrame, strict: bool) -> DataFrame:
    """The lines that hold something; broken ones raise an error or are left out."""
    lines = text.filter(F.trim("value") != "")
    broken = F.try_parse_json(F.col("value")).isNull()
    if not strict:
        return lines.filter(~broken)
    reason = F.concat(F.lit("Invalid JSON line in "), F.col("_path"))
    return lines.withColumn("value", F.when(broken, F.raise_error(reason)).otherwise(F.col("value")))


def scan(
    spark: SparkSession,
    landing: str,
    date: str | None = None,
    source: str | None = None,
    on_invalid: str = "raise",
    dataset: str | None = None,
    split_arrays: bool = False,
) -> DataFrame:
    """Records of every run of a date as ``payload`` plus run columns.

    All reruns of the date are read together. Array files that are valid JSON but not an
    array are skipped (``inventory`` reports them). A file or line that is no JSON is an error;
    with ``on_invalid='skip'`` it is left out. Text after the end of an array is only reported
    by ``inventory``, which parses more thoroughly.

    With ``split_arrays`` array files are read by byte ranges of
    ``spark.sql.files.maxPartitionBytes``: the same rows, but many tasks share a large file and
    none holds more of it than a record. It scans the files three times, so it is for files
    that are too large for one task.
    """
    if on_invalid not in ("raise", "skip"):
        raise ValueError(f"on_invalid must be 'raise' or 'skip', not {on_invalid!r}")
    strict = on_invalid == "raise"

    def whole_arrays(paths: list[str]) -> DataFrame:
        # The outer form, with its empty rows dropped after: for the plain form Spark
        # infers a filter on the array and would parse every file again to test it.
        return (
            _elements(_text(spark, paths, True), strict)
            .select("_path", F.posexplode_outer("_elements").alias("_position", "payload"))
            .filter(F.col("_position").isNotNull())
        )

    found, parts = runs(spark, landing, date, source, dataset), []
    for extension, paths in _paths_of(landing, found).items():
        if extension == ".json":
            records = arrays.elements(spark, paths, strict, whole_arrays) if split_arrays else whole_arrays(paths)
        else:
            records = _lines(_text(spark, paths, False), strict).select(
                "_path", F.lit(None).cast("int").alias("_position"), F.col("value").alias("payload")
            )
        parts.append(records)
    return _with_run(spark, reduce(DataFrame.unionByName, parts), landing, found).select(
        "payload",
        "_ingest_ts",
        "_source",
        "_ingestion_date",
        "_position",
        F.xxhash64("payload").alias("_record_hash"),
    )


def load_latest(
    spark: SparkSession,
    landing: str,
    date: str,
    key: str,
    parser: Callable[[DataFrame], DataFrame],
    source: str | None = None,
    normalize_key: bool = False,
    dataset: str | None = None,
    counts: Observation | None = None,
    split_arrays: bool = False,
) -> DataFrame:
    """Landed records of a date through ``parser``, newest record per ``key``.

    ``parser`` turns ``payload`` into columns and keeps ``RUN_COLUMNS``. Records without a key
    count as one key; ``counts`` observes how many records were read and how many lack the key
    (``records_read``, ``null_keys``).
    """
    parsed = scan(spark, landing, date, source, dataset=dataset, split_arrays=split_arrays).transform(parser)
    if counts is not None:
        parsed = parsed.observe(
            counts,
            F.count(F.lit(1)).alias("records_read"),
            F.count_if(F.col(key).isNull()).alias("null_keys"),
        )
    latest = keep_latest(parsed, key, latest_first(), normalize_key)
    return latest.drop("_position", "_record_hash")


def _is_empty(record: Column) -> Column:
    return record.isNull() | F.trim(record).isin(*EMPTY_RECORDS)


def inventory(
    spark: SparkSession,
    landing: str,
    date: str | None = None,
    source: str | None = None,
    dataset: str | None = None,
) -> DataFrame:
    """``(path, valid, is_array, records, empty_records)`` per array file or per record line."""
    found, parts = runs(spark, landing, date, source, dataset), []
    for extension, text in _text_of(spark, landing, found).items():
        path = F.col("_path").alias("path")
        if extension == ".json":
            valid = text.select("value", path, is_json(F.col("value")).alias("valid"))
            elements = F.when(F.col("valid"), F.from_json("value", "array<string>"))
            empty = F.array_size(F.filter("_elements", _is_empty))
            parts.append(
                valid.select("path", "valid", elements.alias("_elements")).select(
                    "path",
                    "valid",
                    F.col("_elements").isNotNull().alias("is_array"),
                    F.coalesce(F.array_size("_elements"), F.lit(0)).alias("records"),
                    F.coalesce(empty, F.lit(0)).alias("empty_records"),
                )
            )
        else:
            parts.append(
                text.filter(F.trim("value") != "").select(
                    path,
                    is_json(F.col("value")).alias("valid"),
                    F.lit(True).alias("is_array"),
                    F.lit(1).alias("records"),
                    _is_empty(F.col("value")).cast("int").alias("empty_records"),
                )
            )
    return reduce(DataFrame.unionByName, parts)


def found_runs(spark: SparkSession, landing: str) -> DataFrame:
    """Distinct ``(dataset, date)`` of the runs that landed."""
    try:
        pairs = sorted({(r.dataset, r.date) for r in runs(spark, landing)})
    except FileNotFoundError:
        pairs = []
    return spark.createDataFrame(pairs, "dataset string, date string")


def landed_dates(files: DataFrame, dataset: str | None = None, source: str | None = None) -> DataFrame:
    """Distinct dates of the runs (of a dataset and source) that files with a ``path`` are of."""
    pattern = f"/([^/]+?){RUN_PATTERN[len('(.+?)'):]}(?:/|$)"
    part = {n: F.regexp_extract("path", pattern, i) for i, n in ((1, "dataset"), (2, "source"), (3, "date"))}
    found = files.select(*[c.alias(n) for n, c in part.items()]).filter("date <> ''")
    for name, wanted in (("dataset", dataset), ("source", source)):
        if wanted is not None:
            found = found.filter(F.col(name) == wanted)
    return found.select("date").distinct()
