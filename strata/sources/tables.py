"""Dated tables, timestamped snapshots and the metrics log.

Every write goes to a staging folder first and is moved into place when complete, so a
lost executor or a failed job leaves the previous data readable and a rerun starts clean.
A date is replaced by two moves; a process that ends between them leaves the old rows in the
staging folder, from where the next read or write puts them back.
"""

from __future__ import annotations

import json
import re
from collections.abc import Mapping, Sequence
from datetime import date as calendar_date
from datetime import datetime
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql.utils import AnalysisException  # noqa: F401

from strata.sources import storage

DATE_COLUMN = "_processing_date"

#: What reading a missing, damaged or foreign table raises, at once or when it runs.
READ_ERRORS = (PySparkException, Py4JJavaError)


def _counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    """Count rows while they are written. The observation sits directly below the writer,
    in the last stage, where each task is counted once even when it is retried."""
    rows = Observation()
    return df.observe(rows, F.count(F.lit(1)).alias("n")), rows


def require_format(spark: SparkSession, fmt: str) -> None:
    """An error that names what is missing, before anything is read or written."""
    if fmt != "delta":
        return
    try:
        spark._jvm.org.apache.spark.util.Utils.classForName("io.delta.tables.DeltaTable", True, False)
    except Exception as missing:
        raise ValueError("Table format 'delta' needs the Delta Lake package on the session's class path") from missing


def write_dated(
    df: DataFrame,
    path: str,
    date: str | None = None,
    partition_by: Sequence[str] = (),
    fmt: str = "parquet",
    replace: str = "date",
) -> dict:
    """Write one day of a table partitioned by ``_processing_date`` and ``partition_by``.

    ``replace='date'`` replaces the requested date and each date present in ``df`` as a whole,
    so a rerun leaves no stale rows, also when it has no rows at all. ``replace='cells'`` only
    replaces the partition cells present in ``df``. The date defaults to today; it is requested
    unless ``df`` brings dates of its own and none is given. The columns are stored beside the
    rows, so that a table without rows can be read.

    Rows are rebalanced by the partition columns, so a cell is written by few tasks and
    adaptive execution splits a cell that holds a large share of the rows.
    """
    if replace not in ("date", "cells"):
        raise ValueError(f"replace must be 'date' or 'cells', not {replace!r}")
    require_format(df.sparkSession, fmt)
    requested = date is not None or DATE_COLUMN not in df.columns
    date = date or calendar_date.today().isoformat()
    if DATE_COLUMN not in df.columns:
        df = df.withColumn(DATE_COLUMN, F.lit(date))
    cells = [DATE_COLUMN, *[c for c in partition_by if c != DATE_COLUMN]]
    spread, rows = _counted(df.hint("rebalance", *cells))
    writer = spread.write.format(fmt).partitionBy(*cells)
    if replace == "cells":
        writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").save(path)
    elif fmt == "delta":
        condition = f"{DATE_COLUMN} = '{date}'"
        writer.mode("overwrite").option("replaceWhere", condition).save(path)
    else:
        _replace_dates(df.sparkSession, writer, path, date if requested else None)
    if fmt != "delta":
        _store_schema(df, path, cells)
    return {
        "records_written": rows.get["n"],
        "partitions": cells,
        "processing_date": date,
        "path": path,
    }


RETIRED = "_retired_"
SCHEMA_FILE = "_columns.json"


def _replace_dates(spark: SparkSession, writer, path: str, requested: str | None) -> None:
    restore_dates(spark, path)
    aside, root = storage.staging(path), path.rstrip("/")
    try:
        writer.mode("errorifexists").save(aside)
        new = storage.names(spark, f"{aside}/{DATE_COLUMN}=*")
        gone = [f"{DATE_COLUMN}={requested}"] if requested is not None else []
        for folder in [*new, *(f for f in gone if f not in new)]:
            _swap(spark, root, aside, folder, folder in new)
    finally:
        # After a failure the old rows go back first.
        restore_dates(spark, path)
        storage.delete(spark, aside)


def _swap(spark: SparkSession, root: str, aside: str, folder: str, has_rows: bool) -> None:
    old, retired = f"{root}/{folder}", f"{aside}/{RETIRED}{folder}"
    if storage.exists(spark, old):
        storage.move(spark, old, retired)
    if not has_rows:
        storage.delete(spark, retired)
        return
    try:
        storage.move(spark, f"{aside}/{folder}", old)
    except FileExistsError:
        # A reader found the date between the two moves and put the old rows back.
        storage.move(spark, old, f"{retired}.again")
        storage.move(spark, f"{aside}/{folder}", old)


def restore_dates(spark: SparkSession, path: str) -> None:
    """Puts back the dates whose replacement was broken off between its two moves."""
    root = path.rstrip("/")
    for staged in storage.names(spark, f"{root}/_staging_*"):
        for retired in storage.names(spark, f"{root}/{staged}/{RETIRED}{DATE_COLUMN}=*"):
            place = f"{root}/{retired.removeprefix(RETIRED).removesuffix('.again')}"
            if not storage.exists(spark, place):
                storage.move(spark, f"{root}/{staged}/{retired}", place)


def _store_schema(df: DataFrame, path: str, cells: Sequence[str]) -> None:
    """The table's columns, partition columns last and as text; columns of earlier writes stay."""
    spark, file = df.sparkSession, f"{path.rstrip('/')}/{SCHEMA_FILE}"
    before = storage.read_text(spark, file)
    fields = {f.name: f for f in T.StructType.fromJson(json.loads(before)).fields} if before else {}
    fields |= {f.name: T.StructField(f.name, f.dataType) for f in df.schema.fields}
    names = [*(n for n in fields if n not in cells), *cells]
    kept = [T.StructField(n, T.StringType()) if n in cells else fields[n] for n in names]
    after = T.StructType(kept).json()
    if after != before:
        storage.write_text(spark, file, after)


def read_dated(
    spark: SparkSession,
    path: str,
    date: str | None = None,
    schema: T.StructType | None = None,
    fmt: str = "parquet",
) -> DataFrame:
    """The whole table or one date.

    For one date only that folder is listed, however many dates the table has; a date the
    table lacks gives no rows. Partition columns come back as strings; Spark's type inference
    would turn dates and codes into other types. The columns come from the file that each write
    leaves, so nothing is listed or read to infer them; a table without it is inspected.
    """
    require_format(spark, fmt)
    reader = spark.read.format(fmt)
    if fmt == "delta":
        df = reader.load(path)
        return df if date is None else df.filter(F.col(DATE_COLUMN) == date)
    restore_dates(spark, path)
    known = storage.read_text(spark, f"{path.rstrip('/')}/{SCHEMA_FILE}")
    if known and schema is None:
        schema = T.StructType.fromJson(json.loads(known))
    reader = reader.option("basePath", path)
    location = path if date is None else f"{path.rstrip('/')}/{DATE_COLUMN}={date}"
    if not storage.exists(spark, location):
        if known:
            return spark.createDataFrame([], schema)
        location = path
    if schema is None:
        text = {DATE_COLUMN, *_partition_columns(spark, location)}
        found = reader.load(location).schema.fields
        schema = T.StructType(
            [
                T.StructField(f.name, T.StringType() if f.name in text else f.dataType)
                for f in found
            ]
        )
    df = spark.read.format(fmt).option("basePath", path).schema(schema).load(location)
    return df if date is None else df.filter(F.col(DATE_COLUMN) == date)


def _partition_columns(spark: SparkSession, location: str) -> list[str]:
    """Partition columns below ``location``, read off the folder names of its first branch."""
    columns, branch = [], location.rstrip("/")
    while found := storage.names(spark, f"{branch}/*=*"):
        columns.append(found[0].split("=", 1)[0])
        branch = f"{branch}/{found[0]}"
    return columns


# --- snapshots ---------------------------------------------------------------------------


def write_snapshot(
    df: DataFrame,
    root: str,
    name: str,
    execution_date: str,
    fmt: str = "parquet",
    now: datetime | None = None,
) -> dict:
    """Write a new ``<name>_gold_<date>_<timestamp>`` folder; returns its path and row count."""
    spark, timestamp = df.sparkSession, storage.run_timestamp(now)
    target = f"{root.rstrip('/')}/{name}_gold_{execution_date}_{timestamp}"
    stamped, rows = _counted(
        df.withColumns(
            {"_execution_date": F.lit(execution_date), "_processing_timestamp": F.lit(timestamp)}
        )
    )
    if fmt == "delta":
        stamped.write.format(fmt).mode("errorifexists").save(target)
    else:
        aside = storage.staging(root)
        stamped.write.format(fmt).mode("errorifexists").save(aside)
        storage.move(spark, aside, target)
    return {"path": target, "record_count": rows.get["n"]}


def find_snapshot(
    spark: SparkSession, root: str, name: str, execution_date: str | None = None
) -> str | None:
    """Path of the newest snapshot of a table (of one date, if given), else None."""
    date = re.escape(execution_date) if execution_date else r"\d{4}-\d{2}-\d{2}"
    wanted = re.compile(rf"{re.escape(name)}_gold_{date}_\d{{8}}_\d{{6}}(_\d{{6}})?")
    found = [n for n in storage.names(spark, f"{root.rstrip('/')}/{name}_gold_*") if wanted.fullmatch(n)]
    return f"{root.rstrip('/')}/{max(found)}" if found else None


def read_snapshot(
    spark: SparkSession,
    root: str,
    name: str,
    execution_date: str | None = None,
    fmt: str = "parquet",
) -> DataFrame:
    path = find_snapshot(spark, root, name, execution_date)
    if path is None:
        raise FileNotFoundError(f"No snapshot of '{name}' for date {execution_date or 'any'} in {root}")
    return spark.read.format(fmt).load(path)


def found_snapshots(spark: SparkSession, root: str) -> DataFrame:
    """Distinct ``(dataset, date)`` of the snapshots under ``root``."""
    pattern = re.compile(r"(.+)_gold_(\d{4}-\d{2}-\d{2})_\d{8}_\d{6}(_\d{6})?")
    matches = (pattern.fullmatch(n) for n in storage.names(spark, f"{root.rstrip('/')}/*_gold_*"))
    return spark.createDataFrame(
        sorted({(m.group(1), m.group(2)) for m in matches if m}), "dataset string, date string"
    )


def try_read(spark: SparkSession, path: str, fmt: str = "parquet") -> tuple[DataFrame | None, str]:
    """The table, or None and the reason it cannot be read."""
    try:
        return spark.read.format(fmt).load(path), ""
    except READ_ERRORS as error:
        return None, reason_of(error)


def reason_of(error: Exception) -> str:
    """The innermost reason Spark gives for a failed read, on one line."""
    lines = [line.strip() for line in str(error).splitlines() if line.strip()]
    causes = [line for line in lines if line.startswith("Caused by:")]
    return (causes[-1].removeprefix("Caused by:").strip() if causes else lines[0] if lines else repr(error))[:300]


# --- metrics -----------------------------------------------------------------------------


def append_metrics(
    spark: SparkSession, path: str, metrics: Mapping[str, Any], now: datetime | None = None
) -> None:
    """Append one JSON line with a timestamp. Nested values are stored as JSON objects."""
    event = {**metrics, "timestamp": (now or datetime.now()).isoformat()}
    line = spark.range(0, 1, 1, 1).select(F.lit(json.dumps(event, default=str)).alias("value"))
    line.write.mode("append").text(path)


def read_metrics(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path)
