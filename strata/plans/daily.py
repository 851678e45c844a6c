"""One day of a dataset: landed records -> silver table -> gold snapshots, checked in between.

A plain function; scheduling, retries and fetching stay outside.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from strata.operators import alerts, checks, conform, rollup
from strata.operators.parse import parse_payload
from strata.plans.specs import DatasetSpec
from strata.sources import landing, storage, tables

@dataclass(frozen=True)
class Layout:
    """Where a dataset lives. ``fmt`` is the format of the silver and gold tables."""

    landing: str
    silver: str
    gold: str
    metrics: str | None = None
    fmt: str = "parquet"

    @classmethod
    def under(cls, root: str, dataset: str, fmt: str = "parquet") -> Layout:
        root = root.rstrip("/")
        return cls(
            f"{root}/bronze/{dataset}", f"{root}/silver/{dataset}", f"{root}/gold",
            f"{root}/metrics", fmt,
        )


def load_latest(
    spark: SparkSession,
    spec: DatasetSpec,
    layout: Layout,
    date: str,
    normalize_key: bool = False,
    counts: Observation | None = None,
) -> DataFrame:
    """Landed records of a date and dataset, parsed by the declared fields, newest record per
    key. ``counts`` observes the records read and those without a key."""

    def parser(records: DataFrame) -> DataFrame:
        return parse_payload(records, spec.fields, keep=landing.RUN_COLUMNS)

    return landing.load_latest(
        spark, layout.landing, date, spec.key, parser, spec.source, normalize_key, spec.name, counts
    )


def build_silver(
    spark: SparkSession,
    spec: DatasetSpec,
    layout: Layout,
    date: str,
    replace: str = "date",
    steps: Sequence[conform.Step] = conform.STEPS,
    quarantine: str | None = None,
) -> dict:
    """Land-to-silver for one date as a single write job. ``steps`` replaces conform steps.

    With a ``quarantine`` path, rows that break a row-level rule go to a dated table there,
    with their reasons, instead of to silver; a rerun without such rows empties the date there.

    The result also counts, out of the same job, the records read, those without a key, the
    duplicates left out, null values of required fields and values outside declared domains.
    """
    read, audit = Observation(), Observation()
    latest = load_latest(spark, spec, layout, date, counts=read)
    rows = latest.transform(conform.conform, spec, steps)
    audits = conform.row_audits(rows, spec)
    rows = rows.observe(audit, F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in audits.items()])
    write = lambda df, path, cells: tables.write_dated(
        df, path, date, cells, layout.fmt, replace
    )
    if quarantine is None:
        written = write(rows, layout.silver, spec.partition_by)
        return written | _seen(read, audit)
    # Both outputs come from one stored pass instead of running the whole chain twice.
    stored = storage.workspace(spark, "tagged")
    try:
        checks.tag_reasons(rows, checks.row_rules(rows, spec.quality)).write.parquet(stored)
        valid, rejected = checks.split_tagged(spark.read.parquet(stored))
        written = write(valid, layout.silver, spec.partition_by)
        written["quarantined"] = write(rejected, quarantine, ())["records_written"]
    finally:
        storage.delete(spark, stored)
    return written | _seen(read, audit)


def _seen(read: Observation, audit: Observation) -> dict:
    found = {**read.get, **audit.get}
    return {
        "records_read": found.pop("records_read"),
        "null_keys": found.pop("null_keys"),
        "duplicates_removed": read.get["records_read"] - found.pop("rows"),
        "audit": found,
    }


def read_silver(spark: SparkSession, layout: Layout, date: str | None = None) -> DataFrame:
    return tables.read_dated(spark, layout.silver, date, fmt=layout.fmt)


def build_gold(
    spark: SparkSession,
    spec: DatasetSpec,
    layout: Layout,
    date: str,
    source_date: str | None = "same",
    now: datetime | None = None,
) -> dict[str, dict]:
    """Write a snapshot of every declared rollup.

    The silver rows of the date (``source_date=None``: of all dates) are read once per
    shared base, normally once in all. The base is stored as a table so that the rollups
    neither repeat the scan nor depend on blocks an executor could take with it.
    """
    source = read_silver(spark, layout, date if source_date == "same" else source_date)
    for r in spec.rollups:
        rollup.require_dimensions(source, r.dimensions)
    wanted = [rollup.available(source, r) for r in spec.rollups]
    written = {}
    snapshot = lambda table, r: tables.write_snapshot(
        table, layout.gold, r.name, date, layout.fmt, now
    )
    for grain, covered in rollup.plan_bases(wanted):
        if grain is None:
            written.update({r.name: snapshot(rollup.aggregate(source, r), r) for r in covered})
            continue
        stored = storage.workspace(spark, "gold-base")
        try:
            rollup.base_for(source, covered, grain).write.parquet(stored)
            base = spark.read.parquet(stored)
            write = lambda r: snapshot(rollup.rollup(base, r), r)  # noqa: E731, B023
            # The tables are small and independent: their jobs run side by side.
            with ThreadPoolExecutor(len(covered)) as pool:
                written.update(zip([r.name for r in covered], pool.map(write, covered)))
        finally:
            storage.delete(spark, stored)
    return written


# --- checks of the layers ----------------------------------------------------------------


def check_bronze(
    spark: SparkSession, spec: DatasetSpec, layout: Layout, date: str | None = None
) -> DataFrame:
    try:
        files = landing.inventory(spark, layout.landing, date, spec.source, spec.name)
    except FileNotFoundError as missing:
        return checks.failed_row(spark, "bronze", spec.name, "files_present", str(missing))
    return checks.check_landed(files, spec.quality, spec.name)


def check_silver(
    spark: SparkSession, spec: DatasetSpec, layout: Layout, date: str | None = None
) -> DataFrame:
    """Checks of the silver rows. A table that cannot be read gives a failed row, whether that
    shows when it is opened or when the checks run."""
    try:
        rows = read_silver(spark, layout, date)
        return _settled(checks.check_silver(rows, spec.quality, spec.name))
    except tables.READ_ERRORS as error:
        return checks.failed_row(spark, "silver", spec.name, "readable", tables.reason_of(error))


def _settled(results: DataFrame) -> DataFrame:
    """Check rows (as many as checks) that no longer depend on the table they are about."""
    return results.sparkSession.createDataFrame(results.collect(), checks.RESULT_SCHEMA)


def check_gold(
    spark: SparkSession,
    spec: DatasetSpec,
    layout: Layout,
    date: str | None = None,
    expected: Sequence[str] | None = None,
) -> DataFrame:
    """Checks of the newest snapshot of every expected table (default: the declared ones).

    With nothing expected only the existence of the folder is checked.
    """
    names = [r.name for r in spec.rollups] if expected is None else list(expected)
    if not names:
        if storage.exists(spark, layout.gold):
            return spark.createDataFrame([], checks.RESULT_SCHEMA)
        reason = f"Gold path does not exist: {layout.gold}"
        return checks.failed_row(spark, "gold", spec.name, "path_exists", reason)
    parts = {}
    unreadable = lambda name, reason: checks.failed_row(
        spark, "gold", name, "readable", f"Cannot read table {name}: {reason}"
    )
    for name in names:
        path = tables.find_snapshot(spark, layout.gold, name, date)
        if path is None:
            parts[name] = checks.failed_row(spark, "gold", name, "present", f"No snapshot of {name}")
            continue
        table, reason = tables.try_read(spark, path, layout.fmt)
        if table is None:
            parts[name] = unreadable(name, reason)
        else:
            parts[name] = checks.check_gold(table, spec.quality, name, path)
    try:
        return _settled(reduce(DataFrame.unionByName, parts.values()))
    except tables.READ_ERRORS:
        # Some table is damaged inside: find out which.
        for name, part in parts.items():
            try:
                parts[name] = _settled(part)
            except tables.READ_ERRORS as error:
                parts[name] = unreadable(name, tables.reason_of(error))
        return reduce(DataFrame.unionByName, parts.values())


def check_declared(spark: SparkSession, spec: DatasetSpec, layout: Layout, date: str) -> DataFrame:
    """What the declaration promises beyond the rules of a layer: the fields landed records
    carry, the completeness of required columns, and that every aggregate with dimensions adds
    up to silver and lacks none of its dimension values."""
    parts = []
    if spec.quality.landed_fields:
        landed = landing.scan(spark, layout.landing, date, spec.source, dataset=spec.name)
        parts.append(checks.check_landed_fields(landed, spec.quality.landed_fields, spec.name))
    silver = read_silver(spark, layout, date)
    rules = [checks.complete(n, spec.quality.completeness) for n in spec.required if n in silver.columns]
    if rules:
        parts.append(checks.evaluate(silver, rules, "silver", spec.name))
    for r in spec.rollups:
        if r.dimensions and r.record_count:
            gold = tables.read_snapshot(spark, layout.gold, r.name, date, layout.fmt)
            parts.append(checks.check_sum_matches_source(gold, silver, r.name))
            parts.append(checks.check_dimensions_present(gold, silver, r.dimensions, r.name))
    if not parts:
        return spark.createDataFrame([], checks.RESULT_SCHEMA)
    return reduce(DataFrame.unionByName, parts)


def check_all(
    spark: SparkSession, spec: DatasetSpec, layout: Layout, date: str | None = None
) -> DataFrame:
    """Result rows of all three layers."""
    return (
        check_bronze(spark, spec, layout, date)
        .unionByName(check_silver(spark, spec, layout, date))
        .unionByName(check_gold(spark, spec, layout, date))
    )


# --- the day -----------------------------------------------------------------------------


def kpi_metrics(
    spark: SparkSession, results: DataFrame, spec: DatasetSpec, silver: DataFrame
) -> DataFrame:
    """``(metric, value)`` rows for ``alerts.kpi_alerts`` out of the check results of a day and
    its silver rows. A record with an invalid coordinate counts once, whichever it is; one-row
    summaries do not count as small tables."""
    value = lambda condition: F.sum(F.when(condition, F.col("observed")))
    at = lambda layer, metric: (F.col("layer") == layer) & (F.col("metric") == metric)
    grouped = [r.name for r in spec.rollups if r.dimensions]
    wide = results.agg(
        value(at("bronze", "record_count")).alias("bronze_record_count"),
        value(at("silver", "total_records")).alias("_silver"),
        F.min(
            F.when(
                (F.col("layer") == "gold")
                & F.col("dataset").isin(grouped)
                & (F.col("metric") == F.concat("dataset", F.lit("_count"))),
                F.col("observed"),
            )
        ).alias("gold_row_count"),
        value(at("silver", "avg_quality_score")).alias("avg_quality_score"),
        value(at("silver", "duplicate_count")).alias("duplicate_count"),
        value(
            (F.col("layer") == "silver") & F.col("metric").endswith("_null_count")
        ).alias("null_required_field_count"),
    )
    outside = F.lit(False)
    for name in (spec.score.latitude, spec.score.longitude):
        if name in silver.columns and name in spec.quality.ranges:
            low, high = spec.quality.ranges[name]
            number = F.col(name).try_cast("double")
            outside = outside | F.coalesce((number < low) | (number > high), F.lit(False))
    bad = silver.agg(F.try_divide(F.count_if(outside), F.count("*"))).scalar()
    delta = F.abs(F.try_divide(F.col("bronze_record_count") - F.col("_silver"), "bronze_record_count"))
    derived = wide.select(
        "*",
        (delta * 100).alias("silver_bronze_delta_pct"),
        (bad * 100).alias("invalid_coordinate_pct"),
    ).drop("_silver")
    return derived.unpivot([], derived.columns, "metric", "value")


def run_day(
    spark: SparkSession,
    spec: DatasetSpec,
    layout: Layout,
    date: str,
    records: DataFrame | None = None,
    now: datetime | None = None,
) -> Mapping[str, dict]:
    """Land ``records`` (unless already landed), then build and check silver and gold.

    A layer that fails its checks raises ``QualityGateError`` and stops the day. Returns, and
    appends to the metrics log, the summary of every stage with the alerts it gives rise to; the
    log also gets a line for a day that fails, with the reason.
    """
    started = datetime.now()
    day: dict[str, dict] = {}
    results: list[DataFrame] = []

    def passed(found: DataFrame) -> dict:
        results.append(_settled(found))
        return checks.assert_passed(results[-1])

    try:
        if records is not None:
            source = spec.source or "api"
            day["landed"] = landing.append_records(records, layout.landing, spec.name, date, source, now)
        day["bronze_checks"] = passed(check_bronze(spark, spec, layout, date))
        day["silver"] = build_silver(spark, spec, layout, date)
        day["silver_checks"] = passed(check_silver(spark, spec, layout, date))
        day["gold"] = build_gold(spark, spec, layout, date, now=now)
        day["gold_checks"] = passed(check_gold(spark, spec, layout, date))
        day["declared_checks"] = passed(check_declared(spark, spec, layout, date))
    except Exception as error:
        _log_day(spark, layout, date, day, results, started, reason=str(error)[:1000])
        raise
    _log_day(spark, layout, date, day, results, started)
    return day


def _log_day(spark, layout: Layout, date: str, day: dict, results, started: datetime, reason=None) -> None:
    if not layout.metrics:
        return
    raised = []
    if results:
        found = alerts.alert_rows(reduce(DataFrame.unionByName, results))
        raised = [r.asDict(recursive=True) for r in found.collect()]  # a row per layer and severity
    bronze = day.get("bronze_checks", {}).get("bronze", {}).get("metrics", {})
    event = {
        "run_date": date,
        "bronze_record_count": bronze.get("record_count"),
        "silver_metrics": day.get("silver"),
        "gold_metrics": {n: t["record_count"] for n, t in day.get("gold", {}).items()},
        "alerts": raised,
        "execution_time": (datetime.now() - started).total_seconds(),
    }
    if reason is not None:
        event["failure"] = reason
    tables.append_metrics(spark, layout.metrics, event)
