"""Queries for landing files, dated tables, snapshots, metrics and the daily run.

Each writes to a fresh folder and returns what a reader finds there.
"""

from __future__ import annotations

import uuid
from dataclasses import replace
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators import pages, rollup
from strata.operators.parse import parse_payload
from strata.plans import daily, states
from strata.plans.daily import Layout
from strata.sources import landing, latest, storage, tables
from workloads import fixtures as fx
from workloads.registry import query
from workloads.rollups import BY_KIND, BY_LOCATION, GOLD_SQL, QUALITY, joined_kinds

RAW_TEXT = f"SELECT {', '.join(n for n in fx.NAMES if n != 'seq')}, CAST(seq AS VARCHAR) AS seq"


@query("bronze_append_roundtrip", f"WITH {fx.RAW_CTE} {RAW_TEXT}, 'batch' AS _source, '{fx.DATE}' AS _ingestion_date FROM raw")
def bronze_append_roundtrip(spark, sf_dir):
    root = storage.workspace(spark, "append")
    landing.append_records(fx.messy_places(spark, sf_dir), root, "places", fx.DATE, "batch")
    records = landing.scan(spark, root, fx.DATE, "batch")
    return parse_payload(records, fx.FIELDS, keep=["_source", "_ingestion_date"])


@query(
    "bronze_envelope",
    f"WITH {fx.RAW_CTE} {RAW_TEXT}, 'api' AS _source, '{fx.DATE}' AS _ingestion_date, true AS stamped FROM raw",
)
def bronze_envelope(spark, sf_dir):
    wrapped = landing.envelope(fx.messy_places(spark, sf_dir), "api", fx.DATE)
    stamped = wrapped.withColumn("stamped", F.col("_ingest_ts") <= F.current_timestamp())
    return parse_payload(stamped, fx.FIELDS, keep=["_source", "_ingestion_date", "stamped"])


@query("bronze_scan_by_date", f"WITH {fx.RAW_CTE} {RAW_TEXT}, '{fx.DATE}' AS _ingestion_date FROM raw")
def bronze_scan_by_date(spark, sf_dir):
    records = landing.scan(spark, fx.landed(spark, sf_dir), fx.DATE)
    return parse_payload(records, fx.FIELDS, keep=["_ingestion_date"])


@query(
    "bronze_load_dedup",
    f"""WITH {fx.RAW_CTE}, latest AS (SELECT * FROM raw
          QUALIFY row_number() OVER (PARTITION BY id ORDER BY seq % 2 DESC, seq DESC) = 1)
        {RAW_TEXT} FROM latest""",
)
def bronze_load_dedup(spark, sf_dir):
    """The later run (odd records) wins over the earlier one."""
    layout = Layout(fx.landed(spark, sf_dir), "", "")
    return daily.load_latest(spark, fx.PLACES, layout, fx.DATE).drop("_ingest_ts")


@query(
    "bronze_merge_latest",
    f"""WITH {fx.RAW_CTE}, latest AS (SELECT * FROM raw
          QUALIFY row_number() OVER (PARTITION BY id ORDER BY seq % 2 DESC, seq DESC) = 1)
        {RAW_TEXT} FROM latest""",
)
def bronze_merge_latest(spark, sf_dir):
    """The later run is merged into a bucketed table of the earlier one: the rule, and the rows,
    of ``bronze_load_dedup`` without a shuffle of the stored side."""
    name, path = f"latest_{uuid.uuid4().hex}", storage.workspace(spark, "latest")
    records = parse_payload(landing.scan(spark, fx.landed(spark, sf_dir), fx.DATE), fx.FIELDS, keep=landing.RUN_COLUMNS)
    later = F.col("_ingest_ts") >= F.to_timestamp(F.lit(fx.SECOND_RUN.isoformat(sep=" ")))
    # Positions order an array file; lines go by the number that the fixture gives them.
    placed = records.withColumn("_position", F.col("seq").cast("int"))
    latest.create(placed.filter(~later), name, path, "id", buckets=8)
    latest.refresh(spark, placed.filter(later), name, path, "id")
    return spark.table(name).drop(*landing.RUN_COLUMNS)


@query(
    "bronze_multi_run_union",
    f"""WITH {fx.RAW_CTE} SELECT CASE seq % 2 WHEN 0 THEN '01:00' ELSE '02:00' END AS run,
          'api' AS _source, count(*) AS records FROM raw GROUP BY ALL""",
)
def bronze_multi_run_union(spark, sf_dir):
    records = landing.scan(spark, fx.landed(spark, sf_dir), fx.DATE)
    run = F.date_format("_ingest_ts", "HH:mm").alias("run")
    return records.groupBy(run, "_source").agg(F.count("*").alias("records"))


@query(
    "bronze_skip_invalid",
    f"""WITH {fx.RAW_CTE} SELECT CASE WHEN seq % 40 = 0 THEN NULL ELSE id END AS id, count(*) AS n
        FROM raw GROUP BY ALL""",
)
def bronze_skip_invalid(spark, sf_dir):
    """Files that are broken or no array are left out; blank records parse to nulls."""
    root = fx.landed(spark, sf_dir)
    records = landing.scan(spark, root, fx.NEXT_DATE, on_invalid="skip")
    parsed = parse_payload(records, fx.FIELDS[:1], keep=())
    return parsed.groupBy("id").agg(F.count("*").alias("n"))


@query(
    "bronze_split_arrays",
    f"""WITH {fx.RAW_CTE} {RAW_TEXT}, CAST(row_number() OVER (ORDER BY raw.seq) - 1 AS INTEGER) AS position FROM raw""",
)
def bronze_split_arrays(spark, sf_dir):
    """One array file with all records, read by byte ranges; positions are those of the array."""
    records = landing.scan(spark, fx.one_array(spark, sf_dir), fx.DATE, split_arrays=True)
    return parse_payload(records.withColumnRenamed("_position", "position"), fx.FIELDS, keep=["position"])


SILVER_LIST = ", ".join(fx.SILVER_COLUMNS)
EVERY_DATE = f"""WITH {fx.SILVER_CTE}, dated AS (
  SELECT *, '{fx.DATE}' AS _processing_date FROM silver UNION ALL
  SELECT *, '{fx.NEXT_DATE}' FROM silver)"""


def _silver_columns(df, *more):
    return df.select(*fx.SILVER_COLUMNS, *more)


@query("silver_write_roundtrip", f"{EVERY_DATE} SELECT {SILVER_LIST}, _processing_date FROM dated")
def silver_write_roundtrip(spark, sf_dir):
    layout = fx.dated(spark, sf_dir)
    return _silver_columns(tables.read_dated(spark, layout.silver), "_processing_date")


@query(
    "silver_read_by_date",
    f"{EVERY_DATE} SELECT {SILVER_LIST}, _processing_date FROM dated WHERE _processing_date = '{fx.NEXT_DATE}'",
)
def silver_read_by_date(spark, sf_dir):
    layout = fx.dated(spark, sf_dir)
    rows = tables.read_dated(spark, layout.silver, fx.NEXT_DATE)
    return _silver_columns(rows, "_processing_date")


@query(
    "silver_rerun_idempotent",
    f"""WITH {fx.SILVER_CTE} SELECT {SILVER_LIST}, '{fx.DATE}' AS _processing_date FROM silver
        WHERE country <> 'Canada'""",
)
def silver_rerun_idempotent(spark, sf_dir):
    """A second run without Canada leaves no Canadian rows of the first run behind."""
    path = storage.workspace(spark, "rerun")
    rows = fx.conformed_places(spark, sf_dir)
    tables.write_dated(rows, path, fx.DATE, fx.PLACES.partition_by)
    tables.write_dated(rows.filter("country <> 'Canada'"), path, fx.DATE, fx.PLACES.partition_by)
    return _silver_columns(tables.read_dated(spark, path), "_processing_date")


@query(
    "silver_rerun_cells",
    f"""WITH {fx.SILVER_CTE} SELECT country, count(*) AS n, max(CASE WHEN country = 'Canada' THEN 1 ELSE 2 END)
          AS run FROM silver GROUP BY country""",
)
def silver_rerun_cells(spark, sf_dir):
    """Cell-level overwrite keeps the cells the second run did not write."""
    path = storage.workspace(spark, "cells")
    rows = fx.conformed_places(spark, sf_dir)
    cells = fx.PLACES.partition_by
    first = rows.withColumn("run", F.lit(1))
    second = rows.filter("country <> 'Canada'").withColumn("run", F.lit(2))
    tables.write_dated(first, path, fx.DATE, cells, replace="cells")
    tables.write_dated(second, path, fx.DATE, cells, replace="cells")
    written = tables.read_dated(spark, path)
    return written.groupBy("country").agg(F.count("*").alias("n"), F.max("run").alias("run"))


@query("silver_write_default_date", f"WITH {fx.SILVER_CTE} SELECT {SILVER_LIST}, true AS today FROM silver")
def silver_write_default_date(spark, sf_dir):
    path = storage.workspace(spark, "today")
    written = tables.write_dated(fx.conformed_places(spark, sf_dir), path)
    rows = tables.read_dated(spark, path)
    today = (F.col("_processing_date") == F.lit(written["processing_date"])).alias("today")
    return _silver_columns(rows, today)


GOLD_COLUMNS = "SELECT g.*, '{date}' AS _execution_date FROM ({sql}) g"
STAMPS = ("_created_at", "_processing_timestamp")


def _by_location(spark, sf_dir):
    return rollup.aggregate(fx.conformed_places(spark, sf_dir), BY_LOCATION)


def _by_kind(spark, sf_dir):
    return rollup.aggregate(fx.conformed_places(spark, sf_dir), BY_KIND)


@query(
    "gold_snapshot_roundtrip",
    f"WITH {fx.SILVER_CTE} " + GOLD_COLUMNS.format(date=fx.DATE, sql=GOLD_SQL["by_location"]),
)
def gold_snapshot_roundtrip(spark, sf_dir):
    root = storage.workspace(spark, "gold")
    written = tables.write_snapshot(_by_location(spark, sf_dir), root, "by_location", fx.DATE)
    return joined_kinds(spark.read.parquet(written["path"]).drop(*STAMPS))


def _two_days(spark, sf_dir):
    """Two snapshots of one date and one of the next date."""
    root = storage.workspace(spark, "snapshots")
    by_kind = _by_kind(spark, sf_dir)
    for version, (date, hour) in enumerate([(fx.DATE, 1), (fx.DATE, 2), (fx.NEXT_DATE, 1)], 1):
        rows = by_kind.withColumn("version", F.lit(version))
        tables.write_snapshot(rows, root, "by_kind", date, now=datetime(2026, 1, 27, hour))
    return root


@query(
    "gold_read_latest",
    f"WITH {fx.SILVER_CTE} SELECT g.*, 3 AS version, '{fx.NEXT_DATE}' AS _execution_date FROM ({GOLD_SQL['by_kind']}) g",
)
def gold_read_latest(spark, sf_dir):
    return tables.read_snapshot(spark, _two_days(spark, sf_dir), "by_kind").drop(*STAMPS)


@query(
    "gold_read_latest_for_date",
    f"WITH {fx.SILVER_CTE} SELECT g.*, 2 AS version, '{fx.DATE}' AS _execution_date FROM ({GOLD_SQL['by_kind']}) g",
)
def gold_read_latest_for_date(spark, sf_dir):
    return tables.read_snapshot(spark, _two_days(spark, sf_dir), "by_kind", fx.DATE).drop(*STAMPS)


ROW_COUNTS = " UNION ALL ".join(
    f"SELECT '{spec.name}' AS name, count(*) AS record_count FROM ({sql})"
    for spec, sql in zip(fx.PLACES.rollups, GOLD_SQL.values())
)


@query("gold_all_row_counts", f"WITH {fx.SILVER_CTE} {ROW_COUNTS}")
def gold_all_row_counts(spark, sf_dir):
    layout = fx.dated(spark, sf_dir)
    fresh = Layout(layout.landing, layout.silver, storage.workspace(spark, "gold-all"))
    written = daily.build_gold(spark, fx.PLACES, fresh, fx.DATE)
    return _stored_counts(spark, written, "name")


def _stored_counts(spark, snapshots, label):
    """Rows found in each stored snapshot."""
    counts = [
        spark.read.parquet(t["path"]).agg(F.count("*").alias("record_count")).withColumn(label, F.lit(n))
        for n, t in snapshots.items()
    ]
    return reduce(DataFrame.unionByName, counts)


@query(
    "metrics_append",
    "SELECT o_orderstatus AS stage, count(*) AS record_count FROM orders GROUP BY ALL",
)
def metrics_append(spark, sf_dir):
    """Row counts of one stored table per group, logged one event at a time."""
    root = storage.workspace(spark, "metrics")
    orders = fx.table(spark, sf_dir, "orders")
    tables.write_dated(orders, f"{root}/orders", fx.DATE, ["o_orderstatus"])
    stored = tables.read_dated(spark, f"{root}/orders", fx.DATE)
    for row in stored.groupBy("o_orderstatus").count().collect():  # a row per status
        event = {"stage": row.o_orderstatus, "record_count": row["count"]}
        tables.append_metrics(spark, f"{root}/log", event)
    return tables.read_metrics(spark, f"{root}/log", "stage string, record_count bigint")


def _landed_pages(spark, sf_dir):
    """Customers in pages of 200 with an empty page after the last one."""
    places = fx.messy_places(spark, sf_dir)
    total = places.agg(F.count("*")).scalar()
    landed = fx.paged(places, 200).select((F.col("page") + 1).alias("page"), "records")
    end = landed.agg((F.max("page") + 1).alias("page")).select(
        "page", F.array().cast("array<string>").alias("records")
    )
    return landed.unionByName(end).select(
        "page", F.lit(200).alias("per_page"), "records", total.alias("reported_total")
    )


@query(
    "page_reconciliation",
    """SELECT count(*) AS reported_total, count(*) AS received,
         CAST(ceil(count(*) / 200.0) AS BIGINT) AS expected_pages,
         CAST(ceil(count(*) / 200.0) AS BIGINT) AS pages_received,
         CAST(0 AS BIGINT) AS missing_pages, true AS complete FROM customer""",
)
def page_reconciliation(spark, sf_dir):
    return pages.reconcile_pages(_landed_pages(spark, sf_dir))


GAPPED = "page % 10 NOT IN (3, 4) AND page NOT IN (1, 12)"


@query(
    "page_gaps",
    f"""WITH {fx.RAW_CTE}, every AS (SELECT DISTINCT CAST(floor(seq / 20) + 1 AS BIGINT) AS page FROM raw), bounds AS (
         SELECT greatest(max(page), CAST(ceil((SELECT count(*) FROM raw) / 20.0) AS BIGINT)) AS last FROM every WHERE {GAPPED}
       ), gone AS (
         SELECT page, page - row_number() OVER (ORDER BY page) AS island FROM (SELECT unnest(range(1, last + 1)) AS page FROM bounds)
         WHERE page NOT IN (SELECT page FROM every WHERE {GAPPED})
       )
       SELECT 'missing' AS kind, min(page) AS first_page, max(page) AS last_page, count(*) AS n FROM gone GROUP BY island
       UNION ALL SELECT 'repeated', page, page, CAST(2 AS BIGINT) FROM every WHERE {GAPPED} AND page % 7 = 0""",
)
def page_gaps(spark, sf_dir):
    """Pages of 20 records of which some ranges never landed and some pages landed twice."""
    places = fx.messy_places(spark, sf_dir)
    total = places.agg(F.count("*")).scalar()
    landed = fx.paged(places, 20).select((F.col("page") + 1).alias("page"), "records").filter(GAPPED)
    twice = landed.unionByName(landed.filter("page % 7 = 0"))
    return pages.page_gaps(twice.select("page", F.lit(20).alias("per_page"), "records", total.alias("reported_total")))


@query(
    "page_union",
    f"WITH {fx.RAW_CTE} SELECT CAST(floor(seq / 200) + 1 AS BIGINT) AS page, id FROM raw",
)
def page_union(spark, sf_dir):
    records = pages.page_records(_landed_pages(spark, sf_dir))
    return parse_payload(records, fx.FIELDS[:1], keep=["page"]).select("page", "id")


@query(
    "daily_run",
    f"""WITH {fx.RAW_CTE}, latest AS (SELECT * FROM raw
          QUALIFY row_number() OVER (PARTITION BY id ORDER BY seq % 2 DESC, seq DESC) = 1), {fx.conform_ctes()}
        SELECT 'landed' AS stage, (SELECT count(*) FROM raw WHERE seq % 2 = 1) AS record_count
        UNION ALL SELECT 'silver', (SELECT count(*) FROM silver)
        UNION ALL {ROW_COUNTS.replace('AS name', 'AS stage')}""",
)
def daily_run(spark, sf_dir):
    """A whole day with an earlier run already landed: land, check, silver, check, gold,
    check, metrics."""
    layout = Layout.under(storage.workspace(spark, "day"), "places")
    places = fx.messy_places(spark, sf_dir)
    early, late = places.filter("seq % 2 = 0"), places.filter("seq % 2 = 1")
    landing.append_records(early, layout.landing, "places", fx.DATE, "api", fx.FIRST_RUN)
    day = daily.run_day(spark, fx.LENIENT, layout, fx.DATE, late)
    count = F.count("*").alias("record_count")
    arrived = spark.read.text(day["landed"]["path"]).agg(count).withColumn("stage", F.lit("landed"))
    silver = daily.read_silver(spark, layout, fx.DATE).agg(count).withColumn("stage", F.lit("silver"))
    return arrived.unionByName(silver).unionByName(_stored_counts(spark, day["gold"], "stage"))


def _day_of(spark, label, records, spec=fx.LENIENT, quarantine=False):
    """A layout with one landed run per frame, silver built after each."""
    layout = Layout.under(storage.workspace(spark, label), "places")
    aside = f"{layout.silver}_rejected" if quarantine else None
    for run, rows in zip((fx.FIRST_RUN, fx.SECOND_RUN), records):
        landing.append_records(rows, layout.landing, "places", fx.DATE, "api", run)
        written = daily.build_silver(spark, spec, layout, fx.DATE, quarantine=aside)
    return layout, aside, written


@query(
    "quarantine_rerun_clears",
    f"""WITH {fx.LATEST_CTE}, {fx.conform_ctes()}
        SELECT 'silver' AS part, count(*) AS n FROM silver UNION ALL SELECT 'rejected', 0""",
)
def quarantine_rerun_clears(spark, sf_dir):
    """The first run has records to reject, the second corrects all of them."""
    places = fx.messy_places(spark, sf_dir)
    good = places.withColumns({"name": F.lit("named"), "kind": F.lit(fx.KINDS[0]), "latitude": F.lit("1"), "longitude": F.lit("2")})
    layout, aside, _ = _day_of(spark, "corrected", [places, good], fx.PLACES, quarantine=True)
    count = F.count("*").alias("n")
    silver = tables.read_dated(spark, layout.silver, fx.DATE).agg(count).withColumn("part", F.lit("silver"))
    rejected = tables.read_dated(spark, aside, fx.DATE).agg(count).withColumn("part", F.lit("rejected"))
    return silver.unionByName(rejected)


@query(
    "silver_rerun_empty",
    f"WITH {fx.SILVER_CTE} SELECT '{fx.NEXT_DATE}' AS _processing_date, count(*) AS n FROM silver",
)
def silver_rerun_empty(spark, sf_dir):
    """A rerun without rows empties its own date and leaves the other one."""
    path = storage.workspace(spark, "emptied")
    rows = fx.conformed_places(spark, sf_dir)
    for date in (fx.DATE, fx.NEXT_DATE):
        tables.write_dated(rows, path, date, fx.PLACES.partition_by)
    tables.write_dated(rows.filter("false"), path, fx.DATE, fx.PLACES.partition_by)
    left = tables.read_dated(spark, path).groupBy("_processing_date").agg(F.count("*").alias("n"))
    return left.unionByName(
        tables.read_dated(spark, path, fx.DATE).groupBy("_processing_date").agg(F.count("*").alias("n"))
    )


@query("bronze_lines_invalid", f"WITH {fx.RAW_CTE} SELECT id, name FROM raw")
def bronze_lines_invalid(spark, sf_dir):
    """Broken lines between good ones are left out on request; without it they are an error."""
    root = storage.workspace(spark, "broken-lines")
    places = fx.messy_places(spark, sf_dir)
    lines = places.select(F.explode(F.array(landing.as_json(places), F.lit("{broken"))).alias("value"))
    lines.write.text(f"{root}/places_bronze_api_{fx.DATE}_20260125_010000.jsonl")
    records = landing.scan(spark, root, fx.DATE, on_invalid="skip")
    return parse_payload(records, fx.FIELDS[:2], keep=())


@query("bronze_two_datasets", f"WITH {fx.RAW_CTE} SELECT id FROM raw WHERE seq % 2 = 0")
def bronze_two_datasets(spark, sf_dir):
    """Two datasets share a landing folder; only the runs of one are read."""
    root = storage.workspace(spark, "shared")
    places = fx.messy_places(spark, sf_dir)
    for dataset, parity in (("places", 0), ("places_old", 1), ("old_places", 1)):
        landing.append_records(places.filter(F.col("seq") % 2 == parity), root, dataset, fx.DATE)
    return parse_payload(landing.scan(spark, root, fx.DATE, dataset="places"), fx.FIELDS[:1], keep=())


# --- gold over many dates from states ------------------------------------------------------

BOTH_DATES = f"""WITH {fx.SILVER_CTE.replace('silver AS', 'every AS')}, silver AS (
  SELECT * FROM every WHERE CAST(seq AS INTEGER) % 3 <> 0 UNION ALL
  SELECT * FROM every WHERE CAST(seq AS INTEGER) % 3 <> 1)"""


def _from_states(spark, sf_dir, *rollups):
    """Two dates that share a third of their records, each read once into its state."""
    layout = Layout.under(storage.workspace(spark, "states"), "places")
    spec = replace(fx.PLACES, rollups=rollups)
    rows = fx.conformed_places(spark, sf_dir)
    for date, rest in ((fx.DATE, 0), (fx.NEXT_DATE, 1)):
        some = rows.filter(F.col("seq").cast("int") % 3 != rest)
        tables.write_dated(some, layout.silver, date, spec.partition_by)
        states.update(spark, spec, layout, date)
    return states.merged(spark, spec, layout)


@query("gold_states_by_kind", f"{BOTH_DATES} {GOLD_SQL['by_kind']}")
def gold_states_by_kind(spark, sf_dir):
    return _from_states(spark, sf_dir, BY_KIND)[BY_KIND.name].drop("_created_at")


@query("gold_states_by_location", f"{BOTH_DATES} {GOLD_SQL['by_location']}")
def gold_states_by_location(spark, sf_dir):
    """Two distinct columns: collected values of one, bitmaps of the other."""
    return joined_kinds(_from_states(spark, sf_dir, BY_LOCATION)[BY_LOCATION.name]).drop("_created_at")


@query("gold_states_quality", f"{BOTH_DATES} {GOLD_SQL['quality_metrics']}")
def gold_states_quality(spark, sf_dir):
    """Four distinct columns without dimensions: bitmaps of dictionary codes."""
    return _from_states(spark, sf_dir, QUALITY)[QUALITY.name].drop("_created_at")
