"""Queries for data-quality checks, quarantine and alerts."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.operators import alerts, checks, quantiles, rollup
from strata.plans import daily, sql_checks
from strata.sources import landing, storage, tables
from workloads import fixtures as fx
from workloads.registry import ORACLES, query
from workloads.rollups import BY_KIND, BY_LOCATION

RULES = fx.PLACES.quality
KIND_LIST = ", ".join(f"'{k}'" for k in fx.KINDS)


def _row(layer, dataset, metric, field, severity, observed, bound, passed) -> str:
    """One check row in SQL; ``v`` is the observed value."""
    tail = ("" if bound is None else f", limit {bound:.2f}") + ("" if field is None else f" ({field})")
    message = f"printf('%s is %.2f%s', '{metric}', CAST(v AS DOUBLE), '{tail}')"
    text = lambda s: "NULL" if s is None else f"'{s}'"
    limit = "NULL" if bound is None else str(bound)
    return f"""SELECT {text(layer)} AS layer, {text(dataset)} AS dataset, {text(metric)} AS metric,
      CAST({text(field)} AS VARCHAR) AS field, {text(severity)} AS severity,
      CAST(v AS DOUBLE) AS observed, CAST({limit} AS DOUBLE) AS bound, ({passed}) AS passed,
      CASE WHEN NOT ({passed}) THEN {message} END AS message FROM (SELECT {observed} AS v)"""


def _none(layer, dataset, metric, field, severity, observed) -> str:
    return _row(layer, dataset, metric, field, severity, observed, 0, "v = 0")


def _scalar(expression: str, source: str) -> str:
    return f"(SELECT {expression} FROM {source})"


def unique_sql(source, dataset="places"):
    keys = "(count(DISTINCT id) + coalesce(max(CASE WHEN id IS NULL THEN 1 END), 0))"
    return _none("silver", dataset, "duplicate_count", "id", "error",
                 _scalar(f"count(*) - {keys}", source))


def required_sql(name, source, layer="silver", severity="error"):
    return _row(layer, "places", f"{name}_null_count", name, severity,
                _scalar(f"count(*) FILTER ({name} IS NULL)", source), 0, "v = 0")


def range_sql(name, limit, source):
    value = f"try_cast({name} AS DOUBLE)"
    return _none("silver", "places", f"{name}_out_of_range", name, "warning",
                 _scalar(f"count(*) FILTER ({value} < -{limit} OR {value} > {limit})", source))


def allowed_sql(source):
    return _none("silver", "places", "kind_invalid_values", "kind", "warning",
                 _scalar(f"count(*) FILTER (kind NOT IN ({KIND_LIST}))", source))


def mean_sql(source):
    return _row("silver", "places", "avg_quality_score", "data_quality_score", "warning",
                _scalar("avg(data_quality_score)", source), 80.0, "coalesce(v >= 80.0, true)")


def total_sql(source):
    return _row("silver", "places", "total_records", None, "info", _scalar("count(*)", source), None, "true")


def silver_rows_sql(source, required=("id", "name")):
    parts = [total_sql(source), unique_sql(source), *[required_sql(n, source) for n in required],
             range_sql("latitude", 90, source), range_sql("longitude", 180, source),
             allowed_sql(source), mean_sql(source)]
    return " UNION ALL ".join(parts)


def _places(spark, sf_dir):
    return fx.messy_places(spark, sf_dir)


def _silver(df, *which):
    return checks.evaluate(df, which, "silver", "places")


@query("check_unique", f"WITH {fx.RAW_CTE} {unique_sql('raw')}")
def check_unique(spark, sf_dir):
    return _silver(_places(spark, sf_dir), checks.unique("id"))


@query("check_required", f"WITH {fx.RAW_CTE} {required_sql('id', 'raw')} UNION ALL {required_sql('name', 'raw')}")
def check_required(spark, sf_dir):
    return _silver(_places(spark, sf_dir), checks.required("id"), checks.required("name"))


@query(
    "check_range",
    f"WITH {fx.RAW_CTE} {range_sql('latitude', 90, 'raw')} UNION ALL {range_sql('longitude', 180, 'raw')}",
)
def check_range(spark, sf_dir):
    limits = RULES.ranges.items()
    return _silver(_places(spark, sf_dir), *[checks.in_range(n, *pair) for n, pair in limits])


@query("check_allowed", f"WITH {fx.RAW_CTE} {allowed_sql('raw')}")
def check_allowed(spark, sf_dir):
    return _silver(_places(spark, sf_dir), checks.allowed("kind", fx.KINDS))


@query("check_avg_score", f"WITH {fx.SILVER_CTE} {mean_sql('silver')}")
def check_avg_score(spark, sf_dir):
    score = checks.mean_at_least("data_quality_score", RULES.mean_score * 100, "avg_quality_score")
    return _silver(fx.conformed_places(spark, sf_dir), score)


@query(
    "silver_checks",
    f"WITH {fx.SILVER_CTE} {silver_rows_sql('silver')}",
)
def silver_checks(spark, sf_dir):
    """All silver rules on one date of the stored table."""
    return daily.check_silver(spark, fx.PLACES, fx.dated(spark, sf_dir), fx.NEXT_DATE)


PAGES = f"(count(DISTINCT seq // {fx.PAGE}) + 2)"


@query(
    "bronze_checks",
    f"""WITH {fx.RAW_CTE} """
    + " UNION ALL ".join(
        [
            _row("bronze", "places", "file_count", None, "info", _scalar(PAGES, "raw"), None, "true"),
            _none("bronze", "places", "invalid_json_count", "path", "error", "1"),
            _none("bronze", "places", "non_array_count", "path", "warning", "1"),
            _row("bronze", "places", "record_count", None, "error", _scalar("count(*)", "raw"), 100, "v >= 100"),
            _none("bronze", "places", "empty_record_count", None, "warning",
                  _scalar("count(*) FILTER (seq % 40 = 0)", "raw")),
            _row("bronze", "places", "filled_record_count", None, "error",
                 _scalar("count(*) FILTER (seq % 40 <> 0)", "raw"), 1, "v > 0"),
        ]
    ),
)
def bronze_checks(spark, sf_dir):
    files = landing.inventory(spark, fx.landed(spark, sf_dir), fx.NEXT_DATE)
    return checks.check_landed(files, RULES, "places")


@query(
    "check_bronze_fields",
    f"""WITH {fx.RAW_CTE} {required_sql('id', 'raw', 'bronze', 'warning')} UNION ALL
        {required_sql('name', 'raw', 'bronze', 'warning')} UNION ALL
        {required_sql('kind', 'raw', 'bronze', 'warning')}""",
)
def check_bronze_fields(spark, sf_dir):
    records = landing.scan(spark, fx.landed(spark, sf_dir), fx.DATE)
    return checks.check_landed_fields(records, RULES.landed_fields, "places")


# An aggregate with negative counts, shares above 100 and a text column called "country".
BAD_GOLD = """
SELECT concat('nation ', CAST(c_nationkey AS STRING)) AS country,
  count(*) - CASE WHEN c_nationkey % 5 = 0 THEN 1000000 ELSE 0 END AS record_count,
  CASE WHEN c_nationkey % 4 = 0 THEN 120.0E0 ELSE 50.0E0 END AS percentage_of_total
FROM {customer} GROUP BY c_nationkey"""
BAD_GOLD_CTE = "bad AS (" + BAD_GOLD.format(customer="customer") + ")"


def _bad_gold(spark, sf_dir):
    return spark.sql(BAD_GOLD, customer=fx.table(spark, sf_dir, "customer"))


def negative_sql(column, dataset, source):
    return _none("gold", dataset, f"{dataset}.{column}_negative", column, "error",
                 _scalar(f"count(*) FILTER ({column} < 0)", source))


def share_sql(dataset, source):
    share = "percentage_of_total"
    return _none("gold", dataset, f"{dataset}.{share}_invalid", share, "warning",
                 _scalar(f"count(*) FILTER ({share} < 0 OR {share} > 100)", source))


def rows_sql(dataset, source):
    return _row("gold", dataset, f"{dataset}_count", None, "warning", _scalar("count(*)", source), None, "v <> 0")


@query("check_non_negative", f"WITH {BAD_GOLD_CTE} {negative_sql('record_count', 'bad', 'bad')}")
def check_non_negative(spark, sf_dir):
    df = _bad_gold(spark, sf_dir)
    return checks.evaluate(df, [checks.non_negative("record_count", "bad")], "gold", "bad")


@query("check_percentage", f"WITH {BAD_GOLD_CTE} {share_sql('bad', 'bad')}")
def check_percentage(spark, sf_dir):
    df = _bad_gold(spark, sf_dir)
    return checks.evaluate(df, [checks.percentage("percentage_of_total", "bad")], "gold", "bad")


@query(
    "gold_checks",
    f"""WITH {BAD_GOLD_CTE} {rows_sql('bad', 'bad')} UNION ALL
        {negative_sql('record_count', 'bad', 'bad')} UNION ALL {share_sql('bad', 'bad')}""",
)
def gold_checks(spark, sf_dir):
    root = storage.workspace(spark, "bad-gold")
    written = tables.write_snapshot(_bad_gold(spark, sf_dir), root, "bad", fx.DATE)
    return checks.check_gold(spark.read.parquet(written["path"]), RULES, "bad")


def difference_sql(dataset, observed):
    return _row("gold", dataset, "record_count_difference", "record_count", "error", observed, 0, "v = 0")


@query(
    "check_sum_matches_source",
    f"""WITH {fx.SILVER_CTE} {difference_sql('whole', '0')} UNION ALL
        {difference_sql('partial', _scalar("-count(*) FILTER (country = 'Canada')", 'silver'))}""",
)
def check_sum_matches_source(spark, sf_dir):
    silver = tables.read_dated(spark, fx.dated(spark, sf_dir).silver, fx.DATE)
    whole = rollup.aggregate(silver, BY_LOCATION)
    partial = whole.filter("country <> 'Canada'")
    return checks.check_sum_matches_source(whole, silver, "whole").unionByName(
        checks.check_sum_matches_source(partial, silver, "partial")
    )


@query(
    "check_dimensions_present",
    f"""WITH {fx.SILVER_CTE} """
    + _row(
        "gold", "partial", "missing_dimensions", "country,state", "error",
        _scalar("count(DISTINCT state) FILTER (country = 'Canada')", "silver"), 0, "v = 0",
    ),
)
def check_dimensions_present(spark, sf_dir):
    silver = tables.read_dated(spark, fx.dated(spark, sf_dir).silver, fx.DATE)
    partial = rollup.aggregate(silver, BY_LOCATION).filter("country <> 'Canada'")
    return checks.check_dimensions_present(partial, silver, ["country", "state"], "partial")


def complete_sql(name, source):
    return _row("silver", "places", f"{name}_completeness", name, "warning",
                _scalar(f"avg(CASE WHEN {name} IS NULL THEN 0.0 ELSE 1.0 END)", source),
                0.95, "v >= 0.95")


@query(
    "check_completeness",
    f"""WITH {fx.RAW_CTE} {complete_sql('id', 'raw')} UNION ALL {complete_sql('name', 'raw')} UNION ALL
        {complete_sql('country', 'raw')} UNION ALL {complete_sql('state', 'raw')}""",
)
def check_completeness(spark, sf_dir):
    names = ("id", "name", "country", "state")
    return _silver(_places(spark, sf_dir), *[checks.complete(n, RULES.completeness) for n in names])


def _present_sql(layer, dataset, date, source):
    found = f"(SELECT count(DISTINCT date) FROM {source} WHERE date = '{date}')"
    return _row(layer, dataset, "present", date, "error", found, 1, "v = 1")


@query(
    "presence_audit",
    f"""WITH {fx.SILVER_CTE},
          landed AS (SELECT '{fx.DATE}' AS date FROM raw UNION SELECT '{fx.NEXT_DATE}' FROM raw),
          snapshots AS (SELECT DISTINCT '{fx.DATE}' AS date FROM (SELECT kind FROM silver GROUP BY kind)) """
    + " UNION ALL ".join(
        [
            *[_present_sql("bronze", "places", d, "landed") for d in (fx.DATE, fx.NEXT_DATE, fx.MISSING_DATE)],
            *[_present_sql("gold", "by_kind", d, "snapshots") for d in (fx.DATE, fx.MISSING_DATE)],
        ]
    ),
)
def presence_audit(spark, sf_dir):
    """Landed runs and gold snapshots against the dates that should exist."""
    root = fx.landed(spark, sf_dir)
    landed = landing.found_runs(spark, root)
    dates = [("places", d) for d in (fx.DATE, fx.NEXT_DATE, fx.MISSING_DATE)]
    wanted = spark.createDataFrame(dates, "dataset string, date string")
    gold = storage.workspace(spark, "presence")
    by_kind = rollup.aggregate(fx.conformed_places(spark, sf_dir), BY_KIND)
    tables.write_snapshot(by_kind, gold, "by_kind", fx.DATE)
    dates = [("by_kind", d) for d in (fx.DATE, fx.MISSING_DATE)]
    wanted_gold = spark.createDataFrame(dates, "dataset string, date string")
    return checks.check_presence(landed, wanted, "bronze").unionByName(
        checks.check_presence(tables.found_snapshots(spark, gold), wanted_gold, "gold")
    )


@query(
    "all_checks",
    f"""WITH {fx.SILVER_CTE}, by_kind AS (SELECT kind, count(*) AS record_count,
          50.0 AS percentage_of_total FROM silver GROUP BY kind) """
    + " UNION ALL ".join(
        [
            _row("bronze", "places", "file_count", None, "info", _scalar(PAGES, "raw"), None, "true"),
            _none("bronze", "places", "invalid_json_count", "path", "error", "1"),
            _none("bronze", "places", "non_array_count", "path", "warning", "1"),
            _row("bronze", "places", "record_count", None, "error", _scalar("count(*)", "raw"), 100, "v >= 100"),
            _none("bronze", "places", "empty_record_count", None, "warning",
                  _scalar("count(*) FILTER (seq % 40 = 0)", "raw")),
            _row("bronze", "places", "filled_record_count", None, "error",
                 _scalar("count(*) FILTER (seq % 40 <> 0)", "raw"), 1, "v > 0"),
            silver_rows_sql("silver"),
            rows_sql("places_by_type", "by_kind"),
            negative_sql("record_count", "places_by_type", "by_kind"),
            share_sql("places_by_type", "by_kind"),
        ]
    ),
)
def all_checks(spark, sf_dir):
    """Bronze, silver and gold checks together."""
    layout = fx.dated(spark, sf_dir)
    gold = storage.workspace(spark, "all-gold")
    silver = tables.read_dated(spark, layout.silver, fx.DATE)
    written = tables.write_snapshot(rollup.aggregate(silver, BY_KIND), gold, BY_KIND.name, fx.DATE)
    bronze = checks.check_landed(
        landing.inventory(spark, fx.landed(spark, sf_dir), fx.NEXT_DATE), RULES, "places"
    )
    return bronze.unionByName(checks.check_silver(silver, RULES, "places")).unionByName(
        checks.check_gold(spark.read.parquet(written["path"]), RULES, BY_KIND.name)
    )


REASONS = """list_filter([CASE WHEN id IS NULL THEN 'id_missing' END, CASE WHEN name IS NULL THEN 'name_missing' END,
  CASE WHEN latitude < -90 OR latitude > 90 THEN 'latitude_out_of_range' END,
  CASE WHEN longitude < -180 OR longitude > 180 THEN 'longitude_out_of_range' END,
  CASE WHEN kind NOT IN ({kinds}) THEN 'kind_not_allowed' END], lambda r: r IS NOT NULL)""".format(kinds=KIND_LIST)


@query(
    "quarantine_split",
    f"""WITH {fx.SILVER_CTE}, tagged AS (SELECT id, {REASONS} AS r FROM silver)
        SELECT id, CASE WHEN len(r) = 0 THEN 'valid' ELSE 'rejected' END AS part,
          array_to_string(r, ',') AS reasons FROM tagged""",
)
def quarantine_split(spark, sf_dir):
    """Valid and rejected rows of the stored table, each with its part and reasons."""
    silver = tables.read_dated(spark, fx.dated(spark, sf_dir).silver, fx.DATE)
    valid, rejected = checks.quarantine(silver, checks.row_rules(silver, RULES))
    return valid.select("id", F.lit("valid").alias("part"), F.lit("").alias("reasons")).unionByName(
        rejected.select("id", F.lit("rejected").alias("part"), F.array_join("_reasons", ",").alias("reasons"))
    )


@query(
    "kpi_alerts",
    f"""WITH {fx.SILVER_CTE}, m AS (
          SELECT 'bronze_record_count' AS metric, CAST((SELECT count(*) FROM raw) AS DOUBLE) AS value, 100.0 AS low, 15000.0 AS high
          UNION ALL SELECT 'silver_bronze_delta_pct',
            (SELECT abs((SELECT count(*) FROM raw) - count(*)) / (SELECT CAST(count(*) AS DOUBLE) FROM raw) * 100 FROM silver), NULL, 10.0
          UNION ALL SELECT 'gold_row_count', (SELECT count(DISTINCT coalesce(kind, '-')) FROM silver), 50.0, NULL
          UNION ALL SELECT 'avg_quality_score', (SELECT avg(data_quality_score) FROM silver), 70.0, NULL
          UNION ALL SELECT 'duplicate_count', 0, NULL, 0.0
          UNION ALL SELECT 'null_required_field_count', (SELECT count(*) FILTER (name IS NULL) FROM silver), NULL, 0.0
          UNION ALL SELECT 'invalid_coordinate_pct', (SELECT avg(CASE WHEN latitude NOT BETWEEN -90 AND 90
            OR longitude NOT BETWEEN -180 AND 180 THEN 100.0 ELSE 0.0 END) FROM silver), NULL, 5.0)
        SELECT metric, round(CAST(value AS DOUBLE), 6) AS value, CAST(low AS DOUBLE) AS low, CAST(high AS DOUBLE) AS high,
          coalesce(value < low, false) OR coalesce(value > high, false) AS alert FROM m""",
)
def kpi_alerts(spark, sf_dir):
    results = all_checks(spark, sf_dir)
    silver = tables.read_dated(spark, fx.dated(spark, sf_dir).silver, fx.DATE)
    metrics = daily.kpi_metrics(spark, results, fx.PLACES, silver)
    return alerts.kpi_alerts(metrics).withColumn("value", F.round("value", 6))


@query(
    "alert_rows",
    f"""SELECT CASE WHEN bool_or(severity = 'error') THEN 'HIGH' ELSE 'MEDIUM' END AS severity, layer, 'places' AS dataset,
          'email,slack' AS channels, string_agg(name, ',' ORDER BY name) AS failed_checks
        FROM (SELECT *, metric || coalesce('.' || field, '') AS name FROM ({ORACLES['all_checks']}))
        WHERE NOT passed AND severity <> 'info' GROUP BY layer""",
)
def alert_rows(spark, sf_dir):
    raised = alerts.alert_rows(all_checks(spark, sf_dir))
    return raised.select(
        "severity",
        "layer",
        "dataset",
        F.array_join("channels", ",").alias("channels"),
        F.array_join("failed_checks", ",").alias("failed_checks"),
    )


@query(
    "daily_checks_declared",
    f"""WITH {fx.RAW_CTE}, latest AS (SELECT * FROM raw
          QUALIFY row_number() OVER (PARTITION BY id ORDER BY seq % 2 DESC, seq DESC) = 1), {fx.conform_ctes()},
        places AS (SELECT 'places_by_type' AS dataset UNION ALL SELECT 'places_by_location'
                   UNION ALL SELECT 'places_by_type_location')
        SELECT 'bronze' AS layer, 'places' AS dataset, 'id_null_count' AS metric,
               CAST(count(*) FILTER (id IS NULL) AS DOUBLE) AS observed, count(*) FILTER (id IS NULL) = 0 AS passed FROM raw
        UNION ALL SELECT 'bronze', 'places', 'name_null_count', count(*) FILTER (name IS NULL), count(*) FILTER (name IS NULL) = 0 FROM raw
        UNION ALL SELECT 'bronze', 'places', 'kind_null_count', count(*) FILTER (kind IS NULL), count(*) FILTER (kind IS NULL) = 0 FROM raw
        UNION ALL SELECT 'silver', 'places', 'id_completeness', round(count(id) / CAST(count(*) AS DOUBLE), 6), count(id) >= 0.95 * count(*) FROM silver
        UNION ALL SELECT 'silver', 'places', 'name_completeness', round(count(name) / CAST(count(*) AS DOUBLE), 6), count(name) >= 0.95 * count(*) FROM silver
        UNION ALL SELECT 'gold', dataset, 'record_count_difference', 0.0, true FROM places
        UNION ALL SELECT 'gold', dataset, 'missing_dimensions', 0.0, true FROM places""",
)
def daily_checks_declared(spark, sf_dir):
    """The declared checks of a day that was landed, built and aggregated."""
    layout = daily.Layout.under(storage.workspace(spark, "declared"), "places")
    places = fx.messy_places(spark, sf_dir)
    for parity, run in ((0, fx.FIRST_RUN), (1, fx.SECOND_RUN)):
        part = places.filter(F.col("seq") % 2 == parity)
        landing.append_records(part, layout.landing, "places", fx.DATE, "api", run)
    daily.build_silver(spark, fx.LENIENT, layout, fx.DATE)
    daily.build_gold(spark, fx.LENIENT, layout, fx.DATE)
    found = daily.check_declared(spark, fx.LENIENT, layout, fx.DATE)
    return found.select("layer", "dataset", "metric", F.round("observed", 6).alias("observed"), "passed")


@query(
    "quantiles_by_group",
    """WITH every AS (SELECT event_type, value FROM events UNION ALL SELECT 'all', value FROM events),
            found AS (SELECT event_type, count(value) AS n, quantile_disc(value, [0.05, 0.5, 0.95]) AS v FROM every GROUP BY event_type)
       SELECT event_type, n, unnest([CAST(0.05 AS DOUBLE), 0.5, 0.95]) AS probability, unnest(v) AS value FROM found""",
)
def quantiles_by_group(spark, sf_dir):
    """Quantiles of each kind of event and, from the same sketches merged, of all events."""
    events = fx.table(spark, sf_dir, "events")
    states = quantiles.quantile_states(events, ["value"], by=["event_type"], k=32_000)
    every = quantiles.merge_states(states).select(F.lit("all").alias("event_type"), "field", "n", "sketch")
    return quantiles.quantiles(states.unionByName(every), (0.05, 0.5, 0.95)).drop("field")


@query(
    "quantile_drift",
    """WITH halves AS (SELECT event_type, value, event_id % 2 AS half FROM events UNION ALL
                       SELECT 'moved', value + 1000 * (event_id % 2), event_id % 2 FROM events),
            ranked AS (SELECT event_type, half, cume_dist() OVER (PARTITION BY event_type, half ORDER BY value) AS r, value FROM halves),
            points AS (SELECT a.event_type, abs(a.r - coalesce((SELECT max(b.r) FROM ranked b
                       WHERE b.event_type = a.event_type AND b.half <> a.half AND b.value <= a.value), 0)) AS d FROM ranked a)
       SELECT event_type, (SELECT count(*) FROM halves h WHERE h.event_type = p.event_type AND half = 0) AS n_before,
         (SELECT count(*) FROM halves h WHERE h.event_type = p.event_type AND half = 1) AS n_after, max(d) <= 0.2 AS passed
       FROM points p GROUP BY event_type""",
)
def quantile_drift(spark, sf_dir):
    """The even events of each kind against the odd ones, and one kind that has moved."""
    events = fx.table(spark, sf_dir, "events").select("event_type", "value", (F.col("event_id") % 2).alias("half"))
    moved = events.select(F.lit("moved").alias("event_type"), (F.col("value") + 1000 * F.col("half")).alias("value"), "half")
    states = quantiles.quantile_states(events.unionByName(moved), ["value"], by=["event_type", "half"], k=32_000)
    side = lambda half: states.filter(F.col("half") == half).select(F.col("event_type").alias("field"), "n", "sketch")
    found = quantiles.quantile_drift(side(0), side(1), limit=0.2)
    return found.select(F.col("field").alias("event_type"), "n_before", "n_after", "passed")


@query(
    "checks_from_sql",
    f"""WITH {fx.RAW_CTE} SELECT metric, field, severity, observed, passed FROM (
          {required_sql('id', 'raw')} UNION ALL {required_sql('name', 'raw')} UNION ALL {allowed_sql('raw')})""",
)
def checks_from_sql(spark, sf_dir):
    """Declared checks asked for by name, and combined, from SQL."""
    declared = [checks.required("id"), checks.required("name"), checks.allowed("kind", fx.KINDS)]
    sql_checks.register(spark, _places(spark, sf_dir), declared, "silver", "places")
    calls = dict.fromkeys(f"places_{c.metric}()" for c in declared)
    return spark.sql(" UNION ALL ".join(f"SELECT metric, field, severity, observed, passed FROM {c}" for c in calls))
