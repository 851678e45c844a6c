"""Inputs derived from the test tables. The SQL text runs unchanged on Spark and DuckDB."""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.conform import conform
from strata.operators.dedup import keep_latest
from strata.operators.parse import parse_payload
from strata.plans.daily import Layout
from strata.plans.specs import FieldSpec, place_dataset
from strata.sources import landing, storage, tables

KINDS = ("building", "machinery", "furniture", "household", "automobile")

FIELDS = (
    FieldSpec("id", nullable=False),
    FieldSpec("name", nullable=False),
    FieldSpec("kind"),
    FieldSpec("street"),
    FieldSpec("city"),
    FieldSpec("state"),
    FieldSpec("country"),
    FieldSpec("postal_code"),
    FieldSpec("latitude", "double"),
    FieldSpec("longitude", "double"),
    FieldSpec("phone"),
    FieldSpec("website_url"),
    FieldSpec("seq", "long"),
)
NAMES = tuple(f.name for f in FIELDS)

PLACES = place_dataset("places", FIELDS, "kind", KINDS)

# Names are missing in some records, so a run that must get through does not require them.
LENIENT = replace(PLACES, quality=replace(PLACES.quality, required=("id",)))

# Untidy records: padded and blank names, missing streets, several country spellings,
# unusable coordinates and phones. Every fifth record is an older version of the next one.
MESSY_PLACES = """
SELECT
  CAST(CASE WHEN c_custkey % 5 = 0 THEN c_custkey + 1 ELSE c_custkey END AS STRING) AS id,
  CASE WHEN c_custkey % 40 = 3 THEN '   ' WHEN c_custkey % 41 = 0 THEN NULL
       ELSE concat('  ', c_name, ' ') END AS name,
  CASE WHEN c_custkey % 43 = 0 THEN 'unlisted' ELSE lower(c_mktsegment) END AS kind,
  CASE WHEN c_custkey % 7 = 0 THEN '' ELSE concat(CAST(c_custkey AS STRING), ' Main St') END AS street,
  concat('City ', CAST(c_nationkey AS STRING)) AS city,
  CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE concat('st', CAST(c_nationkey % 4 AS STRING)) END AS state,
  CASE c_nationkey % 6 WHEN 0 THEN 'usa' WHEN 1 THEN ' England ' WHEN 2 THEN 'Republic of Korea'
       WHEN 3 THEN 'U.S.' WHEN 4 THEN NULL ELSE 'Canada' END AS country,
  CASE WHEN c_custkey % 9 = 0 THEN '-' ELSE concat(CAST(10000 + c_custkey AS STRING),
       CASE WHEN c_custkey % 3 = 0 THEN '-' ELSE '' END) END AS postal_code,
  CASE WHEN c_custkey % 17 = 0 THEN 'bad' WHEN c_custkey % 13 = 0 THEN NULL
       ELSE CAST(c_custkey % 200 - 100 AS STRING) END AS latitude,
  CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE CAST(c_custkey % 400 - 200 AS STRING) END AS longitude,
  CASE WHEN c_custkey % 19 = 0 THEN 'N/A'
       WHEN c_custkey % 5 = 1 THEN concat('(303) ', CAST(555 AS STRING), '-', CAST(1000 + c_custkey % 9000 AS STRING))
       ELSE concat('+44 20 ', CAST(70000000 + c_custkey AS STRING)) END AS phone,
  CASE WHEN c_custkey % 6 = 0 THEN NULL ELSE concat('https://site', CAST(c_custkey AS STRING), '.example') END AS website_url,
  c_custkey AS seq
FROM {customer}
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def messy_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(MESSY_PLACES, customer=table(spark, sf_dir, "customer"))


def latest_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Enveloped, parsed as text and de-duplicated by id, highest ``seq`` first."""
    payloads = landing.envelope(messy_places(spark, sf_dir), "api", "2026-01-25")
    parsed = parse_payload(payloads, FIELDS, keep=())
    return keep_latest(parsed, "id", [F.desc(F.col("seq").try_cast("bigint"))])


def conformed_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_places(spark, sf_dir).transform(conform, PLACES)


# --- the same chain in SQL ---------------------------------------------------------------

RAW_CTE = "raw AS (" + MESSY_PLACES.format(customer="customer") + ")"

LATEST_CTE = (
    RAW_CTE
    + """, latest AS (
  SELECT * FROM raw QUALIFY row_number() OVER (PARTITION BY id ORDER BY seq DESC) = 1)"""
)


def _clean(name: str) -> str:
    return f"nullif(trim({name}, ' '), '')"


MAPPED_COUNTRY = """CASE lower({c})
    WHEN 'united states' THEN 'United States' WHEN 'usa' THEN 'United States'
    WHEN 'us' THEN 'United States' WHEN 'u.s.a.' THEN 'United States'
    WHEN 'u.s.' THEN 'United States' WHEN 'england' THEN 'United Kingdom'
    WHEN 'scotland' THEN 'United Kingdom' WHEN 'wales' THEN 'United Kingdom'
    WHEN 'northern ireland' THEN 'United Kingdom' WHEN 'isle of man' THEN 'United Kingdom'
    WHEN 'republic of ireland' THEN 'Ireland' WHEN 'south korea' THEN 'South Korea'
    WHEN 'republic of korea' THEN 'South Korea' ELSE {c} END"""

US_PHONE = (
    "CASE WHEN regexp_full_match({p}, '\\d{{10}}') THEN "
    "concat('(', {p}[1:3], ') ', {p}[4:6], '-', {p}[7:10]) ELSE {p} END"
)


def std_select(source: str) -> str:
    """Cleaned and standardised columns, before the null defaults."""
    digits = f"regexp_replace({_clean('phone')}, '[^\\d]', '', 'g')"
    return f"""SELECT {_clean('id')} AS id, {_clean('name')} AS name, {_clean('kind')} AS kind,
  {_clean('street')} AS street, {_clean('city')} AS city, upper({_clean('state')}) AS state,
  {MAPPED_COUNTRY.format(c=_clean('country'))} AS country,
  regexp_replace({_clean('postal_code')}, '-$', '') AS postal_code,
  try_cast(latitude AS DOUBLE) AS latitude, try_cast(longitude AS DOUBLE) AS longitude,
  {US_PHONE.format(p=digits)} AS phone, {_clean('website_url')} AS website_url,
  CAST(seq AS VARCHAR) AS seq FROM {source}"""


FLAG_COLUMNS = """
  coalesce(latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180, false) AS is_valid_location,
  (street IS NOT NULL AND city IS NOT NULL AND state IS NOT NULL AND postal_code IS NOT NULL)
    AS has_complete_address"""

SCORE_COLUMN = """
  (CASE WHEN id IS NOT NULL THEN 25 ELSE 0 END + CASE WHEN name IS NOT NULL THEN 25 ELSE 0 END
   + CASE WHEN is_valid_location THEN 25 ELSE 0 END
   + CASE WHEN has_complete_address THEN 25 ELSE 0 END) AS data_quality_score"""


def conform_ctes(source: str = "latest") -> str:
    """CTEs ending in ``silver``: everything from the cleaned text to the score."""
    return f"""std AS ({std_select(source)}),
filled AS (SELECT * REPLACE (coalesce(country, 'Unknown') AS country,
  coalesce(state, 'Unknown') AS state) FROM std),
flagged AS (SELECT *, {FLAG_COLUMNS} FROM filled),
silver AS (SELECT *, {SCORE_COLUMN} FROM flagged)"""


SILVER_CTE = LATEST_CTE + ", " + conform_ctes()

SILVER_COLUMNS = (*NAMES, "is_valid_location", "has_complete_address", "data_quality_score")


# --- landed files and tables -------------------------------------------------------------

DATE, NEXT_DATE, MISSING_DATE = "2026-01-25", "2026-01-26", "2026-01-27"
FIRST_RUN, SECOND_RUN = datetime(2026, 1, 25, 1, 0, 0), datetime(2026, 1, 25, 2, 0, 0)
PAGE = 5000


def paged(records: DataFrame, per_page: int) -> DataFrame:
    """``(page, records)``: at most ``per_page`` consecutive records as JSON text per page."""
    body = F.struct("seq", landing.as_json(records).alias("record"))
    return (
        records.select(F.floor(F.col("seq") / per_page).alias("page"), body.alias("body"))
        .groupBy("page")
        .agg(F.array_sort(F.collect_list("body")).alias("bodies"))
        .select("page", F.col("bodies.record").alias("records"))
    )


def write_array_run(records: DataFrame, path: str) -> None:
    """A run of array files, one file per page."""
    text = F.concat(F.lit("["), F.array_join("records", ",\n"), F.lit("]")).alias("value")
    paged(records, PAGE).select(text).write.option("maxRecordsPerFile", 1).text(path)


_STORED: dict[tuple[str, str, str], str] = {}


def _stored(spark: SparkSession, sf_dir: str, label: str, build) -> str:
    """Folder of a stored fixture, built once per application while it exists."""
    key = (spark.sparkContext.applicationId, sf_dir, label)
    if key not in _STORED or not storage.exists(spark, _STORED[key]):
        _STORED[key] = build(spark, sf_dir)
    return _STORED[key]


def _land(spark: SparkSession, sf_dir: str) -> str:
    """Two runs for DATE (array files of the even records, then lines of the odd ones) and
    one for NEXT_DATE with blank records, a broken file and a file that is not an array."""
    root = storage.workspace(spark, "landing")
    places = messy_places(spark, sf_dir)
    even, odd = F.col("seq") % 2 == 0, F.col("seq") % 2 == 1
    name = f"{root}/places_bronze_api_{{}}_{{}}.json"
    write_array_run(places.filter(even), name.format(DATE, "20260125_010000"))
    landing.append_records(places.filter(odd), root, "places", DATE, "api", SECOND_RUN)
    blank = F.when(F.col("seq") % 40 != 0, F.col("record")).otherwise("{}")
    records = places.select("seq", landing.as_json(places).alias("record"))
    pages = (
        records.select(F.floor(F.col("seq") / PAGE).alias("page"), blank.alias("record"))
        .groupBy("page")
        .agg(F.concat(F.lit("["), F.array_join(F.collect_list("record"), ","), F.lit("]")).alias("value"))
        .select("value")
    )
    pages.write.option("maxRecordsPerFile", 1).text(name.format(NEXT_DATE, "20260126_010000"))
    broken = spark.range(1).select(F.lit("{bad").alias("value"))
    broken.write.text(name.format(NEXT_DATE, "20260126_020000"))
    single = records.filter("seq = 1").select(F.col("record").alias("value"))
    single.coalesce(1).write.text(name.format(NEXT_DATE, "20260126_030000"))
    return root


def landed(spark: SparkSession, sf_dir: str) -> str:
    return _stored(spark, sf_dir, "landing", _land)


def _one_array(spark: SparkSession, sf_dir: str) -> str:
    """A run of one file: the lines of the records in order, between brackets and commas."""
    root = storage.workspace(spark, "array")
    places = messy_places(spark, sf_dir)
    first, last = places.agg(F.min("seq"), F.max("seq")).first()
    line = F.concat(
        F.when(F.col("seq") == first, "[").otherwise(","),
        landing.as_json(places),
        F.when(F.col("seq") == last, "]").otherwise(""),
    )
    lines = places.orderBy("seq").select(line.alias("value")).coalesce(1)
    lines.write.text(f"{root}/places_bronze_api_{DATE}_20260125_010000.json")
    return root


def one_array(spark: SparkSession, sf_dir: str) -> str:
    return _stored(spark, sf_dir, "array", _one_array)


def _write_dates(spark: SparkSession, sf_dir: str) -> str:
    """Silver table with all places on each of two dates."""
    root = storage.workspace(spark, "dated")
    rows = conformed_places(spark, sf_dir)
    for date in (DATE, NEXT_DATE):
        tables.write_dated(rows, Layout.under(root, "places").silver, date, PLACES.partition_by)
    return root


def dated(spark: SparkSession, sf_dir: str) -> Layout:
    return Layout.under(_stored(spark, sf_dir, "dated", _write_dates), "places")
