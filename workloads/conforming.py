"""Queries for schema, parsing, typing, standardising, scoring and de-duplication."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.functions import quality, text
from strata.operators import conform, dedup, drift, preview, records
from strata.operators.parse import parse_payload
from strata.operators.schema import build_schema, required_fields
from strata.plans.specs import FieldSpec
from strata.sources import landing
from workloads import fixtures as fx
from workloads.registry import query

CLEAN = fx._clean

ORDER_FIELDS = (
    {"name": "o_orderkey", "type": "long", "nullable": False},
    {"name": "o_custkey", "type": "long"},
    {"name": "o_orderstatus", "type": "string"},
    {"name": "o_totalprice", "type": "double"},
    {"name": "o_orderpriority", "type": "string"},
)


@query(
    "schema_from_config",
    """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority, 'orders' AS _source
       FROM orders""",
)
def schema_from_config(spark, sf_dir):
    """Rows parsed straight into a declared schema that includes an audit column."""
    schema = build_schema(ORDER_FIELDS, audit_fields=[{"name": "_source", "type": "string"}])
    rows = fx.table(spark, sf_dir, "orders").withColumn("_source", F.lit("orders"))
    payload = landing.as_json(rows.select(*schema.names))
    return rows.select(F.from_json(payload, schema).alias("r")).select("r.*")


@query(
    "parse_payload_strings",
    """SELECT event_id, try_cast(json_extract_string(props, '$.k') AS VARCHAR) AS k,
         json_extract_string(props, '$.missing') AS missing FROM events""",
)
def parse_payload_strings(spark, sf_dir):
    events = fx.table(spark, sf_dir, "events")
    fields = [{"name": "k", "type": "int"}, {"name": "missing"}]
    return parse_payload(events, fields, payload="props", keep=["event_id"])


def _raw_columns(replaced: str) -> str:
    return f"WITH {fx.RAW_CTE} SELECT * REPLACE (CAST(seq AS VARCHAR) AS seq, {replaced}) FROM raw"


def _raw_text(spark, sf_dir):
    places = fx.messy_places(spark, sf_dir)
    return places.withColumn("seq", F.col("seq").cast("string"))


@query(
    "enforce_types",
    _raw_columns("try_cast(latitude AS DOUBLE) AS latitude, try_cast(longitude AS DOUBLE) AS longitude"),
)
def enforce_types(spark, sf_dir):
    return conform.enforce_types(_raw_text(spark, sf_dir), fx.FIELDS)


@query(
    "enforce_all_types",
    """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders""",
)
def enforce_all_types(spark, sf_dir):
    orders = fx.table(spark, sf_dir, "orders").select(*[f["name"] for f in ORDER_FIELDS])
    as_text = parse_payload(orders.select(landing.as_json(orders).alias("payload")), ORDER_FIELDS, keep=())
    return conform.enforce_types(as_text, ORDER_FIELDS, conform.ALL_TYPES)


@query(
    "required_null_audit",
    f"""WITH {fx.RAW_CTE} SELECT 'id' AS field, count(*) FILTER (id IS NULL) AS null_count FROM raw
        UNION ALL SELECT 'name', count(*) FILTER (name IS NULL) FROM raw""",
)
def required_null_audit(spark, sf_dir):
    return conform.required_null_audit(fx.messy_places(spark, sf_dir), required_fields(fx.FIELDS))


@query(
    "domain_audit",
    f"""WITH {fx.RAW_CTE} SELECT 'kind' AS field, count(*) FILTER (kind NOT IN
        ('building','machinery','furniture','household','automobile')) AS invalid_count FROM raw""",
)
def domain_audit(spark, sf_dir):
    return conform.domain_audit(fx.messy_places(spark, sf_dir), {"kind": fx.KINDS})


@query("std_trim", f"WITH {fx.RAW_CTE} SELECT seq, trim(name, ' ') AS name, trim(country, ' ') AS country FROM raw")
def std_trim(spark, sf_dir):
    places = fx.messy_places(spark, sf_dir)
    return places.select("seq", *[text.trimmed(F.col(c)).alias(c) for c in ("name", "country")])


@query(
    "std_empty_to_null",
    f"WITH {fx.RAW_CTE} SELECT seq, {CLEAN('name')} AS name, {CLEAN('street')} AS street FROM raw",
)
def std_empty_to_null(spark, sf_dir):
    return conform.clean_strings(fx.messy_places(spark, sf_dir)).select("seq", "name", "street")


@query(
    "std_value_map",
    f"WITH {fx.RAW_CTE} SELECT seq, {fx.MAPPED_COUNTRY.format(c=CLEAN('country'))} AS country FROM raw",
)
def std_value_map(spark, sf_dir):
    places = conform.clean_strings(fx.messy_places(spark, sf_dir)).select("seq", "country")
    return conform.map_values(places, "country", fx.PLACES.standardize.value_maps["country"])


@query(
    "std_value_map_join",
    """SELECT o_orderkey, CASE WHEN n_nationkey IS NULL THEN o_orderstatus
              ELSE concat('nation ', CAST(n_nationkey AS VARCHAR)) END AS code
       FROM (SELECT o_orderkey, o_orderstatus, concat('code-', CAST(o_custkey % 40 AS VARCHAR)) AS c FROM orders)
       LEFT JOIN nation ON c = concat('code-', CAST(n_nationkey AS VARCHAR))""",
)
def std_value_map_join(spark, sf_dir):
    """A mapping too long for a literal map goes through a join. Its rules chain, and the frame
    has columns named like those of a lookup."""
    rules = {f"CODE-{i}": f"step-{i}" for i in range(25)}
    rules.update({f"Step-{i}": f"nation {i}" for i in range(25)})
    rules.update({f"unused-{i}": f"value {i}" for i in range(text.MAX_LITERAL_MAPPING)})
    orders = fx.table(spark, sf_dir, "orders")
    coded = orders.select(
        "o_orderkey",
        "o_orderstatus",
        F.concat(F.lit("code-"), (F.col("o_custkey") % 40).cast("string")).alias("code"),
        F.lit("own").alias("_from"),
        F.lit("own").alias("_mapped_to"),
    )
    known = F.col("code").startswith("nation ") & (F.col("_from") == F.col("_mapped_to"))
    return conform.map_values(coded, "code", rules).select(
        "o_orderkey", F.when(known, F.col("code")).otherwise(F.col("o_orderstatus")).alias("code")
    )


@query(
    "std_value_map_table",
    """WITH RECURSIVE rules AS (
         SELECT n_nationkey AS position, concat('CODE-', n_nationkey) AS source, concat('Step-', n_nationkey % 20) AS target FROM nation
         UNION ALL SELECT 100 + n_nationkey, concat('step-', n_nationkey), n_name FROM nation
         UNION ALL SELECT 200 + n_nationkey, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey
         UNION ALL SELECT 50, 'AFRICA', 'never' UNION ALL SELECT 300, 'asia', 'ASIA PACIFIC' UNION ALL SELECT 301, 'asia pacific', 'asia'
       ), follow(start, pos, target) AS (
         SELECT position, position, target FROM rules
         UNION ALL
         SELECT start, r.position, r.target FROM follow JOIN rules r ON lower(r.source) = lower(follow.target) AND r.position > follow.pos
           AND NOT EXISTS (SELECT 1 FROM rules o WHERE lower(o.source) = lower(r.source) AND o.position > follow.pos AND o.position < r.position)
       ), resolved AS (
         SELECT lower(source) AS source, last(f.target ORDER BY f.pos) AS target FROM rules JOIN follow f ON f.start = rules.position
         GROUP BY rules.position, source
       )
       SELECT o_orderkey, coalesce(target, code) AS code
       FROM (SELECT o_orderkey, concat('code-', o_custkey % 40) AS code FROM orders) LEFT JOIN resolved ON source = lower(code)""",
)
def std_value_map_table(spark, sf_dir):
    """Rules held as a table: they chain over three steps, out of order they do not."""
    nation, region = (fx.table(spark, sf_dir, t) for t in ("nation", "region"))
    key, text_key = F.col("n_nationkey"), F.col("n_nationkey").cast("string")
    columns = lambda df, at, source, target: df.select(at.alias("position"), source.alias("source"), target.alias("target"))
    named = nation.join(region, nation["n_regionkey"] == region["r_regionkey"])
    odd = [(50, "AFRICA", "never"), (300, "asia", "ASIA PACIFIC"), (301, "asia pacific", "asia")]
    rules = (
        columns(nation, key, F.concat(F.lit("CODE-"), text_key), F.concat(F.lit("Step-"), (key % 20).cast("string")))
        .union(columns(nation, key + 100, F.concat(F.lit("step-"), text_key), F.col("n_name")))
        .union(columns(named, key + 200, F.col("n_name"), F.col("r_name")))
        .union(spark.createDataFrame(odd, "position int, source string, target string"))
    )
    orders = fx.table(spark, sf_dir, "orders")
    coded = orders.select("o_orderkey", F.concat(F.lit("code-"), (F.col("o_custkey") % 40).cast("string")).alias("code"))
    return conform.map_values(coded, "code", rules)


# Declared for the drift query: latitude is landed as text, rating never, seq is not declared.
DRIFT_FIELDS = (
    *[FieldSpec(n) for n in ("id", "name", "kind", "street", "city")], FieldSpec("latitude", "double"), FieldSpec("rating", "int"),
)
DRIFT_DECLARED = ", ".join(f"('{f.name}', '{f.type}')" for f in DRIFT_FIELDS)


@query(
    "payload_drift",
    f"""WITH {fx.RAW_CTE}, payloads AS (
         SELECT CASE WHEN seq % 50 = 7 THEN '[1]' WHEN seq % 50 = 8 THEN '{{bad' ELSE CAST(json_merge_patch('{{}}', json_object(
           'id', id, 'name', name, 'kind', kind, 'street', street, 'city', city, 'latitude', latitude, 'seq', seq,
           'extra', CASE WHEN seq % 3 = 0 THEN json_object('a', seq) WHEN seq % 3 = 1 THEN to_json(seq) END)) AS VARCHAR) END AS p FROM raw
       ), declared AS (SELECT * FROM (VALUES {DRIFT_DECLARED}) AS t(field, declared)
       ), objects AS (SELECT p FROM payloads WHERE json_valid(p) AND json_type(p) = 'OBJECT'
       ), entries AS (
         SELECT field, json_type(p, concat('$.', field)) AS kind FROM (SELECT p, unnest(json_keys(p)) AS field FROM objects)
       ), named AS (
         SELECT field, CASE kind WHEN 'VARCHAR' THEN 'STRING' WHEN 'UBIGINT' THEN 'BIGINT' ELSE kind END AS kind FROM entries
       )
       SELECT NULL AS field, 'no_object' AS status, NULL AS declared, NULL AS found, (SELECT count(*) FROM payloads) - (SELECT count(*) FROM objects) AS records
       UNION ALL
       SELECT field, 'undeclared', NULL, string_agg(DISTINCT kind, ',' ORDER BY kind), count(*) FROM named
       WHERE field NOT IN (SELECT field FROM declared) GROUP BY field
       UNION ALL
       SELECT field, 'absent', declared, NULL, (SELECT count(*) FROM objects) - (SELECT count(*) FROM named n WHERE n.field = d.field) FROM declared d
       WHERE (SELECT count(*) FROM named n WHERE n.field = d.field) < (SELECT count(*) FROM objects)
       UNION ALL
       SELECT field, 'retyped', declared, string_agg(DISTINCT kind, ',' ORDER BY kind), count(*) FROM named JOIN declared USING (field)
       WHERE kind <> 'NULL' AND kind <> CASE declared WHEN 'string' THEN 'STRING' ELSE 'BIGINT' END GROUP BY field, declared""",
)
def payload_drift(spark, sf_dir):
    """Records whose fields come and go: every third has an object where others have a number."""
    seq = F.col("seq")
    extra = F.when(seq % 3 == 0, F.parse_json(F.format_string('{"a":%d}', seq))).when(seq % 3 == 1, F.parse_json(seq.cast("string")))
    names = ("id", "name", "kind", "street", "city", "latitude", "seq")
    record = F.to_json(F.struct(*names, extra.alias("extra")))
    payload = F.when(seq % 50 == 7, "[1]").when(seq % 50 == 8, "{bad").otherwise(record).alias("payload")
    return drift.payload_drift(fx.messy_places(spark, sf_dir).select(payload), DRIFT_FIELDS)


@query("std_upper", f"WITH {fx.RAW_CTE} SELECT seq, upper({CLEAN('state')}) AS state FROM raw")
def std_upper(spark, sf_dir):
    return _standardized(spark, sf_dir, "state")


@query(
    "std_phone_digits",
    f"WITH {fx.RAW_CTE} SELECT seq, regexp_replace(phone, '[^\\d]', '', 'g') AS phone FROM raw",
)
def std_phone_digits(spark, sf_dir):
    places = fx.messy_places(spark, sf_dir)
    return places.select("seq", text.digits_only(F.col("phone")).alias("phone"))


@query("std_phone_us", f"WITH {fx.RAW_CTE}, std AS ({fx.std_select('raw')}) SELECT CAST(seq AS BIGINT) AS seq, phone FROM std")
def std_phone_us(spark, sf_dir):
    return _standardized(spark, sf_dir, "phone")


@query(
    "std_postal",
    f"WITH {fx.RAW_CTE} SELECT seq, regexp_replace({CLEAN('postal_code')}, '-$', '') AS postal_code FROM raw",
)
def std_postal(spark, sf_dir):
    return _standardized(spark, sf_dir, "postal_code")


def _standardized(spark, sf_dir, column):
    places = fx.messy_places(spark, sf_dir)
    return conform.standardize(places, fx.PLACES.standardize).select("seq", column)


@query(
    "null_defaults",
    f"""WITH {fx.RAW_CTE} SELECT seq, coalesce(country, 'Unknown') AS country,
        coalesce(state, 'Unknown') AS state FROM raw""",
)
def null_defaults(spark, sf_dir):
    places = fx.messy_places(spark, sf_dir).select("seq", "country", "state")
    return conform.fill_defaults(places, fx.PLACES.defaults)


FLAGGED = f"""WITH {fx.RAW_CTE}, typed AS (SELECT * REPLACE (try_cast(latitude AS DOUBLE) AS latitude,
  try_cast(longitude AS DOUBLE) AS longitude) FROM raw),
flagged AS (SELECT *, {fx.FLAG_COLUMNS} FROM typed), scored AS (SELECT *, {fx.SCORE_COLUMN} FROM flagged)"""


def _scored(spark, sf_dir):
    typed = conform.enforce_types(fx.messy_places(spark, sf_dir), fx.FIELDS)
    return conform.add_quality(typed, fx.PLACES.score)


@query("flag_valid_location", FLAGGED + " SELECT seq, is_valid_location FROM scored")
def flag_valid_location(spark, sf_dir):
    return _scored(spark, sf_dir).select("seq", "is_valid_location")


@query("flag_complete", FLAGGED + " SELECT seq, has_complete_address FROM scored")
def flag_complete(spark, sf_dir):
    return _scored(spark, sf_dir).select("seq", "has_complete_address")


@query("quality_score", FLAGGED + " SELECT seq, data_quality_score FROM scored")
def quality_score(spark, sf_dir):
    return _scored(spark, sf_dir).select("seq", "data_quality_score")


@query(
    "quality_band",
    FLAGGED
    + """ SELECT seq,
      CASE WHEN data_quality_score >= 80 THEN 'Excellent' WHEN data_quality_score >= 60 THEN 'Good'
           WHEN data_quality_score >= 40 THEN 'Fair' ELSE 'Poor' END AS band,
      CASE WHEN data_quality_score >= 90 THEN 'Excellent' WHEN data_quality_score >= 75 THEN 'Good'
           WHEN data_quality_score >= 50 THEN 'Fair' ELSE 'Poor' END AS strict_band FROM scored""",
)
def quality_band(spark, sf_dir):
    score = F.col("data_quality_score")
    return _scored(spark, sf_dir).select(
        "seq",
        quality.score_band(score).alias("band"),
        quality.score_band(score, quality.BANDS_90_75_50).alias("strict_band"),
    )


# Quantities as text; every eleventh one is not a number and every thirteenth is missing.
AMOUNTS = """
SELECT l_orderkey, l_linenumber,
  CASE WHEN l_partkey % 11 = 0 THEN concat('n', CAST(l_partkey AS STRING))
       WHEN l_partkey % 13 = 0 THEN NULL
       ELSE concat(CAST(l_partkey AS STRING), '.', CAST(l_linenumber AS STRING)) END AS amount
FROM {lineitem}"""
AMOUNTS_CTE = "amounts AS (" + AMOUNTS.format(lineitem="lineitem") + ")"


def _amounts(spark, sf_dir):
    return spark.sql(AMOUNTS, lineitem=fx.table(spark, sf_dir, "lineitem"))


@query(
    "to_float_null",
    f"WITH {AMOUNTS_CTE} SELECT * REPLACE (try_cast(amount AS DOUBLE) AS amount) FROM amounts",
)
def to_float_null(spark, sf_dir):
    return records.convert_fields_to_float(_amounts(spark, sf_dir), ["amount", "absent"])


@query(
    "to_float_skip",
    f"WITH {AMOUNTS_CTE} SELECT *, try_cast(amount AS DOUBLE) AS amount_num FROM amounts",
)
def to_float_skip(spark, sf_dir):
    return records.convert_fields_to_float(_amounts(spark, sf_dir), ["amount"], "skip")


@query(
    "to_int_null",
    f"""WITH {AMOUNTS_CTE} SELECT * REPLACE
        (CAST(trunc(try_cast(amount AS DOUBLE)) AS BIGINT) AS amount) FROM amounts""",
)
def to_int_null(spark, sf_dir):
    return records.convert_fields_to_int(_amounts(spark, sf_dir), ["amount"])


@query("normalize_empty", f"WITH {fx.RAW_CTE} SELECT seq, name, nullif(street, '') AS street FROM raw")
def normalize_empty(spark, sf_dir):
    places = fx.messy_places(spark, sf_dir).select("seq", "name", "street")
    return records.normalize_empty_strings(places, ["street"])


@query(
    "silver_conform",
    f"WITH {fx.SILVER_CTE} SELECT {', '.join(fx.SILVER_COLUMNS)} FROM silver",
)
def silver_conform(spark, sf_dir):
    return fx.conformed_places(spark, sf_dir).select(*fx.SILVER_COLUMNS)


@query(
    "dedup_keep_latest",
    """SELECT event_id, user_id, event_type, value FROM events
       QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
)
def dedup_keep_latest(spark, sf_dir):
    events = fx.table(spark, sf_dir, "events")
    latest = dedup.keep_latest(events, "user_id", [F.desc("ts"), F.desc("event_id")])
    return latest.select("event_id", "user_id", "event_type", "value")


@query(
    "dedup_report",
    """SELECT count(*) AS rows_read, count(DISTINCT user_id) AS rows_kept,
         count(*) - count(DISTINCT user_id) AS duplicates_removed FROM events""",
)
def dedup_report(spark, sf_dir):
    return dedup.dedup_report(fx.table(spark, sf_dir, "events"), "user_id")


@query("preview_head", f"WITH {fx.RAW_CTE} SELECT id, name, seq FROM raw ORDER BY seq LIMIT 5")
def preview_head(spark, sf_dir):
    return preview.head(fx.messy_places(spark, sf_dir), ["seq"]).select("id", "name", "seq")


@query("preview_tail", f"WITH {fx.RAW_CTE} SELECT id, name, seq FROM raw ORDER BY seq DESC LIMIT 5")
def preview_tail(spark, sf_dir):
    return preview.tail(fx.messy_places(spark, sf_dir), ["seq"]).select("id", "name", "seq")
