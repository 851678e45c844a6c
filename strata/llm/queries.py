"""The queries over the test tables, one for each operator, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.centroids import cluster_vectors
from strata.llm.decontaminate import contamination_report
from strata.llm.exact_dedup import exact_duplicates
from strata.llm.html_text import extract_pages
from strata.llm.language_id import detect_languages
from strata.llm.licenses import NOTICES, TEXTS, scan_licenses
from strata.llm.line_dedup import repeated_units
from strata.llm.mixing import mix_sources
from strata.llm.near_dedup import near_duplicates
from strata.llm.negatives import mine_hard_negatives
from strata.llm.packing import pack_documents
from strata.llm.quality import classify_quality
from strata.llm.suffix_dedup import repeated_passages

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(run):
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


OP10_SQL = r"""
WITH texts AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body FROM documents
), named AS (
  SELECT doc_id, body, sha256(body) AS text_sha256 FROM texts
)
SELECT doc_id,
       min(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       doc_id = min(doc_id) OVER same AS kept,
       text_sha256
FROM named WINDOW same AS (PARTITION BY body)
"""


@query("op10_exact_dedup", OP10_SQL)
def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents"))


@query("op5_language_id")
def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detect_languages(table(spark, sf_dir, "documents"))


OP7_SQL = r"""
WITH RECURSIVE words AS (
  SELECT row_number() OVER () AS r, doc_id,
         coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x20\x09-\x0D]+'), []) AS w
  FROM documents
), sets AS (
  SELECT r, doc_id,
         CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
              ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) END AS s
  FROM words
), items AS (
  SELECT r, n, hash(x) AS x FROM (SELECT r, len(s) AS n, unnest(s) AS x FROM sets)
), pairs AS (
  SELECT a.r AS a, b.r AS b
  FROM items a JOIN items b ON a.x = b.x AND a.r < b.r AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
  GROUP BY a.r, b.r, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
), links AS (
  SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs
), reach(r, c) AS (
  SELECT r, r FROM sets UNION SELECT links.b, reach.c FROM reach JOIN links ON links.a = reach.r
), named AS (
  SELECT reach.r, min(o.doc_id) AS component_id FROM reach JOIN sets o ON o.r = reach.c GROUP BY reach.r
)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM sets JOIN named USING (r)
"""


@query("op7_near_dedup", OP7_SQL)
def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), n=4, percent=80)


OP9_SQL = r"""
WITH item_words AS (
  SELECT DISTINCT item_id, words FROM (
    SELECT item_id,
           regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM benchmark)
  WHERE len(words) > 0
), windows AS (
  SELECT DISTINCT item_id, least(len(words), 10) AS n,
         array_to_string(words[i:i + least(len(words), 10) - 1], ' ') AS w
  FROM (SELECT item_id, words, unnest(range(1, greatest(len(words) - 10, 0) + 2)) AS i FROM item_words)
), docs AS (
  SELECT row_number() OVER () AS r, doc_id,
         coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS words
  FROM documents
), places AS (
  SELECT r, words, n, unnest(range(1, len(words) - n + 2)) AS i
  FROM docs, (SELECT DISTINCT n FROM windows) WHERE len(words) >= n
), hits AS (
  SELECT r, i, p.n, item_id
  FROM (SELECT r, i, n, array_to_string(words[i:i + n - 1], ' ') AS w FROM places) p
  JOIN windows USING (n, w)
), covered AS (
  SELECT r, count(DISTINCT k) AS n_hit
  FROM (SELECT r, unnest(range(i, i + n)) AS k FROM hits) GROUP BY r
), found AS (
  SELECT r, count(*) AS n_items, string_agg(id, ',' ORDER BY id COLLATE C) AS ids
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS id FROM hits WHERE item_id IS NOT NULL) GROUP BY r
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN covered USING (r) LEFT JOIN found USING (r)
"""


@query("op9_decontamination", OP9_SQL)
def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op3_mixing")
def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents"))


@query("op2_html_extraction")
def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(table(spark, sf_dir, "pages"))


OP1_SQL = r"""
WITH rows AS (
  SELECT row_number() OVER (ORDER BY doc_id) AS r, doc_id,
         regexp_extract_all(text, '(?s).*?(?:\n|[.!?,;:][ \t\r\x0B\x0C]+|$)') AS parts
  FROM documents WHERE text IS NOT NULL
), cut AS (
  SELECT r, doc_id, unnest(parts) AS part, unnest(range(1, len(parts) + 1)) AS k FROM rows
), placed AS (
  SELECT r, doc_id, k,
         CASE WHEN part LIKE '%' || chr(10) THEN part[:-2]
              WHEN regexp_matches(part, '[.!?,;:][ \t\r\x0B\x0C]+$') THEN regexp_replace(part, '[ \t\r\x0B\x0C]+$', '')
              ELSE part END AS line,
         coalesce(sum(length(part)) OVER (PARTITION BY r ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start,
         regexp_extract_all(translate(part, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x20\x09-\x0D]+') AS words
  FROM cut
), units AS (
  SELECT r, doc_id, row_number() OVER (PARTITION BY r ORDER BY k) - 1 AS unit,
         start, start + length(line) AS stop, len(words) AS n_words, array_to_string(words, ' ') AS normal
  FROM placed WHERE len(words) > 0
), ranked AS (
  SELECT *, first_value(doc_id) OVER w AS keep_id, first_value(r) OVER w AS keep_r, first_value(unit) OVER w AS keep_unit
  FROM units WINDOW w AS (PARTITION BY normal ORDER BY doc_id, r, unit)
), later AS (
  SELECT *, unit - row_number() OVER (PARTITION BY r ORDER BY unit) AS run
  FROM ranked WHERE r <> keep_r OR unit <> keep_unit
), passages AS (
  SELECT *, sum(n_words) OVER (PARTITION BY r, run) AS passage FROM later
)
SELECT doc_id, unit, CAST(start AS BIGINT) AS start, CAST(stop AS BIGINT) AS "end", CAST(n_words AS BIGINT) AS n_words, keep_id, keep_unit,
       CAST(passage AS BIGINT) AS passage_words
FROM passages WHERE passage >= 30
"""


@query("op1_substring_dedup", OP1_SQL)
def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_units(table(spark, sf_dir, "documents"))


@query("op4_suffix_dedup")
def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(table(spark, sf_dir, "documents"))


@query("op6_quality_classifier")
def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


_OP8_ROWS = ", ".join("({}, '{}', '{}')".format(i, n, t.replace("'", "''")) for i, (n, t) in enumerate(NOTICES + TEXTS))
OP8_SQL = rf"""
WITH notices AS (
  SELECT id, license, list_filter(regexp_split_to_array(lower(notice), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '') AS w
  FROM (VALUES {_OP8_ROWS}) AS t(id, license, notice)
), templates AS (
  SELECT id, license, CAST(pow(2, ceil(log2(len(w)))) AS INTEGER) AS n,
         list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS p
  FROM notices
), template_pairs AS (
  SELECT id, license, n, len(p) AS size, unnest(p) AS x FROM templates
), docs AS (
  SELECT row_number() OVER () AS r, doc_id,
         list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '') AS w
  FROM documents
), paired AS (
  SELECT r, doc_id, unnest(range(0, len(w) - 1)) AS i, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS x
  FROM docs
), placed AS (
  SELECT r, doc_id, id, license, n, size, x, unnest([i // n, i // n - 1]) AS k, i FROM paired JOIN template_pairs USING (x)
), verified AS (
  SELECT r, doc_id, n, k * n AS first, id, license, list(DISTINCT x) AS s, count(DISTINCT x) / CAST(size AS DOUBLE) AS share
  FROM placed WHERE k >= 0 AND i <= k * n + 2 * n - 2 GROUP BY r, doc_id, n, k, id, license, size
), found AS (
  SELECT * FROM verified WHERE share >= 0.8
), kept AS (
  SELECT * FROM found f WHERE NOT EXISTS (
    SELECT 1 FROM found o WHERE o.r = f.r AND o.n = f.n AND abs(o.first - f.first) <= f.n AND o.share > f.share
      AND len(list_filter(f.s, lambda x: NOT list_contains(o.s, x))) = 0)
)
SELECT doc_id, license, max(share) AS containment, count(DISTINCT (n, first)) AS n_windows, CAST(min(first) AS BIGINT) AS first_word
FROM kept GROUP BY r, doc_id, license
"""


@query("op8_license_scan", OP8_SQL)
def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))


@query("op11_packing")
def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    pieces = pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


OP12_SQL = """
WITH rows AS (
  SELECT row_number() OVER () AS r, vec_id,
         CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.r, a.vec_id AS anchor_id, a.label AS own, b.r AS other, b.vec_id, b.label,
         CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
  FROM rows a JOIN rows b ON a.vec_id % 100 = 0 AND a.r <> b.r AND len(a.v) = len(b.v)
), positives AS (
  SELECT r, anchor_id, own, vec_id AS positive_id, other, score AS positive_score FROM scored WHERE label = own
  QUALIFY row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id, other) <= 5
)
SELECT p.anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY p.r, p.other ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM positives p JOIN scored s ON s.r = p.r AND s.label <> p.own
  AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY row_number() OVER (PARTITION BY p.r, p.other ORDER BY score DESC, vec_id) <= 5
"""


@query("op12_hard_negatives", OP12_SQL)
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, sf_dir, "embeddings").withColumn("label", moved)
    return mine_hard_negatives(vectors, is_anchor=F.col("vec_id") % 100 == 0)


def _op13_sql(rounds: int = 10) -> str:
    """Assignment and move of every round, written one after the other."""
    parts = [
        """WITH kept AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v,
         sha256('3:' || CAST(vec_id AS VARCHAR)) AS h
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), c0 AS (
  SELECT row_number() OVER (ORDER BY h, v) - 1 AS c, v AS m FROM (SELECT h, v FROM kept ORDER BY h, v LIMIT 8)
)"""
    ]
    for i in range(rounds + 1):
        parts.append(f"""a{i} AS MATERIALIZED (
  SELECT r, vec_id, v, c, d, m FROM (
    SELECT *, list_dot_product(v, v) - 2 * list_dot_product(v, m) + list_dot_product(m, m) AS d FROM kept, c{i}
  ) QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, c) = 1
)""")
        if i < rounds:
            parts.append(f"""m{i} AS (
  SELECT c, list(x ORDER BY k) AS m FROM (
    SELECT c, k, floor(sum(x) / count(*)) AS x FROM (SELECT c, unnest(v) AS x, unnest(range(64)) AS k FROM a{i}) GROUP BY c, k
  ) GROUP BY c
), c{i + 1} AS MATERIALIZED (
  SELECT c, coalesce(m{i}.m, c{i}.m) AS m FROM c{i} LEFT JOIN m{i} USING (c)
)""")
    return ",\n".join(parts) + f"""
SELECT vec_id, CAST(c AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance,
       CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(list_transform(m, lambda x: CAST(CAST(x AS BIGINT) AS VARCHAR)), ',')) AS centroid_sha256
FROM a{rounds}
"""


@query("op13_centroid_clustering", _op13_sql())
def op13_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    digest = F.sha2(F.array_join(F.col("centroid").cast("array<string>"), ","), 256)
    return cluster_vectors(table(spark, sf_dir, "embeddings")).select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", digest.alias("centroid_sha256")
    )
