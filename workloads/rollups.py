"""Queries for aggregation by dimensions and the gold tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators import rollup
from strata.plans.specs import dataset_from_config
from workloads import fixtures as fx
from workloads.registry import query


def _share(count: str, total: str) -> str:
    exact = f"CAST({count} * 100.0 AS DECIMAL(30, 12)) / {total}"
    return f"CAST(round(CAST({exact} AS DECIMAL(30, 12)), 2) AS DOUBLE)"


def _orders(spark, sf_dir):
    return fx.table(spark, sf_dir, "orders")


def _lines(spark, sf_dir):
    return fx.table(spark, sf_dir, "lineitem")


def _cents(df, *names):
    """Sums of doubles depend on the order of addition; compare them in cents."""
    return df.withColumns({n: F.round(n, 2) for n in names}).drop("_created_at")


@query(
    "agg_one_dim",
    "SELECT o_orderstatus, count(*) AS record_count, count(*) AS n FROM orders GROUP BY ALL",
)
def agg_one_dim(spark, sf_dir):
    return rollup.aggregate_by_dimensions(
        _orders(spark, sf_dir), ["o_orderstatus"], additional_aggs={"n": "count"}
    ).drop("_created_at")


@query(
    "agg_multi_dim",
    """SELECT l_returnflag, l_linestatus, l_linenumber, count(*) AS record_count
       FROM lineitem GROUP BY ALL""",
)
def agg_multi_dim(spark, sf_dir):
    dims = ["l_returnflag", "l_linestatus", "l_linenumber"]
    return rollup.aggregate_by_dimensions(_lines(spark, sf_dir), dims).drop("_created_at")


@query(
    "agg_avg",
    """SELECT l_returnflag, l_linestatus, round(avg(l_extendedprice), 2) AS avg_price
       FROM lineitem GROUP BY ALL""",
)
def agg_avg(spark, sf_dir):
    return _cents(
        rollup.aggregate_by_dimensions(
            _lines(spark, sf_dir),
            ["l_returnflag", "l_linestatus"],
            include_count=False,
            additional_aggs={"avg_price": ("l_extendedprice", "avg")},
        ),
        "avg_price",
    )


@query(
    "agg_sum",
    """SELECT o_orderpriority, round(sum(o_totalprice), 2) AS total, count(*) AS record_count
       FROM orders GROUP BY ALL""",
)
def agg_sum(spark, sf_dir):
    return _cents(
        rollup.aggregate_by_dimensions(
            _orders(spark, sf_dir), ["o_orderpriority"], additional_aggs={"total": ("o_totalprice", "sum")}
        ),
        "total",
    )


@query(
    "agg_min_max",
    """SELECT o_orderstatus, min(o_totalprice) AS lowest, max(o_totalprice) AS highest,
         count(*) AS record_count FROM orders GROUP BY ALL""",
)
def agg_min_max(spark, sf_dir):
    return rollup.aggregate_by_dimensions(
        _orders(spark, sf_dir),
        ["o_orderstatus"],
        additional_aggs={"lowest": ("o_totalprice", "min"), "highest": ("o_totalprice", "max")},
    ).drop("_created_at")


@query(
    "agg_count_distinct",
    """SELECT o_orderpriority, count(DISTINCT o_custkey) AS customers, count(*) AS record_count
       FROM orders GROUP BY ALL""",
)
def agg_count_distinct(spark, sf_dir):
    return rollup.aggregate_by_dimensions(
        _orders(spark, sf_dir),
        ["o_orderpriority"],
        additional_aggs={"customers": ("o_custkey", "count_distinct")},
    ).drop("_created_at")


@query(
    "agg_collect_set",
    """SELECT l_returnflag, list_aggregate(list_sort(list(DISTINCT l_linestatus)), 'string_agg', ',')
         AS statuses, count(*) AS record_count FROM lineitem GROUP BY ALL""",
)
def agg_collect_set(spark, sf_dir):
    return rollup.aggregate_by_dimensions(
        _lines(spark, sf_dir),
        ["l_returnflag"],
        additional_aggs={"statuses": ("l_linestatus", "collect_set")},
    ).select("l_returnflag", F.array_join("statuses", ",").alias("statuses"), "record_count")


@query(
    "agg_percentage",
    f"""SELECT o_orderstatus, o_orderpriority, count(*) AS record_count, round(sum(o_totalprice), 2) AS total,
         {_share('count(*)', '(SELECT count(*) FROM orders)')} AS percentage_of_total
        FROM orders GROUP BY ALL""",
)
def agg_percentage(spark, sf_dir):
    return _cents(
        rollup.aggregate_by_dimensions(
            _orders(spark, sf_dir),
            ["o_orderstatus", "o_orderpriority"],
            include_percentage=True,
            additional_aggs={"total": ("o_totalprice", "sum")},
        ),
        "total",
    )


@query(
    "agg_conditional_count",
    f"""WITH {fx.SILVER_CTE} SELECT kind, count(*) AS record_count,
          CAST(sum(CASE WHEN is_valid_location THEN 1 ELSE 0 END) AS BIGINT) AS located,
          CAST(sum(CASE WHEN phone IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS with_phone
        FROM silver GROUP BY kind""",
)
def agg_conditional_count(spark, sf_dir):
    return rollup.aggregate_by_dimensions(
        fx.conformed_places(spark, sf_dir),
        ["kind"],
        additional_aggs={
            "located": ("is_valid_location", "count_true"),
            "with_phone": ("phone", "count_present"),
        },
    ).drop("_created_at")


BY_KIND, BY_LOCATION, BY_KIND_LOCATION, QUALITY = fx.PLACES.rollups
TOTAL = "(SELECT count(*) FROM silver)"

GOLD_SQL = {
    "by_kind": f"""SELECT kind, count(*) AS record_count,
        {_share('count(*)', TOTAL)} AS percentage_of_total FROM silver GROUP BY kind""",
    "by_location": f"""SELECT country, state, count(*) AS record_count,
        count(DISTINCT city) AS city_count,
        list_aggregate(list_sort(list(DISTINCT kind)), 'string_agg', ',') AS kinds,
        {_share('count(*)', TOTAL)} AS percentage_of_total FROM silver GROUP BY country, state""",
    "by_kind_location": f"""SELECT country, state, city, kind, count(*) AS record_count,
        {_share('count(*)', TOTAL)} AS percentage_of_total
        FROM silver GROUP BY country, state, city, kind""",
    "quality_metrics": """SELECT count(*) AS total_records,
        count(DISTINCT country) AS country_count, count(DISTINCT state) AS state_count,
        count(DISTINCT city) AS city_count, count(DISTINCT kind) AS kind_count,
        CAST(round(CAST(avg(data_quality_score) AS DECIMAL(18, 9)), 2) AS DOUBLE) AS avg_quality_score,
        min(data_quality_score) AS min_quality_score, max(data_quality_score) AS max_quality_score,
        CAST(sum(CASE WHEN is_valid_location THEN 1 ELSE 0 END) AS BIGINT) AS valid_location_count,
        CAST(sum(CASE WHEN has_complete_address THEN 1 ELSE 0 END) AS BIGINT) AS complete_address_count,
        CAST(sum(CASE WHEN phone IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS records_with_phone,
        CAST(sum(CASE WHEN website_url IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS records_with_website
        FROM silver""",
}


def gold(spark, sf_dir, spec):
    return rollup.aggregate(fx.conformed_places(spark, sf_dir), spec).drop("_created_at")


@query("gold_by_kind", f"WITH {fx.SILVER_CTE} {GOLD_SQL['by_kind']}")
def gold_by_kind(spark, sf_dir):
    return gold(spark, sf_dir, BY_KIND)


def joined_kinds(df):
    return df.withColumn("kinds", F.array_join("kinds", ","))


@query("gold_by_location", f"WITH {fx.SILVER_CTE} {GOLD_SQL['by_location']}")
def gold_by_location(spark, sf_dir):
    return joined_kinds(gold(spark, sf_dir, BY_LOCATION))


@query("gold_by_kind_location", f"WITH {fx.SILVER_CTE} {GOLD_SQL['by_kind_location']}")
def gold_by_kind_location(spark, sf_dir):
    return gold(spark, sf_dir, BY_KIND_LOCATION)


@query("gold_quality_metrics", f"WITH {fx.SILVER_CTE} {GOLD_SQL['quality_metrics']}")
def gold_quality_metrics(spark, sf_dir):
    return gold(spark, sf_dir, QUALITY)


@query(
    "agg_three_distinct",
    """SELECT l_returnflag, count(*) AS record_count, count(DISTINCT l_partkey) AS parts,
              count(DISTINCT l_suppkey) AS suppliers, count(DISTINCT l_orderkey) AS orders
       FROM lineitem GROUP BY l_returnflag""",
)
def agg_three_distinct(spark, sf_dir):
    """Distinct counts of wide columns, each in a pass of its own."""
    wanted = {"parts": "l_partkey", "suppliers": "l_suppkey", "orders": "l_orderkey"}
    measures = {alias: (column, "count_distinct") for alias, column in wanted.items()}
    return rollup.aggregate_by_dimensions(
        _lines(spark, sf_dir), ["l_returnflag"], additional_aggs=measures
    ).drop("_created_at")


SETTINGS = {
    "schemas": {"silver": {"fields": [{"name": n, "type": "string"} for n in fx.NAMES]}},
    "transformations": {
        "gold": {
            "aggregations": [
                {"name": "by_kind", "group_by": ["kind"], "metrics": ["record_count", "percentage_of_total"]},
                {
                    "name": "by_location",
                    "group_by": ["country", "state"],
                    "metrics": ["record_count", "percentage_of_total", "city_count", "kinds"],
                },
                {
                    "name": "by_kind_location",
                    "group_by": ["country", "state", "city", "kind"],
                    "metrics": ["record_count", "percentage_of_total"],
                },
                {
                    "name": "health",
                    "metrics": ["total_records", "avg_quality_score", "valid_location_count", "complete_address_count"],
                },
            ]
        }
    },
}


@query(
    "gold_from_settings",
    f"""WITH {fx.SILVER_CTE}
        SELECT 'by_kind' AS name, count(*) AS n, CAST(sum(c) AS BIGINT) AS records, CAST(NULL AS DOUBLE) AS extra
          FROM (SELECT count(*) AS c FROM silver GROUP BY kind)
        UNION ALL SELECT 'by_location', count(*), CAST(sum(c) AS BIGINT), CAST(sum(k + t) AS DOUBLE)
          FROM (SELECT count(*) AS c, count(DISTINCT kind) AS k, count(DISTINCT city) AS t FROM silver GROUP BY country, state)
        UNION ALL SELECT 'by_kind_location', count(*), CAST(sum(c) AS BIGINT), NULL
          FROM (SELECT count(*) AS c FROM silver GROUP BY country, state, city, kind)
        UNION ALL SELECT 'health', 1, count(*), round(avg(data_quality_score), 2)
          + count(*) FILTER (is_valid_location) + count(*) FILTER (has_complete_address) FROM silver""",
)
def gold_from_settings(spark, sf_dir):
    """The four tables that settings declare by metric names alone, summed up."""
    silver = fx.conformed_places(spark, sf_dir)
    parts = []
    for spec in dataset_from_config("places", SETTINGS).rollups:
        table = rollup.aggregate(silver, spec)
        if spec.name == "by_location":
            extra = F.sum(F.size("kinds") + F.col("city_count")).cast("double")
        elif spec.name == "health":
            extra = F.sum(F.col("avg_quality_score") + F.col("valid_location_count") + F.col("complete_address_count"))
        else:
            extra = F.lit(None).cast("double")
        records = "total_records" if spec.name == "health" else "record_count"
        parts.append(
            table.agg(F.count("*").alias("n"), F.sum(records).alias("records"), extra.alias("extra")).withColumn(
                "name", F.lit(spec.name)
            )
        )
    return reduce(DataFrame.unionByName, parts)
