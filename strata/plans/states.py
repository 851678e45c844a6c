"""Gold over many dates from one mergeable state per date.

A new date reads its own silver rows only and leaves a state; a rollup over any dates merges the
states. A state is exact: counts, sums, minima and maxima at the finest declared grain, the values
of collected sets, and for distinct counts of columns outside that grain bitmaps of dictionary
codes, 4 KB for each 32,768 codes of a group. A rerun replaces the state of its date.

    states.update(spark, spec, layout, "2026-01-25")
    states.build_gold(spark, spec, layout, "2026-01-25")   # over all dates with a state
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.operators import rollup
from strata.plans import daily
from strata.plans.specs import DatasetSpec, RollupSpec
from strata.sources import storage, tables

#: New values of a dictionary that are numbered together.
NUMBERED = 100_000


def _root(layout: daily.Layout, spec: DatasetSpec) -> str:
    return f"{layout.gold.rstrip('/')}_states/{spec.name}"


def _fingerprint(names: Iterable[str]) -> str:
    return "_".join(names) or "all"


def encode(spark: SparkSession, values: DataFrame, path: str) -> DataFrame:
    """value, code for the distinct non-null texts in ``values`` (one column), from the dictionary
    at ``path``; new ones are added to it. Codes begin with 1 and never change; one writer at a
    time. A rerun after a failure numbers what is missing again.

    New values are numbered within hash buckets of about NUMBERED, so no task gets them all.
    """
    own = values.select(F.col(values.columns[0]).cast("string").alias("value")).filter("value IS NOT NULL").distinct()
    schema = "value string, code bigint"
    known = spark.read.schema(schema).parquet(path) if storage.exists(spark, path) else spark.createDataFrame([], schema)
    aside = storage.workspace(spark, "dictionary")
    own.join(known, "value", "left_anti").write.parquet(aside)
    new = spark.read.schema("value string").parquet(aside)
    count, last = new.count(), known.agg(F.max("code")).first()[0] or 0
    if count:
        bucket = F.pmod(F.xxhash64("value"), F.lit(-(-count // NUMBERED)))
        sized = new.groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n"))
        # As many rows as buckets.
        before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        starts = sized.select("bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
        nth = F.row_number().over(Window.partitionBy("bucket").orderBy("value"))
        placed = new.withColumn("bucket", bucket).withColumn("nth", nth).join(starts, "bucket")
        numbered = placed.select("value", (F.lit(last) + F.col("first") + F.col("nth")).cast("long").alias("code"))
        numbered.write.mode("append").parquet(path)
    storage.delete(spark, aside)
    return own.join(spark.read.schema(schema).parquet(path), "value") if count or last else own.join(known, "value")


def _bitmaps(spark: SparkSession, source: DataFrame, dimensions: tuple[str, ...], column: str, path: str) -> DataFrame:
    """The distinct values of ``column`` by dimensions as bitmaps of their codes."""
    pairs = source.select(*dimensions, F.col(column).cast("string").alias("_value")).filter("_value IS NOT NULL").distinct()
    codes = encode(spark, pairs.select("_value"), path).withColumnRenamed("value", "_value")
    coded = pairs.join(codes, "_value")
    return coded.groupBy(*dimensions, F.bitmap_bucket_number("code").alias("_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("code")).alias("_bits")
    )


def _plans(source: DataFrame, spec: DatasetSpec) -> list[tuple[list[str] | None, list[RollupSpec]]]:
    for r in spec.rollups:
        rollup.require_dimensions(source, r.dimensions)
    return rollup.plan_bases([rollup.available(source, r) for r in spec.rollups])


def update(spark: SparkSession, spec: DatasetSpec, layout: daily.Layout, date: str) -> dict[str, int]:
    """Writes the state of a date from its silver rows; the rows of each of its tables by name."""
    source, root, written = daily.read_silver(spark, layout, date), _root(layout, spec), {}

    def store(name: str, table: DataFrame) -> None:
        written[name] = tables.write_dated(table, f"{root}/{name}", date, fmt=layout.fmt)["records_written"]

    for grain, covered in _plans(source, spec):
        if grain is not None:
            store(f"base_{_fingerprint(grain)}", rollup.base_for(source, covered, grain))
            continue
        for r in covered:
            plain, apart = rollup.separate(r)
            store(f"plain_{r.name}", rollup.base_for(source, [plain], plain.dimensions))
            for column, measures in apart.items():
                if any(f == "collect_set" for _, f in measures.values()):
                    one = rollup.distinct_rollup(r, column, measures)
                    store(f"values_{r.name}_{column}", rollup.base_for(source, [one], [*r.dimensions, column]))
                else:
                    bits = _bitmaps(spark, source, r.dimensions, column, f"{root}/dictionary_{column}")
                    store(f"bits_{r.name}_{column}", bits)
    return written


def merged(
    spark: SparkSession, spec: DatasetSpec, layout: daily.Layout, dates: Iterable[str] | None = None
) -> dict[str, DataFrame]:
    """Every rollup of the dataset over the states of ``dates`` (None: of all), by name."""
    source, root, found = daily.read_silver(spark, layout), _root(layout, spec), {}
    wanted = None if dates is None else sorted(set(dates))

    def read(name: str) -> DataFrame:
        table = tables.read_dated(spark, f"{root}/{name}", fmt=layout.fmt)
        some = table if wanted is None else table.filter(F.col(tables.DATE_COLUMN).isin(wanted))
        return some.drop(tables.DATE_COLUMN)

    # Only the columns of silver are asked for here, not its rows.
    for grain, covered in _plans(source, spec):
        if grain is not None:
            base = read(f"base_{_fingerprint(grain)}")
            found.update({r.name: rollup.rollup(base, r) for r in covered})
            continue
        for r in covered:
            plain, apart = rollup.separate(r)
            parts = {}
            for column, measures in apart.items():
                if any(f == "collect_set" for _, f in measures.values()):
                    one = rollup.distinct_rollup(r, column, measures)
                    parts[column] = rollup.rollup(read(f"values_{r.name}_{column}"), one).drop("_created_at")
                else:
                    parts[column] = _counted(read(f"bits_{r.name}_{column}"), r.dimensions, list(measures))
            found[r.name] = rollup.assembled(read(f"plain_{r.name}"), r, parts)
    return found


def _counted(bits: DataFrame, dimensions: tuple[str, ...], names: list[str]) -> DataFrame:
    """The bits set in the union of the bitmaps of each group, under each of the names."""
    union = bits.groupBy(*dimensions, "_bucket").agg(F.bitmap_count(F.bitmap_or_agg("_bits")).alias("_n"))
    total = F.coalesce(F.sum("_n"), F.lit(0).cast("long"))
    return union.groupBy(*dimensions).agg(*[total.alias(n) for n in names])


def build_gold(
    spark: SparkSession,
    spec: DatasetSpec,
    layout: daily.Layout,
    date: str,
    dates: Iterable[str] | None = None,
    now: datetime | None = None,
) -> dict[str, dict]:
    """A snapshot of every rollup over the states of ``dates`` (None: of all)."""
    return {
        name: tables.write_snapshot(table, layout.gold, name, date, layout.fmt, now)
        for name, table in merged(spark, spec, layout, dates).items()
    }
