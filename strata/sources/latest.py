"""The newest record of every key as a bucketed table, brought up to date without reshuffling it.

The table is bucketed and sorted by its key. The newest new records per key are dealt into as many
parts, and a merge join with the stored side needs no exchange there: a day moves its own
records, however many the table holds.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.dedup import keep_latest

#: Columns that order the records of a key; the larger is the newer, null the oldest.
ORDER = ("_ingest_ts", "_position", "_record_hash")


def _newest_first(order: Sequence[str]) -> list[Column]:
    return [F.desc_nulls_last(c) for c in order]


def exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def create(
    df: DataFrame, name: str, path: str, key: str, buckets: int, order: Sequence[str] = ORDER
) -> None:
    """The newest record per key of ``df`` as table ``name`` with its files under ``path``."""
    # Dealt out after the newest are known: before, a frequent key would be one large part.
    parts = keep_latest(df, key, _newest_first(order)).repartition(buckets, key)
    _write(parts, name, f"{path.rstrip('/')}/{uuid.uuid4().hex}", key, buckets)


def _write(df: DataFrame, name: str, location: str, key: str, buckets: int) -> None:
    df.write.format("parquet").bucketBy(buckets, key).sortBy(key).option("path", location).saveAsTable(name)


def _buckets(spark: SparkSession, name: str) -> int:
    described = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect()}
    return int(described["Num Buckets"])


def merged(spark: SparkSession, new: DataFrame, name: str, key: str, order: Sequence[str] = ORDER) -> DataFrame:
    """The newest record per key of the table and of ``new``, with the table's columns.

    The one record without a key is the newest of these. A record that is in both counts once.
    """
    stored, buckets = spark.table(name), _buckets(spark, name)
    columns = stored.columns
    newest = keep_latest(new.select(*columns), key, _newest_first(order)).repartition(buckets, key)
    row = lambda df, side: df.filter(F.col(key).isNotNull()).select(F.col(key).alias("_key"), F.struct(*columns).alias(side))
    both = row(stored, "_old").join(row(newest, "_new"), "_key", "full")
    rank = lambda side: F.struct(*[F.col(f"{side}.{c}") for c in order])
    replaced = F.col("_old").isNull() | (F.col("_new").isNotNull() & (rank("_new") > rank("_old")))
    keyed = both.select(F.when(replaced, F.col("_new")).otherwise(F.col("_old")).alias("r")).select("r.*")
    # At most a record of each side has no key.
    bare = reduce(DataFrame.unionByName, [df.filter(F.col(key).isNull()) for df in (stored, newest)])
    return keyed.unionByName(keep_latest(bare, key, _newest_first(order)))


def refresh(
    spark: SparkSession, new: DataFrame, name: str, path: str, key: str, order: Sequence[str] = ORDER
) -> None:
    """Brings the table up to date with ``new``: written aside as a table of its own, which then
    takes the name. Readers of the old one keep its files, which are left to them."""
    aside = f"{name}_{uuid.uuid4().hex[:12]}"
    _write(merged(spark, new, name, key, order), aside, f"{path.rstrip('/')}/{uuid.uuid4().hex}", key, _buckets(spark, name))
    spark.sql(f"DROP TABLE {name}")
    spark.sql(f"ALTER TABLE {aside} RENAME TO {name}")
