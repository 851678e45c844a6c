"""The newest record of every key, kept up to date as runs land.

A streaming aggregate holds the newest record per date and key in its state and gives out the keys
that a batch changed; these replace their rows in a table partitioned by date and cell (a hash of
the key), of which only the cells with changes are written. A batch that is repeated after a
failure changes nothing: it brings records that are there already.

State has a row per key, so use the RocksDB provider for it
(``spark.sql.streaming.stateStore.providerClass``); rebuilding dates as a whole
(``arrivals.follow_landed``) needs none.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from strata.operators.parse import parse_payload
from strata.plans import daily
from strata.plans.specs import DatasetSpec
from strata.sources import landing, storage, tables

CELL = "_cell"


def _arriving(spark: SparkSession, spec: DatasetSpec, layout: daily.Layout) -> DataFrame:
    """Records of the dataset's runs as they land, as ``landing.scan`` gives them."""
    parts = []
    for extension, whole in (("json", True), ("jsonl", False)):
        pattern = f"{layout.landing}/{spec.name}_bronze_{spec.source}_*.{extension}"
        text = spark.readStream.schema("value string").option("wholetext", whole).format("text").load(pattern)
        text = text.select("value", F.col("_metadata.file_path").alias("_path"))
        if whole:
            parsed = text.select("_path", F.from_json("value", "array<string>").alias("_elements"))
            parts.append(parsed.select("_path", F.posexplode("_elements").alias("_position", "payload")))
        else:
            lines = text.filter(F.trim("value") != "")
            parts.append(lines.select("_path", F.lit(None).cast("int").alias("_position"), F.col("value").alias("payload")))
    name = lambda i: F.regexp_extract("_path", f"([^/]+?){landing.RUN_PATTERN[len('(.+?)'):]}(?:/|$)", i)
    micros = F.coalesce(F.nullif(name(6), F.lit("")), F.lit("000000"))
    time = F.regexp_replace(F.concat(name(4), name(5)), r"(\d{4})(\d\d)(\d\d)(\d\d)(\d\d)(\d\d)", "$1-$2-$3 $4:$5:$6")
    landed_at = F.concat(time, F.lit("."), micros).try_cast("timestamp")
    return reduce(DataFrame.unionByName, parts).select(
        "payload",
        landed_at.alias("_ingest_ts"),
        # Nullable whichever layouts a batch has: the state's columns must not change.
        F.when(F.col("_position") >= 0, F.col("_position")).alias("_position"),
        F.xxhash64("payload").alias("_record_hash"),
        name(3).alias(tables.DATE_COLUMN),
    )


def _cell(key: str, cells: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(cells)).cast("string")


def follow_newest(
    spark: SparkSession,
    spec: DatasetSpec,
    layout: daily.Layout,
    target: str,
    checkpoint: str,
    cells: int = 16,
) -> StreamingQuery:
    """Handles everything landed so far and then stops; ``target`` is a dated table of the parsed
    fields and run columns, read by ``tables.read_dated``.

    The rule is that of ``landing.load_latest``: newest run, then last position, then record hash;
    records without a key are one key. Array files that are no arrays are passed over.
    """
    parsed = parse_payload(_arriving(spark, spec, layout), spec.fields, keep=[*landing.RUN_COLUMNS, tables.DATE_COLUMN])
    columns = [c for c in parsed.columns if c != tables.DATE_COLUMN]
    # Null sorts lowest in a struct, so lines without a position come last, as in the batch rule.
    order = F.struct(*landing.RUN_COLUMNS)
    newest = (
        parsed.groupBy(tables.DATE_COLUMN, F.col(spec.key).alias("_key"))
        .agg(F.max_by(F.struct(*columns), order).alias("r"))
        .select(tables.DATE_COLUMN, "r.*")
    )

    def replace(batch: DataFrame, _: int) -> None:
        changed = storage.workspace(spark, "changed")
        aside = storage.workspace(spark, "cells")
        try:
            batch.withColumn(CELL, _cell(spec.key, cells)).write.parquet(changed)
            new = spark.read.schema(batch.withColumn(CELL, F.lit("")).schema).parquet(changed)
            rows = new
            if storage.exists(spark, f"{target.rstrip('/')}/{tables.SCHEMA_FILE}"):
                there = tables.read_dated(spark, target).join(
                    new.select(tables.DATE_COLUMN, CELL).distinct(), [tables.DATE_COLUMN, CELL], "left_semi"
                )
                gone = new.select(tables.DATE_COLUMN, F.col(spec.key).alias("_key"))
                same = (there[tables.DATE_COLUMN] == gone[tables.DATE_COLUMN]) & there[spec.key].eqNullSafe(gone["_key"])
                rows = there.join(gone, same, "left_anti").select(*new.columns).unionByName(new)
            # Stored first: the cells that are replaced are read for it.
            rows.write.parquet(aside)
            stored = spark.read.schema(rows.schema).parquet(aside)
            if not stored.isEmpty():
                tables.write_dated(stored, target, partition_by=[CELL], replace="cells")
        finally:
            storage.delete(spark, changed)
            storage.delete(spark, aside)

    return (
        newest.writeStream.outputMode("update")
        .foreachBatch(replace)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
