"""Rebuild the dates that received new runs since the last call.

The same gated day as the daily batch, started by arrivals instead of a calendar: a file stream
remembers in its checkpoint which landed files it has seen, and each date with something
new is rebuilt as a whole. That keeps the keep-latest rule exact without holding keys in
state, and repeating a batch after a failure gives the same table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from strata.plans import daily
from strata.plans.specs import DatasetSpec
from strata.sources import landing

FILES = "path string, modificationTime timestamp, length bigint, content binary"


def follow_landed(
    spark: SparkSession, spec: DatasetSpec, layout: daily.Layout, checkpoint: str
) -> StreamingQuery:
    """Start a query that handles everything landed so far and then stops.

    Runs of other datasets or sources in the folder are passed over. A date that fails its
    checks ends the query; it is tried again at the next start.
    """
    files = (
        spark.readStream.format("binaryFile")
        .schema(FILES)
        .load(f"{layout.landing}/*_bronze_*")
        .select("path")  # contents are not read here
    )

    def rebuild(batch: DataFrame, _: int) -> None:
        dates = landing.landed_dates(batch, spec.name, spec.source)
        for row in dates.sort("date").collect():  # as many rows as dates with new runs
            daily.run_day(spark, spec, layout, row.date)

    return (
        files.writeStream.foreachBatch(rebuild)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
