"""Value maps held as tables: ordered rules resolved by joins, however many there are."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.sources import storage

#: Rules of a stretch of the order; neighbours are looked for within one, then between them.
STRETCH = 1 << 16
#: Rounds double the rules that a value has passed; 60 pass any number of rules.
MAX_ROUNDS = 60


def _stored(df: DataFrame) -> tuple[DataFrame, str]:
    path = storage.workspace(df.sparkSession, "rules")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def _following(rules: DataFrame) -> DataFrame:
    """at, target, next: the first later rule for what the rule produces (null: none).

    A value that very many rules produce is looked up by stretches of the order, so that no task
    gets all of these rules.
    """
    events = rules.select(F.col("source").alias("key"), "at", F.col("at").alias("rule"), F.lit(None).cast("string").alias("target")).unionByName(
        rules.select(F.lower("target").alias("key"), "at", F.lit(None).cast("long").alias("rule"), "target")
    )
    events = events.withColumn("stretch", F.floor(F.col("at") / STRETCH))
    here = Window.partitionBy("key", "stretch").orderBy("at").rangeBetween(1, Window.unboundedFollowing)
    local = events.withColumn("near", F.min("rule").over(here))
    firsts = events.filter("rule IS NOT NULL").groupBy("key", "stretch").agg(F.min("rule").alias("first"))
    asked = events.filter("rule IS NULL").select("key", "stretch").distinct()
    beyond = Window.partitionBy("key").orderBy("stretch").rowsBetween(1, Window.unboundedFollowing)
    far = asked.join(firsts, ["key", "stretch"], "full").select("key", "stretch", F.min("first").over(beyond).alias("far"))
    wanted = local.filter("rule IS NULL").join(far, ["key", "stretch"], "left")
    return wanted.select("at", "target", F.coalesce("near", "far").alias("next"))


def resolve_rules(rules: DataFrame, order: str = "position", source: str = "source", target: str = "target") -> DataFrame:
    """source (lower case), target: what each value becomes after all rules, one row per source.

    The rules apply one after the other in ``order`` (whole numbers, each once): a later rule also
    sees what an earlier one produced, an earlier one does not, so ``a -> b, b -> a`` leaves ``a``
    as it is and no chain is endless. Sources match in any case; of several rules for a source the
    first one counts. Rules without source or target are left out.

    Chains are followed by pointer doubling: a round joins each rule's end with the end of that,
    so ``log2`` of the longest chain rounds suffice; nothing is collected.
    """
    given, given_at = _stored(
        rules.select(
            F.col(order).cast("long").alias("at"), F.lower(F.col(source)).alias("source"), F.col(target).alias("target")
        ).filter("at IS NOT NULL AND source IS NOT NULL AND target IS NOT NULL")
    )
    # end: the last rule known to be passed; more: that one has a follower.
    ends, aside = _stored(_following(given).select("at", F.coalesce("next", "at").alias("end"), F.col("next").isNotNull().alias("more")))
    for _ in range(MAX_ROUNDS):
        if ends.filter("more").isEmpty():
            break
        onward = ends.select(F.col("at").alias("end"), F.col("end").alias("further"))
        joined = ends.join(onward, "end").select("at", F.col("further").alias("end"), (F.col("further") != F.col("end")).alias("more"))
        before = aside
        ends, aside = _stored(joined)
        storage.delete(given.sparkSession, before)
    produced = given.select(F.col("at").alias("end"), F.col("target").alias("final"))
    first = given.groupBy("source").agg(F.min("at").alias("at"))
    found, _ = _stored(
        first.join(ends, "at").join(produced, "end").select("source", F.col("final").alias("target"))
    )
    storage.delete(given.sparkSession, aside)
    storage.delete(given.sparkSession, given_at)
    return found
