"""Mixing sources to target weights by entropy balancing.

The mix takes every document at a rate such that each source's words meet its target: the rates
that stay closest, in relative entropy over documents, to taking each document once, and at most
CAP times. They are min(CAP, exp(l * size)) with an l for each source, so long documents give way
first where a source has too many words and come first where it has too few. The convex dual is
solved by Newton iterations over Spark aggregates. Rates become copies per class of equal source
and size, the rounding of a class carried on to the next smaller size, so a source misses its
target by no more than its small documents. Only ids, sizes and sources move; texts stay where
they are.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.shared import discard, global_rank, keep_rows, single_column, stored, text_hash

WEIGHTS = (3.0, 1.0, 2.0)
#: The mix has so many times the words of the input; no source gives more than CAP times its own.
SHARE, CAP = 1.5, 2.0
#: Newton stops when every source is that near its target, relative to it.
TOLERANCE = 1e-9
MAX_STEPS = 200
#: Documents of equal source and size that are ranked together.
RANKED = 256


def word_count(text: str) -> Column:
    r"""Number of runs `[^\x20\x09-\x0D]+`; null has none."""
    return F.coalesce(F.regexp_count(F.col(text).cast("string"), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(
    sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, cap: float = CAP
) -> DataFrame:
    """source, source_size, target for a frame (source, source_size) with one row per source.

    Sources in code point order, null last, take the weights in turn. A target stops at ``cap``
    times its source's size and the excess goes to the others by weight, until none is above.
    Each turn is one aggregate; at least one source stops in each but the last.
    """
    ranked = global_rank(sizes.withColumn("last", F.col("source").isNull()), "last", "source").drop("last")
    weight = F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights)).cast("int") + 1
    )
    table = stored(ranked.select("source", "source_size", weight.alias("weight"), F.lit(False).alias("full")))
    limit = F.col("source_size") * F.lit(cap)
    total = (table.agg(F.sum("source_size")).first()[0] or 0) * share
    while True:
        sums = table.agg(
            F.sum(F.when(F.col("full"), limit).otherwise(0.0)), F.sum(F.when(~F.col("full"), F.col("weight")))
        ).first()
        given, active = sums[0] or 0.0, sums[1] or 0.0
        rest = total - given
        part = F.lit(rest) * F.col("weight") / F.lit(active) if active else F.lit(0.0)
        above = ~F.col("full") & (part > limit)
        if not active or table.filter(above).isEmpty():
            return table.select(
                "source", "source_size", F.when(F.col("full"), limit).otherwise(part).alias("target")
            )
        table = stored(table.withColumn("full", F.col("full") | above))


def balance(classes: DataFrame, targets: DataFrame) -> DataFrame:
    """source, tilt: the l that solve the dual, by Newton's method.

    ``classes`` (source, size, n) is aggregated anew in each step, so that gradient and curvature
    are those of the documents; its rows are the distinct sizes of a source, not the documents.
    A step that would leave the interval in which the solution lies halves it instead. Sources
    without words or target have none.
    """
    share = F.col("target") / F.col("source_size")
    # With sizes of 1 or more, exp(l) alone is a bound on each side; at the cap every document is.
    dual = stored(
        targets.filter("target > 0 and source_size > 0").select(
            "source",
            "target",
            F.when(share >= CAP, float(np.log(CAP))).otherwise(0.0).alias("l"),
            F.least(F.ln(share), F.lit(0.0)).alias("low"),
            F.when(share > 1, float(np.log(CAP))).otherwise(0.0).alias("high"),
        )
    )
    power = F.col("l") * F.col("size")
    free = power < float(np.log(CAP))
    rate = F.when(free, F.exp(power)).otherwise(CAP)
    for _ in range(MAX_STEPS):
        sums = (
            classes.filter("size > 0").join(dual, classes["source"].eqNullSafe(dual["source"]))
            .groupBy(dual["source"], "target", "l", "low", "high")
            .agg(
                F.sum(F.col("size") * F.col("n") * rate).alias("m"),
                F.sum(F.when(free, F.col("size") * F.col("size") * F.col("n") * rate).otherwise(0.0)).alias("curve"),
            )
        )
        gap = F.col("target") - F.col("m")
        off = sums.withColumn("off", F.abs(gap) / F.col("target"))
        off = off.withColumn("low", F.when(gap >= 0, F.col("l")).otherwise(F.col("low"))).withColumn(
            "high", F.when(gap <= 0, F.col("l")).otherwise(F.col("high"))
        )
        newton = F.col("l") + F.try_divide(gap, F.col("curve"))
        inside = newton.isNotNull() & (newton >= F.col("low")) & (newton <= F.col("high"))
        moved = F.when(F.col("off") <= TOLERANCE, F.col("l")).when(inside, newton).otherwise((F.col("low") + F.col("high")) / 2)
        before, dual = dual, stored(off.select("source", "target", moved.alias("l"), "low", "high", "off"))
        discard(before)
        if (dual.agg(F.max("off")).first()[0] or 0.0) <= TOLERANCE:
            return dual.select("source", F.col("l").alias("tilt"))
    raise RuntimeError("the mix did not settle")


def _round_source(rows: pd.DataFrame) -> pd.DataFrame:
    """Copies for each size of a source, from the largest down, the remainder carried on."""
    rows = rows.sort_values("size", ascending=False, kind="stable")
    carry, copies = 0.0, []
    for size, n, rate in zip(rows["size"], rows["n"], rows["rate"]):
        wanted = rate * n * size + carry
        taken = min(max(0, round(wanted / size)), int(CAP) * int(n))
        copies.append(taken)
        carry = wanted - taken * size
    return pd.DataFrame({"source": rows["source"], "size": rows["size"], "n": rows["n"], "copies": copies})


def mix_sources(
    docs: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    source: str = "source",
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
) -> DataFrame:
    """One row per input row: doc_id, size, source_size, target, copies, taken.

    Every document is taken 0, 1 or 2 times whole; among documents of equal source and size a
    hash of id and text decides, so reruns agree and repeated rows share what their rows get in
    total. Empty and null texts have size 0 and are taken once (0 words); a source without words
    has target 0; null is a source of its own. An empty table gives no rows.
    """
    return _mixed(docs, text, key, source, weights, share).drop("text_hash")


def _mixed(docs: DataFrame, text: str, key: str, source: str, weights, share) -> DataFrame:
    rows = stored(
        docs.select(
            F.col(key).alias("doc_id"),
            F.col(source).cast("string").alias("source"),
            word_count(text).alias("size"),
            text_hash(text).alias("text_hash"),
        )
    )
    classes = stored(rows.groupBy("source", "size").agg(F.count("*").alias("n")))
    sizes = classes.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    targets = stored(source_targets(sizes, weights, share))
    tilts = stored(balance(classes, targets))

    def to_source(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
        other = right.withColumnRenamed("source", "_s")
        return left.join(other, left["source"].eqNullSafe(other["_s"]), how).drop("_s")

    tilted = to_source(classes.filter("size > 0"), tilts, "left")
    rate = F.least(F.lit(CAP), F.exp(F.least(F.col("tilt") * F.col("size"), F.lit(1.0))))
    rated = tilted.withColumn("rate", F.coalesce(rate, F.lit(0.0)))
    rounded = rated.groupBy("source").applyInPandas(
        _round_source, "source string, size bigint, n bigint, copies bigint"
    )
    plan = stored(to_source(rounded, targets))

    # Ranks are taken in parts of about RANKED documents of a class, and the copies of a class
    # are spread over its parts by their sizes.
    own = rows.filter("size > 0")
    whole = plan.withColumnsRenamed({"source": "_s", "size": "_z"})
    placed = own.join(whole, own["source"].eqNullSafe(whole["_s"]) & (own["size"] == whole["_z"])).drop("_s", "_z")
    placed = placed.withColumn("order", F.xxhash64(F.lit("mix"), "doc_id", "text_hash")).withColumn(
        "part", F.pmod(F.xxhash64("order"), F.ceil(F.col("n") / RANKED))
    )
    placed = stored(placed)
    within = Window.partitionBy("source", "size").orderBy("part").rowsBetween(Window.unboundedPreceding, 0)
    parts = (
        placed.groupBy("source", "size", "part", "n", "copies")
        .agg(F.count("*").alias("here"))
        .withColumn("through", F.sum("here").over(within))
        .withColumn("last", _floored("copies", F.col("through"), "n"))
        .withColumn("first", _floored("copies", F.col("through") - F.col("here"), "n"))
        .select("source", "size", "part", "here", (F.col("last") - F.col("first")).alias("given"))
    )
    parts = stored(parts).withColumnsRenamed({"source": "_s", "size": "_z", "part": "_p"})
    nth = Window.partitionBy("source", "size", "part").orderBy("order", "doc_id", "text_hash")
    ranked = placed.withColumn("nth", F.row_number().over(nth))
    dealt = ranked.join(
        parts,
        ranked["source"].eqNullSafe(parts["_s"]) & (ranked["size"] == parts["_z"]) & (ranked["part"] == parts["_p"]),
    )
    copies = F.floor(F.col("given") / F.col("here")) + (F.col("nth") <= F.col("given") % F.col("here")).cast("long")
    full = dealt.select("doc_id", "text_hash", "size", "source_size", "target", copies.cast("long").alias("copies"))
    empty = to_source(rows.filter("size = 0"), targets).select(
        "doc_id", "text_hash", "size", "source_size", "target", F.lit(1).cast("long").alias("copies")
    )
    return full.unionByName(empty).withColumn("taken", F.col("copies") * F.col("size"))


def _floored(copies: str, through: Column, n: str) -> Column:
    """copies * through div n without overflow."""
    product = F.col(copies).cast("decimal(19,0)") * through.cast("decimal(19,0)")
    return F.floor(product / F.col(n).cast("decimal(19,0)")).cast("long")


def apply_mix(docs: DataFrame, text: str = "text", key: str = "doc_id", source: str = "source") -> DataFrame:
    """The documents of the mix, each as often as it is taken, with ``copy`` (1, 2, ...). Rows that
    agree in id and text come as often as they are taken together."""
    taken = stored(_mixed(docs, text, key, source, WEIGHTS, SHARE).filter("copies > 0"))
    id_, own, other, n = (single_column(x, *docs.columns) for x in ("_id", "_own_hash", "_mix_hash", "_copies"))
    # Rows that agree in id and text are one here, which comes as often as all of them.
    wanted = taken.groupBy(F.col("doc_id").alias(id_), F.col("text_hash").alias(other)).agg(F.sum("copies").alias(n))
    copy = single_column("copy", *docs.columns)
    return (
        keep_rows(docs, taken, text, key)
        .withColumn(own, text_hash(text))
        .join(wanted, F.col(key).eqNullSafe(F.col(id_)) & (F.col(own) == F.col(other)))
        .withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(n).cast("int"))))
        .select(*docs.columns, copy)
    )
