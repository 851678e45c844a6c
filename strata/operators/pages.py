"""Reconciliation of a paged download that was landed page by page.

Input: ``(page, per_page, records ARRAY<STRING>, reported_total)``, pages numbered from 1.
The download stops at the first empty page, so later pages do not count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _sizes(pages: DataFrame) -> DataFrame:
    size = F.coalesce(F.array_size("records"), F.lit(0))
    return pages.groupBy("page").agg(F.sum(F.when(size > 0, size).otherwise(0)).alias("received"))


def _stop(sizes: DataFrame) -> Column:
    """First empty page as a scalar subquery; null when every page has records."""
    return sizes.agg(F.min(F.when(F.col("received") == 0, F.col("page")))).scalar()


def page_records(pages: DataFrame) -> DataFrame:
    """All records up to the first empty page as ``(page, position, payload)``."""
    before = F.coalesce(F.col("page") < _stop(_sizes(pages)), F.lit(True))
    return pages.filter(before).select(
        "page", F.posexplode("records").alias("position", "payload")
    )


def reconcile_pages(pages: DataFrame) -> DataFrame:
    """One row comparing what arrived with what the source reported.

    The records are read once: the stop page comes from the same shuffle as the sizes, and
    the reported numbers from a scan of their two columns alone.
    """
    sizes = _sizes(pages)
    counted = F.coalesce(F.col("page") < _stop(sizes), F.lit(True))
    totals = sizes.agg(
        F.coalesce(F.sum(F.when(counted, F.col("received"))), F.lit(0)).alias("received"),
        F.count_if(counted).alias("pages_received"),
        F.max(F.when(counted, F.col("page"))).alias("last_page"),
    )
    reported = totals.select(
        "*",
        pages.agg(F.max("reported_total")).scalar().alias("reported_total"),
        pages.agg(F.max("per_page")).scalar().alias("per_page"),
    )
    expected = F.ceil(F.try_divide(F.col("reported_total").cast("double"), F.col("per_page")))
    return reported.select(
        "reported_total",
        "received",
        expected.alias("expected_pages"),
        "pages_received",
        (F.coalesce("last_page", F.lit(0)) - F.col("pages_received")).alias("missing_pages"),
        F.coalesce(F.col("received") == F.col("reported_total"), F.lit(True)).alias("complete"),
    )


#: Page numbers of a stretch; gaps are looked for within one, then between the ends of them.
STRETCH = 1 << 16


def page_gaps(pages: DataFrame) -> DataFrame:
    """One row per departure from one landing of each page: kind, first_page, last_page, n.

    * ``missing``: a range of pages between 1 and the last one, of ``n`` pages. The last page is
      the larger of the last landed with records and the one that the reported total ends on;
    * ``repeated``: a page that landed ``n`` times with records.

    Pages from the first empty one on do not count. Ranges come from the neighbours of the landed
    numbers, within stretches of the numbers and between these; no page is enumerated.
    """
    size = F.coalesce(F.array_size("records"), F.lit(0))
    landed = pages.groupBy("page").agg(F.count_if(size > 0).alias("n"))
    stop = landed.filter("n = 0").agg(F.min("page")).scalar()
    counted = landed.filter((F.col("n") > 0) & F.coalesce(F.col("page") < stop, F.lit(True))).select(
        F.col("page").cast("long").alias("page"), "n", F.floor(F.col("page") / STRETCH).alias("stretch")
    )
    expected = pages.agg(
        F.ceil(F.try_divide(F.max("reported_total").cast("double"), F.max("per_page"))).cast("long").alias("e")
    )
    # Beyond the ends: page 0 landed, and so did the one behind the last.
    end = F.greatest(expected.select("e").scalar(), counted.agg(F.max("page")).scalar())
    ends = pages.sparkSession.range(2).select(F.when(F.col("id") == 0, F.lit(0).cast("long")).otherwise(end + 1).alias("page"))
    marks = counted.select("page", "stretch").unionByName(
        ends.filter("page IS NOT NULL").select("page", F.floor(F.col("page") / STRETCH).alias("stretch"))
    )
    near = Window.partitionBy("stretch").orderBy("page")
    within = marks.select(F.lag("page").over(near).alias("before"), "page").filter("before IS NOT NULL")
    # As many rows as stretches.
    edges = marks.groupBy("stretch").agg(F.min("page").alias("page"), F.max("page").alias("last"))
    between = edges.select(F.lag("last").over(Window.orderBy("stretch")).alias("before"), "page").filter("before IS NOT NULL")
    gaps = within.unionByName(between).filter("page - before > 1")
    missing = gaps.select(
        F.lit("missing").alias("kind"),
        (F.col("before") + 1).alias("first_page"),
        (F.col("page") - 1).alias("last_page"),
        (F.col("page") - F.col("before") - 1).alias("n"),
    )
    repeated = counted.filter("n > 1").select(F.lit("repeated").alias("kind"), F.col("page").alias("first_page"), F.col("page").alias("last_page"), "n")
    return missing.unionByName(repeated)
