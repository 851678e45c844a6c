"""Alert rows from check results and metric limits. Delivery is left to the caller."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Marker of each severity and the default routing of severities to channels.
SEVERITY_MARKS = {
    "CRITICAL": ":rotating_light:",
    "HIGH": ":warning:",
    "MEDIUM": ":information_source:",
    "LOW": ":white_check_mark:",
    "INFO": ":bell:",
}
DEFAULT_ROUTES = {
    "slack": ("CRITICAL", "HIGH"),
    "email": ("CRITICAL", "HIGH", "MEDIUM"),
}


def alert_rows(
    results: DataFrame,
    severity: str = "HIGH",
    routes: Mapping[str, Sequence[str]] = DEFAULT_ROUTES,
) -> DataFrame:
    """One row per (layer, dataset) with a failed check: severity, channels, failed checks,
    metrics and a ready message. The input is check rows, so groups are bounded by the
    number of declared checks."""
    failed = ~F.col("passed")
    channels = sorted(c for c, accepted in routes.items() if severity in accepted)
    name = F.concat_ws(".", "metric", "field")
    per_layer = results.groupBy("layer", "dataset").agg(
        F.array_sort(F.collect_list(F.when(failed, name))).alias("failed_checks"),
        F.map_from_entries(
            F.array_sort(F.collect_list(F.struct(name.alias("name"), "observed")))
        ).alias("metrics"),
    )
    title = f"{SEVERITY_MARKS.get(severity, SEVERITY_MARKS['INFO'])} *{severity}* Alert"
    return per_layer.filter(F.array_size("failed_checks") > 0).select(
        F.lit(severity).alias("severity"),
        "layer",
        "dataset",
        F.lit(channels).cast("array<string>").alias("channels"),
        "failed_checks",
        "metrics",
        F.concat(
            F.lit(f"{title}\nData quality issues in "),
            F.concat_ws(".", "layer", "dataset"),
            F.lit("\n- "),
            F.array_join("failed_checks", "\n- "),
        ).alias("message"),
    )


@dataclass(frozen=True)
class Kpi:
    """Limits of one metric; a value outside them raises an alert."""

    metric: str
    low: float | None = None
    high: float | None = None


# Documented alert limits. Ratios are in percent.
DEFAULT_KPIS = (
    Kpi("bronze_record_count", 100, 15000),
    Kpi("silver_bronze_delta_pct", None, 10),
    Kpi("gold_row_count", 50, None),
    Kpi("avg_quality_score", 70, None),
    Kpi("duplicate_count", None, 0),
    Kpi("null_required_field_count", None, 0),
    Kpi("invalid_coordinate_pct", None, 5),
)


def kpi_alerts(metrics: DataFrame, kpis: Sequence[Kpi] = DEFAULT_KPIS) -> DataFrame:
    """Rows ``(metric, value)`` against their limits. The limit table has one row per
    declared KPI, so Spark broadcasts it."""
    limits = metrics.sparkSession.createDataFrame(
        pa.table(
            {
                "metric": pa.array([k.metric for k in kpis], pa.string()),
                "low": pa.array([k.low for k in kpis], pa.float64()),
                "high": pa.array([k.high for k in kpis], pa.float64()),
            }
        )
    )
    too_low = F.coalesce(F.col("value") < F.col("low"), F.lit(False))
    too_high = F.coalesce(F.col("value") > F.col("high"), F.lit(False))
    return metrics.join(limits, "metric").select(
        "metric", "value", "low", "high", (too_low | too_high).alias("alert")
    )
