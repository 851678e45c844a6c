"""Data-quality checks compiled into aggregates, one result row per check.

Result rows: ``layer, dataset, metric, field, severity, observed, bound, passed, message``.
Only a failed ``error`` fails a layer; ``warning`` rows are reported and ``info`` rows are
plain metrics.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.parse import parse_payload
from strata.plans.specs import QualitySpec

ERROR, WARNING, INFO = "error", "warning", "info"

RESULT_SCHEMA = (
    "layer string, dataset string, metric string, field string, severity string, "
    "observed double, bound double, passed boolean, message string"
)


@dataclass(frozen=True)
class Check:
    """An aggregate and the test of its value.

    ``fails`` is a SQL condition on ``{v}``, the aggregated value as double. All failures are
    worded alike: metric, value, limit, field. An ``info`` row may carry a ``note`` instead.
    ``alone`` marks an aggregate over distinct values: it gets its own narrow
    pass, because carrying every other counter along with each distinct key would widen the
    largest shuffle.
    """

    metric: str
    severity: str
    observed: Column
    fails: str = "false"
    field: str | None = None
    bound: float | None = None
    alone: bool = False
    note: str = ""

    def wording(self) -> str:
        """A ``format_string`` pattern for the value."""
        if self.severity == INFO:
            return _plain(self.note)
        limit = "" if self.bound is None else f", limit {self.bound:.2f}"
        where = "" if self.field is None else f" ({self.field})"
        return f"{_plain(self.metric)} is %.2f{limit}{_plain(where)}"


def _literal(value: str | float | None) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return repr(float(value)) + "D"


def _plain(name: str) -> str:
    """A name as text inside a ``format_string`` pattern."""
    return name.replace("%", "%%")


def _violations(metric: str, severity: str, broken: Column, field: str) -> Check:
    """Check that no row satisfies ``broken``."""
    return Check(metric, severity, F.count_if(broken), "{v} > 0", field, 0)


def evaluate(df: DataFrame, checks: Sequence[Check], layer: str, dataset: str) -> DataFrame:
    """Run all checks on one table: one scan for the counters, one per distinct check."""
    together = [c for c in checks if not c.alone]
    groups = ([together] if together else []) + [[c] for c in checks if c.alone]
    return reduce(DataFrame.unionByName, [_result_rows(df, g, layer, dataset) for g in groups])


def _result_rows(df: DataFrame, checks: Sequence[Check], layer: str, dataset: str) -> DataFrame:
    wide = df.agg(*[c.observed.cast("double").alias(f"_{i}") for i, c in enumerate(checks)])
    rows = [_result_row(c, f"_{i}", layer, dataset) for i, c in enumerate(checks)]
    return wide.selectExpr(f"inline(array({', '.join(rows)}))")


def _result_row(check: Check, value: str, layer: str, dataset: str) -> str:
    failed = f"coalesce({check.fails.format(v=value)}, false)"
    shown = "true" if check.severity == INFO and check.note else failed
    return f"""named_struct(
        'layer', {_literal(layer)}, 'dataset', {_literal(dataset)},
        'metric', {_literal(check.metric)}, 'field', CAST({_literal(check.field)} AS STRING),
        'severity', {_literal(check.severity)}, 'observed', {value},
        'bound', CAST({_literal(check.bound)} AS DOUBLE), 'passed', NOT {failed},
        'message', if({shown}, format_string({_literal(check.wording())}, {value}), NULL))"""


def failed_row(
    spark: SparkSession, layer: str, dataset: str, metric: str, message: str, severity: str = ERROR
) -> DataFrame:
    """Result row of a check that could not look at any data (missing path, unreadable table)."""
    row = (layer, dataset, metric, None, severity, None, None, False, message)
    return spark.createDataFrame([row], RESULT_SCHEMA)


# --- single checks -----------------------------------------------------------------------


def total_records() -> Check:
    return Check("total_records", INFO, F.count("*"))


def unique(key: str) -> Check:
    """Rows minus distinct keys; all null keys together count as one value."""
    null_key = F.coalesce(F.max(F.when(F.col(key).isNull(), 1)), F.lit(0))
    return Check(
        "duplicate_count",
        ERROR,
        F.count("*") - F.count_distinct(key) - null_key,
        "{v} > 0",
        key,
        0,
        alone=True,
    )


def required(name: str, severity: str = ERROR) -> Check:
    return Check(
        f"{name}_null_count",
        severity,
        F.count_if(F.col(name).isNull()),
        "{v} > 0",
        name,
        0,
    )


def in_range(name: str, low: float, high: float) -> Check:
    """Nulls pass; NaN sorts above every number, so it is out of range."""
    value = F.col(name).try_cast("double")
    return _violations(
        f"{name}_out_of_range",
        WARNING,
        (value < low) | (value > high),
        name,
    )


def allowed(name: str, values: Sequence[str]) -> Check:
    return _violations(
        f"{name}_invalid_values",
        WARNING,
        F.col(name).isNotNull() & ~F.col(name).isin(list(values)),
        name,
    )


def mean_at_least(name: str, bound: float, metric: str) -> Check:
    """No rows, no mean, nothing to warn about."""
    return Check(metric, WARNING, F.avg(name), f"{{v}} < {bound}", name, bound)


def not_empty(dataset: str) -> Check:
    return Check(f"{dataset}_count", WARNING, F.count("*"), "{v} = 0")


def non_negative(name: str, dataset: str) -> Check:
    return _violations(
        f"{dataset}.{name}_negative",
        ERROR,
        F.col(name) < 0,
        name,
    )


def percentage(name: str, dataset: str) -> Check:
    return _violations(
        f"{dataset}.{name}_invalid",
        WARNING,
        (F.col(name) < 0) | (F.col(name) > 100),
        name,
    )


def complete(name: str, ratio: float) -> Check:
    """Share of non-null values."""
    return Check(
        f"{name}_completeness",
        WARNING,
        F.avg(F.col(name).isNotNull().cast("double")),
        f"{{v}} < {ratio}",
        name,
        ratio,
    )


# --- checks of one layer -----------------------------------------------------------------


def silver_checks(df: DataFrame, spec: QualitySpec) -> list[Check]:
    """The rules of ``spec`` whose columns exist in ``df``."""
    have = set(df.columns)
    checks = [total_records()]
    if spec.unique_key in have:
        checks.append(unique(spec.unique_key))
    checks += [required(n) for n in spec.required if n in have]
    checks += [in_range(n, *limits) for n, limits in spec.ranges.items() if n in have]
    checks += [allowed(n, values) for n, values in spec.allowed.items() if n in have and values]
    if "data_quality_score" in have:
        bound = spec.mean_score * 100
        checks.append(mean_at_least("data_quality_score", bound, "avg_quality_score"))
    return checks


def gold_checks(df: DataFrame, dataset: str, spec: QualitySpec) -> list[Check]:
    """Emptiness, non-negative counts, shares within 0..100.

    Count columns are the declared ones, else every *numeric* column with "count" in its
    name (which leaves out a text column such as ``country``).
    """
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    counts = spec.count_columns
    if counts is None:
        counts = [n for n in numeric if "count" in n.lower()]
    checks = [not_empty(dataset)]
    checks += [non_negative(n, dataset) for n in counts if n in numeric]
    checks += [percentage(n, dataset) for n in spec.percentage_columns if n in numeric]
    return checks


def check_silver(df: DataFrame, spec: QualitySpec, dataset: str) -> DataFrame:
    return evaluate(df, silver_checks(df, spec), "silver", dataset)


def check_gold(
    df: DataFrame, spec: QualitySpec, dataset: str, path: str | None = None
) -> DataFrame:
    """Checks of one aggregate table; a ``path`` is reported by its last component."""
    found = gold_checks(df, dataset, spec)
    if path:
        folder = path.rstrip("/").rsplit("/", 1)[-1]
        nothing = F.max(F.lit(None).cast("double"))
        found.append(Check(f"{dataset}_path", INFO, nothing, note=folder))
    return evaluate(df, found, "gold", dataset)


def check_landed(files: DataFrame, spec: QualitySpec, dataset: str) -> DataFrame:
    """Checks of landed raw data from its inventory
    ``(path, valid, is_array, records, empty_records)``, one row or more per file."""
    per_file = files.groupBy("path").agg(
        F.bool_and("valid").alias("valid"),
        F.bool_and("is_array").alias("is_array"),
        F.sum("records").alias("records"),
        F.sum("empty_records").alias("empty_records"),
    )
    records = F.coalesce(F.sum("records"), F.lit(0))
    empty = F.coalesce(F.sum("empty_records"), F.lit(0))
    limit = spec.min_landed
    checks = [
        Check("file_count", INFO, F.count("*")),
        _violations("invalid_json_count", ERROR, ~F.col("valid"), "path"),
        _violations(
            "non_array_count",
            WARNING,
            F.col("valid") & ~F.col("is_array"),
            "path",
        ),
        Check(
            "record_count",
            ERROR,
            records,
            f"{{v}} < {limit}",
            bound=limit,
        ),
        Check("empty_record_count", WARNING, empty, "{v} > 0", bound=0),
        Check(
            "filled_record_count", ERROR, records - empty, "{v} = 0", bound=1
        ),
    ]
    return evaluate(per_file, checks, "bronze", dataset)


def check_landed_fields(df: DataFrame, names: Sequence[str], dataset: str) -> DataFrame:
    """Fields every landed payload should carry (a missing key and a JSON null look the same)."""
    parsed = parse_payload(df, [{"name": n} for n in names], keep=())
    return evaluate(parsed, [required(n, WARNING) for n in names], "bronze", dataset)


# --- checks across tables ----------------------------------------------------------------


def check_sum_matches_source(
    gold: DataFrame, source: DataFrame, dataset: str, measure: str = "record_count"
) -> DataFrame:
    """Rows behind an aggregate table equal the rows of its source."""
    rows = source.agg(F.count("*")).scalar()
    summed = gold.agg((F.coalesce(F.sum(measure), F.lit(0)) - rows).alias("difference"))
    check = Check(
        f"{measure}_difference",
        ERROR,
        F.max("difference"),
        "{v} <> 0",
        measure,
        0,
    )
    return evaluate(summed, [check], "gold", dataset)


def missing_dimensions(gold: DataFrame, source: DataFrame, dimensions: Sequence[str]) -> DataFrame:
    """Dimension values of the source that the aggregate table lacks; null is a value."""
    wanted = source.select(*dimensions).distinct().alias("s")
    found = gold.select(*dimensions).distinct().alias("g")
    same = reduce(
        lambda a, b: a & b, [F.col(f"s.{d}").eqNullSafe(F.col(f"g.{d}")) for d in dimensions]
    )
    return wanted.join(found, same, "left_anti")


def check_dimensions_present(
    gold: DataFrame, source: DataFrame, dimensions: Sequence[str], dataset: str
) -> DataFrame:
    check = Check(
        "missing_dimensions",
        ERROR,
        F.count("*"),
        "{v} > 0",
        ",".join(dimensions),
        0,
    )
    return evaluate(missing_dimensions(gold, source, dimensions), [check], "gold", dataset)


def check_presence(found: DataFrame, expected: DataFrame, layer: str) -> DataFrame:
    """One row per expected ``(dataset, date)``, failed when nothing was found for it."""
    have = found.select("dataset", "date").distinct().withColumn("_found", F.lit(1.0))
    joined = expected.join(have, ["dataset", "date"], "left")
    missing = F.col("_found").isNull()
    return joined.select(
        F.lit(layer).alias("layer"),
        "dataset",
        F.lit("present").alias("metric"),
        F.col("date").alias("field"),
        F.lit(ERROR).alias("severity"),
        F.coalesce("_found", F.lit(0.0)).alias("observed"),
        F.lit(1.0).alias("bound"),
        (~missing).alias("passed"),
        F.when(missing, F.format_string("present is 0.00, limit 1.00 (%s)", "date")).alias("message"),
    )


# --- rows instead of counts --------------------------------------------------------------


def tag_reasons(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Add ``_reasons``: the names of the rules a row breaks (empty for a valid row)."""
    broken = [F.when(condition, F.lit(name)) for name, condition in rules.items()]
    return df.withColumn("_reasons", F.array_compact(F.array(*broken)))


def row_rules(df: DataFrame, spec: QualitySpec) -> dict[str, Column]:
    """Row-level form of the required, range and allowed-value checks."""
    have = set(df.columns)
    rules = {f"{n}_missing": F.col(n).isNull() for n in spec.required if n in have}
    for n, (low, high) in spec.ranges.items():
        if n in have:
            value = F.col(n).try_cast("double")
            rules[f"{n}_out_of_range"] = (value < low) | (value > high)
    for n, values in spec.allowed.items():
        if n in have:
            rules[f"{n}_not_allowed"] = F.col(n).isNotNull() & ~F.col(n).isin(list(values))
    return rules


def split_tagged(tagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(valid, rejected)`` of tagged rows; rejected rows keep ``_reasons``."""
    valid = tagged.filter(F.array_size("_reasons") == 0).drop("_reasons")
    return valid, tagged.filter(F.array_size("_reasons") > 0)


def quarantine(df: DataFrame, rules: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """``(valid, rejected)`` of ``df``. Writing both runs ``df`` twice, so let it be a stored
    table (``daily.build_silver`` stores the tagged rows first)."""
    return split_tagged(tag_reasons(df, rules))


# --- verdicts ----------------------------------------------------------------------------


class QualityGateError(Exception):
    """A layer failed its checks."""


def summary(results: DataFrame) -> dict[str, dict]:
    """Per layer ``{layer, passed, errors, warnings, metrics}``. Reads the check rows, whose
    number is the number of declared checks, never data rows."""
    layers: dict[str, dict] = {}
    for row in results.collect():
        entry = layers.setdefault(
            row.layer,
            {"layer": row.layer, "passed": True, "errors": [], "warnings": [], "metrics": {}},
        )
        noted = row.severity == INFO and row.message is not None
        entry["metrics"][row.metric] = row.message if noted else row.observed
        if not row.passed:
            entry["warnings" if row.severity != ERROR else "errors"].append(row.message)
            entry["passed"] = entry["passed"] and row.severity != ERROR
    return layers


def assert_passed(results: DataFrame) -> dict[str, dict]:
    """The summary, or an error naming the failed layers."""
    layers = summary(results)
    failed = {name: entry["errors"] for name, entry in layers.items() if not entry["passed"]}
    if failed:
        raise QualityGateError(f"Validation failed: {failed}")
    return layers
