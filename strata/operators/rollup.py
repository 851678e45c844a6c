"""Aggregation by dimensions.

Every aggregate is computed in two levels: a *base* grouped by the dimensions plus the
column that needs distinct values, then the aggregate itself over the base. The base
combines map-side, a hot group is spread over its distinct values, and several aggregates can
share one base, so the input is read once for all of them.

A base over several distinct columns at once may be as large as the input. It is only used
where these columns are the dimensions of another aggregate of the same input; otherwise each
distinct column has a pass of its own and the results are joined by the dimensions.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.plans.specs import Measure, RollupSpec

SET_FUNCTIONS = ("count_distinct", "collect_set")
# Partial aggregates each other function is put together from.
NEEDS = {
    "avg": ("total", "present"),
    "avg_2dp": ("total", "present"),
    "sum": ("sum",),
    "min": ("min",),
    "max": ("max",),
    "count_true": ("true",),
    "count_present": ("present",),
}
FUNCTIONS = (*NEEDS, *SET_FUNCTIONS)

ROWS = "_rows"
PART = "_part_"


def _part(kind: str, column: str) -> str:
    return f"{PART}{kind}_{column}"


def _partials(column: str, function: str) -> dict[str, Column]:
    """Base columns a measure needs, by name, so that equal ones are shared."""
    c = F.col(column)
    made = {
        "total": lambda: F.sum(c.cast("double")),
        "present": lambda: F.count(c),
        "sum": lambda: F.sum(c),
        "min": lambda: F.min(c),
        "max": lambda: F.max(c),
        "true": lambda: F.sum(F.when(c, 1).otherwise(0)),
    }
    return {_part(kind, column): made[kind]() for kind in NEEDS[function]}


def _final(measure: Measure) -> Column:
    if measure == "count":
        return F.coalesce(F.sum(ROWS), F.lit(0).cast("bigint"))
    column, function = measure
    if function == "count_distinct":
        return F.count_distinct(column)
    if function == "collect_set":
        return F.array_sort(F.collect_set(column))
    parts = [_part(kind, column) for kind in NEEDS[function]]
    if function in ("avg", "avg_2dp"):
        mean = F.try_divide(F.sum(parts[0]), F.sum(parts[1]))
        return F.round(mean, 2) if function == "avg_2dp" else mean
    if function in ("min", "max"):
        return F.min(parts[0]) if function == "min" else F.max(parts[0])
    return F.sum(parts[0])


def _measures(spec: RollupSpec) -> dict[str, Measure]:
    measures: dict[str, Measure] = {"record_count": "count"} if spec.record_count else {}
    measures.update(spec.measures)
    for alias, measure in measures.items():
        if measure != "count" and (isinstance(measure, str) or measure[1] not in FUNCTIONS):
            raise ValueError(f"Unknown aggregate for '{alias}': {measure}")
    if not measures:
        raise ValueError(f"Rollup '{spec.name}' has nothing to aggregate")
    return measures


def _grain(spec: RollupSpec) -> list[str]:
    """Columns the base must keep apart for this rollup."""
    distinct = [
        m[0] for m in _measures(spec).values() if m != "count" and m[1] in SET_FUNCTIONS
    ]
    return list(dict.fromkeys([*spec.dimensions, *distinct]))


def _apart(spec: RollupSpec) -> list[str]:
    """Columns beyond the dimensions that need distinct values."""
    return [c for c in _grain(spec) if c not in spec.dimensions]


def base_for(df: DataFrame, specs: Iterable[RollupSpec], grain: Sequence[str]) -> DataFrame:
    """Group ``df`` once by ``grain`` with every partial the rollups need."""
    partials: dict[str, Column] = {ROWS: F.count("*")}
    for spec in specs:
        for measure in _measures(spec).values():
            if measure != "count" and measure[1] not in SET_FUNCTIONS:
                partials.update(_partials(*measure))
    return df.groupBy(*grain).agg(*[c.alias(name) for name, c in partials.items()])


def _ordering(spec: RollupSpec) -> list[Column]:
    named = [F.desc(n[1:]) if n.startswith("-") else F.asc(n) for n in spec.order_by]
    rest = [d for d in spec.dimensions if d not in spec.order_by]
    return [*named, *rest] if named else []


def total_rows(base: DataFrame) -> Column:
    """Rows behind a base, as a scalar subquery that reuses the shuffle of the base.

    Only equal shuffles are reused. Asking for the other partials as well keeps Spark from
    pruning them here, which would make it read the input a second time.
    """
    others = [F.max(c).alias(c) for c in base.columns if c.startswith(PART)]
    return base.agg(F.struct(F.sum(ROWS).alias(ROWS), *others)).scalar().getField(ROWS)


def rollup(base: DataFrame, spec: RollupSpec) -> DataFrame:
    """One aggregate table from a base.

    Shares refer to the rows of the whole base. Their total is a scalar subquery, not a
    window over all groups, which would run in a single task.
    """
    measures = {alias: _final(m).alias(alias) for alias, m in _measures(spec).items()}
    result = base.groupBy(*spec.dimensions).agg(*measures.values())
    if spec.percentage and spec.record_count:
        share = F.round(F.try_divide("record_count", total_rows(base)) * 100, 2)
        result = result.withColumn("percentage_of_total", share)
    ordering = _ordering(spec)
    return (result.orderBy(*ordering) if ordering else result).withColumn(
        "_created_at", F.current_timestamp()
    )


def require_dimensions(df: DataFrame, dimensions: Sequence[str]) -> None:
    missing = [d for d in dimensions if d not in df.columns]
    if missing:
        raise ValueError(f"no such columns to group by: {missing}")


def available(df: DataFrame, spec: RollupSpec) -> RollupSpec:
    """``spec`` without the measures of a dimensionless summary whose column is absent."""
    if spec.dimensions:
        return spec
    kept = {a: m for a, m in spec.measures.items() if m == "count" or m[0] in df.columns}
    return RollupSpec(spec.name, (), kept, spec.record_count, spec.percentage, spec.order_by)


def aggregate(df: DataFrame, spec: RollupSpec) -> DataFrame:
    """One aggregate table straight from detail rows."""
    require_dimensions(df, spec.dimensions)
    spec = available(df, spec)
    if len(_apart(spec)) > 1:
        return _joined(df, spec)
    return rollup(base_for(df, [spec], _grain(spec)), spec)


def separate(spec: RollupSpec) -> tuple[RollupSpec, dict[str, dict[str, Measure]]]:
    """A rollup without its distinct columns, and the measures of each of those."""
    measures = _measures(spec)
    apart = {
        c: {a: m for a, m in measures.items() if m != "count" and m[1] in SET_FUNCTIONS and m[0] == c}
        for c in _apart(spec)
    }
    rest = {a: m for a, m in measures.items() if not any(a in group for group in apart.values())}
    return RollupSpec("plain", spec.dimensions, {**rest, ROWS: "count"}, record_count=False), apart


def distinct_rollup(spec: RollupSpec, column: str, measures: Mapping[str, Measure]) -> RollupSpec:
    return RollupSpec(column, spec.dimensions, measures, record_count=False)


def _joined(df: DataFrame, spec: RollupSpec) -> DataFrame:
    """An aggregate with several distinct columns: one pass for each, joined by dimension."""
    plain, apart = separate(spec)
    found = {}
    for column, group in apart.items():
        one = distinct_rollup(spec, column, group)
        found[column] = rollup(base_for(df, [one], _grain(one)), one).drop("_created_at")
    return assembled(base_for(df, [plain], _grain(plain)), spec, found)


def assembled(base: DataFrame, spec: RollupSpec, found: Mapping[str, DataFrame]) -> DataFrame:
    """An aggregate from the base of its plain part and, for each distinct column, a frame of the
    dimensions and the measures of that column. A group that such a frame lacks has no values."""
    measures = _measures(spec)
    plain, apart = separate(spec)
    result = rollup(base, plain).drop("_created_at")
    for column, group in apart.items():
        values = found[column]
        if spec.dimensions:
            values = values.withColumnsRenamed({d: f"{PART}{d}" for d in spec.dimensions})
            same = [F.col(d).eqNullSafe(F.col(f"{PART}{d}")) for d in spec.dimensions]
            counts = [a for a, m in group.items() if m[1] == "count_distinct"]
            result = result.join(values, same, "left").drop(*[f"{PART}{d}" for d in spec.dimensions])
            result = result.fillna(0, counts) if counts else result
        else:
            one = values.select(F.struct(*group).alias("v")).scalar()
            result = result.withColumns({alias: one.getField(alias) for alias in group})
    columns = [*spec.dimensions, *measures]
    if spec.percentage and spec.record_count:
        share = F.round(F.try_divide(ROWS, total_rows(base)) * 100, 2)
        result = result.withColumn("percentage_of_total", share)
        columns.append("percentage_of_total")
    result, ordering = result.select(*columns), _ordering(spec)
    return (result.orderBy(*ordering) if ordering else result).withColumn(
        "_created_at", F.current_timestamp()
    )


def aggregate_by_dimensions(
    df: DataFrame,
    dimensions: Sequence[str],
    include_count: bool = True,
    include_percentage: bool = False,
    additional_aggs: Mapping[str, Measure] | None = None,
) -> DataFrame:
    spec = RollupSpec(
        "aggregate",
        tuple(dimensions),
        dict(additional_aggs or {}),
        record_count=include_count,
        percentage=include_percentage,
    )
    return aggregate(df, spec)


def plan_bases(specs: Sequence[RollupSpec]) -> list[tuple[list[str] | None, list[RollupSpec]]]:
    """Group rollups by shared base: the widest grain serves every rollup it covers.

    A grain with several distinct columns is only made if the dimensions of some rollup make it
    anyway; a rollup that would need it alone comes with None and is aggregated by itself.
    """
    narrow = [s for s in specs if len(_apart(s)) <= 1]
    waiting = sorted(specs, key=lambda s: len(_grain(s)), reverse=True)
    plans: list[tuple[list[str] | None, list[RollupSpec]]] = []
    for first in sorted(narrow, key=lambda s: len(_grain(s)), reverse=True):
        if first in waiting:
            grain = _grain(first)
            covered = [s for s in waiting if set(_grain(s)) <= set(grain)]
            waiting = [s for s in waiting if s not in covered]
            plans.append((grain, covered))
    return plans + [(None, [s]) for s in waiting]
