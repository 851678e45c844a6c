"""Payload drift: how landed JSON departs from the declared fields."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.operators.schema import Declared
from strata.plans.specs import FieldSpec

# The JSON types that hold each declared type without a change.
HOLDS = {
    "string": ("STRING",),
    "int": ("BIGINT",),
    "integer": ("BIGINT",),
    "long": ("BIGINT",),
    "float": ("DOUBLE", "DECIMAL", "BIGINT"),
    "double": ("DOUBLE", "DECIMAL", "BIGINT"),
    "boolean": ("BOOLEAN",),
    "bool": ("BOOLEAN",),
    "timestamp": ("STRING",),
    "date": ("STRING",),
}
ABSENT, NO_OBJECT, NULL = "ABSENT", "NO_OBJECT", "VOID"


def _json_type(value: Column) -> Column:
    """BIGINT, DOUBLE, DECIMAL, STRING, BOOLEAN, ARRAY, OBJECT, or VOID for a JSON null."""
    return F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0)


def payload_drift(df: DataFrame, fields: Declared, payload: str = "payload") -> DataFrame:
    """One row per field and kind of departure: field, status, declared, found, records.

    * ``undeclared``: a field of the records that is not declared; ``found`` has its JSON types;
    * ``absent``: a declared field that ``records`` of them lack (a null is not absent);
    * ``retyped``: a declared field whose non-null values have JSON types that do not hold the
      declared one;
    * ``no_object`` (field null): payloads that are null, no JSON, or no object.

    Payloads are parsed once, as variants, in one scan; what is shuffled are counts by field and
    JSON type. Field names are case-sensitive; only fields of the top level are compared, whatever
    is nested counts as ``OBJECT`` or ``ARRAY``.
    """
    declared = [FieldSpec.of(f) for f in fields]
    names = F.array(*[F.lit(f.name) for f in declared]) if declared else F.array().cast("array<string>")
    parsed = df.select(F.try_variant_get(F.try_parse_json(F.col(payload)), "$", "map<string,variant>").alias("_fields"))

    def item(field: Column, kind: Column) -> Column:
        return F.struct(field.cast("string").alias("field"), kind.alias("kind"))

    entries = F.col("_fields")
    present = F.transform(F.map_entries(entries), lambda e: item(e["key"], _json_type(e["value"])))
    lacking = F.filter(names, lambda n: ~F.map_contains_key(entries, n))
    items = F.concat(present, F.transform(lacking, lambda n: item(n, F.lit(ABSENT))))
    other = F.array(item(F.lit(None), F.lit(NO_OBJECT)))
    counted = (
        parsed.select(F.explode(F.when(entries.isNull(), other).otherwise(items)).alias("i"))
        .groupBy("i.field", "i.kind")
        .agg(F.count("*").alias("n"))
    )
    # As many rows as fields are declared.
    table = df.sparkSession.createDataFrame(
        [(f.name, f.type, list(HOLDS.get(f.type.lower(), HOLDS["string"]))) for f in declared],
        "name string, declared string, holds array<string>",
    )
    known = counted.join(F.broadcast(table), F.col("field") == F.col("name"), "left")
    kind = F.col("kind")
    status = (
        F.when(kind == NO_OBJECT, "no_object")
        .when(kind == ABSENT, "absent")
        .when(F.col("declared").isNull(), "undeclared")
        .when((kind != NULL) & ~F.array_contains("holds", kind), "retyped")
    )
    types = F.array_sort(F.collect_set(F.when(kind.isin(ABSENT, NO_OBJECT), None).otherwise(kind)))
    return (
        known.withColumn("status", status)
        .filter(F.col("status").isNotNull())
        .groupBy("field", "status", "declared")
        .agg(F.array_join(types, ",").alias("found"), F.sum("n").alias("records"))
        .select("field", "status", "declared", F.nullif("found", F.lit("")).alias("found"), "records")
    )
