import random

from pyspark.sql import functions as F

from strata.functions.text import resolve_mapping
from strata.operators import conform, mappings
from strata.operators.drift import payload_drift
from strata.plans.specs import FieldSpec
from tests.support import rows

RULES = "position bigint, source string, target string"


def resolved(spark, rules):
    found = mappings.resolve_rules(spark.createDataFrame(rules, RULES)).collect()
    assert len({r.source for r in found}) == len(found)
    return {r.source: r.target for r in found}


def plain(rules):
    """The rules one after the other for every source; the first of equal sources counts."""
    out = {}
    for _, source, target in reversed(rules):
        out[source.lower()] = out.get(target.lower(), target)
    return out


def test_chains_as_on_the_driver(spark, monkeypatch):
    rng = random.Random(1)
    for n, names in ((0, 1), (200, 30), (200, 400)):
        monkeypatch.setattr(mappings, "STRETCH", rng.choice([3, 20, 1 << 16]))
        pick = lambda: rng.choice(["v{}", "V{}"]).format(rng.randrange(names))
        rules = [(3 * i, pick(), pick()) for i in range(n)]
        assert resolved(spark, rules) == plain(rules)
    unique = {f"k{i}": f"K{i + 1}" for i in range(300)}
    assert resolved(spark, [(i, a, b) for i, (a, b) in enumerate(unique.items())]) == resolve_mapping(unique)


def test_cycles_nulls_and_a_target_of_very_many(spark):
    assert resolved(spark, [(1, "a", "b"), (2, "b", "a"), (3, "c", "c")]) == {"a": "a", "b": "a", "c": "c"}
    assert resolved(spark, [(2, "b", "a"), (1, "a", "B")]) == {"a": "a", "b": "a"}
    assert resolved(spark, [(1, None, "x"), (2, "x", None), (None, "x", "y")]) == {}
    many = [(i, f"s{i}", "Hot") for i in range(1000)] + [(2000, "hot", "cold"), (2001, "COLD", "ice")]
    assert set(resolved(spark, many).values()) == {"ice"}


def test_a_table_replaces_values_like_a_mapping(spark):
    mapping = {"a": "b", "B": "c", "x": "y"}
    frame = spark.createDataFrame([(v, "k") for v in ("A", "b", "x", "z", None)], "v string, source string")
    table = spark.createDataFrame([(i, *r) for i, r in enumerate(mapping.items())], RULES)
    assert rows(conform.map_values(frame, "v", table)) == rows(conform.map_values(frame, "v", mapping))


def test_payload_drift(spark):
    payloads = ['{"a": "x", "b": 1}', '{"a": 2, "c": null}', '{"a": null, "b": 1.5, "A": true}', "[]", None, "{", "{}", '{"a": {"b": 1}, "b": "1"}']
    fields = [FieldSpec("a"), FieldSpec("b", "double"), FieldSpec("d", "int")]
    frame = spark.createDataFrame([(p,) for p in payloads], "payload string")
    assert rows(payload_drift(frame, fields)) == sorted([
        ("A", "undeclared", None, "BOOLEAN", 1), ("c", "undeclared", None, "VOID", 1), ("a", "retyped", "string", "BIGINT,OBJECT", 2),
        ("b", "retyped", "double", "STRING", 1), ("a", "absent", "string", None, 1), ("b", "absent", "double", None, 2),
        ("d", "absent", "int", None, 5), (None, "no_object", None, None, 3),
    ], key=str)
    assert payload_drift(frame.filter(F.lit(False)), fields).collect() == []
    plan = payload_drift(frame, fields)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.lower().count("parsejson") == 1, plan
