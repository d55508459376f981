"""Schemas as columns against the validator that looks at one value at a time."""

import json
import random

import pytest
from pyspark.sql import functions as F

from glyphmill.functions import shapes
from glyphmill.functions.schema import Schema
from glyphmill.operators import validate

NODE = {"$ref": "#/definitions/node"}
SCHEMAS = [
    {"type": ["array", "null"], "minItems": 1, "maxItems": 3, "items": {"type": "integer", "minimum": -2, "maximum": 5}},
    {"items": [{"type": "string", "minLength": 1, "maxLength": 3}, {"enum": [1, "a", None, True, [1, {"x": 2}], {"b": [], "a": 1.0}]}], "additionalItems": {"type": "number"}},
    {"items": [{"const": 1}, True, {}], "additionalItems": False},
    {"type": "object", "required": ["a", "é"], "properties": {"a": {"type": "boolean"}, "b": {"pattern": "^\\w+'?$"}, "it's": False}, "additionalProperties": {"type": "array", "items": {"type": "string"}}},
    {"properties": {"a": {"properties": {"b": {"type": "string"}}, "additionalProperties": False}}, "additionalProperties": False, "dependencies": {"a": ["c"], "c": {"required": ["d"]}}},
    {"oneOf": [{"type": "integer"}, {"minimum": 2}, {"type": "array", "items": {"oneOf": [{"type": "string"}, {"const": 0}]}}]},
    {"allOf": [{"type": ["string", "number"]}, {"not": {"enum": ["x", 3]}}], "anyOf": [{"type": "number", "maximum": 4}, {"minLength": 2}]},
    {"definitions": {"node": {"oneOf": [{"type": "string"}, {"type": "array", "items": NODE}, {"type": "object", "required": ["a"], "properties": {"a": NODE, "b": {"$ref": "#/definitions/few"}}, "additionalProperties": False}]}, "few": {"type": "object", "additionalProperties": {"type": "integer"}}}, "$ref": "#/definitions/node"},
    {"definitions": {"x": {"properties": {"a": {"not": {"$ref": "#/definitions/y"}}}}, "y": {"anyOf": [{"$ref": "#/definitions/x"}, {"type": "null"}], "minItems": 1}}, "type": "object", "additionalProperties": {"anyOf": [{"$ref": "#/definitions/y"}, {"$ref": "#/definitions/x"}]}},
    {"items": {"not": {"items": {"not": {"type": "string"}}}}},
]


def value(rng, depth=0):
    kind = rng.randrange(8 if depth < 4 else 5)
    if kind < 5:
        return [rng.choice([None, True, False]), rng.choice([-3, 0, 1, 2, 3, 6]), rng.choice([1.0, 2.5, 1e20, -0.5]), rng.choice(["", "a", "x", "it's", "abcd", "é", "b\n"]), rng.choice([[], {}])][kind]
    if kind == 5:
        return [value(rng, depth + 1) for _ in range(rng.randrange(1, 5))]
    return {k: value(rng, depth + 1) for k in rng.sample(["a", "b", "c", "d", "é", "it's"], rng.randrange(1, 5))}


def plain(schema, v):
    return sorted(f"{word} at {''.join(f'/{p}' for p in path)}" for path, word in Schema(schema).faults(v))


@pytest.mark.parametrize("number", range(len(SCHEMAS)))
def test_faults_equal_the_validator(spark, number):
    rng, schema = random.Random(number), SCHEMAS[number]
    values = [value(rng) for _ in range(250)] + [None, {}, [], "x", 3]
    rows = spark.createDataFrame([(i, json.dumps(v, ensure_ascii=i % 2 == 0)) for i, v in enumerate(values)], "k long, t string")
    levels = shapes.deepest(rows, "t")
    found = shapes.faults(rows, schema, "t", levels)
    assert not any(word in found._jdf.queryExecution().executedPlan().toString() for word in ("Python", "Pandas", "Arrow"))
    got = {r["k"]: sorted(r["faults"]) for r in found.collect()}
    for i, v in enumerate(values):
        assert got[i] == plain(schema, v), (v, schema)


def test_depth(spark):
    texts = {"1": 1, "[]": 2, '{"a":[{}]}': 4, '"[[["': 1, '["\\"[[", "\\\\", {"]":1}]': 3, "": 1}
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    assert {r["t"]: r["d"] for r in rows.select("t", shapes.depth(F.col("t")).alias("d")).collect()} == texts
    assert shapes.deepest(rows.where("false"), "t") == 1


def test_odd_texts_and_schemas(spark):
    rows = spark.createDataFrame([(1, None, "x"), (2, "{", "x"), (3, '{"a":1,"a":2}', "x"), (4, "{}", "x")], "k long, t string, faults string")
    got = {r["k"]: r["faults"] for r in shapes.faults(rows, {"type": "object"}, "t", 2).collect()}
    assert got == {1: ["type at "], 2: ["type at "], 3: ["type at "], 4: []}
    assert shapes.faults(rows.where("false"), {"type": "object"}, "t", 1).count() == 0
    with pytest.raises(shapes.Unsupported):
        shapes.faults(rows, {"$ref": "other.json#/x"}, "t", 2)
    with pytest.raises(shapes.Unsupported):
        shapes.faults(rows, {"definitions": {"a": {"allOf": [{"$ref": "#/definitions/a"}]}}, "oneOf": [{"$ref": "#/definitions/a"}]}, "t", 2)


def test_rows_beyond_the_levels_are_checked_one_by_one(spark):
    schema = {"definitions": SCHEMAS[7]["definitions"], "type": "array", "items": {"type": "array", "items": [{"anyOf": [NODE]}]}}

    def nested(n, inside):
        return "[" * n + inside + "]" * n

    texts = [nested(k, x) for k in (1, 5, shapes.LEVELS - 2, shapes.LEVELS, 40) for x in ('"s"', "0", '{"a":"s"}', '{"c":"s"}')]
    banks = spark.createDataFrame([(1, i, f"[{t}]") for i, t in enumerate(texts)], "bank long, place long, row string")
    got = {(r["place"], r["rule"]) for r in validate.schema_errors(banks, schema).collect()}
    want = {(i, f"schema {word} at {'/'.join(map(str, path[1:]))}") for i, t in enumerate(texts) for path, word in Schema(schema).faults(json.loads(f"[[{t}]]"))}
    assert got == want and len(want) == 10
    shallow = validate.schema_errors(banks.where("place < 4"), schema)
    assert "Pandas" not in shallow._jdf.queryExecution().executedPlan().toString()


def test_index_rules(spark):
    cases = {
        "[]": ["index_not_object"], "{": ["index_not_object"], "{}": ["missing_title", "missing_revision", "missing_format"],
        '{"title":"t","revision":"r","format":3}': [], '{"title":null,"revision":"r","version":3}': ["missing_title"],
        '{"title":"t","revision":"r","format":3,"isUpdatable":true,"indexUrl":"u"}': ["update_without_urls"],
        '{"title":"t","revision":"r","format":3,"isUpdatable":false}': [], '{"title":"t","revision":"r","format":3,"isUpdatable":null}': [],
        '{"title":"t","revision":"r","format":3,"sourceLanguage":"zho","targetLanguage":"Zh"}': ["bad_targetLanguage"],
        '{"title":"t","revision":"r","format":3,"sourceLanguage":null,"targetLanguage":"e1"}': ["bad_sourceLanguage", "bad_targetLanguage"],
    }
    rows = spark.createDataFrame([(t,) for t in cases], "t string")
    assert {r["t"]: r["e"] for r in rows.select("t", validate.index_rules(F.col("t")).alias("e")).collect()} == cases
    light = rows.select("t", validate.index_rules(F.col("t"), "light", {"title": "t", "url": 1}).alias("e")).collect()
    assert {r["t"]: r["e"] for r in light}['{"title":"t","revision":"r","format":3}'] == ["light_url"]
    assert "valid: false" in validate.report({"valid": False, "errors": ["x"]})


def test_a_pronunciation_is_normalized_once(spark):
    """Within functions of arrays each mention of a column is computed, so what is named often is bound."""
    from pyspark.sql import functions as F

    from glyphmill.functions import readings, text

    c = F.col("v")
    rows = spark.createDataFrame([("　\x1f gā/gà \x85 ",)], "v string")
    df = rows.select(readings.reading(c, c, F.lit(False)).alias("r"), text.strip(c).alias("s"))
    plan = df._jdf.queryExecution().analyzed().toString()
    assert (plan.count("decompose"), plan.count("compose") - plan.count("decompose")) == (1, 1)
    assert df.select("r.readings", "s").first() == (["gā", "gà"], "gā/gà")
