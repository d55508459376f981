"""JSON Schemas (draft 7) as SQL over VARIANT values: rows are checked where they are, without Python.

A schema is compiled into expressions of two kinds.  `fits` tells whether a value fits, `faults` which rules it breaks and
where.  References make schemas recursive and expressions can't be, so they are written out down to the depth of the data:

* What a value's parts say is worked out once and bound to a name: an array of its parts, each with its key, its kind and
  the verdicts of all definitions on it.  A schema that refers to a definition in many places looks its verdict up.  So a
  level takes one copy of each definition, however often it is referred to, and a schema over n levels n copies.
* A subschema of a part that looks into the part becomes a definition of its own; one that says something about a text or a
  number only is written where it is used.  Members that have the same subschema share one test.

A level of nesting is two lambdas in each other, which Spark's analysis follows by recursion: LEVELS is what its stack bears.
Rows that nest deeper are checked by functions.schema, so no row goes unchecked.
"""

from __future__ import annotations

import json
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Levels that are written out.
LEVELS = 12
#: Keywords that look into a value's parts.
INNER = {"items", "additionalItems", "minItems", "maxItems", "required", "properties", "additionalProperties", "dependencies"}
COMBINED = ("allOf", "anyOf", "oneOf", "not")
_NUMBER = "({k} IN ('BIGINT', 'DOUBLE', 'FLOAT') OR startswith({k}, 'DECIMAL'))"
_TYPES = {
    "object": "{k} = 'OBJECT'", "array": "{k} = 'ARRAY'", "string": "{k} = 'STRING'", "boolean": "{k} = 'BOOLEAN'", "null": "{k} = 'VOID'", "number": _NUMBER,
    "integer": f"({_NUMBER} AND try_variant_get({{x}}, '$', 'double') = rint(try_variant_get({{x}}, '$', 'double')))",
}


class Unsupported(ValueError):
    """A schema that can't be written as columns."""


def quoted(text: str) -> str:
    """A string as a SQL literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def kind(x: str) -> str:
    """What a value is; the kinds of numbers are those of SQL."""
    return f"CASE WHEN try_variant_get({x}, '$', 'array<variant>') IS NOT NULL THEN 'ARRAY' WHEN try_variant_get({x}, '$', 'map<string,variant>') IS NOT NULL THEN 'OBJECT' ELSE coalesce(schema_of_variant({x}), 'VOID') END"


def parts(x: str, c: str, e: str) -> str:
    """A value's parts (k, v), in order; null where it has none to have."""
    items = f"transform(try_variant_get({x}, '$', 'array<variant>'), {c} -> named_struct('k', CAST(NULL AS STRING), 'v', {c}))"
    members = f"transform(map_entries(try_variant_get({x}, '$', 'map<string,variant>')), {e} -> named_struct('k', {e}.key, 'v', {e}.value))"
    return f"coalesce({items}, {members})"


def _all(tests: list[str], joint: str = " AND ", none: str = "true") -> str:
    return f"({joint.join(tests)})" if tests else none


class Compiled:
    """A schema's expressions for values of at most `levels` levels, the value itself counted."""

    def __init__(self, top: dict[str, Any], levels: int):
        self.top, self.levels = top, levels
        self.names: dict[str, Any] = {}  # definitions by name
        self.refs: dict[str, str] = {}  # references to names
        self.lifted: dict[str, str] = {}  # texts of subschemas to names
        self.bodies: dict[str, str] = {}
        self.used = 0

    # --- schemas

    def found(self, ref: str) -> Any:
        if not ref.startswith("#"):
            raise Unsupported(f"reference to another schema: {ref}")
        at: Any = self.top
        for part in ref[1:].split("/")[1:]:
            at = at[int(part)] if isinstance(at, list) else at[part.replace("~1", "/").replace("~0", "~")]
        return at

    def name_of(self, schema: Any) -> str:
        """The definition that a schema stands for, a new one if need be."""
        if isinstance(schema, dict) and "$ref" in schema:
            ref = schema["$ref"]
            if ref not in self.refs:
                self.refs[ref] = self.new(self.found(ref))
            return self.refs[ref]
        text = json.dumps(schema, sort_keys=True)
        if text not in self.lifted:
            self.lifted[text] = self.new(schema)
        return self.lifted[text]

    def new(self, schema: Any) -> str:
        name = f"d{len(self.names)}"
        self.names[name] = schema
        return name

    def looks_inside(self, schema: Any) -> bool:
        return isinstance(schema, dict) and ("$ref" in schema or bool(INNER & schema.keys()) or any(self.looks_inside(s) for c in COMBINED if c in schema for s in (schema[c] if isinstance(schema[c], list) else [schema[c]])))

    def fresh(self, prefix: str) -> str:
        self.used += 1
        return f"{prefix}{self.used}"

    # --- whether a value fits

    def same(self, value: Any, x: str, k: str) -> str:
        if isinstance(value, str):
            return f"({k} = 'STRING' AND try_variant_get({x}, '$', 'string') = {quoted(value)})"
        if value is None:
            return f"({k} = 'VOID')"
        if isinstance(value, bool):
            return f"({k} = 'BOOLEAN' AND try_variant_get({x}, '$', 'boolean') = {str(value).lower()})"
        if isinstance(value, int | float):
            return f"({_NUMBER.format(k=k)} AND try_variant_get({x}, '$', 'double') = {float(value)!r}D)"
        return f"(to_json({x}) = to_json(parse_json({quoted(json.dumps(value))})))"

    def one_of(self, values: list[Any], x: str, k: str) -> str:
        texts = [v for v in values if isinstance(v, str)]
        tests = [f"({k} = 'STRING' AND try_variant_get({x}, '$', 'string') IN ({', '.join(map(quoted, texts))}))"] if texts else []
        return _all(tests + [self.same(v, x, k) for v in values if not isinstance(v, str)], " OR ", "false")

    def plain(self, schema: dict[str, Any], x: str, k: str) -> dict[str, str]:
        """Tests of the keywords that are about a value itself."""
        text, number = f"try_variant_get({x}, '$', 'string')", f"try_variant_get({x}, '$', 'double')"
        out = {}
        for word, given in schema.items():
            if word == "type":
                out[word] = _all([_TYPES[t].format(x=x, k=k) for t in ([given] if isinstance(given, str) else given)], " OR ")
            elif word == "enum":
                out[word] = self.one_of(given, x, k)
            elif word == "const":
                out[word] = self.same(given, x, k)
            elif word == "pattern":
                out[word] = f"({k} <> 'STRING' OR {text} RLIKE {quoted('(?U)' + given)})"
            elif word in ("minLength", "maxLength"):
                out[word] = f"({k} <> 'STRING' OR char_length({text}) {'>=' if word == 'minLength' else '<='} {given})"
            elif word in ("minimum", "maximum"):
                out[word] = f"(NOT {_NUMBER.format(k=k)} OR {number} {'>=' if word == 'minimum' else '<='} {float(given)!r}D)"
        return out

    def part_fits(self, schema: Any, c: str) -> str:
        """Whether a part c (k, v, d: verdicts, with its kind t) fits."""
        if schema is True or schema == {}:
            return "true"
        if schema is False:
            return "false"
        if self.looks_inside(schema):
            return f"{c}.d.{self.name_of(schema)}"
        return self.value_fits(schema, f"{c}.v", f"{c}.d.t", "")

    def value_fits(self, schema: Any, x: str, k: str, ch: str, above: tuple[str, ...] = ()) -> str:
        """Whether a value x of kind k with parts ch fits."""
        if schema is True or schema is False:
            return str(schema).lower()
        if "$ref" in schema:
            if schema["$ref"] in above:
                raise Unsupported(f"a reference that leads to itself: {schema['$ref']}")
            return self.value_fits(self.found(schema["$ref"]), x, k, ch, (*above, schema["$ref"]))
        tests = list(self.plain(schema, x, k).values())
        if "items" in schema or "minItems" in schema or "maxItems" in schema:
            tests.append(f"({k} <> 'ARRAY' OR {_all(self.items_fit(schema, ch))})")
        members = self.members_fit(schema, x, k, ch, above)
        if members:
            tests.append(f"({k} <> 'OBJECT' OR {_all(members)})")
        for word in COMBINED:
            if word in schema:
                subs = [self.value_fits(s, x, k, ch, above) for s in (schema[word] if isinstance(schema[word], list) else [schema[word]])]
                tests.append(
                    _all(subs) if word == "allOf" else _all(subs, " OR ") if word == "anyOf" else f"(NOT {subs[0]})" if word == "not"
                    else f"(({' + '.join(f'CAST({s} AS INT)' for s in subs)}) = 1)"
                )
        return _all([f"coalesce({t}, false)" for t in tests])

    def items_fit(self, schema: dict[str, Any], ch: str) -> list[str]:
        tests = [f"size({ch}) {'>=' if w == 'minItems' else '<='} {schema[w]}" for w in ("minItems", "maxItems") if w in schema]
        items = schema.get("items", True)
        if isinstance(items, list):
            tests += [f"(size({ch}) <= {i} OR {self.part_fits(s, f'get({ch}, {i})')})" for i, s in enumerate(items) if s not in (True, {})]
            c = self.fresh("c")
            more = self.part_fits(schema.get("additionalItems", True), c)
            if more != "true":
                tests.append(f"(size({ch}) <= {len(items)} OR forall(slice({ch}, {len(items) + 1}, size({ch})), {c} -> {more}))")
        else:
            c = self.fresh("c")
            test = self.part_fits(items, c)
            tests += [f"forall({ch}, {c} -> {test})"] if test != "true" else []
        return tests

    def members_fit(self, schema: dict[str, Any], x: str, k: str, ch: str, above: tuple[str, ...]) -> list[str]:
        has = lambda name: f"exists({ch}, {(c := self.fresh('c'))} -> {c}.k = {quoted(name)})"
        tests = [has(name) for name in schema.get("required", ())]
        given, others = schema.get("properties", {}), schema.get("additionalProperties", True)
        if given or others not in (True, {}):
            c, alike = self.fresh("c"), {}
            for name, sub in given.items():
                alike.setdefault(self.part_fits(sub, c), []).append(name)
            cases = [f"WHEN {c}.k IN ({', '.join(map(quoted, names))}) THEN {test}" for test, names in alike.items()]
            rest = self.part_fits(others, c)
            tests.append(f"forall({ch}, {c} -> CASE {' '.join(cases)} ELSE {rest} END)" if cases else f"forall({ch}, {c} -> {rest})")
        for name, needs in schema.get("dependencies", {}).items():
            met = _all([has(n) for n in needs]) if isinstance(needs, list) else self.value_fits(needs, x, k, ch, above)
            tests.append(f"(NOT {has(name)} OR {met})")
        return tests

    def verdicts(self, x: str, levels: int) -> str:
        """A struct of a value's kind `t` and a field for each definition."""
        if not levels:
            none = "".join(f", '{n}', false" for n in self.bodies)
            return f"named_struct('t', {kind(x)}{none})"
        c, e, p, b = (self.fresh(prefix) for prefix in "cepb")
        inner = f"transform({parts(x, c, e)}, {p} -> named_struct('k', {p}.k, 'v', {p}.v, 'd', {self.verdicts(f'{p}.v', levels - 1)}))"
        bodies = "".join(f", '{n}', {body.replace('§x', f'{b}.x').replace('§k', f'{b}.t').replace('§p', f'{b}.p')}" for n, body in self.bodies.items())
        return f"get(transform(array(named_struct('x', {x}, 't', {kind(x)}, 'p', {inner})), {b} -> named_struct('t', {b}.t{bodies})), 0)"

    def define(self) -> None:
        """The bodies of all definitions; making one may bring up others."""
        while missing := [n for n in self.names if n not in self.bodies]:
            for n in missing:
                self.bodies[n] = self.value_fits(self.names[n], "§x", "§k", "§p")

    # --- which rules a value breaks

    def faults(self, schema: Any, x: str, path: str, levels: int, above: tuple[str, ...] = ()) -> str:
        """An array of `keyword at path` for a value x; path is an expression.  What combinations and recursive references
        say is told at their own place."""
        told = lambda test, word, where=path: f"IF(coalesce({test}, false), array(), array(concat('{word} at ', {where})))"
        if schema is True or schema == {}:
            return "CAST(array() AS array<string>)"
        if schema is False:
            return told("false", "false")
        if "$ref" in schema:
            ref = schema["$ref"]
            if ref in above:
                return told(f"{self.verdicts_later(x, levels)}.{self.name_of(schema)}", "$ref")
            return self.faults(self.found(ref), x, path, levels, (*above, ref))
        k = f"({kind(x)})"
        out = [told(test, word) for word, test in self.plain(schema, x, k).items()]
        items, members = f"try_variant_get({x}, '$', 'array<variant>')", f"try_variant_get({x}, '$', 'map<string,variant>')"
        for word in ("minItems", "maxItems"):
            if word in schema:
                out.append(told(f"({items} IS NULL OR size({items}) {'>=' if word == 'minItems' else '<='} {schema[word]})", word))
        step = lambda name: f"concat({path}, '/', {name})"
        given = schema.get("items", True)
        if isinstance(given, list):
            for i, sub in enumerate(given):
                inner = self.faults(sub, f"get({items}, {i})", step(quoted(str(i))), levels - 1, above)
                out.append(f"IF(coalesce(size({items}), 0) > {i}, {inner}, array())")
            if (more := schema.get("additionalItems", True)) not in (True, {}):
                out.append(self.each(f"slice({items}, {len(given) + 1}, greatest(size({items}) - {len(given)}, 0))", len(given), more, path, levels, above))
        elif given not in (True, {}):
            out.append(self.each(items, 0, given, path, levels, above))
        for name in schema.get("required", ()):
            out.append(told(f"({members} IS NULL OR map_contains_key({members}, {quoted(name)}))", "required", step(quoted(name))))
        named = schema.get("properties", {})
        for name, sub in named.items():
            if sub not in (True, {}):
                inner = self.faults(sub, f"try_element_at({members}, {quoted(name)})", step(quoted(name)), levels - 1, above)
                out.append(f"IF(coalesce(map_contains_key({members}, {quoted(name)}), false), {inner}, array())")
        if (others := schema.get("additionalProperties", True)) not in (True, {}):
            e, m = self.fresh("e"), self.fresh("m")
            known = f"{m}.key NOT IN ({', '.join(map(quoted, named))})" if named else "true"
            left = f"filter(map_entries({members}), {m} -> {known})"
            inner = f"array(concat('additionalProperties at ', {step(f'{e}.key')}))" if others is False else self.faults(others, f"{e}.value", step(f"{e}.key"), levels - 1, above)
            out.append(f"coalesce(flatten(transform({left}, {e} -> {inner})), array())")
        for name, needs in schema.get("dependencies", {}).items():
            if isinstance(needs, list):
                inner = "concat(" + ", ".join([*(told(f"map_contains_key({members}, {quoted(n)})", "dependencies", step(quoted(n))) for n in needs), "array()"]) + ")"
            else:
                inner = self.faults(needs, x, path, levels, above)
            out.append(f"IF(coalesce(map_contains_key({members}, {quoted(name)}), false), {inner}, array())")
        for sub in schema.get("allOf", ()):
            out.append(self.faults(sub, x, path, levels, above))
        for word in ("anyOf", "oneOf", "not"):
            if word in schema:
                out.append(told(f"{self.verdicts_later(x, levels)}.{self.name_of({word: schema[word]})}", word))
        return f"concat({', '.join([*out, 'CAST(array() AS array<string>)'])})"

    def each(self, items: str, first: int, schema: Any, path: str, levels: int, above: tuple[str, ...]) -> str:
        c, i = self.fresh("c"), self.fresh("i")
        inner = self.faults(schema, c, f"concat({path}, '/', CAST({i} + {first} AS STRING))", levels - 1, above)
        return f"coalesce(flatten(transform({items}, ({c}, {i}) -> {inner})), array())"

    def verdicts_later(self, x: str, levels: int) -> str:
        """A mark for verdicts(), which is filled in when all definitions are known."""
        self.later[mark := f"«{len(self.later)}»"] = (x, max(levels, 0))
        return mark

    def expression(self, column: str) -> str:
        """The array of faults of a VARIANT column."""
        self.later: dict[str, tuple[str, int]] = {}
        out = self.faults(self.top, f"`{column}`", "''", self.levels)
        self.define()
        for mark, (x, levels) in reversed(self.later.items()):
            out = out.replace(mark, self.verdicts(x, levels))
        return out


def depth(text: Column) -> Column:
    """Levels of a JSON text: 1 for a number, one more for each array or object around it; not told for other texts."""
    bare = F.regexp_replace(F.replace(F.replace(text, F.lit("\\\\"), F.lit("")), F.lit('\\"'), F.lit("")), '"[^"]*"', "")
    marks = F.split(F.regexp_replace(bare, r"[^\[\]{}]", ""), "")
    start = F.struct(F.lit(0).alias("now"), F.lit(0).alias("most"))

    def step(s: Column, mark: Column) -> Column:
        now = s["now"] + F.when(mark.isin("[", "{"), 1).when(mark.isin("]", "}"), -1).otherwise(0)
        return F.struct(now.alias("now"), F.greatest(s["most"], now).alias("most"))

    return F.aggregate(marks, start, step)["most"] + 1


def deepest(rows: DataFrame, text: str) -> int:
    """Levels of the deepest of some JSON texts; 1 if there are none."""
    return rows.agg(F.coalesce(F.max(depth(F.col(text))), F.lit(1))).first()[0]


def faults(rows: DataFrame, schema: dict[str, Any], text: str, levels: int) -> DataFrame:
    """rows with faults: an array of `keyword at path` for what a JSON text breaks of a schema; empty for texts that fit.

    levels bounds the texts' depth (see deepest()); what is deeper counts as broken.  A text that is null or isn't JSON (or
    repeats a name in an object) is judged as null.  Raises Unsupported for schemas that refer to others.
    """
    value = "_value"
    while value in rows.columns:
        value = f"_{value}"
    parsed = rows.withColumn(value, F.coalesce(F.try_parse_json(text), F.parse_json(F.lit("null"))))
    keep = [F.col(f"`{c}`") for c in rows.columns if c != "faults"]
    return parsed.select(*keep, F.expr(Compiled(schema, levels).expression(value)).alias("faults"))
