"""JSON Schema compiled to column expressions: a table of documents against a schema, without a document on the driver.

Each subschema becomes an expression over a variant that gives its faults as an
array of texts; arrays are walked by higher-order functions.  What is said is what
``rules.document_faults`` says of one document.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Keywords that are compiled, and those that say nothing about a document.
KNOWN = {"$ref", "allOf", "anyOf", "oneOf", "not", "type", "const", "enum", "properties", "required", "additionalProperties", "minProperties", "maxProperties", "items", "uniqueItems", "minItems", "maxItems", "pattern", "minLength", "maxLength", "minimum", "maximum"}
SILENT = {"$schema", "$id", "$defs", "definitions", "title", "description", "default", "examples", "$comment", "format"}

INTEGER, NUMBER = r"^(BIGINT|DECIMAL\(\d+,0\))$", r"^(BIGINT|DECIMAL.*|DOUBLE|FLOAT)$"


def _none() -> Column:
    return F.array().cast("array<string>")


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is made once for a row, however often it is named."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


class Value:
    """A variant and what is asked of it; ``x`` is what ``read`` makes of it."""

    def __init__(self, x: Column):
        self.v, self.object, self.array, self.scalar = (x[c] for c in ("v", "object", "array", "scalar"))
        self.is_object, self.is_array = self.object.isNotNull(), self.array.isNotNull()
        self.text = F.try_variant_get(self.v, "$", "string")
        self.number = F.try_variant_get(self.v, "$", "double")

    @staticmethod
    def read(v: Column) -> Column:
        parts = F.struct(v.alias("v"), F.try_variant_get(v, "$", "map<string,variant>").alias("object"), F.try_variant_get(v, "$", "array<variant>").alias("array"))
        scalar = lambda p: F.when(p["object"].isNull() & p["array"].isNull(), F.schema_of_variant(p["v"]))  # noqa: E731 - of a scalar alone, as it reads all of a value
        return once(parts, lambda p: F.struct(p["v"].alias("v"), p["object"].alias("object"), p["array"].alias("array"), scalar(p).alias("scalar")))

    def said(self, c: Column) -> Column:
        return F.coalesce(c, F.lit(False))

    @property
    def is_string(self) -> Column:
        return self.said(self.scalar == "STRING")

    @property
    def is_number(self) -> Column:
        return self.said(self.scalar.rlike(NUMBER))

    def is_kind(self, kind: str) -> Column:
        return {
            "object": self.is_object, "array": self.is_array, "string": self.is_string, "boolean": self.said(self.scalar == "BOOLEAN"),
            "integer": self.said(self.scalar.rlike(INTEGER)), "number": self.is_number, "null": self.said(F.is_variant_null(self.v)),
        }[kind]

    def equals(self, x: Any) -> Column:
        if x is None:
            return self.is_kind("null")
        if isinstance(x, bool):
            return self.is_kind("boolean") & (self.text == str(x).lower())
        if isinstance(x, int | float):
            return self.is_number & (self.number == float(x))
        if isinstance(x, str):
            return self.is_string & (self.text == x)
        return F.to_json(self.v) == F.to_json(F.parse_json(F.lit(json.dumps(x))))


def _step(name: str) -> str:
    return f'$["{name}"]' if not name.replace("_", "").isalnum() else f"$.{name}"


def compiled(v: Column, at: Column, schema: Any, root: dict, refs: tuple[str, ...] = ()) -> Column:
    """The faults of a variant at a place, as an array of texts.  Raises on keywords that aren't known and on schemas that hold themselves."""
    if schema is True or schema == {}:
        return _none()
    if schema is False:
        return F.array(F.concat(at, F.lit(": fits what it must not")))
    if odd := set(schema) - KNOWN - SILENT:
        raise ValueError(f"keywords that aren't known: {', '.join(sorted(odd))}")
    if "$ref" in schema:
        if schema["$ref"] in refs:
            raise ValueError(f"a schema that holds itself: {schema['$ref']}")
        target = root
        for step in schema["$ref"].lstrip("#/").split("/"):
            target = target[step]
        return compiled(v, at, target, root, (*refs, schema["$ref"]))
    return once(v, lambda v: once(Value.read(v), lambda x: _faults(Value(x), at, schema, root, refs)))


def _faults(x: Value, at: Column, schema: dict, root: dict, refs: tuple[str, ...]) -> Column:
    sub = lambda s: compiled(x.v, at, s, root, refs)
    say = lambda broken, text: F.when(broken, F.array(F.concat(at, F.lit(f": {text}")))).otherwise(_none())
    whole, rest = [sub(s) for s in schema.get("allOf", ())], []
    if "anyOf" in schema:
        whole.append(say(sum(((F.size(sub(s)) == 0).cast("int") for s in schema["anyOf"]), F.lit(0)) == 0, "fits none of anyOf"))
    if "oneOf" in schema:
        whole.append(say(sum(((F.size(sub(s)) == 0).cast("int") for s in schema["oneOf"]), F.lit(0)) != 1, "does not fit exactly one of oneOf"))
    if "not" in schema:
        whole.append(say(F.size(sub(schema["not"])) == 0, "fits what it must not"))
    if "const" in schema:
        rest.append(say(~x.equals(schema["const"]), f"is not {schema['const']!r}"))
    if "enum" in schema:
        rest.append(say(~_any(x.equals(e) for e in schema["enum"]), "is none of the values"))

    own, more = schema.get("properties", {}), schema.get("additionalProperties", True)
    inner = [F.transform(F.array_except(F.array(*map(F.lit, schema["required"])), F.map_keys(x.object)), lambda k: F.concat(at, F.lit(": lacks "), k))] if schema.get("required") else []
    for k, s in own.items():
        inner.append(F.when(F.map_contains_key(x.object, k), compiled(x.object[k], F.concat(at, F.lit(f".{k}")), s, root, refs)).otherwise(_none()))
    others = F.array_except(F.map_keys(x.object), F.array(*map(F.lit, own)).cast("array<string>"))
    if more is False:
        inner.append(F.transform(others, lambda k: F.concat(at, F.lit(": has "), k)))
    elif isinstance(more, dict) and more:
        inner.append(F.flatten(F.transform(others, lambda k: compiled(x.object[k], F.concat(at, F.lit("."), k), more, root, refs))))
    inner += _bounds(schema, F.size(x.object), "minProperties", "maxProperties", say)
    if inner:
        rest.append(F.when(x.is_object, F.concat(*inner)).otherwise(_none()))

    inner = [F.flatten(F.transform(x.array, lambda e, i: compiled(e, F.concat(at, F.lit("["), i.cast("string"), F.lit("]")), schema["items"], root, refs)))] if schema.get("items") else []
    if schema.get("uniqueItems"):
        texts = F.transform(x.array, lambda e: F.to_json(e))
        inner.append(say(F.size(F.array_distinct(texts)) < F.size(texts), "repeats an item"))
    inner += _bounds(schema, F.size(x.array), "minItems", "maxItems", say)
    if inner:
        rest.append(F.when(x.is_array, F.concat(*inner)).otherwise(_none()))

    inner = [say(~x.text.rlike(schema["pattern"]), "does not match the pattern")] if "pattern" in schema else []
    inner += _bounds(schema, F.length(x.text), "minLength", "maxLength", say)
    if inner:
        rest.append(F.when(x.is_string, F.concat(*inner)).otherwise(_none()))
    if inner := _bounds(schema, x.number, "minimum", "maximum", say):
        rest.append(F.when(x.is_number, F.concat(*inner)).otherwise(_none()))

    found = F.concat(*rest) if rest else _none()
    if kinds := schema.get("type"):
        found = F.when(_any(x.is_kind(k) for k in ([kinds] if isinstance(kinds, str) else kinds)), found).otherwise(F.array(F.concat(at, F.lit(f": is not {kinds}"))))
    return F.concat(*whole, found)


def _any(conditions) -> Column:
    out = F.lit(False)
    for c in conditions:
        out = out | c
    return out


def _bounds(schema: dict, size: Column, low: str, high: str, say) -> list[Column]:
    out = F.lit(False)
    for name, broken in ((low, lambda n: size < n), (high, lambda n: size > n)):
        if name in schema:
            out = out | broken(schema[name])
    return [say(out, "is out of bounds")] if low in schema or high in schema else []


def violations(docs: DataFrame, schema: dict, key: str = "key", body: str = "body", rule: str = "schema") -> DataFrame:
    """(rule, key, path, detail) for what a schema doesn't allow in each row's document (V1).

    A text that isn't strict JSON, or is null, is a fault of its own at ``$``.
    """
    v = F.col("_v")
    found = F.when(v.isNull(), F.array(F.lit("$: is not JSON"))).otherwise(compiled(v, F.lit("$"), schema, schema))
    each = docs.select(F.col(key).cast("string").alias("key"), F.try_parse_json(F.col(body)).alias("_v")).select("key", F.explode(found).alias("x"))
    return each.select(F.lit(rule).alias("rule"), "key", F.expr("substring(x, 1, instr(x, ': ') - 1)").alias("path"), F.expr("substring(x, instr(x, ': ') + 2)").alias("detail"))
