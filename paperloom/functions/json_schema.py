"""JSON Schema (draft 2020-12) as column expressions over VARIANT.

``errors`` turns a schema into one expression that gives all errors of a value, sorted by path: no Python runs over the
rows, and a schema is read once, on the driver. References (``$ref``) go to ``$defs`` of the schema itself or to other
documents by their ``$id``. A keyword that would decide over validity but isn't known raises an error, instead of letting
rows pass. Recursive references are followed ``depth`` levels down; a value that lies deeper has an error of the rule
``depth``.

An error has a path (keys and places from the root, as in ``/a/0/b``), the keyword that failed and a detail (a missing or
unexpected name). As usual, ``anyOf``, ``oneOf`` and ``not`` give one error where they stand, ``allOf``, ``$ref``, ``if``
with ``then`` and ``else`` those of what they apply. 1.0 is an integer and equals 1.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import let

#: Keywords that say nothing about validity.
SILENT = {"$id", "$schema", "$defs", "$comment", "$anchor", "title", "description", "default", "examples", "deprecated", "readOnly", "writeOnly", "then", "else"}
#: Formats that are checked; others are annotations.
FORMATS = {
    "date-time": r"^\d{4}-(0[1-9]|1[0-2])-(0[1-9]|[12]\d|3[01])[Tt]([01]\d|2[0-3]):[0-5]\d:([0-5]\d|60)(\.\d+)?([Zz]|[+-]([01]\d|2[0-3]):[0-5]\d)$",
    "date": r"^\d{4}-(0[1-9]|1[0-2])-(0[1-9]|[12]\d|3[01])$",
    "email": r"^[^@\s]+@[^@\s]+$",
    "uuid": r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$",
}
ERROR = "array<struct<steps:array<string>,rule:string,detail:string>>"
#: Digits of a place in a path while errors are sorted.
PLACE = 10
DEPTH = 12


@dataclass(frozen=True)
class Value:
    """A value and what can be asked about it; each answer is an expression over a lambda's variable."""

    v: Column
    steps: Column
    kind: Column  # the head of the variant's schema, such as STRING or OBJECT
    object: Column  # map<string, variant>, null for others
    list: Column  # array<variant>, null for others

    is_string = property(lambda x: x.kind == "STRING")
    is_object = property(lambda x: x.kind == "OBJECT")
    is_array = property(lambda x: x.kind == "ARRAY")
    is_number = property(lambda x: x.kind.isin("BIGINT", "DECIMAL", "DOUBLE", "FLOAT"))
    text = property(lambda x: F.try_variant_get(x.v, "$", "string"))
    number = property(lambda x: F.try_variant_get(x.v, "$", "double"))

    def at(self, step: Column) -> Column:
        return F.concat(self.steps, F.array(step))


def _of(v: Column, steps: Column, use) -> Column:
    """``use(Value)`` with the value's parts computed once."""
    def bound(x: Column) -> Column:
        return use(Value(x["v"], x["steps"], x["kind"], x["object"], x["list"]))

    # the schema of an object or a list would be that of all it holds, at every level again
    held = F.struct(v.alias("v"), steps.alias("steps"), F.try_variant_get(v, "$", "map<string,variant>").alias("object"), F.try_variant_get(v, "$", "array<variant>").alias("list"))
    parts = let(held, lambda x: F.struct(
        x["v"].alias("v"), x["steps"].alias("steps"),
        F.when(x["object"].isNotNull(), "OBJECT").when(x["list"].isNotNull(), "ARRAY").otherwise(F.regexp_extract(F.schema_of_variant(x["v"]), "^[A-Z]+", 0)).alias("kind"),
        x["object"].alias("object"), x["list"].alias("list"),
    ))
    # errors are lists: flattening binds the parts as taking the first would, without asking for the body's type at each row
    return F.flatten(F.transform(F.array(parts), bound))


def _none() -> Column:
    return F.array().cast(ERROR)


def _error(value: Value, rule: str, detail: Column | str | None = None) -> Column:
    detail = F.lit(detail) if detail is None or isinstance(detail, str) else detail
    return F.struct(value.steps.alias("steps"), F.lit(rule).alias("rule"), detail.cast("string").alias("detail"))


def _when(broken: Column, value: Value, rule: str, detail=None) -> Column:
    return F.when(F.coalesce(broken, F.lit(False)), F.array(_error(value, rule, detail))).otherwise(_none())


def _each(names: Column, value: Value, rule: str) -> Column:
    return F.coalesce(F.transform(names, lambda n: _error(value, rule, n)), _none())


def _joined(parts: list[Column]) -> Column:
    return parts[0] if len(parts) == 1 else F.concat(*parts) if parts else _none()


def _canonical(v: Column) -> Column:
    """A text that equal JSON values share: numbers as doubles, objects with sorted keys."""
    kind = F.regexp_extract(F.schema_of_variant(v), "^[A-Z]+", 0)
    return F.when(kind.isin("BIGINT", "DECIMAL", "DOUBLE", "FLOAT"), F.concat(F.lit("#"), F.try_variant_get(v, "$", "double").cast("string"))).otherwise(F.to_json(v))


def _equals(value: Value, constant) -> Column:
    if constant is None:
        return value.kind == "VOID"
    if isinstance(constant, bool):
        return (value.kind == "BOOLEAN") & (F.try_variant_get(value.v, "$", "boolean") == constant)
    if isinstance(constant, (int, float)):
        whole = isinstance(constant, int) and abs(constant) < 1 << 63
        return value.is_number & (F.when(value.kind == "BIGINT", F.try_variant_get(value.v, "$", "bigint") == constant).otherwise(value.number == float(constant)) if whole else value.number == float(constant))
    if isinstance(constant, str):
        return value.is_string & (value.text == constant)
    return F.to_json(value.v) == F.to_json(F.parse_json(F.lit(json.dumps(constant, ensure_ascii=False))))


def _compared(value: Value, limit, sign: str) -> Column:
    """Whether a number breaks a limit."""
    compare = {"<": lambda a, b: a < b, ">": lambda a, b: a > b, "<=": lambda a, b: a <= b, ">=": lambda a, b: a >= b}[sign]
    plain = compare(value.number, F.lit(float(limit)))
    if isinstance(limit, int) and abs(limit) < 1 << 63:
        plain = F.when(value.kind == "BIGINT", compare(F.try_variant_get(value.v, "$", "bigint"), F.lit(limit))).otherwise(plain)
    return value.is_number & plain


def _is_type(value: Value, name: str) -> Column:
    whole = value.number == F.floor(value.number)
    return {
        "null": lambda: value.kind == "VOID", "boolean": lambda: value.kind == "BOOLEAN", "string": lambda: value.is_string, "object": lambda: value.is_object, "array": lambda: value.is_array,
        "number": lambda: value.is_number, "integer": lambda: (value.kind == "BIGINT") | (value.is_number & whole),
    }[name]()


class Compiler:
    """Turns schemas into expressions; ``registry`` has further documents by their ``$id``."""

    def __init__(self, root: dict, registry: dict[str, dict] | None = None, depth: int = DEPTH):
        self.registry = dict(registry or {})
        self.root, self.depth = root, depth
        if "$id" in root:
            self.registry.setdefault(root["$id"], root)

    def _resolved(self, ref: str, base: dict) -> tuple[dict | bool, dict]:
        document, _, pointer = ref.partition("#")
        if document:
            base = self.registry[document]
        found = base
        for part in filter(None, pointer.split("/")):
            part = part.replace("~1", "/").replace("~0", "~")
            found = found[int(part)] if isinstance(found, list) else found[part]
        return found, base

    def errors(self, v: Column) -> Column:
        return self._value(v, F.array().cast("array<string>"), self.root, self.root, 0)

    def _value(self, v: Column, steps: Column, schema: dict | bool, base: dict, level: int) -> Column:
        return _of(v, steps, lambda value: self._apply(value, schema, base, level))

    def _apply(self, value: Value, schema: dict | bool, base: dict, level: int) -> Column:
        if isinstance(schema, bool):
            return _none() if schema else F.array(_error(value, "false"))
        if level > self.depth:
            return F.array(_error(value, "depth"))
        found = []
        for keyword, argument in schema.items():
            if keyword in SILENT:
                continue
            rule = getattr(self, "on_reference" if keyword == "$ref" else f"on_{keyword}", None)
            if rule is None or keyword == "reference":
                raise ValueError(f"the keyword {keyword!r} isn't known")
            made = rule(value, argument, schema, base, level)
            if made is not None:
                found.append(made)
        return _joined(found)

    def _holds(self, value: Value, schema, base, level) -> Column:
        return F.size(self._apply(value, schema, base, level)) == 0

    # any value

    def on_reference(self, value, ref, schema, base, level):
        target, base = self._resolved(ref, base)
        return self._apply(value, target, base, level + 1)

    def on_type(self, value, names, schema, base, level):
        names = [names] if isinstance(names, str) else names
        return _when(~reduce(Column.__or__, [_is_type(value, n) for n in names]), value, "type", "|".join(names))

    def on_enum(self, value, constants, schema, base, level):
        texts = [c for c in constants if isinstance(c, str)]
        others = [_equals(value, c) for c in constants if not isinstance(c, str)]
        same = reduce(Column.__or__, [*([value.is_string & value.text.isin(texts)] if texts else []), *others])
        return _when(~F.coalesce(same, F.lit(False)), value, "enum")

    def on_const(self, value, constant, schema, base, level):
        return _when(~F.coalesce(_equals(value, constant), F.lit(False)), value, "const")

    def on_allOf(self, value, schemas, schema, base, level):
        return _joined([self._apply(value, s, base, level) for s in schemas])

    def on_anyOf(self, value, schemas, schema, base, level):
        return _when(~reduce(Column.__or__, [self._holds(value, s, base, level) for s in schemas]), value, "anyOf")

    def on_oneOf(self, value, schemas, schema, base, level):
        return _when(reduce(Column.__add__, [self._holds(value, s, base, level).cast("int") for s in schemas]) != 1, value, "oneOf")

    def on_not(self, value, inner, schema, base, level):
        return _when(self._holds(value, inner, base, level), value, "not")

    def on_if(self, value, condition, schema, base, level):
        then, other = (self._apply(value, schema.get(k, True), base, level) for k in ("then", "else"))
        return F.when(self._holds(value, condition, base, level), then).otherwise(other)

    # numbers and texts

    def on_minimum(self, value, limit, *_):
        return _when(_compared(value, limit, "<"), value, "minimum")

    def on_maximum(self, value, limit, *_):
        return _when(_compared(value, limit, ">"), value, "maximum")

    def on_exclusiveMinimum(self, value, limit, *_):
        return _when(_compared(value, limit, "<="), value, "exclusiveMinimum")

    def on_exclusiveMaximum(self, value, limit, *_):
        return _when(_compared(value, limit, ">="), value, "exclusiveMaximum")

    def on_multipleOf(self, value, of, *_):
        if isinstance(of, int):
            exact = F.try_variant_get(value.v, "$", "decimal(38,10)") % of
            return _when(value.is_number & (exact != 0), value, "multipleOf")
        times = value.number / F.lit(float(of))
        return _when(value.is_number & (times != F.floor(times)), value, "multipleOf")

    def on_minLength(self, value, n, *_):
        return _when(value.is_string & (F.length(value.text) < n), value, "minLength")

    def on_maxLength(self, value, n, *_):
        return _when(value.is_string & (F.length(value.text) > n), value, "maxLength")

    def on_pattern(self, value, pattern, *_):
        return _when(value.is_string & ~value.text.rlike(pattern), value, "pattern")

    def on_format(self, value, name, *_):
        return _when(value.is_string & ~value.text.rlike(FORMATS[name]), value, "format", name) if name in FORMATS else None

    # arrays

    def on_items(self, value, inner, schema, base, level):
        skipped = len(schema.get("prefixItems", []))
        places = F.transform(value.list, lambda x, i: F.struct(x.alias("x"), i.alias("i")))
        places = F.slice(places, skipped + 1, F.greatest(F.size(places) - skipped, F.lit(0))) if skipped else places
        each = F.transform(places, lambda x: self._value(x["x"], value.at(F.lpad(x["i"].cast("string"), PLACE, "0")), inner, base, level + 1))
        return F.coalesce(F.flatten(each), _none())

    def on_prefixItems(self, value, schemas, schema, base, level):
        each = [F.when(F.size(value.list) > i, self._value(F.get(value.list, F.lit(i)), value.at(F.lit(f"{i:0{PLACE}}")), s, base, level + 1)).otherwise(_none()) for i, s in enumerate(schemas)]
        return F.when(value.is_array, _joined(each)).otherwise(_none())

    def on_contains(self, value, inner, schema, base, level):
        n = F.size(F.filter(F.transform(value.list, lambda x: F.size(self._value(x, value.steps, inner, base, level + 1))), lambda k: k == 0))
        least, most = schema.get("minContains", 1), schema.get("maxContains")
        return _when(value.is_array & ((n < least) if most is None else (n < least) | (n > most)), value, "contains")

    def on_minContains(self, *_):
        return None

    on_maxContains = on_minContains

    def on_minItems(self, value, n, *_):
        return _when(value.is_array & (F.size(value.list) < n), value, "minItems")

    def on_maxItems(self, value, n, *_):
        return _when(value.is_array & (F.size(value.list) > n), value, "maxItems")

    def on_uniqueItems(self, value, wanted, *_):
        return _when(value.is_array & (F.size(F.array_distinct(F.transform(value.list, _canonical))) < F.size(value.list)), value, "uniqueItems") if wanted else None

    # objects

    def on_required(self, value, names, *_):
        return _each(F.when(value.is_object, F.filter(F.lit(names).cast("array<string>"), lambda n: F.element_at(value.object, n).isNull())), value, "required") if names else None

    def on_dependentRequired(self, value, needed, *_):
        found = [F.when(F.element_at(value.object, F.lit(k)).isNotNull(), F.filter(F.lit(names).cast("array<string>"), lambda n: F.element_at(value.object, n).isNull())) for k, names in needed.items() if names]
        return _joined([_each(x, value, "dependentRequired") for x in found])

    def on_properties(self, value, schemas, schema, base, level):
        each = [F.when(value.is_object & F.element_at(value.object, F.lit(k)).isNotNull(), self._value(F.element_at(value.object, F.lit(k)), value.at(F.lit(k)), s, base, level + 1)).otherwise(_none()) for k, s in schemas.items()]
        return _joined(each)

    def on_patternProperties(self, value, schemas, schema, base, level):
        def under(pattern, inner):
            names = F.filter(F.map_keys(value.object), lambda k: k.rlike(pattern))
            return F.coalesce(F.flatten(F.transform(names, lambda k: self._value(F.element_at(value.object, k), value.at(k), inner, base, level + 1))), _none())

        return _joined([under(p, s) for p, s in schemas.items()])

    def on_additionalProperties(self, value, inner, schema, base, level):
        if inner is True:
            return None
        known, patterns = list(schema.get("properties", {})), list(schema.get("patternProperties", {}))
        names = F.map_keys(value.object)
        names = F.filter(names, lambda k: ~k.isin(known)) if known else names
        names = F.filter(names, lambda k: ~reduce(Column.__or__, [k.rlike(p) for p in patterns])) if patterns else names
        if inner is False:
            return _each(F.array_sort(names), value, "additionalProperties")
        return F.coalesce(F.flatten(F.transform(names, lambda k: self._value(F.element_at(value.object, k), value.at(k), inner, base, level + 1))), _none())

    def on_propertyNames(self, value, inner, schema, base, level):
        each = F.transform(F.map_keys(value.object), lambda k: self._value(F.parse_json(F.to_json(F.array(k))).cast("array<variant>")[0], value.steps, inner, base, level + 1))
        return F.coalesce(F.flatten(each), _none())

    def on_minProperties(self, value, n, *_):
        return _when(value.is_object & (F.size(value.object) < n), value, "minProperties")

    def on_maxProperties(self, value, n, *_):
        return _when(value.is_object & (F.size(value.object) > n), value, "maxProperties")


def errors(value: Column, schema: dict, registry: dict[str, dict] | None = None, depth: int = DEPTH) -> Column:
    """Array of (path, rule, detail): everything by which a VARIANT breaks a schema, in order of path and rule.

    Places in arrays count as numbers in this order. A null (of SQL, not of JSON) has no errors.
    """
    found = F.array_sort(F.array_distinct(Compiler(schema, registry, depth).errors(value)))
    path = lambda steps: F.concat(F.lit("/"), F.array_join(F.transform(steps, lambda s: F.when(s.rlike(rf"^0\d{{{PLACE - 1}}}$"), F.regexp_replace(s, r"^0+(?=\d)", "")).otherwise(s)), "/"))
    return F.when(value.isNotNull(), F.transform(found, lambda e: F.struct(path(e["steps"]).alias("path"), e["rule"].alias("rule"), e["detail"].alias("detail"))))


def failures(rows: DataFrame, key: str, document: Column, schema: dict, registry: dict[str, dict] | None = None) -> DataFrame:
    """(key, path, rule, detail) of ``rows`` whose JSON text ``document`` breaks the schema; what is no JSON at all (or
    repeats a key within an object) has the rule ``json``. A null text is no JSON."""
    parsed = rows.select(F.col(key), F.try_parse_json(document).alias("__v"))
    none = F.array(F.struct(F.lit("/").alias("path"), F.lit("json").alias("rule"), F.lit(None).cast("string").alias("detail")))
    found = parsed.select(key, F.when(F.col("__v").isNull(), none).otherwise(errors(F.col("__v"), schema, registry)).alias("__e"))
    # the outer explode adds no filter on the errors below it, which would have them searched for three times
    return found.select(key, F.explode_outer("__e").alias("__e")).filter("__e IS NOT NULL").select(key, "__e.path", "__e.rule", "__e.detail")
