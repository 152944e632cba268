import json

import pytest
from pyspark.sql import functions as F

from paperloom.functions import json_schema

COMMON = {
    "$id": "https://example.org/common",
    "$defs": {
        "id": {"type": "string", "pattern": "^[a-z]+_[0-9]+$"},
        "path": {"type": "string", "minLength": 1, "pattern": r"^(?!/)(?!.*(?:^|/)\.\.(?:/|$)).+$"},
        "share": {"type": "number", "minimum": 0, "maximum": 1},
        "tree": {"type": "object", "properties": {"n": {"type": "integer"}, "children": {"type": "array", "items": {"$ref": "#/$defs/tree"}}}, "required": ["n"], "additionalProperties": False},
    },
}
SCHEMA = {
    "$id": "https://example.org/report",
    "type": "object",
    "additionalProperties": False,
    "required": ["id", "mode", "counts"],
    "properties": {
        "id": {"$ref": "https://example.org/common#/$defs/id"},
        "mode": {"enum": ["none", "required", 3, None]},
        "profiles": {"type": "array", "uniqueItems": True, "items": {"enum": ["a", "b", "c"]}},
        "counts": {"type": "object", "minProperties": 1, "propertyNames": {"pattern": "^[a-z]+$"}, "additionalProperties": {"type": "integer", "minimum": 0}},
        "files": {"type": "array", "maxItems": 20, "items": {"$ref": "#/$defs/file"}},
        "active": {"const": False},
        "tree": {"$ref": "https://example.org/common#/$defs/tree"},
        "pair": {"prefixItems": [{"type": "string"}, {"type": "number"}], "items": False, "type": "array"},
        "when": {"type": "string", "format": "date-time"},
        "some": {"type": "array", "contains": {"type": "string"}},
        "step": {"type": "number", "multipleOf": 5, "exclusiveMinimum": 0, "exclusiveMaximum": 100},
        "either": {"oneOf": [{"type": "string"}, {"type": "string", "minLength": 3}, {"type": "null"}]},
        "any": {"anyOf": [{"$ref": "https://example.org/common#/$defs/id"}, {"type": "null"}]},
        "odd": {"not": {"type": "string", "maxLength": 2}},
    },
    "allOf": [
        {"if": {"properties": {"mode": {"const": "none"}}, "required": ["mode"]}, "then": {"properties": {"profiles": {"maxItems": 0}}}},
        {"if": {"properties": {"mode": {"const": "required"}}, "required": ["mode"]}, "then": {"required": ["profiles"], "properties": {"profiles": {"minItems": 1}}}},
    ],
    "dependentRequired": {"active": ["files"]},
    "$defs": {"file": {"type": "object", "required": ["path"], "properties": {"path": {"$ref": "https://example.org/common#/$defs/path"}, "share": {"$ref": "https://example.org/common#/$defs/share"}}, "patternProperties": {"^x-": {"type": "string"}}, "additionalProperties": False}},
}
GOOD = {"id": "run_1", "mode": "none", "counts": {"a": 1.0}}
CASES = [
    (GOOD, []),
    ([], [("/", "type")]),
    (None, [("/", "type")]),
    ({}, [("/", "required:counts"), ("/", "required:id"), ("/", "required:mode")]),
    ({**GOOD, "extra": 1, "another": 2}, [("/", "additionalProperties:another"), ("/", "additionalProperties:extra")]),
    ({**GOOD, "id": "Run 1"}, [("/id", "pattern")]),
    ({**GOOD, "id": 7}, [("/id", "type")]),
    ({**GOOD, "mode": "odd"}, [("/mode", "enum")]),
    ({**GOOD, "mode": 3.0}, []),
    ({**GOOD, "mode": None}, []),
    ({**GOOD, "profiles": ["a"]}, [("/profiles", "maxItems")]),
    ({**GOOD, "mode": "required"}, [("/", "required:profiles")]),
    ({**GOOD, "mode": "required", "profiles": []}, [("/profiles", "minItems")]),
    ({**GOOD, "mode": "required", "profiles": ["a", "x", "a"]}, [("/profiles", "uniqueItems"), ("/profiles/1", "enum")]),
    ({**GOOD, "counts": {}}, [("/counts", "minProperties")]),
    ({**GOOD, "counts": {"a": -1, "B": 2, "c": 1.5, "d": True}}, [("/counts", "pattern"), ("/counts/a", "minimum"), ("/counts/c", "type"), ("/counts/d", "type")]),
    ({**GOOD, "files": [{"path": f"f/{i}"} for i in range(11)] + [{"path": "/abs"}, {"share": 1.5, "x-a": 1, "y": 0}, {"path": "a/../b"}]}, [("/files/11/path", "pattern"), ("/files/12", "additionalProperties:y"), ("/files/12", "required:path"), ("/files/12/share", "maximum"), ("/files/12/x-a", "type"), ("/files/13/path", "pattern")]),
    ({**GOOD, "files": [{"path": "f"}] * 21}, [("/files", "maxItems")]),
    ({**GOOD, "active": True}, [("/", "dependentRequired:files"), ("/active", "const")]),
    ({**GOOD, "active": 0, "files": []}, [("/active", "const")]),
    ({**GOOD, "tree": {"n": 1, "children": [{"n": 2, "children": [{"n": "x"}]}, {"m": 1}]}}, [("/tree/children/0/children/0/n", "type"), ("/tree/children/1", "additionalProperties:m"), ("/tree/children/1", "required:n")]),
    ({**GOOD, "pair": ["a", "b", 3]}, [("/pair/1", "type"), ("/pair/2", "false")]),
    ({**GOOD, "pair": [1]}, [("/pair/0", "type")]),
    ({**GOOD, "when": "2024-02-30"}, [("/when", "format:date-time")]),
    ({**GOOD, "when": "2024-02-28T10:00:00.5Z"}, []),
    ({**GOOD, "some": [1, 2]}, [("/some", "contains")]),
    ({**GOOD, "some": [1, "2"]}, []),
    ({**GOOD, "step": 12}, [("/step", "multipleOf")]),
    ({**GOOD, "step": 0}, [("/step", "exclusiveMinimum")]),
    ({**GOOD, "step": 100.0}, [("/step", "exclusiveMaximum")]),
    ({**GOOD, "either": "abc"}, [("/either", "oneOf")]),
    ({**GOOD, "either": "ab"}, []),
    ({**GOOD, "any": "NO"}, [("/any", "anyOf")]),
    ({**GOOD, "odd": "ab"}, [("/odd", "not")]),
    ({**GOOD, "odd": "abc"}, []),
]


def test_cases(spark):
    rows = spark.createDataFrame([(i, json.dumps(c)) for i, (c, _) in enumerate(CASES)], "i long, body string")
    found = json_schema.failures(rows, "i", F.col("body"), SCHEMA, {COMMON["$id"]: COMMON})
    got = {}
    for r in found.collect():
        got.setdefault(r.i, []).append((r.path, f"{r.rule}:{r.detail}" if r.detail and r.rule != "type" else r.rule))
    for i, (case, want) in enumerate(CASES):
        assert got.get(i, []) == want, case


def test_no_json_and_depth(spark):
    rows = spark.createDataFrame([(1, None), (2, "{"), (3, '{"a":1,"a":2}'), (4, json.dumps({"n": 1})), (5, json.dumps({"n": 1, "c": {"n": 1, "c": {"n": 1, "c": {"n": "x"}}}}))], "i long, body string")
    schema = {"type": "object", "properties": {"n": {"type": "integer"}, "c": {"$ref": "#"}}}
    assert sorted((r.i, r.path, r.rule) for r in json_schema.failures(rows, "i", F.col("body"), schema).collect()) == [(1, "/", "json"), (2, "/", "json"), (3, "/", "json"), (5, "/c/c/c/n", "type")]
    shallow = rows.select("i", F.explode(json_schema.errors(F.try_parse_json("body"), schema, depth=3)).alias("e")).select("i", "e.path", "e.rule").collect()
    assert {tuple(r) for r in shallow} == {(5, "/c/c", "depth")}


@pytest.mark.parametrize("keyword", ["unevaluatedProperties", "dependentSchemas", "value"])
def test_unknown_keywords_raise(spark, keyword):
    with pytest.raises(ValueError):
        json_schema.errors(F.lit(None).cast("variant"), {keyword: {}})


def test_errors_are_searched_for_once(spark):
    rows = spark.range(3).select("id", F.lit('{"id": 1}').alias("body"))
    found = json_schema.failures(rows, "id", F.col("body"), {"type": "object", "properties": {"id": {"type": "string"}}})
    assert sorted(map(tuple, found.collect())) == [(i, "/id", "type", "string") for i in range(3)]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("array_sort") == 1, plan
