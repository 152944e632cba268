"""Nested documents as queries: contracts checked against JSON schemas, references at any depth, canonical payloads,
hashes of sets, catalogs in global order.

Documents are JSON texts that both engines build from a table's rows with the same expressions.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import storage
from ..functions import identity, json_schema
from ..functions.scalar import REFERENCE_FIELDS
from ..operators import digests, json_tree, package

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str):
    def register(function):
        QUERIES[function.__name__], SQL[function.__name__] = function, sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- contracts -------------------------------------------------------------------------------------------------------

COMMON = {
    "$id": "paperloom:common",
    "$defs": {
        "id": {"type": "string", "pattern": "^[a-z][a-z0-9]*_[0-9]+$"},
        "path": {"type": "string", "minLength": 1, "pattern": r"^(?!/)(?!.*(?:^|/)\.\.(?:/|$))(?!.*\\).+$"},
        "share": {"type": "number", "minimum": 0, "maximum": 1},
        "header": {"type": "object", "additionalProperties": False, "required": ["schema_id", "schema_version", "revision"], "properties": {"schema_id": {"const": "report"}, "schema_version": {"type": "string", "pattern": r"^2\.[0-9]+\.[0-9]+$"}, "revision": {"type": "integer", "minimum": 1}, "extensions": {"type": "object", "propertyNames": {"pattern": "^[a-z]+$"}}}},
        "slot": {
            "type": "object", "required": ["state"], "properties": {"state": {"enum": ["available", "unsupported", "absent"]}, "ref": {"$ref": "#/$defs/id"}, "reason": {"type": "string"}},
            "allOf": [{"if": {"properties": {"state": {"const": "available"}}}, "then": {"required": ["ref"]}}, {"if": {"properties": {"state": {"const": "unsupported"}}}, "then": {"required": ["reason"]}, "else": {"not": {"required": ["reason"]}}}],
        },
    },
}
REPORT = {
    "$id": "paperloom:report",
    "type": "object",
    "additionalProperties": False,
    "required": ["header", "counters", "edges", "mode", "sources"],
    "properties": {
        "header": {"$ref": "paperloom:common#/$defs/header"},
        "mode": {"enum": ["none", "auto", "required"]},
        "profiles": {"type": "array", "uniqueItems": True, "items": {"enum": ["page", "slide", "tile"]}},
        "sources": {"type": "array", "minItems": 1, "items": {"anyOf": [{"$ref": "paperloom:common#/$defs/id"}, {"type": "null"}]}},
        "counters": {"type": "object", "required": ["total", "failed"], "additionalProperties": {"type": "integer", "minimum": 0}},
        "edges": {"type": "array", "items": {"type": "object", "additionalProperties": False, "required": ["path", "confidence"], "properties": {"path": {"$ref": "paperloom:common#/$defs/path"}, "confidence": {"$ref": "paperloom:common#/$defs/share"}, "asset_refs": {"type": "array", "items": {"type": "string"}}}}},
        "slots": {"type": "object", "additionalProperties": {"$ref": "paperloom:common#/$defs/slot"}},
        "executed": {"const": False},
        "commit": {"oneOf": [{"type": "object", "required": ["eligible", "blocking"], "properties": {"eligible": {"const": True}, "blocking": {"const": 0}}}, {"type": "object", "required": ["eligible"], "properties": {"eligible": {"const": False}}}]},
    },
    "allOf": [
        {"if": {"properties": {"mode": {"const": "none"}}, "required": ["mode"]}, "then": {"properties": {"profiles": {"maxItems": 0}}}},
        {"if": {"properties": {"mode": {"const": "required"}}, "required": ["mode"]}, "then": {"required": ["profiles"], "properties": {"profiles": {"minItems": 1}}}},
    ],
}
_ID = "CAST(event_id AS STRING)"
_MODE = "CASE event_id % 5 WHEN 0 THEN 'none' WHEN 1 THEN 'auto' WHEN 4 THEN 'sometimes' ELSE 'required' END"
_PROFILES = "CASE event_id % 7 WHEN 0 THEN '' WHEN 1 THEN ',\"profiles\":[]' WHEN 2 THEN ',\"profiles\":[\"page\",\"slide\",\"page\"]' WHEN 3 THEN ',\"profiles\":[\"page\",\"film\"]' ELSE ',\"profiles\":[\"tile\"]' END"
_REPORT = "'{\"header\":{\"schema_id\":\"' || CASE WHEN event_id % 31 = 0 THEN 'other' ELSE 'report' END || '\",\"schema_version\":\"' || CASE WHEN event_id % 13 = 0 THEN '1.0.0' ELSE '2.0.1' END || '\",\"revision\":' || CASE WHEN event_id % 17 = 0 THEN '0' ELSE '1.0' END || CASE WHEN event_id % 29 = 0 THEN ',\"extensions\":{\"ok\":1,\"Not_ok\":{}}' ELSE '' END || '},\"mode\":\"' || " + _MODE + " || '\"' || " + _PROFILES + " || ',\"sources\":[' || CASE event_id % 19 WHEN 0 THEN '' WHEN 1 THEN 'null,\"Bad id\"' ELSE '\"src_' || CAST(user_id AS STRING) || '\"' END || '],\"counters\":' || CASE event_id % 23 WHEN 0 THEN '{\"total\":1}' WHEN 1 THEN '{\"total\":-3,\"failed\":0.5,\"odd\":true}' ELSE '{\"total\":' || CAST(user_id AS STRING) || ',\"failed\":0}' END || ',\"edges\":[{\"path\":\"p/1\",\"confidence\":' || CASE WHEN event_id % 6 = 0 THEN '1.5' ELSE '0.25' END || ',\"asset_refs\":[\"a\"' || CASE WHEN event_id % 37 = 0 THEN ',{\"path\":\"x\"}' ELSE '' END || ']},{\"path\":\"' || CASE event_id % 11 WHEN 0 THEN '/abs' WHEN 1 THEN 'a/../b' ELSE 'p/2' END || '\"' || CASE WHEN event_id % 41 = 0 THEN '' ELSE ',\"confidence\":1' END || CASE WHEN event_id % 43 = 0 THEN ',\"weight\":2' ELSE '' END || '}],\"slots\":{\"main\":' || CASE event_id % 10 WHEN 0 THEN '{\"state\":\"available\"}' WHEN 1 THEN '{\"state\":\"unsupported\"}' WHEN 2 THEN '{\"state\":\"unsupported\",\"reason\":\"r\"}' WHEN 3 THEN '{\"state\":\"absent\",\"reason\":\"r\"}' WHEN 4 THEN '{\"state\":\"lost\"}' ELSE '{\"state\":\"available\",\"ref\":\"doc_1\"}' END || '},\"executed\":' || CASE WHEN event_id % 47 = 0 THEN 'true' ELSE 'false' END || ',\"commit\":{\"eligible\":' || CASE WHEN event_id % 2 = 0 THEN 'true' ELSE 'false' END || ',\"blocking\":' || CASE WHEN event_id % 8 = 0 THEN '2' ELSE '0' END || '}' || CASE WHEN event_id % 53 = 0 THEN ',\"zzz\":null' ELSE '' END || CASE WHEN event_id % 59 = 0 THEN '' ELSE '}' END"
#: What breaks a report, as (path, rule, detail, condition).
_BROKEN = [
    ("/header/schema_id", "const", None, "event_id % 31 = 0"),
    ("/header/schema_version", "pattern", None, "event_id % 13 = 0"),
    ("/header/revision", "minimum", None, "event_id % 17 = 0"),
    ("/header/extensions", "pattern", None, "event_id % 29 = 0"),
    ("/mode", "enum", None, "event_id % 5 = 4"),
    ("/profiles", "maxItems", None, "event_id % 5 = 0 AND event_id % 7 NOT IN (0, 1)"),
    ("/profiles", "minItems", None, "event_id % 5 IN (2, 3) AND event_id % 7 = 1"),
    ("/", "required", "profiles", "event_id % 5 IN (2, 3) AND event_id % 7 = 0"),
    ("/profiles", "uniqueItems", None, "event_id % 7 = 2"),
    ("/profiles/1", "enum", None, "event_id % 7 = 3"),
    ("/sources", "minItems", None, "event_id % 19 = 0"),
    ("/sources/1", "anyOf", None, "event_id % 19 = 1"),
    ("/counters", "required", "failed", "event_id % 23 = 0"),
    ("/counters/total", "minimum", None, "event_id % 23 = 1"),
    ("/counters/failed", "type", "integer", "event_id % 23 = 1"),
    ("/counters/odd", "type", "integer", "event_id % 23 = 1"),
    ("/edges/0/confidence", "maximum", None, "event_id % 6 = 0"),
    ("/edges/0/asset_refs/1", "type", "string", "event_id % 37 = 0"),
    ("/edges/1/path", "pattern", None, "event_id % 11 IN (0, 1)"),
    ("/edges/1", "required", "confidence", "event_id % 41 = 0"),
    ("/edges/1", "additionalProperties", "weight", "event_id % 43 = 0"),
    ("/slots/main", "required", "ref", "event_id % 10 = 0"),
    ("/slots/main", "required", "reason", "event_id % 10 = 1"),
    ("/slots/main", "not", None, "event_id % 10 = 3"),
    ("/slots/main/state", "enum", None, "event_id % 10 = 4"),
    ("/executed", "const", None, "event_id % 47 = 0"),
    ("/commit", "oneOf", None, "event_id % 8 = 0"),
    ("/", "additionalProperties", "zzz", "event_id % 53 = 0"),
]
_quote = lambda x: "CAST(NULL AS VARCHAR)" if x is None else f"'{x}'"


@query(" UNION ALL ".join([
    *[f"SELECT event_id, '{path}' AS path, '{rule}' AS rule, {_quote(detail)} AS detail FROM events WHERE event_id % 59 <> 0 AND {where}" for path, rule, detail, where in _BROKEN],
    "SELECT event_id, '/', 'json', NULL FROM events WHERE event_id % 59 = 0",
]))
def contract_documents(spark, sf_dir):
    """V1, K1: nested documents against a schema with references, conditions, alternatives; every error with its path."""
    # dealt anew: a document takes far longer to check than its small row to read, and few large row groups make few tasks
    rows = table(spark, sf_dir, "events").select("event_id", "user_id").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "event_id").selectExpr("event_id", f"{_REPORT} AS body")
    return json_schema.failures(rows, "event_id", F.col("body"), REPORT, {COMMON["$id"]: COMMON})


# --- references at any depth --------------------------------------------------------------------------------------------

_REF = lambda name, more="": f"'{{\"path\":\"' || {name} || '\",\"sha256\":\"{{x}}\",\"schema_id\":\"s\",\"schema_version\":2,\"contract_id\":\"c' || CAST(event_id % 9 AS STRING) || '\"{more}}}'"
_NESTED = f"""'{{"a":' || CASE WHEN event_id % 3 = 0 THEN {_REF("'one/' || CAST(event_id AS STRING)", ',"inner":[[{"deep":')[:-2]}' || {_REF("'two/' || CAST(user_id AS STRING)", ',"note":"} { not a brace"')} || '}}]],"unit_refs":["u1",2,null,"u' || CAST(user_id AS STRING) || '"]}}' ELSE '[]' END || ',"b":[1,{{"asset_refs":["z"],"unit_refs":{{"not":"a list"}},"x/y~z":' || CASE WHEN event_id % 4 = 0 THEN {_REF("event_type")} ELSE '{{"path":"no","sha256":"x"}}' END || '}}]}}'"""


@query(f"""WITH t AS (SELECT event_id, {_NESTED} AS body FROM events),
n AS (SELECT event_id, j.value AS o FROM t, json_tree(t.body) j WHERE j.type = 'OBJECT')
SELECT event_id, o->>'$.path' AS path, o->>'$.sha256' AS sha256, o->>'$.schema_version' AS schema_version, o->>'$.contract_id' AS contract_id, CASE WHEN starts_with(o->>'$.path', 'one/') THEN '/a' WHEN starts_with(o->>'$.path', 'two/') THEN '/a/inner/0/0/deep' ELSE '/b/1/x~1y~0z' END AS pointer
FROM n WHERE {" AND ".join(f"json_exists(o, '$.{f}')" for f in REFERENCE_FIELDS)}""")
def json_reference_tree(spark, sf_dir):
    """References that hold further references, lists and braces in texts, at any depth."""
    rows = table(spark, sf_dir, "events").selectExpr("event_id", f"{_NESTED} AS body")
    return json_tree.references(rows, "event_id", F.col("body")).drop("schema_id")


@query(f"""WITH t AS (SELECT event_id, {_NESTED} AS body FROM events), n AS (SELECT event_id, j.value AS v FROM t, json_tree(t.body) j WHERE j.type = 'ARRAY' AND j.key IN ('unit_refs', 'asset_refs'))
SELECT DISTINCT event_id, e.value->>'$' AS reference FROM n, json_each(n.v) e WHERE e.type = 'VARCHAR'""")
def json_string_references(spark, sf_dir):
    """texts in lists under given names, at any depth."""
    rows = table(spark, sf_dir, "events").selectExpr("event_id", f"{_NESTED} AS body")
    return json_tree.string_references(rows, "event_id", F.col("body"), ["unit_refs", "asset_refs"])


# --- canonical payloads and sets -----------------------------------------------------------------------------------------


@query("""SELECT o_orderkey, sha256('{"flags":{"a":' || (o_orderkey % 2 = 0) || ',"é":null},"header":{"nested":{"created_at":"kept"},"revision":' || o_orderkey % 7 || '},"lines":[' ||
  '{"price":' || CAST(o_totalprice / 7 AS VARCHAR) || ',"tags":{"B":[' || o_custkey || ',2],"a":[]},"text":' || CAST(to_json(o_orderpriority || chr(9) || '"' || chr(1)) AS VARCHAR) || '},' ||
  '{"price":' || CAST(o_totalprice * 1e12 AS VARCHAR) || ',"tags":{},"text":null}]}') AS payload_hash FROM orders""")
def canonical_payload(spark, sf_dir):
    """hash of nested payloads: structs, lists, maps, doubles; what a header has for the moment is left out."""
    price = F.col("o_totalprice")
    line = lambda p, tags, t: F.struct(p.alias("price"), t.cast("string").alias("text"), tags.cast("map<string,array<bigint>>").alias("tags"))
    first = line(price / 7, F.create_map(F.lit("a"), F.array().cast("array<bigint>"), F.lit("B"), F.array(F.col("o_custkey"), F.lit(2).cast("long"))), F.concat("o_orderpriority", F.lit('\t"\x01')))
    second = line(price * 1e12, F.create_map(), F.lit(None))
    header = F.struct((F.col("o_orderkey") % 7).alias("revision"), F.lit("x").alias("content_hash"), F.lit("now").alias("created_at"), F.struct(F.lit("kept").alias("created_at")).alias("nested"))
    flags = F.create_map(F.lit("é"), F.lit(None).cast("boolean"), F.lit("a"), F.col("o_orderkey") % 2 == 0)
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.struct(F.array(first, second).alias("lines"), header.alias("header"), flags.alias("flags")).alias("v"))
    return rows.select("o_orderkey", identity.content_hash(identity.canonical_value(F.col("v"), rows.schema["v"].dataType)).alias("payload_hash"))


_SITE = "nullif(regexp_extract(coalesce(url, ''), '^https?://([^/]*)', 1), '')"
_FANOUT, _LEVELS = 4, 8
_node = lambda at: f"SELECT site, no // {_FANOUT} AS no, CASE WHEN count(*) = 1 AND no // {_FANOUT} = 0 THEN any_value(digest) ELSE sha256(string_agg(digest || chr(10), '' ORDER BY no)) END AS digest FROM n{at} GROUP BY site, no // {_FANOUT}"


@query(f"""WITH n0 AS (SELECT {_SITE} AS site, row_number() OVER (PARTITION BY {_SITE} ORDER BY page_id) - 1 AS no, sha256(coalesce(html, '')) AS digest FROM pages),
{", ".join(f"n{i + 1} AS ({_node(i)})" for i in range(_LEVELS))},
k AS (SELECT site, count(*) AS n FROM n0 GROUP BY 1)
SELECT k.site, k.n, sha256(k.n || ':' || digest) AS root FROM k JOIN n{_LEVELS} x ON x.site IS NOT DISTINCT FROM k.site""")
def identity_tree(spark, sf_dir):
    """Hash of a selection of any size, from a tree of hashes; no group meets in one task."""
    rows = table(spark, sf_dir, "pages").select(F.expr(f"{_SITE} AS site"), "page_id", F.sha2(F.encode(F.coalesce("html", F.lit("")), "UTF-8"), 256).alias("sha256"))
    return digests.roots(rows, ["site"], ["page_id"], F.col("sha256"), _FANOUT)


# --- catalogs in order ----------------------------------------------------------------------------------------------------


@query("SELECT p_brand, p_partkey, row_number() OVER (ORDER BY p_brand, p_partkey) - 1 AS place, p_name FROM part")
def ordered_catalog(spark, sf_dir):
    """O1: a catalog written in global order; every row's place follows from its file's rank and its place in the file."""
    path = storage.fresh("catalog", spark)
    storage.write_ordered(table(spark, sf_dir, "part").select("p_brand", "p_partkey", "p_name"), path, ["p_brand", "p_partkey"])
    return storage.read_ordered(spark, path, place="place")


# --- verified reads -------------------------------------------------------------------------------------------------------

_EXPECTED = "o_orderkey AS input_id, 'in/' || CAST(o_orderkey AS STRING) AS path, CASE WHEN o_orderkey % 7 = 0 THEN 'x' ELSE o_orderpriority END AS sha256, 'report' AS schema_id, o_custkey % 50 AS document_id"
_STORED = "'in/' || CAST(o_orderkey AS STRING) AS path, o_orderpriority AS sha256, CASE WHEN o_orderkey % 11 = 0 THEN NULL WHEN o_orderkey % 13 = 0 THEN 'not json' ELSE '{\"header\":{\"schema_id\":\"' || CASE WHEN o_orderkey % 5 = 0 THEN 'other' ELSE 'report' END || '\",\"schema_version\":\"' || CASE WHEN o_orderkey % 3 = 0 THEN '1.4.0' ELSE '2.1.0' END || '\"},\"document_id\":' || CAST(CASE WHEN o_orderkey % 17 = 0 THEN -1 ELSE o_custkey % 50 END AS STRING) || '}' END AS body"


@query(f"""WITH e AS (SELECT {_EXPECTED} FROM orders), s AS (SELECT {_STORED} FROM orders WHERE o_orderkey % 19 <> 0)
SELECT input_id, CASE WHEN s.path IS NULL THEN 'absent' WHEN s.sha256 <> e.sha256 THEN 'hash' WHEN body IS NULL OR body = 'not json' THEN 'not_json' WHEN body->>'$.header.schema_id' <> schema_id THEN 'schema' WHEN body NOT LIKE '%"2.1.0"%' THEN 'version' WHEN CAST(body->>'$.document_id' AS BIGINT) <> document_id THEN 'document' END AS failure
FROM e LEFT JOIN s USING (path) WHERE failure IS NOT NULL""")
def verified_inputs(spark, sf_dir):
    """What a stage reads is there, unchanged, of the expected schema, of version 2 and of the same document."""
    rows = table(spark, sf_dir, "orders")
    return package.verified_input_failures(rows.selectExpr(f"inline(array(struct({_EXPECTED})))"), rows.where("o_orderkey % 19 <> 0").selectExpr(f"inline(array(struct({_STORED})))"))
