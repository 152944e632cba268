"""The engine's operators as queries over the given tables, each with the SQL that gives the same rows.

Where an operator needs documents of other formats, a table is read as one: orders are packages and lineitems their
members, conversations are decks and turns their slides, parts are worksheets' cells, nations are styles based on
regions, page urls are part paths.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import scalar
from ..functions.identity import bundle_hash, canonical_json, content_hash, sql_stable_id, stable_id
from ..functions.ranks import EXACTNESS, STATUS, gravest
from ..functions.windows import numbered, running_total
from ..operators import graph, ir, mapping, parts, quality, render, security, sheets, text, validate
from ..sources import probe

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(function):
        QUERIES[function.__name__] = function
        if sql:
            SQL[function.__name__] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "lang", "source", F.coalesce("text", F.lit("")).alias("text")).withColumn("document_id", text.document_id(F.col("text")))


DOC_ID = sql_stable_id("document", """('{"role":"primary","sha256":"' || sha256(coalesce(text, '')) || '"}')""")

# --- acquisition and identity ----------------------------------------------------------------------------------------


@query("SELECT doc_id, sha256(coalesce(text, '')) AS sha256, CAST(strlen(coalesce(text, '')) AS BIGINT) AS size_bytes FROM documents")
def artifact_hash(spark, sf_dir):
    """Hash and size of every artifact."""
    body = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    return table(spark, sf_dir, "documents").select("doc_id", F.sha2(body, 256).alias("sha256"), F.octet_length(body).cast("long").alias("size_bytes"))


@query("""
SELECT doc_id, size_bytes, CAST(sum(size_bytes) OVER (ORDER BY doc_id) AS BIGINT) AS running_bytes,
       sum(size_bytes) OVER (ORDER BY doc_id) > 1000000 AS over_budget
FROM (SELECT doc_id, CAST(strlen(coalesce(text, '')) AS BIGINT) AS size_bytes FROM documents)""")
def artifact_budget_running(spark, sf_dir):
    """Cumulative bytes against a budget, in order of acquisition."""
    rows = table(spark, sf_dir, "documents").select("doc_id", F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("size_bytes"))
    out = running_total(rows, F.col("size_bytes"), "doc_id", "running_bytes")
    return out.withColumn("over_budget", F.col("running_bytes") > 1_000_000)


@query("""
WITH k AS (SELECT l_orderkey, l_linenumber, CAST(l_quantity AS BIGINT) AS amount, CASE WHEN l_linenumber = 7 THEN NULL ELSE CAST((CAST(l_partkey AS HUGEINT) * 1000003 * 998244353 * 65537) % 9223372036854775783 AS BIGINT) END AS key FROM lineitem)
SELECT l_orderkey, l_linenumber, key, CAST(sum(amount) OVER (ORDER BY key) AS BIGINT) AS running, row_number() OVER (PARTITION BY key ORDER BY l_orderkey, l_linenumber) - 1 AS place FROM k""")
def sparse_running_total(spark, sf_dir):
    """Running totals and places over a sparse key with repeats and nulls."""
    wide = lambda x: F.lit(x).cast("decimal(19,0)")
    key = (F.col("l_partkey").cast("decimal(10,0)") * wide(1000003 * 998244353)).cast("decimal(27,0)") * F.lit(65537).cast("decimal(6,0)")
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_quantity").cast("long").alias("amount"), F.when(F.col("l_linenumber") != 7, (key % wide(9223372036854775783)).cast("long")).alias("key"))
    totals = running_total(rows, F.col("amount"), "key", "running")
    return numbered(totals, ["l_orderkey", "l_linenumber"], "place", within=["key"]).drop("amount")


@query(f"SELECT doc_id, {DOC_ID} AS document_id FROM documents")
def document_identity(spark, sf_dir):
    """stable ids of documents."""
    return _documents(spark, sf_dir).select("doc_id", "document_id")


@query(f"SELECT {DOC_ID} AS document_id, count(*) AS n_artifacts, min(doc_id) AS first_artifact FROM documents GROUP BY 1 HAVING count(*) > 1")
def identity_duplicates(spark, sf_dir):
    """Identities that several artifacts share."""
    return _documents(spark, sf_dir).groupBy("document_id").agg(F.count("*").alias("n_artifacts"), F.min("doc_id").alias("first_artifact")).filter("n_artifacts > 1")


@query("""
SELECT url, sha256('[' || string_agg('{"ordinal":' || page_id || ',"role":"primary","sha256":"' || sha256(coalesce(html, '')) || '"}', ',' ORDER BY page_id) || ']') AS content_identity_hash, count(*) AS n_artifacts
FROM pages GROUP BY url""")
def identity_manifest(spark, sf_dir):
    """Hash of a selection's artifacts in canonical order."""
    row = F.struct(F.col("page_id").alias("ordinal"), F.lit("primary").alias("role"), F.sha2(F.encode(F.coalesce("html", F.lit("")), "UTF-8"), 256).alias("sha256"))
    return table(spark, sf_dir, "pages").groupBy("url").agg(bundle_hash(F.collect_list(row)).alias("content_identity_hash"), F.count("*").alias("n_artifacts"))


@query("""SELECT conv_id, turn, sha256('{"role":' || CAST(to_json(role) AS VARCHAR) || ',"text":' || CAST(to_json(text) AS VARCHAR) || ',"turn":' || turn || '}') AS content_hash FROM conversations""")
def canonical_content_hash(spark, sf_dir):
    """hash of a record's canonical JSON."""
    json = canonical_json(role=F.col("role"), text=F.col("text"), turn=F.col("turn"))
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", content_hash(json).alias("content_hash"))


@query("""
WITH l AS (SELECT c_custkey AS locator_id, CASE c_mktsegment WHEN 'BUILDING' THEN 'url' WHEN 'MACHINERY' THEN 'embedded' WHEN 'AUTOMOBILE' THEN 'bytes' ELSE 'local_file' END AS kind,
  CASE WHEN c_acctbal < 0 THEN 'nowhere' ELSE 'https://host/' || c_name END AS uri FROM customer)
SELECT locator_id, CASE WHEN kind = 'url' AND uri = 'nowhere' THEN 'DS-REQ-001' WHEN kind = 'url' THEN 'DS-ACQ-003' WHEN kind = 'bytes' THEN 'DS-ACQ-002' ELSE 'DS-ACQ-001' END AS code
FROM l WHERE kind <> 'local_file'""")
def locator_refusals(spark, sf_dir):
    """Locators that can't be acquired."""
    from ..sources.acquire import refusals

    segment = F.col("c_mktsegment")
    kind = F.when(segment == "BUILDING", "url").when(segment == "MACHINERY", "embedded").when(segment == "AUTOMOBILE", "bytes").otherwise("local_file")
    uri = F.when(F.col("c_acctbal") < 0, "nowhere").otherwise(F.concat(F.lit("https://host/"), "c_name"))
    return refusals(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("locator_id"), kind.alias("kind"), uri.alias("uri")))


# --- text --------------------------------------------------------------------------------------------------------------

_END = r"\n\r\x0b\x0c\x1c\x1d\x1e\x{85}\x{2028}\x{2029}"


def _lines_sql(body: str) -> str:
    return rf"""
d AS (SELECT doc_id, {DOC_ID} AS document_id, {body} AS body FROM documents),
u AS (SELECT doc_id, document_id, unnest(p) AS piece, unnest(range(len(p))) AS ordinal FROM (SELECT *, regexp_extract_all(body, '[^{_END}]*(?:\r\n|[{_END}])|[^{_END}]+') AS p FROM d)),
lines AS (SELECT doc_id, document_id, ordinal, rtrim(piece, chr(13) || chr(10)) AS text, begins AS byte_start, begins + CAST(strlen(rtrim(piece, chr(13) || chr(10))) AS BIGINT) AS byte_end
  FROM (SELECT *, CAST(coalesce(sum(strlen(piece)) OVER (PARTITION BY doc_id ORDER BY ordinal ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS begins FROM u))"""


_LINES = _lines_sql("coalesce(text, '')")
_LINE_ID = sql_stable_id("line", """('{"document_id":"' || document_id || '","ordinal":' || ordinal || ',"start":' || byte_start || '}')""")


def _text_lines(spark, sf_dir, body=None) -> DataFrame:
    docs = _documents(spark, sf_dir)
    docs = docs.withColumn("text", body(F.col("text"))) if body else docs
    out = text.lines(docs.withColumn("both", F.struct("doc_id", "document_id")), "both")
    unit = stable_id("line", canonical_json(document_id=F.col("document_id.document_id"), ordinal=F.col("ordinal"), start=F.col("byte_start")))
    return out.select(F.col("document_id.doc_id").alias("doc_id"), F.col("document_id.document_id").alias("document_id"), "ordinal", unit.alias("unit_id"), "byte_start", "byte_end", "text")


@query(f"WITH {_LINES} SELECT doc_id, document_id, ordinal, {_LINE_ID} AS unit_id, byte_start, byte_end, text FROM lines")
def text_lines(spark, sf_dir):
    """Lines with ordinals and byte offsets."""
    return _text_lines(spark, sf_dir)


_MIXED = "replace(replace(replace(replace(replace(coalesce(text, ''), ', ', chr(13)), ' th', chr(13) || chr(10)), ' e', chr(0)), ' d', chr(8232)), ' a', chr(12))"


@query(f"WITH {_lines_sql(_MIXED)} SELECT doc_id, ordinal, byte_start, byte_end, octet_length(encode(text)) AS n_bytes, sha256(text) AS sha256 FROM lines")
def text_lines_mixed(spark, sf_dir):
    """Lines of texts with every kind of line end, and with U+0000 within lines."""

    def body(t):
        for old, new in ((", ", "\r"), (" th", "\r\n"), (" e", "\0"), (" d", "\u2028"), (" a", "\f")):
            t = F.replace(t, F.lit(old), F.lit(new))
        return t

    return _text_lines(spark, sf_dir, body).select("doc_id", "ordinal", "byte_start", "byte_end", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2(F.encode("text", "UTF-8"), 256).alias("sha256"))


@query("""
SELECT doc_id, CASE WHEN (crlf > 0)::INT + (lf > 0)::INT + (cr > 0)::INT = 0 THEN 'none' WHEN (crlf > 0)::INT + (lf > 0)::INT + (cr > 0)::INT > 1 THEN 'mixed' WHEN crlf > 0 THEN 'crlf' WHEN lf > 0 THEN 'lf' ELSE 'cr' END AS newline_style
FROM (SELECT doc_id, (length(t) - length(replace(t, chr(13) || chr(10), ''))) / 2 AS crlf, length(t) - length(replace(t, chr(10), '')) - (length(t) - length(replace(t, chr(13) || chr(10), ''))) / 2 AS lf,
             length(t) - length(replace(t, chr(13), '')) - (length(t) - length(replace(t, chr(13) || chr(10), ''))) / 2 AS cr
      FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents))""")
def newline_style(spark, sf_dir):
    """A2: census of line ends."""
    return table(spark, sf_dir, "documents").select("doc_id", text.newline_style(F.coalesce("text", F.lit(""))).alias("newline_style"))


@query(r"SELECT conv_id, turn, len(list_distinct(regexp_extract_all(text, '[\x00-\x08\x0B\x0E-\x1F\x7F]'))) AS n_controls, CASE WHEN text = '' THEN 1.0 WHEN len(regexp_extract_all(text, '[\x00-\x08\x0B\x0E-\x1F]')) <= length(text) * 0.01 THEN 0.98 ELSE 0.0 END::DOUBLE AS confidence FROM conversations")
def control_findings(spark, sf_dir):
    """A3, P5: control characters and the confidence that bytes are text."""
    rows = table(spark, sf_dir, "conversations")
    return rows.select("conv_id", "turn", F.size(text.control_findings(F.col("text"))).cast("long").alias("n_controls"), text.text_confidence(F.col("text")).alias("confidence"))


@query("""
WITH a AS (SELECT 'page' AS origin, page_id AS id, html AS body, lower(regexp_extract(regexp_extract(coalesce(url, ''), '^[^?#]*'), '\\.([a-z0-9]{1,5})$', 1)) AS extension FROM pages
  UNION ALL SELECT 'benchmark', item_id, text, 'csv' FROM benchmark)
SELECT origin, id, CASE WHEN starts_with(body, '%PDF-') THEN 'pdf' WHEN starts_with(body, 'BM') AND strlen(body) >= 14 THEN 'bmp' WHEN starts_with(body, 'GIF89a') THEN 'gif' ELSE 'txt' END AS format_name,
  CASE WHEN extension = '' THEN false ELSE extension NOT IN ('txt', 'md', 'csv', 'log') END AS extension_mismatch FROM a""".replace("\\\\", "\\"))
def format_probe(spark, sf_dir):
    """Format by signature, and whether the name agrees."""
    bare = F.regexp_extract(F.coalesce("url", F.lit("")), "^[^?#]*", 0)
    pages = table(spark, sf_dir, "pages").select(F.lit("page").alias("origin"), F.col("page_id").alias("id"), F.col("html").alias("body"), F.lower(F.regexp_extract(bare, r"\.([a-z0-9]{1,5})$", 1)).alias("extension"))
    items = table(spark, sf_dir, "benchmark").select(F.lit("benchmark").alias("origin"), F.col("item_id").alias("id"), F.col("text").alias("body"), F.lit("csv").alias("extension"))
    rows = pages.unionByName(items).withColumn("content", F.encode("body", "UTF-8"))
    name = F.coalesce(probe.signature_format(F.col("content")), F.when(probe.text_confidence(F.col("content")) > 0, "txt").otherwise("unknown_binary"))
    rows = rows.withColumn("format_name", name)
    return rows.select("origin", "id", "format_name", probe.extension_mismatch(F.col("format_name"), F.col("extension")).alias("extension_mismatch"))


# --- security and access -------------------------------------------------------------------------------------------------

_MEMBERS = """
m AS (SELECT l_orderkey AS package_id, CASE WHEN l_linenumber = 7 THEN '../escape' ELSE 'part' || l_linenumber || CASE WHEN l_returnflag = 'R' AND l_linenumber = 3 THEN '/vbaProject.bin' ELSE '.xml' END END AS path,
  CAST(l_quantity * 100 AS BIGINT) AS compressed, CAST(l_extendedprice * 1000 AS BIGINT) AS inflated FROM lineitem),
n AS (SELECT package_id, lower(path) AS name, count(*) AS k, sum(compressed) AS c, sum(inflated) AS i FROM m GROUP BY 1, 2),
t AS (SELECT package_id, CAST(sum(k) AS BIGINT) AS n_parts, CAST(sum(c) AS BIGINT) AS compressed, CAST(sum(i) AS BIGINT) AS inflated, bool_or(name LIKE '../%') AS unsafe, bool_or(contains(name, 'vbaproject')) AS active, max(k) > 1 AS duplicated FROM n GROUP BY 1),
f AS (SELECT package_id, 'DS-LIM-001' AS code, 'critical' AS severity, 'block' AS effect FROM t WHERE n_parts > 6 OR inflated > 300000000
  UNION ALL SELECT package_id, 'DS-SEC-002', 'critical', 'block' FROM t WHERE inflated / greatest(compressed, 1) > 200 AND inflated > 10485760
  UNION ALL SELECT package_id, 'DS-SEC-001', 'critical', 'block' FROM t WHERE unsafe OR duplicated
  UNION ALL SELECT package_id, 'DS-SEC-003', 'warning', 'review' FROM t WHERE active)"""
_BUDGET = security.Budget(decompressed_bytes=300_000_000, parts=6)


def _packages(spark, sf_dir) -> DataFrame:
    number = F.col("l_linenumber")
    path = F.when(number == 7, "../escape").otherwise(F.concat(F.lit("part"), number.cast("string"), F.when((F.col("l_returnflag") == "R") & (number == 3), "/vbaProject.bin").otherwise(".xml")))
    members = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("package_id"), path.alias("path"), F.round(F.col("l_quantity") * 100).cast("long").alias("compressed"), F.round(F.col("l_extendedprice") * 1000).cast("long").alias("inflated"))
    return security.package_totals(members)


@query(f"WITH {_MEMBERS} SELECT * FROM t")
def package_inventory(spark, sf_dir):
    """Sizes, counts, unsafe, duplicated and active members of packages."""
    return _packages(spark, sf_dir)


@query(f"WITH {_MEMBERS} SELECT * FROM f")
def security_findings(spark, sf_dir):
    """Findings of the security preflight."""
    return security.findings(_packages(spark, sf_dir), _BUDGET)


@query(f"""WITH {_MEMBERS}, g AS (SELECT package_id, max(CASE effect WHEN 'block' THEN 3 ELSE 2 END) AS r FROM f GROUP BY 1),
r AS (SELECT t.package_id, greatest(CASE WHEN n_parts > 4 THEN 1 ELSE 0 END, coalesce(r, 0)) AS r FROM t LEFT JOIN g USING (package_id))
SELECT package_id, CASE r WHEN 3 THEN 'block' WHEN 2 THEN 'review' WHEN 1 THEN 'allow_restricted' ELSE 'allow' END AS decision, CASE r WHEN 3 THEN 'rejected' WHEN 2 THEN 'review' ELSE 'ok' END AS status FROM r""")
def security_decision(spark, sf_dir):
    """The gravest effect decides."""
    totals = _packages(spark, sf_dir)
    return security.decisions(totals, security.findings(totals, _BUDGET), F.col("n_parts") > 4)


@query("""
SELECT c_custkey, CASE WHEN c_acctbal < -500 THEN 'blocked' WHEN c_mktsegment = 'MACHINERY' AND c_acctbal < 0 THEN 'reject' WHEN c_mktsegment = 'BUILDING' AND s_suppkey IS NULL THEN 'secret_required' WHEN c_acctbal > 5000 THEN 'clear_restricted' ELSE 'clear' END AS access_state
FROM customer LEFT JOIN supplier ON s_suppkey = c_custkey""")
def access_state(spark, sf_dir):
    """Access states, secrets by left join."""
    rows = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "supplier").select("s_suppkey"), F.col("s_suppkey") == F.col("c_custkey"), "left")
    segment, balance = F.col("c_mktsegment"), F.col("c_acctbal")
    state = security.access_state(balance < -500, (segment == "MACHINERY") & (balance < 0), segment == "BUILDING", F.col("s_suppkey").isNotNull(), balance > 5000)
    return rows.select("c_custkey", state.alias("access_state"))


# --- parts, resources ----------------------------------------------------------------------------------------------------

_PARTS = """
p AS (SELECT page_id, CASE page_id % 9 WHEN 0 THEN 'word/media/image' || page_id || '.png' WHEN 1 THEN 'word/document.xml' WHEN 2 THEN '_rels/.rels' WHEN 3 THEN 'word/embeddings/o' || page_id || '.bin' WHEN 4 THEN 'word/vbaProject.bin' WHEN 5 THEN 'ppt/theme/theme1.xml' WHEN 6 THEN 'word/fonts/f.odttf' WHEN 7 THEN 'customXml/item1.xml' ELSE 'data/' || page_id || '.dat' END AS path, page_id % 4 = 0 AS encrypted FROM pages),
x AS (SELECT *, lower(regexp_extract(path, '[.]([^./]+)$', 1)) AS extension FROM p),
t AS (SELECT page_id, path, encrypted, CASE WHEN path = 'word/document.xml' THEN 'application/main+xml' WHEN extension = 'png' THEN 'image/png' WHEN extension = 'rels' THEN 'application/rels+xml' WHEN extension = 'xml' THEN 'application/xml' ELSE 'application/octet-stream' END AS media_type FROM x)"""


def _parts(spark, sf_dir) -> DataFrame:
    n = F.col("page_id")
    names = ["word/media/image{}.png", "word/document.xml", "_rels/.rels", "word/embeddings/o{}.bin", "word/vbaProject.bin", "ppt/theme/theme1.xml", "word/fonts/f.odttf", "customXml/item1.xml", "data/{}.dat"]
    path = F.replace(F.element_at(F.array(*[F.lit(x) for x in names]), (n % 9 + 1).cast("int")), F.lit("{}"), n.cast("string"))
    rows = table(spark, sf_dir, "pages").select("page_id", path.alias("path"), (n % 4 == 0).alias("encrypted"))
    overrides = spark.range(1).select(F.lit("word/document.xml").alias("path"), F.lit("application/main+xml").alias("override"))
    defaults = spark.range(1).select(F.explode(F.create_map(*[F.lit(x) for x in ("png", "image/png", "rels", "application/rels+xml", "xml", "application/xml")])).alias("extension", "default"))
    return parts.media_types(rows, overrides, defaults)


@query(f"WITH {_PARTS} SELECT page_id, path, media_type FROM t")
def media_type_resolution(spark, sf_dir):
    """Override, default or octet-stream."""
    return _parts(spark, sf_dir).select("page_id", "path", "media_type")


@query(f"""WITH {_PARTS} SELECT page_id, CASE WHEN path LIKE '%.rels' THEN 'relationships' WHEN media_type LIKE '%+xml' OR media_type = 'application/xml' THEN 'xml' WHEN contains(path, '/media/') OR contains(path, '/embeddings/') OR contains(lower(path), 'vbaproject') OR contains(path, '/fonts/') THEN 'resource' ELSE 'binary' END AS kind,
array_to_string(list_filter([CASE WHEN path LIKE 'customXml/%' THEN 'custom_xml' END, CASE WHEN contains(path, '/embeddings/') THEN 'embedded_object' END, CASE WHEN encrypted THEN 'encrypted_entry' END, CASE WHEN contains(path, 'vbaProject') THEN 'macro' END], lambda x: x IS NOT NULL), ',') AS flags FROM t""")
def part_kind_flags(spark, sf_dir):
    """Kinds and security flags of parts."""
    p, m = F.col("path"), F.col("media_type")
    return _parts(spark, sf_dir).select("page_id", parts.part_kind(p, m).alias("kind"), F.array_join(parts.security_flags(p, m, F.col("encrypted")), ",").alias("flags"))


_KIND = "CASE WHEN contains(path, '/media/') THEN 'image' WHEN contains(path, '/embeddings/') THEN 'embedded_document' WHEN contains(path, 'vbaProject') THEN 'macro_project' WHEN contains(path, '/fonts/') THEN 'font' WHEN contains(path, '/theme/') THEN 'theme' END"


def _resources(spark, sf_dir) -> DataFrame:
    p, m = F.col("path"), F.col("media_type")
    rows = _parts(spark, sf_dir).select("page_id", "path", parts.resource_kind(p, m, parts.security_flags(p, m, F.col("encrypted"))).alias("kind"))
    return rows.filter("kind IS NOT NULL").select("path", "kind", F.col("page_id").alias("resource_id"))


@query(f"WITH {_PARTS} SELECT page_id AS resource_id, path, {_KIND} AS kind FROM t WHERE {_KIND} IS NOT NULL")
def resource_classification(spark, sf_dir):
    """Parts that are resources."""
    return _resources(spark, sf_dir)


@query(f"""WITH {_PARTS}, r AS (SELECT path, min(page_id) AS resource_id, {_KIND} AS kind FROM t WHERE {_KIND} IS NOT NULL GROUP BY path),
e AS (SELECT event_id, 'word/media/image' || (user_id % 300) || '.png' AS target FROM events) SELECT kind, resource_id, count(*) AS n_uses, min(event_id) AS first_use FROM e JOIN r ON path = target GROUP BY 1, 2""")
def resource_occurrences(spark, sf_dir):
    """Relationships whose target is a resource."""
    resources = _resources(spark, sf_dir).groupBy("path", "kind").agg(F.min("resource_id").alias("resource_id"))
    links = table(spark, sf_dir, "events").select(F.col("event_id").alias("relationship_id"), F.col("user_id").alias("owner_id"), F.concat(F.lit("word/media/image"), (F.col("user_id") % 300).cast("string"), F.lit(".png")).alias("target"))
    return parts.occurrences(links, resources).groupBy("kind", "resource_id").agg(F.count("*").alias("n_uses"), F.min("relationship_id").alias("first_use"))


@query(f"""WITH {_PARTS}, r AS (SELECT path, min(page_id) AS resource_id FROM t WHERE {_KIND} IS NOT NULL GROUP BY path)
SELECT resource_id, path FROM r WHERE path NOT IN (SELECT 'word/media/image' || (user_id % 300) || '.png' FROM events)""")
def unused_resources(spark, sf_dir):
    """Resources without an occurrence."""
    resources = _resources(spark, sf_dir).groupBy("path", "kind").agg(F.min("resource_id").alias("resource_id"))
    links = table(spark, sf_dir, "events").select(F.col("event_id").alias("relationship_id"), F.col("user_id").alias("owner_id"), F.concat(F.lit("word/media/image"), (F.col("user_id") % 300).cast("string"), F.lit(".png")).alias("target"))
    return parts.unused(resources, parts.occurrences(links, resources)).select("resource_id", "path")


@query("SELECT nation.n_name AS path, CASE WHEN n_nationkey % 2 = 0 THEN 'word/_rels/' || n_name || '.xml.rels' ELSE 'x/' || n_name END AS rels, CASE WHEN n_nationkey % 2 = 0 THEN 'word/' || n_name || '.xml' END AS source_part, n_name || '#a' AS address, n_name AS normal, NOT (n_nationkey % 5 = 0) AS portable FROM nation")
def part_paths(spark, sf_dir):
    """Portable paths, owners of relationship files, normal part paths."""
    name, key = F.col("n_name"), F.col("n_nationkey")
    rels = F.when(key % 2 == 0, F.concat(F.lit("word/_rels/"), name, F.lit(".xml.rels"))).otherwise(F.concat(F.lit("x/"), name))
    odd = F.when(key % 5 == 0, F.concat(F.lit("a/../"), name)).otherwise(name)
    rows = table(spark, sf_dir, "nation").select(name.alias("path"), rels.alias("rels"), F.concat(name, F.lit("#a")).alias("address"), odd.alias("odd"))
    return rows.select("path", "rels", scalar.rels_source_part(F.col("rels")).alias("source_part"), "address", scalar.normal_part_path(F.concat(F.lit("/"), F.col("address"))).alias("normal"), scalar.is_portable_path(F.col("odd")).alias("portable"))


# --- sheets --------------------------------------------------------------------------------------------------------------

_CELLS = """
c AS (SELECT l_orderkey % 50 AS sheet, l_orderkey * 8 + l_linenumber AS cell_id, l_orderkey // 50 + 1 AS row, (l_partkey % 40) + 1 AS col, CASE l_linenumber WHEN 1 THEN 's' WHEN 2 THEN 'str' WHEN 3 THEN 'b' WHEN 4 THEN 'e' ELSE 'n' END AS code,
  CASE WHEN l_linenumber = 6 THEN NULL WHEN l_linenumber = 1 THEN CAST(l_suppkey % 30 AS VARCHAR) WHEN l_linenumber = 3 THEN CAST(l_partkey % 2 AS VARCHAR) ELSE l_shipdate::DATE::VARCHAR || '/' || CAST(l_partkey AS VARCHAR) END AS raw,
  CASE WHEN l_suppkey % 10 = 0 THEN CASE WHEN l_partkey % 2 = 0 THEN 'SUM(A' || l_linenumber || ':$B$' || (l_partkey % 90 + 1) || ')+now( )' ELSE '''My Sheet''!C' || (l_partkey % 90 + 1) || '*C1+C1' END END AS formula FROM lineitem)"""


def _cells(spark, sf_dir) -> DataFrame:
    line, order, item, supplier = F.col("l_linenumber"), F.col("l_orderkey"), F.col("l_partkey"), F.col("l_suppkey")
    code = F.when(line == 1, "s").when(line == 2, "str").when(line == 3, "b").when(line == 4, "e").otherwise("n")
    other = F.concat(F.date_format("l_shipdate", "yyyy-MM-dd"), F.lit("/"), item.cast("string"))
    raw = F.when(line == 6, None).when(line == 1, (supplier % 30).cast("string")).when(line == 3, (item % 2).cast("string")).otherwise(other)
    place = (item % 90 + 1).cast("string")
    formula = F.when(supplier % 10 == 0, F.when(item % 2 == 0, F.concat(F.lit("SUM(A"), line.cast("string"), F.lit(":$B$"), place, F.lit(")+now( )"))).otherwise(F.concat(F.lit("'My Sheet'!C"), place, F.lit("*C1+C1"))))
    return table(spark, sf_dir, "lineitem").select((order % 50).alias("sheet"), (order * 8 + line).alias("cell_id"), (F.floor(order / 50) + 1).alias("row"), ((item % 40) + 1).alias("column"), code.alias("code"), raw.alias("raw"), formula.alias("formula"))


@query(f"""WITH {_CELLS} SELECT cell_id, CASE WHEN formula IS NOT NULL THEN 'formula' WHEN code = 's' AND raw IS NULL THEN 'blank' WHEN code IN ('s', 'str') THEN 'string' WHEN code = 'b' THEN 'boolean' WHEN code = 'e' THEN 'error' WHEN raw IS NOT NULL THEN 'number' ELSE 'blank' END AS value_kind,
CASE WHEN code = 's' THEN CASE WHEN CAST(raw AS INT) < 20 THEN 'shared' || raw ELSE raw END WHEN code = 'b' THEN CASE WHEN raw = '1' THEN 'true' ELSE 'false' END ELSE raw END AS value FROM c""")
def cell_typing(spark, sf_dir):
    """Kinds and values of cells, shared strings by index."""
    strings = F.array(*[F.lit(f"shared{i}") for i in range(20)])
    kind = sheets.value_kind(F.col("code"), F.col("raw"), F.col("formula").isNotNull())
    return _cells(spark, sf_dir).select("cell_id", kind.alias("value_kind"), sheets.resolved_value(F.col("code"), F.col("raw"), strings).alias("value"))


@query(f"""WITH {_CELLS} SELECT cell_id, formula AS source, array_to_string(list_sort(list_distinct(regexp_extract_all(formula, '(?:''[^'']+''!)?\\$?[A-Z]{{1,3}}\\$?[1-9][0-9]*'))), ',') AS dependencies, regexp_matches(formula, '(?i)\\b(?:NOW|TODAY|RAND|RANDBETWEEN|OFFSET|INDIRECT)\\s*\\(') AS volatile FROM c WHERE formula IS NOT NULL""")
def formula_dependencies(spark, sf_dir):
    """Dependencies and volatility of formulas, which are never calculated."""
    f = F.col("formula")
    return _cells(spark, sf_dir).filter(f.isNotNull()).select("cell_id", f.alias("source"), F.array_join(scalar.formula_dependencies(f), ",").alias("dependencies"), scalar.is_volatile(f).alias("volatile"))


@query(f"WITH {_CELLS} SELECT cell_id, CASE WHEN col > 26 THEN chr(CAST(64 + (col - 1) // 26 AS INT)) ELSE '' END || chr(CAST(65 + (col - 1) % 26 AS INT)) || row AS address, col AS column_number, row AS row_number FROM c")
def cell_addresses(spark, sf_dir):
    """Addresses to row and column numbers and back."""
    rows = _cells(spark, sf_dir).select("cell_id", scalar.a1_address(F.col("row"), F.col("column")).alias("address"))
    return rows.select("cell_id", "address", scalar.a1_column(F.col("address")).alias("column_number"), scalar.a1_row(F.col("address")).alias("row_number"))


@query(f"WITH {_CELLS} SELECT sheet, (row - 1) // 26 AS tile_row, (col - 1) // 12 AS tile_column, count(*) AS n_cells, min(cell_id) AS first_cell, max(row) AS max_row FROM c GROUP BY 1, 2, 3")
def cell_tiles(spark, sf_dir):
    """Cells dealt to tiles."""
    return sheets.tiles(_cells(spark, sf_dir)).groupBy("sheet", "tile_row", "tile_column").agg(F.count("*").alias("n_cells"), F.min("cell_id").alias("first_cell"), F.max("row").alias("max_row"))


@query(f"WITH {_CELLS} SELECT sheet, max(row) AS max_row, max(col) AS max_column, count(*) AS n_cells FROM c GROUP BY 1")
def sheet_extents(spark, sf_dir):
    """Extents of sheets."""
    return sheets.extents(_cells(spark, sf_dir))


@query(f"WITH {_CELLS} SELECT cell_id, CASE WHEN length(raw) > 10 THEN substr(raw, 1, 9) || '…' ELSE raw END AS shown, coalesce(length(raw) > 10, false) AS is_clipped FROM c")
def cell_clipping(spark, sf_dir):
    """What a cell's box shows of its value."""
    return sheets.clipped(_cells(spark, sf_dir).withColumn("value", F.col("raw"))).select("cell_id", "shown", "is_clipped")


# --- slides, tree of units -----------------------------------------------------------------------------------------------


@query("""SELECT conv_id AS deck, turn AS slide, count(*) AS n_shapes, CAST(sum(CASE WHEN role = 'user' THEN 1 ELSE 0 END) AS BIGINT) AS n_text_shapes, max(length(text)) AS longest FROM conversations GROUP BY 1, 2""")
def slide_shapes(spark, sf_dir):
    """Shapes by slide."""
    rows = table(spark, sf_dir, "conversations")
    return rows.groupBy(F.col("conv_id").alias("deck"), F.col("turn").alias("slide")).agg(F.count("*").alias("n_shapes"), F.count_if(F.col("role") == "user").alias("n_text_shapes"), F.max(F.length("text")).cast("long").alias("longest"))


@query("SELECT c.conv_id, c.turn, coalesce(CAST(p.turn AS VARCHAR), 'root') AS parent FROM (SELECT DISTINCT conv_id, turn FROM conversations) c LEFT JOIN (SELECT DISTINCT conv_id, turn FROM conversations) p ON p.conv_id = c.conv_id AND p.turn = c.turn - 1")
def shape_parent(spark, sf_dir):
    """Parents by self-join, the root where there is none."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn").distinct()
    above = rows.select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("turn").alias("above"))
    return rows.join(above, ["conv_id", "turn"], "left").select("conv_id", "turn", F.coalesce(F.col("above").cast("string"), F.lit("root")).alias("parent"))


_IR = lambda native, kind: sql_stable_id("ir", f"""('{{"document_id":"' || document_id || '","kind":"' || {kind} || '","native_id":"' || {native} || '"}}')""")
_ROOT = sql_stable_id("ir", """('{"document_id":"' || document_id || '","synthetic":"document"}')""")


@query(f"WITH {_LINES}, w AS (SELECT *, {_LINE_ID} AS native_id FROM lines) SELECT doc_id, {_IR('native_id', chr(39) + 'text_line' + chr(39))} AS unit_id, {_ROOT} AS parent_id, ordinal, native_id, text, false AS protected FROM w")
def ir_projection_text(spark, sf_dir):
    """Lines as units of the tree."""
    return ir.project_text(_text_lines(spark, sf_dir), "doc_id").select("doc_id", "unit_id", "parent_id", "ordinal", "native_id", "text", "protected")


@query(f"""WITH {_CELLS}, k AS (SELECT 'd' || sheet AS document_id, 'w' || sheet AS worksheet_id, 'c' || cell_id AS native_id, cell_id AS ordinal, formula IS NOT NULL AS protected,
 CASE WHEN formula IS NULL AND code IN ('s', 'str', 'e') AND NOT (code = 's' AND raw IS NULL) THEN raw END AS text FROM c)
SELECT document_id, {_IR('native_id', chr(39) + 'cell' + chr(39))} AS unit_id, {_IR('worksheet_id', chr(39) + 'worksheet' + chr(39))} AS parent_id, ordinal, text, protected FROM k""")
def ir_projection_sheet(spark, sf_dir):
    """Cells as units below their worksheets."""
    rows = _cells(spark, sf_dir).withColumn("value_kind", sheets.value_kind(F.col("code"), F.col("raw"), F.col("formula").isNotNull()))
    s = F.col("sheet").cast("string")
    cells = rows.select(F.concat(F.lit("d"), s).alias("document_id"), F.concat(F.lit("w"), s).alias("worksheet_id"), F.concat(F.lit("c"), F.col("cell_id").cast("string")).alias("cell_id"), "value_kind", F.col("raw").alias("value"), F.col("cell_id").alias("ordinal"))
    return ir.project_sheet(cells).select("document_id", "unit_id", "parent_id", "ordinal", "text", "protected")


@query(f"""WITH k AS (SELECT 'd' || conv_id AS document_id, 's' || turn AS slide_id, 'h' || turn || role AS native_id, turn AS ordinal, text, CASE WHEN role = 'user' THEN 'text_shape' ELSE 'visual_object' END AS kind FROM conversations)
SELECT document_id, kind, {_IR('native_id', 'kind')} AS unit_id, {_IR('slide_id', chr(39) + 'slide' + chr(39))} AS parent_id, ordinal, text FROM k""")
def ir_projection_slides(spark, sf_dir):
    """Shapes as units below their slides."""
    turn = F.col("turn").cast("string")
    shapes = table(spark, sf_dir, "conversations").select(F.concat(F.lit("d"), F.col("conv_id").cast("string")).alias("document_id"), F.concat(F.lit("s"), turn).alias("slide_id"), F.concat(F.lit("h"), turn, "role").alias("shape_id"), (F.col("role") == "user").alias("has_text"), "text", F.col("turn").alias("ordinal"))
    return ir.project_slides(shapes).select("document_id", "kind", "unit_id", "parent_id", "ordinal", "text")


@query("""WITH b AS (SELECT n_regionkey AS document_id, count(*) AS n FROM nation GROUP BY 1)
SELECT CAST(n_regionkey AS VARCHAR) AS document_id, 'style' || lpad(CAST(s_suppkey AS VARCHAR), 6, '0') AS native_id, n - 1 + row_number() OVER (PARTITION BY n_regionkey ORDER BY s_suppkey) AS ordinal, s_name AS text FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN b ON document_id = n_regionkey""")
def ir_catalog_append(spark, sf_dir):
    """Catalogs continue the ordinals of the profile's units."""
    nation = table(spark, sf_dir, "nation")
    order = Window.partitionBy("n_regionkey").orderBy("n_nationkey")
    base = nation.select(F.col("n_regionkey").cast("string").alias("document_id"), (F.row_number().over(order) - 1).cast("long").alias("ordinal"))
    rows = table(spark, sf_dir, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("n_regionkey").cast("string").alias("document_id"), F.concat(F.lit("style"), F.lpad(F.col("s_suppkey").cast("string"), 6, "0")).alias("native_id"), F.col("s_name").alias("text"))
    return ir.append_catalog(base, rows, F.lit("style_definition"), F.lit(True)).select("document_id", "native_id", "ordinal", "text")


@query("""WITH a AS (SELECT l_orderkey AS annotation_id, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_suppkey) AS pos, l_suppkey AS native_id FROM lineitem), f AS (SELECT annotation_id, min(pos) AS pos FROM a WHERE native_id % 3 = 0 GROUP BY 1)
SELECT annotation_id, max(CASE WHEN a.pos = f.pos THEN native_id END) AS unit_id FROM a LEFT JOIN f USING (annotation_id) GROUP BY 1""")
def annotation_first_target(spark, sf_dir):
    """The first target that is a unit."""
    rows = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("annotation_id")).agg(F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_suppkey"))), lambda x: x["l_suppkey"]).alias("targets"))
    units = table(spark, sf_dir, "supplier").filter("s_suppkey % 3 = 0").select(F.col("s_suppkey").alias("native_id"), F.col("s_suppkey").alias("unit_id"))
    return ir.first_target(rows, units)


_TREE = """
u AS (SELECT 'd' || (l_orderkey % 20) AS document_id, 'u' || l_orderkey || '_' || l_linenumber AS unit_id, CASE WHEN l_linenumber = 1 THEN CASE WHEN l_orderkey < 20 THEN NULL ELSE 'u' || (l_orderkey - 20) || '_1' END WHEN l_suppkey % 50 = 0 THEN 'u' || l_orderkey || '_' || l_linenumber ELSE 'u' || l_orderkey || '_' || (l_linenumber - 1) END AS parent_id,
  CASE WHEN l_partkey % 40 = 0 THEN 'synthetic' ELSE 'native_projection' END AS origin, CAST(l_partkey AS VARCHAR) AS native_id FROM lineitem)"""


def _tree(spark, sf_dir) -> DataFrame:
    order, line = F.col("l_orderkey"), F.col("l_linenumber")
    name = lambda o, n: F.concat(F.lit("u"), o.cast("string"), F.lit("_"), n.cast("string"))
    parent = F.when(line == 1, F.when(order < 20, None).otherwise(name(order - 20, F.lit(1)))).when(F.col("l_suppkey") % 50 == 0, name(order, line)).otherwise(name(order, line - 1))
    return table(spark, sf_dir, "lineitem").select(F.concat(F.lit("d"), (order % 20).cast("string")).alias("document_id"), name(order, line).alias("unit_id"), parent.alias("parent_id"), F.when(F.col("l_partkey") % 40 == 0, "synthetic").otherwise("native_projection").alias("origin"), F.col("l_partkey").cast("string").alias("native_id"))


@query(f"""WITH {_TREE} SELECT document_id, unit_id, 'repeated_id' AS rule FROM u GROUP BY 1, 2 HAVING count(*) > 1
UNION ALL SELECT document_id, NULL, 'one_root' FROM u GROUP BY 1 HAVING sum(CASE WHEN parent_id IS NULL THEN 1 ELSE 0 END) <> 1
UNION ALL SELECT document_id, unit_id, 'own_parent' FROM u WHERE unit_id = parent_id
UNION ALL SELECT document_id, unit_id, 'orphan' FROM u WHERE parent_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM u p WHERE p.document_id = u.document_id AND p.unit_id = u.parent_id)
UNION ALL SELECT document_id, unit_id, 'source_of_origin' FROM u WHERE origin = 'synthetic' AND native_id IS NOT NULL""")
def ir_invariants(spark, sf_dir):
    """V2: repeated ids, roots, own parents, orphans, origins."""
    return ir.broken_invariants(_tree(spark, sf_dir))


_LOOPS = """
u AS (SELECT CAST(l_orderkey % 500 AS VARCHAR) AS document_id, 'u' || l_partkey % 40 AS unit_id, CASE WHEN l_partkey % 40 % 8 = 0 AND l_orderkey % 3 = 0 THEN NULL WHEN l_partkey % 40 % 8 = 0 THEN 'u' || (l_partkey % 40 + l_orderkey % 500 % 8) % 40 ELSE 'u' || (l_partkey % 40 - 1) END AS parent_id FROM lineitem
  UNION ALL SELECT CAST(s_suppkey % 500 AS VARCHAR), 'u' || s_nationkey, 'u' || (s_nationkey + 3) FROM supplier WHERE s_suppkey % 2 = 0)"""


@query(f"""WITH RECURSIVE {_LOOPS}, e AS (SELECT DISTINCT * FROM u WHERE parent_id <> unit_id),
w(document_id, unit_id, here) AS (SELECT document_id, unit_id, parent_id FROM e UNION SELECT w.document_id, w.unit_id, e.parent_id FROM w JOIN e ON e.document_id = w.document_id AND e.unit_id = w.here)
SELECT document_id, unit_id FROM w WHERE here = unit_id""")
def ir_cycles(spark, sf_dir):
    """V2: units that are their own ancestors; repeated ids have several parents."""
    one, order = F.col("l_partkey") % 40, F.col("l_orderkey")
    name = lambda n: F.concat(F.lit("u"), n.cast("string"))
    parent = F.when(one % 8 != 0, name(one - 1)).when(order % 3 != 0, name((one + order % 500 % 8) % 40))
    rows = table(spark, sf_dir, "lineitem").select((order % 500).cast("string").alias("document_id"), name(one).alias("unit_id"), parent.alias("parent_id"))
    more = table(spark, sf_dir, "supplier").filter("s_suppkey % 2 = 0").select((F.col("s_suppkey") % 500).cast("string").alias("document_id"), name(F.col("s_nationkey")).alias("unit_id"), name(F.col("s_nationkey") + 3).alias("parent_id"))
    return ir.on_cycles(rows.unionByName(more))


_CHAIN = """
e AS (SELECT 'n' || n_nationkey AS node, CASE WHEN n_nationkey % 4 = 0 THEN 'r' || n_regionkey ELSE 'n' || (n_nationkey - 1) END AS parent FROM nation UNION ALL SELECT 'c' || c_custkey, 'n' || c_nationkey FROM customer)"""


def _chain(spark, sf_dir) -> DataFrame:
    key = F.col("n_nationkey")
    parent = F.when(key % 4 == 0, F.concat(F.lit("r"), F.col("n_regionkey").cast("string"))).otherwise(F.concat(F.lit("n"), (key - 1).cast("string")))
    nations = table(spark, sf_dir, "nation").select(F.concat(F.lit("n"), key.cast("string")).alias("node"), parent.alias("parent"))
    customers = table(spark, sf_dir, "customer").select(F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("node"), F.concat(F.lit("n"), F.col("c_nationkey").cast("string")).alias("parent"))
    return nations.unionByName(customers)


@query(f"""WITH RECURSIVE {_CHAIN}, v AS (SELECT 'n' || n_nationkey AS node, 'font' AS name, n_name AS value FROM nation WHERE n_nationkey % 3 = 0 UNION ALL SELECT 'r' || r_regionkey, 'color', r_name FROM region UNION ALL SELECT 'c' || c_custkey, 'size', c_mktsegment FROM customer WHERE c_custkey % 2 = 0),
a(node, above, depth) AS (SELECT node, node, 0 FROM (SELECT node FROM e UNION SELECT parent FROM e) UNION ALL SELECT a.node, e.parent, depth + 1 FROM a JOIN e ON e.node = a.above WHERE depth < 20)
SELECT node, name, value FROM (SELECT a.node, name, value, row_number() OVER (PARTITION BY a.node, name ORDER BY depth, value) AS k FROM a JOIN v ON v.node = a.above) WHERE k = 1""")
def style_inheritance(spark, sf_dir):
    """Properties along the chain that styles are based on."""
    named = lambda df, node, name, value: df.select(node.alias("node"), F.lit(name).alias("name"), F.col(value).alias("value"))
    text_of = lambda p, c: F.concat(F.lit(p), F.col(c).cast("string"))
    values = named(table(spark, sf_dir, "nation").filter("n_nationkey % 3 = 0"), text_of("n", "n_nationkey"), "font", "n_name")
    values = values.unionByName(named(table(spark, sf_dir, "region"), text_of("r", "r_regionkey"), "color", "r_name")).unionByName(named(table(spark, sf_dir, "customer").filter("c_custkey % 2 = 0"), text_of("c", "c_custkey"), "size", "c_mktsegment"))
    return graph.inherited(values, _chain(spark, sf_dir))


@query(f"""WITH RECURSIVE {_CHAIN}, d AS (SELECT 'n' || n_nationkey AS node, CASE WHEN n_nationkey % 6 = 0 THEN n_name END AS address FROM nation UNION ALL SELECT 'c' || c_custkey, NULL FROM customer),
a(node, above, depth) AS (SELECT node, node, 0 FROM d UNION ALL SELECT a.node, e.parent, depth + 1 FROM a JOIN e ON e.node = a.above WHERE depth < 20),
n AS (SELECT a.node, address, row_number() OVER (PARTITION BY a.node ORDER BY depth) AS k FROM a JOIN d ON d.node = a.above WHERE address IS NOT NULL)
SELECT d.node, n.address FROM d LEFT JOIN n ON n.node = d.node AND k = 1""")
def native_address_resolution(spark, sf_dir):
    """The nearest address upward."""
    key = F.col("n_nationkey")
    nations = table(spark, sf_dir, "nation").select(F.concat(F.lit("n"), key.cast("string")).alias("node"), F.when(key % 6 == 0, F.col("n_name")).alias("address"))
    customers = table(spark, sf_dir, "customer").select(F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("node"), F.lit(None).cast("string").alias("address"))
    return graph.nearest(nations.unionByName(customers), _chain(spark, sf_dir))


@query("""WITH RECURSIVE e AS (SELECT p_partkey AS node, CASE WHEN p_partkey % 10 = 9 THEN p_partkey - p_partkey % 5 ELSE p_partkey + 1 END AS parent FROM part WHERE p_size % 2 = 0 OR p_partkey % 10 >= 5),
a(node, above, depth) AS (SELECT node, parent, 1 FROM e UNION ALL SELECT a.node, e.parent, depth + 1 FROM a JOIN e ON e.node = a.above WHERE depth < 12 AND a.above <> a.node)
SELECT DISTINCT node FROM a WHERE node = above""")
def reference_cycles(spark, sf_dir):
    """V6: references that lead back to themselves."""
    key = F.col("p_partkey")
    edges = table(spark, sf_dir, "part").filter((F.col("p_size") % 2 == 0) | (key % 10 >= 5)).select(key.alias("node"), F.when(key % 10 == 9, key - key % 5).otherwise(key + 1).alias("parent"))
    return graph.on_cycles(edges)


@query("""WITH RECURSIVE k AS (SELECT CAST(p_partkey AS BIGINT) AS k, p_size, max(p_partkey) OVER () AS n FROM part),
e AS (SELECT k AS node, k + 1 AS parent FROM k WHERE k % 10 <> 9 UNION SELECT k, k - k % 10 FROM k WHERE k % 10 = 7 AND 10 * k < 9 * n UNION SELECT k, k + 10 FROM k WHERE k % 10 = 3 AND k % 50 < 20 UNION SELECT k, k FROM k WHERE p_size = 7 UNION SELECT k, k + 1 FROM k WHERE k % 10 = 9 AND 10 * k >= 9 * n UNION SELECT k, k - 25 FROM k WHERE k % 100 = 48),
r(node, there) AS (SELECT node, parent FROM e UNION SELECT r.node, e.parent FROM r JOIN e ON e.node = r.there)
SELECT a.node, min(a.there) AS component FROM r a JOIN r b ON b.node = a.there AND b.there = a.node GROUP BY 1""")
def reference_components(spark, sf_dir):
    """V6: strongly connected components of references with many parents: cycles, bridges, edges to oneself, a long tail."""
    rows = table(spark, sf_dir, "part").select(F.col("p_partkey").cast("long").alias("k"), "p_size")
    rows = rows.crossJoin(F.broadcast(rows.agg(F.max("k").alias("n"))))  # one row
    ends = F.array_compact(F.array(
        F.when(F.expr("k % 10 <> 9 OR 10 * k >= 9 * n"), F.col("k") + 1), F.when(F.expr("k % 10 = 7 AND 10 * k < 9 * n"), F.col("k") - F.col("k") % 10), F.when(F.expr("k % 10 = 3 AND k % 50 < 20"), F.col("k") + 10),
        F.when(F.col("p_size") == 7, F.col("k")), F.when(F.expr("k % 100 = 48"), F.col("k") - 25),
    ))
    return graph.strongly_connected(rows.select(F.col("k").alias("node"), F.explode(ends).alias("parent")))


# --- entities and edges ----------------------------------------------------------------------------------------------------

_ENTITIES = """
n AS (SELECT 'binary' AS layer, 's' || s_suppkey AS entity_id, 'artifact' AS kind, s_name AS address, NULL AS owner FROM supplier
  UNION ALL SELECT 'container', 'p' || p_partkey, p_brand, p_name, NULL FROM part UNION ALL SELECT 'native', 'l' || l_partkey, l_returnflag, NULL, 'p' || l_partkey FROM lineitem)"""


def _entities(spark, sf_dir) -> DataFrame:
    none = F.lit(None).cast("string")
    key = lambda p, c: F.concat(F.lit(p), F.col(c).cast("string"))
    rows = lambda df, layer, entity, kind, address, owner: df.select(F.lit(layer).alias("layer"), entity.alias("entity_id"), kind.alias("kind"), address.alias("address"), owner.alias("owner"))
    return mapping.inventory([
        rows(table(spark, sf_dir, "supplier"), "binary", key("s", "s_suppkey"), F.lit("artifact"), F.col("s_name"), none),
        rows(table(spark, sf_dir, "part"), "container", key("p", "p_partkey"), F.col("p_brand"), F.col("p_name"), none),
        rows(table(spark, sf_dir, "lineitem"), "native", key("l", "l_partkey"), F.col("l_returnflag"), none, key("p", "l_partkey")),
    ])


@query(f"WITH {_ENTITIES} SELECT layer, kind, count(DISTINCT entity_id) AS n_entities, min(entity_id) AS first_id, max(entity_id) AS last_id FROM n GROUP BY 1, 2")
def entity_inventory(spark, sf_dir):
    """Entities of all layers by kind."""
    return mapping.by_kind(_entities(spark, sf_dir))


@query(f"WITH {_ENTITIES} SELECT layer, entity_id, min(kind) AS kind, min(address) AS address, min(owner) AS owner, count(*) AS n_rows, count(DISTINCT kind) > 1 OR count(DISTINCT address) > 1 OR count(DISTINCT owner) > 1 AS conflict FROM n GROUP BY 1, 2")
def entity_merge(spark, sf_dir):
    """A5: one row per entity, with conflicts."""
    return mapping.merged(_entities(spark, sf_dir))


_PAIRS = """
q AS (SELECT 'p' || l_partkey AS source_id, 'l' || l_suppkey AS target_id, CASE l_returnflag WHEN 'A' THEN 'exact' WHEN 'N' THEN 'approximate' ELSE 'inferred' END AS exactness, CASE l_returnflag WHEN 'A' THEN 1.0 WHEN 'N' THEN 0.7 ELSE 0.5 END::DOUBLE AS confidence, l_linestatus AS method FROM lineitem)"""


def _pairs(spark, sf_dir) -> DataFrame:
    flag = F.col("l_returnflag")
    return table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("p"), F.col("l_partkey").cast("string")).alias("source_id"), F.concat(F.lit("l"), F.col("l_suppkey").cast("string")).alias("target_id"),
        F.when(flag == "A", "exact").when(flag == "N", "approximate").otherwise("inferred").alias("exactness"), F.when(flag == "A", 1.0).when(flag == "N", 0.7).otherwise(0.5).alias("confidence"), F.col("l_linestatus").alias("method"),
    )


@query(f"WITH {_PAIRS} SELECT source_id, exactness, confidence, method, count(DISTINCT target_id) AS n_targets, min(target_id) AS first_target, max(target_id) AS last_target FROM q GROUP BY 1, 2, 3, 4")
def grouped_edges(spark, sf_dir):
    """Edges with their distinct targets."""
    return mapping.grouped_edges(_pairs(spark, sf_dir))


@query(f"""WITH {_PAIRS}, s AS (SELECT source_id, count(DISTINCT target_id) AS t FROM q GROUP BY 1), k AS (SELECT CASE WHEN t = 1 THEN 'one_to_one' ELSE 'one_to_many' END AS cardinality FROM s) SELECT cardinality, count(*) AS n_edges FROM k GROUP BY 1""")
def edge_cardinality(spark, sf_dir):
    """Classes of edges."""
    sizes = _pairs(spark, sf_dir).groupBy("source_id", "target_id").agg(F.lit(1).alias("one")).groupBy("source_id").agg(F.count("*").alias("t"))
    return sizes.groupBy(mapping.cardinality(F.lit(1), F.col("t")).alias("cardinality")).agg(F.count("*").alias("n_edges"))


@query(f"WITH {_PAIRS} SELECT source_id, CASE max(CASE exactness WHEN 'exact' THEN 2 WHEN 'approximate' THEN 1 ELSE 0 END) WHEN 2 THEN 'exact' WHEN 1 THEN 'approximate' ELSE 'inferred' END AS exactness FROM q GROUP BY 1")
def best_exactness(spark, sf_dir):
    """An entity's best exactness."""
    assert EXACTNESS[-1] == "exact"
    return mapping.best_exactness(_pairs(spark, sf_dir), "source_id")


@query("""
WITH n AS (SELECT o_orderkey AS document_id, 'n' || o_orderkey AS native_id, o_orderkey || '/' || (o_orderkey % 5) AS part_path FROM orders),
p AS (SELECT l_orderkey AS document_id, l_orderkey || '/' || l_linenumber AS path, l_orderkey * 10 + l_linenumber AS part_id FROM lineitem),
s AS (SELECT document_id, min(part_id) AS only_part FROM p GROUP BY 1 HAVING count(*) = 1)
SELECT n.document_id, native_id, coalesce(p.part_id, only_part) AS part_id, CASE WHEN p.part_id IS NULL AND only_part IS NULL THEN 'inferred' ELSE 'exact' END AS exactness, CASE WHEN p.part_id IS NULL AND only_part IS NULL THEN 0.5 ELSE 1.0 END::DOUBLE AS confidence,
CASE WHEN p.part_id IS NOT NULL THEN 'part_path' WHEN only_part IS NOT NULL THEN 'single_part' ELSE 'container_scope' END AS method FROM n LEFT JOIN p ON p.document_id = n.document_id AND path = part_path LEFT JOIN s ON s.document_id = n.document_id""")
def origin_edges(spark, sf_dir):
    """Where native units come from, by priority."""
    key = F.col("o_orderkey")
    native = table(spark, sf_dir, "orders").select(key.alias("document_id"), F.concat(F.lit("n"), key.cast("string")).alias("native_id"), F.concat(key.cast("string"), F.lit("/"), (key % 5).cast("string")).alias("part_path"))
    own = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("document_id"), F.concat(F.col("l_orderkey").cast("string"), F.lit("/"), F.col("l_linenumber").cast("string")).alias("path"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("part_id"))
    single = own.groupBy("document_id").agg(F.min("part_id").alias("part_id"), F.count("*").alias("n")).filter("n = 1").select("document_id", "part_id")
    return mapping.origins(native, own, single)


@query("SELECT 'p' || p_partkey AS entity_id FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R') UNION ALL SELECT 'p-' || s_suppkey FROM supplier")
def unmapped_entities(spark, sf_dir):
    """Entities without an edge."""
    entities = table(spark, sf_dir, "part").select(F.concat(F.lit("p"), F.col("p_partkey").cast("string")).alias("entity_id"))
    more = table(spark, sf_dir, "supplier").select(F.concat(F.lit("p-"), F.col("s_suppkey").cast("string")).alias("entity_id"))
    return mapping.unmapped(entities.unionByName(more), _pairs(spark, sf_dir).filter("exactness = 'inferred'"), "source_id")


@query("""
WITH g AS (SELECT l_orderkey * 8 + l_linenumber AS mapping_id, 'container' AS source_layer, 'p' || l_partkey AS source_id, CASE WHEN l_linenumber = 5 THEN 'binary' ELSE 'native' END AS target_layer, CASE WHEN l_linenumber = 5 THEN 's' || l_suppkey ELSE 'l' || (l_partkey + CASE WHEN l_suppkey % 25 = 0 THEN 1000000 ELSE 0 END) END AS target_id, 'exact' AS exactness, CASE WHEN l_suppkey % 30 = 0 THEN 0.9 ELSE 1.0 END AS confidence FROM lineitem),
k AS (SELECT 'p' || p_partkey AS id FROM part UNION SELECT 's' || s_suppkey FROM supplier UNION SELECT 'l' || l_partkey FROM lineitem)
SELECT mapping_id, 'unknown_source' AS rule FROM g WHERE source_id NOT IN (SELECT id FROM k) UNION ALL SELECT mapping_id, 'unknown_target' FROM g WHERE target_id NOT IN (SELECT id FROM k)
UNION ALL SELECT mapping_id, 'backward' FROM g WHERE target_layer = 'binary' UNION ALL SELECT mapping_id, 'confidence' FROM g WHERE confidence < 1 UNION ALL SELECT mapping_id, 'repeated_id' FROM g GROUP BY 1 HAVING count(*) > 1""")
def mapping_invariants(spark, sf_dir):
    """Rules on edges."""
    line, supplier, item = F.col("l_linenumber"), F.col("l_suppkey"), F.col("l_partkey")
    far = item + F.when(supplier % 25 == 0, 1_000_000).otherwise(0)
    target = F.when(line == 5, F.concat(F.lit("s"), supplier.cast("string"))).otherwise(F.concat(F.lit("l"), far.cast("string")))
    pairs = table(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") * 8 + line).alias("mapping_id"), F.lit("container").alias("source_layer"), F.concat(F.lit("p"), item.cast("string")).alias("source_id"), F.when(line == 5, "binary").otherwise("native").alias("target_layer"), target.alias("target_id"),
        F.lit("exact").alias("exactness"), F.when(supplier % 30 == 0, 0.9).otherwise(1.0).alias("confidence"),
    )
    return mapping.broken_edges(pairs, _entities(spark, sf_dir))


# --- quality ------------------------------------------------------------------------------------------------------------------

_MEASURED = """
x AS (SELECT source, CASE WHEN quality = 1 THEN 'native_core_unit' WHEN lang = 'en' THEN 'native_style' ELSE 'rendered_surface' END AS feature, CASE WHEN quality = 1 THEN 'structural' WHEN lang = 'en' THEN 'style' ELSE 'visual' END AS axis, CASE WHEN quality = 1 THEN 'error' ELSE 'warning' END AS severity,
  d.doc_id % 7 <> 0 AS required, true AS preserved, toxic = 1 AS opaque, d.doc_id % 11 = 0 AS unsupported, CASE d.doc_id % 5 WHEN 0 THEN NULL WHEN 1 THEN 'approximate' ELSE 'exact' END AS projected, CASE WHEN d.doc_id % 3 = 0 THEN 'inferred' END AS rendered FROM documents d JOIN labels l ON l.doc_id = d.doc_id),
y AS (SELECT *, coalesce(projected IN ('approximate', 'inferred'), false) OR (axis = 'visual' AND coalesce(rendered IN ('approximate', 'inferred'), false)) AS weak FROM x),
z AS (SELECT source, feature, axis, severity, count(*) AS encountered, count(*) FILTER (required) AS required, count(*) FILTER (preserved) AS preserved, count(projected) AS projected, count(rendered) AS rendered, count(*) FILTER (opaque) AS opaque, count(*) FILTER (weak) AS approximated, count(*) FILTER (unsupported) AS unsupported,
  count(*) FILTER (required AND projected IS NULL) AS omitted, count(*) FILTER (required AND projected IS NOT NULL AND NOT weak) AS exact_hits, count(*) FILTER (required AND projected IS NOT NULL AND weak) AS approximate_hits FROM y GROUP BY 1, 2, 3, 4),
s AS (SELECT source, axis, CASE WHEN sum(required) > 0 THEN round_even((sum(exact_hits) + 0.5::DOUBLE * sum(approximate_hits)) / sum(required), 6) END AS score FROM z GROUP BY 1, 2)"""
_KEYS = ["source", "feature", "axis", "severity"]


def _measured(spark, sf_dir) -> DataFrame:
    rows = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id")
    good, english, key = F.col("quality") == 1, F.col("lang") == "en", F.col("doc_id")
    facts = rows.select(
        "source", F.when(good, "native_core_unit").when(english, "native_style").otherwise("rendered_surface").alias("feature"), F.when(good, "structural").when(english, "style").otherwise("visual").alias("axis"), F.when(good, "error").otherwise("warning").alias("severity"),
        (key % 7 != 0).alias("required"), F.lit(True).alias("preserved"), (F.col("toxic") == 1).alias("opaque"), (key % 11 == 0).alias("unsupported"), F.when(key % 5 == 0, None).when(key % 5 == 1, "approximate").otherwise("exact").alias("projected"), F.when(key % 3 == 0, "inferred").alias("rendered"),
    )
    return quality.measurements(facts, _KEYS, F.col("axis") == "visual")


@query(f"WITH {_MEASURED} SELECT * FROM z")
def coverage_measurements(spark, sf_dir):
    """Counters per feature."""
    return _measured(spark, sf_dir)


@query(f"WITH {_MEASURED} SELECT * FROM s")
def axis_scores(spark, sf_dir):
    """Scores per axis, null without a required perimeter."""
    return quality.axis_scores(_measured(spark, sf_dir), ["source"])


@query(f"""WITH {_MEASURED} SELECT source, round_even(max(CASE WHEN axis = 'visual' THEN score END) * coalesce(max(CASE WHEN axis = 'structural' THEN score END), 1.0) * coalesce(max(CASE WHEN axis = 'style' THEN score END), 1.0), 6) AS visual FROM s GROUP BY 1""")
def visual_score(spark, sf_dir):
    """Product of the factors that exist."""
    scores = quality.axis_scores(_measured(spark, sf_dir), ["source"])
    of = lambda axis: F.max(F.when(F.col("axis") == axis, F.col("score")))
    return scores.groupBy("source").agg(quality.visual_score(of("visual"), of("structural"), of("style")).alias("visual"))


_LOSS_ID = sql_stable_id("loss", """('{"feature":"' || feature || '","kind":"' || kind || '","source":"' || source || '"}')""")
_LOSSES = f"""
o AS (SELECT source, feature, severity, 'omitted' AS kind, omitted AS n_refs FROM z WHERE omitted > 0 UNION ALL SELECT source, feature, severity, 'approximated', approximated FROM z WHERE approximated > 0 UNION ALL SELECT source, feature, severity, 'unsupported', unsupported FROM z WHERE unsupported > 0),
losses AS (SELECT {_LOSS_ID} AS loss_id, source, feature, severity, kind, n_refs FROM o)"""


@query(f"WITH {_MEASURED}, {_LOSSES} SELECT * FROM losses")
def loss_records(spark, sf_dir):
    """Losses of measurements, with ids."""
    return quality.losses(_measured(spark, sf_dir), ["source"])


@query(f"""WITH {_MEASURED}, {_LOSSES}, c AS (SELECT source, count(*) FILTER (severity = 'error') AS major, count(*) FILTER (severity = 'warning') AS minor FROM losses GROUP BY 1),
r AS (SELECT source, round_even(CASE WHEN source = 'src1' THEN 0.25 WHEN source = 'src2' THEN 1 - least(0.9, 0.2 * major + 0.05 * minor) ELSE least(0.95, 1 - least(0.9, 0.2 * major + 0.05 * minor)) END, 6)::DOUBLE AS score FROM c)
SELECT source, score, CASE WHEN score >= 1 THEN 'none' WHEN score >= 0.85 THEN 'low' WHEN score >= 0.6 THEN 'medium' ELSE 'high' END AS risk FROM r""")
def roundtrip_risk(spark, sf_dir):
    """Score and risk of writing back."""
    counts = quality.losses(_measured(spark, sf_dir), ["source"]).groupBy("source").agg(F.count_if(F.col("severity") == "error").alias("major"), F.count_if(F.col("severity") == "warning").alias("minor"))
    score, risk = quality.roundtrip(F.col("major"), F.col("minor"), F.col("source") == "src1", F.col("source") == "src2")
    return counts.select("source", score.alias("score"), risk.alias("risk"))


@query("""SELECT l_linestatus AS document_id, l_shipmode AS from_layer, 'native' AS to_layer, count(*) AS n_edges, min(confidence) AS confidence, CASE max(w) WHEN 0 THEN 'exact' WHEN 1 THEN 'approximate' ELSE 'inferred' END AS exactness, CASE WHEN max(w) = 0 THEN 'preserved' ELSE 'preserved_with_loss' END AS state
FROM (SELECT l_linestatus, 'container' || (l_suppkey % 6) AS l_shipmode, CASE l_returnflag WHEN 'A' THEN 1.0 WHEN 'N' THEN 0.7 ELSE 0.5 END::DOUBLE AS confidence, CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END AS w FROM lineitem WHERE l_suppkey % 6 <> 0 OR l_returnflag = 'A') GROUP BY 1, 2""")
def transition_summary(spark, sf_dir):
    """What the edges between two layers preserve."""
    flag = F.col("l_returnflag")
    edges = table(spark, sf_dir, "lineitem").filter((F.col("l_suppkey") % 6 != 0) | (flag == "A")).select(F.col("l_linestatus").alias("document_id"), F.concat(F.lit("container"), (F.col("l_suppkey") % 6).cast("string")).alias("from_layer"), F.lit("native").alias("to_layer"), F.when(flag == "A", 1.0).when(flag == "N", 0.7).otherwise(0.5).alias("confidence"), F.when(flag == "A", "exact").when(flag == "N", "approximate").otherwise("inferred").alias("exactness"))
    return quality.transitions(edges, ["document_id"])


@query(f"WITH {_MEASURED}, {_LOSSES} SELECT source, CASE WHEN bool_or(severity = 'error') THEN 'review' ELSE 'ok' END AS status FROM losses GROUP BY 1")
def document_status(spark, sf_dir):
    """Status by severities and strictness."""
    return quality.document_status(quality.losses(_measured(spark, sf_dir), ["source"]), ["source"])


_STATES = "(SELECT l.doc_id, source, CASE WHEN toxic = 1 AND quality = 0 THEN 'rejected' WHEN toxic = 1 THEN 'error' WHEN quality = 0 THEN 'review' ELSE 'ok' END AS status FROM labels l JOIN documents d ON d.doc_id = l.doc_id)"


def _states(spark, sf_dir) -> DataFrame:
    toxic, poor = F.col("toxic") == 1, F.col("quality") == 0
    return table(spark, sf_dir, "labels").join(table(spark, sf_dir, "documents").select("doc_id", "source", "lang"), "doc_id").withColumn("status", F.when(toxic & poor, "rejected").when(toxic, "error").when(poor, "review").otherwise("ok"))


@query("SELECT lang, CASE max(CASE WHEN toxic = 1 AND quality = 0 THEN 2 WHEN toxic = 1 THEN 3 WHEN quality = 0 THEN 1 ELSE 0 END) WHEN 3 THEN 'error' WHEN 2 THEN 'rejected' WHEN 1 THEN 'review' ELSE 'ok' END AS status FROM labels l JOIN documents d ON d.doc_id = l.doc_id GROUP BY 1")
def status_rollup(spark, sf_dir):
    """The gravest status."""
    return _states(spark, sf_dir).groupBy("lang").agg(gravest(F.col("status"), STATUS).alias("status"))


@query(f"""SELECT source, count(*) AS n_documents, count(*) FILTER (status = 'ok') AS n_ok, count(*) FILTER (status = 'review') AS n_review, count(*) FILTER (status = 'rejected') AS n_rejected, count(*) FILTER (status = 'error') AS n_error,
CASE max(CASE status WHEN 'error' THEN 3 WHEN 'rejected' THEN 2 WHEN 'review' THEN 1 ELSE 0 END) WHEN 3 THEN 'error' WHEN 2 THEN 'rejected' WHEN 1 THEN 'review' ELSE 'ok' END AS status, bool_and(status IN ('ok', 'review')) AS eligible FROM {_STATES} GROUP BY 1""")
def package_summary(spark, sf_dir):
    """A package's counts, status and eligibility."""
    return quality.package_summary(_states(spark, sf_dir), "source")


@query(f"WITH {_MEASURED} SELECT source, feature FROM (SELECT source, feature, encountered, approximated, CASE WHEN feature = 'native_style' THEN required + 3 * opaque ELSE required END AS required, CASE WHEN feature = 'rendered_surface' THEN omitted * 4 ELSE omitted END AS omitted FROM z) WHERE required > encountered OR omitted > required OR approximated > encountered")
def quality_invariants(spark, sf_dir):
    """V4: counters that contradict each other."""
    rows = _measured(spark, sf_dir)
    rows = rows.withColumn("required", F.when(F.col("feature") == "native_style", F.col("required") + 3 * F.col("opaque")).otherwise(F.col("required"))).withColumn("omitted", F.when(F.col("feature") == "rendered_surface", F.col("omitted") * 4).otherwise(F.col("omitted")))
    return quality.broken_counters(rows, ["source", "feature"])


# --- rendering ------------------------------------------------------------------------------------------------------------------

_PAGES = f"""{_LINES}, c AS (SELECT doc_id, ordinal, text, greatest(CAST(ceil(length(text) / {render.line_characters()}.0) AS BIGINT), 1) AS n FROM lines),
f AS (SELECT *, CAST(coalesce(sum(n) OVER (PARTITION BY doc_id ORDER BY ordinal ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS first FROM c),
g AS (SELECT doc_id, ordinal, unnest(range(n)) AS pos, first, text FROM f),
segments AS (SELECT doc_id, ordinal, (first + pos) // {render.page_lines()} AS page, (first + pos) % {render.page_lines()} AS slot, CASE WHEN text = '' THEN '{render.EMPTY_LINE}' ELSE substr(text, CAST(pos * {render.line_characters()} + 1 AS BIGINT), {render.line_characters()}) END AS segment FROM g)"""


def _segments(spark, sf_dir) -> DataFrame:
    lines = _text_lines(spark, sf_dir).select(F.col("doc_id").alias("document_id"), "ordinal", F.col("ordinal").alias("unit_id"), "text")
    return render.paginate(lines)


@query(f"WITH {_PAGES} SELECT doc_id AS document_id, ordinal AS unit_id, page, slot, segment FROM segments")
def text_pagination(spark, sf_dir):
    """Visual lines on pages (lines cut at the page's width)."""
    return _segments(spark, sf_dir)


@query(f"WITH {_PAGES} SELECT doc_id AS document_id, page, count(*) AS n_segments, round_even(sum(least(698.0::DOUBLE, greatest(9.52::DOUBLE, length(segment) * 9.52::DOUBLE))), 3) AS total_width, max(62 + slot * 20 + 6)::DOUBLE AS lowest FROM segments GROUP BY 1, 2")
def text_boxes(spark, sf_dir):
    """Boxes of visual lines."""
    boxed = render.boxes(_segments(spark, sf_dir))
    return boxed.groupBy("document_id", "page").agg(F.count("*").alias("n_segments"), F.bround(F.sum("width"), 3).alias("total_width"), F.max("y").alias("lowest"))


@query(f"WITH {_PAGES} SELECT doc_id AS document_id, max(page) + 1 AS n_pages, count(*) AS n_segments, count(DISTINCT ordinal) AS n_visible_units FROM segments GROUP BY 1")
def visibility_summary(spark, sf_dir):
    """What is visible of each document."""
    return render.visibility(_segments(spark, sf_dir))


@query("SELECT p_brand, p_partkey, p_size FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_size DESC, p_name, p_partkey) AS k FROM part) WHERE k = 1")
def renderer_top1(spark, sf_dir):
    """The candidate of highest priority, ties by name."""
    return render.best(table(spark, sf_dir, "part").select("p_brand", "p_name", "p_partkey", "p_size"), ["p_brand"], "p_size", "p_name").select("p_brand", "p_partkey", "p_size")


@query(r"""SELECT conv_id, turn, replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;') AS escaped FROM conversations""")
def xml_escape(spark, sf_dir):
    """Text for an XML document."""
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", scalar.xml_escaped(F.col("text")).alias("escaped"))


# --- validation --------------------------------------------------------------------------------------------------------------------


@query("""WITH w AS (SELECT user_id AS key, event_type AS profile, max(CASE WHEN event_id % 2 = 0 THEN 1 ELSE 0 END) AS want, sum(CASE WHEN event_id % 2 = 1 THEN 1 ELSE 0 END) AS have FROM events GROUP BY 1, 2)
SELECT key AS user_id, profile, CASE WHEN have = 0 THEN 'missing' WHEN want = 0 THEN 'unexpected' ELSE 'duplicate' END AS difference FROM w WHERE have = 0 OR want = 0 OR have > 1""")
def profile_set_diff(spark, sf_dir):
    """Requested against observed profiles."""
    rows = table(spark, sf_dir, "events").select("user_id", F.col("event_type").alias("profile"), "event_id")
    return validate.profile_differences(rows.filter("event_id % 2 = 0").select("user_id", "profile").distinct(), rows.filter("event_id % 2 = 1"), "user_id")


@query("""SELECT path, CASE WHEN old IS NULL THEN 'added' WHEN new IS NULL THEN 'removed' ELSE 'modified' END AS change FROM (SELECT CAST(o_orderkey AS VARCHAR) AS path, CASE WHEN o_orderkey % 3 <> 0 THEN sha256(CAST(o_custkey AS VARCHAR)) END AS old, CASE WHEN o_orderkey % 5 <> 0 THEN sha256(CAST(o_custkey + CASE WHEN o_orderkey % 7 = 0 THEN 1 ELSE 0 END AS VARCHAR)) END AS new FROM orders)
WHERE (old IS NULL) <> (new IS NULL) OR old <> new""")
def snapshot_diff(spark, sf_dir):
    """Two snapshots of hashes."""
    key = F.col("o_orderkey")
    row = lambda c: (key.cast("string").alias("path"), F.sha2(F.encode(c.cast("string"), "UTF-8"), 256).alias("hash"))
    orders = table(spark, sf_dir, "orders")
    return validate.snapshot_differences(orders.filter("o_orderkey % 3 <> 0").select(*row(F.col("o_custkey"))), orders.filter("o_orderkey % 5 <> 0").select(*row(F.col("o_custkey") + F.when(key % 7 == 0, 1).otherwise(0))))


@query("""SELECT reference_id, CASE WHEN l_linenumber = 7 THEN 'not_portable' WHEN o_orderkey IS NULL THEN 'missing' ELSE 'hash_mismatch' END AS failure
FROM (SELECT l_orderkey * 8 + l_linenumber AS reference_id, l_linenumber, l_orderkey, l_suppkey FROM lineitem) l LEFT JOIN (SELECT o_orderkey FROM orders WHERE o_orderkey % 9 <> 0) ON o_orderkey = l_orderkey WHERE l_linenumber = 7 OR o_orderkey IS NULL OR l_suppkey % 20 = 0""")
def reference_integrity(spark, sf_dir):
    """References that don't resolve to what they name."""
    key, line = F.col("l_orderkey"), F.col("l_linenumber")
    path = F.concat(F.when(line == 7, "/").otherwise(""), F.lit("o/"), key.cast("string"))
    references = table(spark, sf_dir, "lineitem").select((key * 8 + line).alias("reference_id"), path.alias("path"), F.when(F.col("l_suppkey") % 20 == 0, "other").otherwise("hash").alias("hash"))
    targets = table(spark, sf_dir, "orders").filter("o_orderkey % 9 <> 0").select(F.concat(F.lit("o/"), F.col("o_orderkey").cast("string")).alias("path"), F.lit("hash").alias("hash"))
    return validate.reference_failures(references, targets)


@query("""SELECT CAST(c_custkey AS VARCHAR) AS path, 'undeclared' AS side FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders) UNION ALL SELECT DISTINCT CAST(o_custkey AS VARCHAR), 'absent' FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 10 <> 0) AND o_custkey % 10 = 0
UNION ALL SELECT CAST(c_custkey AS VARCHAR), 'undeclared' FROM customer WHERE false""".replace("FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)", "FROM customer WHERE c_custkey % 10 <> 0 AND c_custkey NOT IN (SELECT o_custkey FROM orders)"))
def undeclared_files(spark, sf_dir):
    """Files that only the disk or only the manifest has."""
    present = table(spark, sf_dir, "customer").filter("c_custkey % 10 <> 0").select(F.col("c_custkey").cast("string").alias("path"))
    declared = table(spark, sf_dir, "orders").select(F.col("o_custkey").cast("string").alias("path")).distinct()
    return validate.undeclared(present, declared)


@query("""SELECT o_orderkey, rule, level FROM (SELECT o_orderkey, unnest([CASE WHEN o_totalprice < 1000 THEN 'price' END, CASE WHEN o_orderstatus NOT IN ('O', 'F') THEN 'status' END, CASE WHEN o_orderpriority LIKE '1%' THEN 'urgent' END]) AS rule, unnest(['error', 'warning', 'info']) AS level FROM orders) WHERE rule IS NOT NULL""")
def draft_checks(spark, sf_dir):
    """A table of rules evaluated in one pass over the rows (the rules of runs and packages are in ``rules``)."""
    rules = [("price", F.col("o_totalprice") < 1000, "error"), ("status", ~F.col("o_orderstatus").isin("O", "F"), "warning"), ("urgent", F.col("o_orderpriority").startswith("1"), "info")]
    return validate.checks(table(spark, sf_dir, "orders"), "o_orderkey", rules)


@query("""SELECT user_id AS run_id, marker, lacking FROM (SELECT user_id, list(DISTINCT event_type) AS n FROM events WHERE event_id % 4 = 0 GROUP BY 1), (SELECT unnest(['purchase', 'click']) AS marker, unnest(['view', 'signup']) AS lacking) WHERE list_contains(n, marker) AND NOT list_contains(n, lacking)""")
def marker_implications(spark, sf_dir):
    """Markers whose stage did not complete."""
    nodes = table(spark, sf_dir, "events").filter("event_id % 4 = 0").select(F.col("user_id").alias("run_id"), F.col("event_type").alias("name"))
    return validate.implied(nodes, [("purchase", "view"), ("click", "signup")])


@query("""WITH n AS (SELECT p_partkey, p_name, p_type, replace(initcap_words, ' ', '') AS native FROM (SELECT p_partkey, p_name, p_type, 'docProps' || p_partkey || ' ' || upper(substr(p_type, 1, 3)) || 'Size' AS initcap_words FROM part))
SELECT p_partkey, native, regexp_replace(regexp_replace(lower(regexp_replace(regexp_replace(native, '([A-Z]+)([A-Z][a-z])', '\\1_\\2', 'g'), '([a-z0-9])([A-Z])', '\\1_\\2', 'g')), '[^a-z0-9_.:-]+', '_', 'g'), '_+', '_', 'g') AS canonical FROM n""".replace("\\\\", "\\"))
def property_names(spark, sf_dir):
    """Canonical property names."""
    native = F.concat(F.lit("docProps"), F.col("p_partkey").cast("string"), F.upper(F.substring("p_type", 1, 3)), F.lit("Size"))
    rows = table(spark, sf_dir, "part").select("p_partkey", F.replace(native, F.lit(" "), F.lit("")).alias("native"))
    return rows.select("p_partkey", "native", scalar.property_name(F.col("native")).alias("canonical"))


@query("""SELECT s_suppkey, CASE WHEN lower(name) IN ('creator', 'lastmodifiedby', 'company', 'manager') THEN 'personal' ELSE 'public' END AS sensitivity, CASE WHEN ((s_suppkey * 45) % 360) % 90 = 0 THEN (s_suppkey * 45) % 360 ELSE 0 END AS rotation, regexp_replace(s_name, '[^A-Za-z0-9._-]+', '_', 'g') AS safe_name
FROM (SELECT s_suppkey, s_name, ['Creator', 'title', 'lastModifiedBy', 'pages'][CAST(s_suppkey % 4 + 1 AS INT)] AS name FROM supplier)""")
def small_functions(spark, sf_dir):
    """sensitivity, rotation, safe file names."""
    key = F.col("s_suppkey")
    name = F.element_at(F.array(*[F.lit(x) for x in ("Creator", "title", "lastModifiedBy", "pages")]), (key % 4 + 1).cast("int"))
    return table(spark, sf_dir, "supplier").select("s_suppkey", scalar.sensitivity(name).alias("sensitivity"), scalar.rotation(key * 45).alias("rotation"), scalar.safe_file_name(F.col("s_name")).alias("safe_name"))


@query("SELECT lang, source, count(*) AS n_documents, CAST(sum(n_lines) AS BIGINT) AS n_units, CASE WHEN sum(n_lines) > 0 THEN 1.0 END::DOUBLE AS coverage FROM (SELECT lang, source, CASE WHEN coalesce(text, '') = '' THEN 0 ELSE len(string_split(text, chr(10))) - CASE WHEN text LIKE '%' || chr(10) THEN 1 ELSE 0 END END AS n_lines FROM documents) GROUP BY 1, 2")
def unit_coverage(spark, sf_dir):
    """Flagship: units and structural coverage of text documents by language and source."""
    docs = table(spark, sf_dir, "documents").select("lang", "source", F.coalesce("text", F.lit("")).alias("text"))
    n = F.regexp_count("text", F.lit("\n")) + F.when((F.col("text") != "") & ~F.col("text").endswith("\n"), 1).otherwise(0)
    counted = docs.select("lang", "source", n.cast("long").alias("n"))
    total = counted.groupBy("lang", "source").agg(F.count("*").alias("n_documents"), F.sum("n").alias("n_units"))
    return total.withColumn("coverage", scalar.weighted_ratio(F.col("n_units"), F.lit(0), F.col("n_units")))
