"""The validation rules as queries: tables are read as runs, their files, references, nodes and documents.

Each frame is a table's rows under expressions that Spark and the SQL of the oracle read alike.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import identity, scalar
from ..operators import ir, mapping, package, quality, sheets, validate

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str):
    def register(function):
        QUERIES[function.__name__], SQL[function.__name__] = function, sql
        return function

    return register


class Frame:
    """Rows of a table under a filter, as (expression AS name) in both engines."""

    def __init__(self, table: str, where: str = "true", **columns: str):
        self.table, self.where, self.columns = table, where, columns

    def rows(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return spark.read.parquet(f"{sf_dir}/{self.table}.parquet").where(self.where).selectExpr(*[f"{e} AS {n}" for n, e in self.columns.items()])

    @property
    def sql(self) -> str:
        return f"(SELECT {', '.join(f'{e} AS {n}' for n, e in self.columns.items())} FROM {self.table} WHERE {self.where})"


def _checks(rule: str, subject: str, source: str, code: str = package.INTEGRITY, level: str = "critical", blocking: str = "true", kind: str = "integrity", document: str = "CAST(NULL AS VARCHAR)") -> str:
    name = rule if rule.startswith("(") else f"'{rule}'"
    return f"SELECT CAST(run_id AS VARCHAR) AS run_id, CAST({document} AS VARCHAR) AS document_id, {name} AS rule, '{kind}' AS kind, '{code}' AS code, '{level}' AS level, {blocking} AS blocking, CAST({subject} AS VARCHAR) AS subject FROM {source}"


def _all(*parts: str) -> str:
    return " UNION ALL ".join(parts)


_RUN, _PATH = "o_orderkey % 5", "CASE WHEN o_orderkey % 50 = 0 THEN '/abs/' ELSE 'f/' END || CAST(o_orderkey AS STRING)"
_DECLARED = Frame("orders", "o_orderkey % 3 <> 0", run_id=_RUN, path=_PATH, sha256="o_orderpriority", schema_id="o_orderstatus")
_TWICE = Frame("orders", "o_orderkey % 23 = 0 AND o_orderkey % 3 <> 0", run_id=_RUN, path=_PATH, sha256="o_orderpriority", schema_id="o_orderstatus")
_FILES = Frame("orders", "o_orderkey % 9 <> 0 AND o_orderkey % 8 <> 0", run_id=_RUN, path=_PATH, sha256="CASE WHEN o_orderkey % 11 = 0 THEN 'x' ELSE o_orderpriority END", schema_id="CASE WHEN o_orderkey % 13 = 0 THEN 'z' ELSE o_orderstatus END", contract_id="CAST(o_custkey AS STRING)", valid="o_orderkey % 17 <> 0", size_bytes="o_custkey")


@query(f"""WITH d AS ({_DECLARED.sql} UNION ALL {_TWICE.sql}), k AS (SELECT d.run_id, d.path, CASE WHEN d.path LIKE '/%' THEN 'declared_not_portable' WHEN f.sha256 IS NULL THEN 'declared_absent' WHEN f.sha256 <> d.sha256 THEN 'declared_hash' WHEN f.schema_id <> d.schema_id THEN 'declared_schema' WHEN NOT f.valid THEN 'declared_invalid' END AS r
FROM d LEFT JOIN {_FILES.sql} f ON f.run_id = d.run_id AND f.path = d.path) {_all(_checks("(r)", "path", "k WHERE r IS NOT NULL"), _checks("declared_twice", "path", "(SELECT run_id, path FROM d GROUP BY 1, 2 HAVING count(*) > 1)"))}""")
def declared_artifacts(spark, sf_dir):
    """V7: declared files are portable, present, unchanged, of their schema and valid, and declared once."""
    return package.declared_failures(_DECLARED.rows(spark, sf_dir).unionByName(_TWICE.rows(spark, sf_dir)), _FILES.rows(spark, sf_dir))


_REFERENCES = Frame("lineitem", "true", run_id="l_orderkey % 5", owner="'p/' || CAST(l_partkey AS STRING)", path="'f/' || CAST(l_orderkey AS STRING)", sha256="'1-URGENT'", contract_id="CAST(l_suppkey AS STRING)")


@query(f"""WITH r AS (SELECT q.*, f.sha256 AS actual, f.contract_id AS other FROM {_REFERENCES.sql} q LEFT JOIN {_FILES.sql} f ON f.run_id = q.run_id AND f.path = q.path), d AS {_DECLARED.sql}
{_all(_checks("reference_unresolved", "owner || ' > ' || path", "r WHERE actual IS NULL"), _checks("reference_hash", "owner || ' > ' || path", "r WHERE actual <> sha256"), _checks("reference_header", "owner || ' > ' || path", "r WHERE actual IS NOT NULL AND other <> contract_id"), _checks("reference_undeclared", "owner || ' > ' || path", "r WHERE NOT EXISTS (SELECT 1 FROM d WHERE d.run_id = r.run_id AND d.path = r.path)"))}""")
def nested_references(spark, sf_dir):
    """References in contracts resolve with equal hash and header, and to what is declared."""
    return package.nested_reference_failures(_REFERENCES.rows(spark, sf_dir), _FILES.rows(spark, sf_dir), _DECLARED.rows(spark, sf_dir))


_LINKS = Frame("part", "p_size % 2 = 0 OR p_partkey % 10 >= 5", run_id="CAST(p_partkey AS BIGINT) - p_partkey % 10", owner="p_partkey", path="CASE WHEN p_partkey % 10 = 9 THEN p_partkey - p_partkey % 5 ELSE p_partkey + 1 END")


@query(f"""WITH RECURSIVE e AS {_LINKS.sql}, w AS (SELECT run_id, owner AS first, path AS here, 1 AS n FROM e UNION ALL SELECT w.run_id, w.first, e.path, n + 1 FROM w JOIN e ON e.owner = w.here AND e.run_id = w.run_id WHERE n < 10 AND w.here <> w.first)
{_checks("reference_cycle", "first", "(SELECT DISTINCT run_id, first FROM w WHERE here = first)")}""")
def contract_cycles(spark, sf_dir):
    """V6, V7: references that lead back to where they begin."""
    return package.cycle_failures(_LINKS.rows(spark, sf_dir))


_AFTER = Frame("orders", "o_orderkey % 7 <> 0", run_id=_RUN, path=_PATH, sha256="CASE WHEN o_orderkey % 10 = 1 THEN 'y' ELSE o_orderpriority END")
_BEFORE = Frame("orders", "o_orderkey % 4 <> 0", run_id=_RUN, path=_PATH, sha256="o_orderpriority")


@query(f"""{_checks("input_mutated", "path", f"(SELECT coalesce(b.run_id, a.run_id) AS run_id, coalesce(b.path, a.path) AS path FROM {_BEFORE.sql} b FULL JOIN {_AFTER.sql} a ON a.run_id = b.run_id AND a.path = b.path WHERE a.sha256 IS DISTINCT FROM b.sha256)")}""")
def inputs_unmutated(spark, sf_dir):
    """What is read must not change while it is validated."""
    return package.changed_failures(_BEFORE.rows(spark, sf_dir), _AFTER.rows(spark, sf_dir), "input_mutated")


_NODES = Frame("events", "event_id % 3 = 0", run_id="user_id", stage="event_type", state="CASE event_id % 7 WHEN 0 THEN 'failed' WHEN 1 THEN 'partial' WHEN 2 THEN 'odd' ELSE 'completed' END")
_RUNS = Frame("customer", "c_custkey <= 200", run_id="CAST(c_custkey AS BIGINT)")
_STAGES = ["click", "purchase", "signup", "view"]


@query(f"""WITH n AS {_NODES.sql}, w AS (SELECT run_id, unnest({_STAGES}) AS stage FROM {_RUNS.sql})
{_all(_checks("stage_not_completed", "stage", "w WHERE NOT EXISTS (SELECT 1 FROM n WHERE n.run_id = w.run_id AND n.stage = w.stage AND state IN ('completed', 'partial'))"), _checks("node_state", "stage", "n WHERE state IN ('failed', 'odd')", level="error"),
_checks("stage_twice", "stage", "(SELECT run_id, stage FROM n GROUP BY 1, 2 HAVING count(*) > 1)"), _checks("node_partial", "stage", "n WHERE state = 'partial'", package.PARTIAL, "warning", "false", "quality"))}""")
def run_stages(spark, sf_dir):
    """V7, V8: every stage has one complete node; odd, failed and partial ones are named."""
    return package.stage_failures(_NODES.rows(spark, sf_dir), _RUNS.rows(spark, sf_dir), _STAGES)


_MARKERS = Frame("events", "event_id % 4 = 0", run_id="user_id", marker="CASE WHEN event_id % 40 = 0 THEN 'COMMITTED' WHEN event_id % 44 = 0 THEN 'ODD' ELSE event_type END")
_IMPLIED = [("purchase", "view"), ("click", "signup"), ("view", "view"), ("signup", "signup")]


@query(f"""WITH n AS {_NODES.sql}, m AS {_MARKERS.sql}, i AS (SELECT unnest({[a for a, _ in _IMPLIED]}) AS a, unnest({[b for _, b in _IMPLIED]}) AS stage), k AS (SELECT run_id, marker, stage FROM m JOIN i ON a = marker)
{_all(_checks("marker_without_stage", "marker || ' > ' || stage", "k WHERE NOT EXISTS (SELECT 1 FROM n WHERE n.run_id = k.run_id AND n.stage = k.stage AND state IN ('completed', 'partial'))"), _checks("marker_unknown", "marker", "m WHERE marker = 'ODD' OR marker NOT IN (SELECT a FROM i) AND marker <> 'COMMITTED'", level="error"), _checks("premature_commit", "marker", "m WHERE marker = 'COMMITTED'"))}""")
def run_markers(spark, sf_dir):
    """Markers imply complete stages, are known, and don't claim a commit that nobody made."""
    return package.marker_failures(_MARKERS.rows(spark, sf_dir), _NODES.rows(spark, sf_dir), _IMPLIED)


_ASKED = Frame("customer", "true", run_id="c_custkey", policy_hash="c_mktsegment")
_USED = Frame("customer", "c_custkey % 7 <> 0", run_id="c_custkey", policy_hash="CASE WHEN c_custkey % 11 = 0 THEN 'OTHER' ELSE c_mktsegment END")


@query(f"""{_checks("policy_changed", "policy_hash", f"(SELECT a.* FROM {_ASKED.sql} a LEFT JOIN {_USED.sql} u ON u.run_id = a.run_id WHERE u.policy_hash IS DISTINCT FROM a.policy_hash)", kind="policy")}""")
def applied_policy(spark, sf_dir):
    """V7: the policy applied is the policy asked for."""
    return package.policy_failures(_ASKED.rows(spark, sf_dir), _USED.rows(spark, sf_dir))


@query(f"""{_checks("undeclared_contract", "path", f"{_FILES.sql} f WHERE NOT EXISTS (SELECT 1 FROM {_DECLARED.sql} d WHERE d.run_id = f.run_id AND d.path = f.path)", level="error")}""")
def undeclared_contracts(spark, sf_dir):
    """Files of a run that it doesn't declare."""
    return package.undeclared_failures(_FILES.rows(spark, sf_dir), _DECLARED.rows(spark, sf_dir))


_DECISIONS = Frame("orders", "true", run_id=_RUN, document_id="CAST(o_orderkey AS STRING)", decision="CASE WHEN o_orderkey % 12 = 0 THEN 'block' WHEN o_orderkey % 12 < 4 THEN 'review' WHEN o_orderkey % 12 < 6 THEN 'allow_restricted' ELSE 'allow' END")
_SECURITY = _all(_checks("security_block", "document_id", f"{_DECISIONS.sql} WHERE decision = 'block'", package.POLICY, "critical", "true", "security", "document_id"), _checks("security_review", "document_id", f"{_DECISIONS.sql} WHERE decision IN ('review', 'allow_restricted')", package.PARTIAL, "warning", "false", "security", "document_id"))


@query(_SECURITY)
def security_checks(spark, sf_dir):
    """V7: blocked documents fail, restricted ones warn."""
    return package.security_failures(_DECISIONS.rows(spark, sf_dir))


_PEOPLE = Frame("customer", "true", run_id="c_custkey % 5", document_id="CAST(c_custkey AS STRING)")
_PRESENT = Frame("orders", "true", run_id="o_custkey % 5", document_id="CAST(o_custkey AS STRING)", kind="CASE o_orderkey % 4 WHEN 0 THEN 'native' WHEN 1 THEN 'technical_ir' WHEN 2 THEN 'mapping' ELSE 'coverage' END", own_id="CASE WHEN o_orderkey % 40 < 2 THEN 'x' ELSE CAST(o_custkey AS STRING) END")
_KINDS = ["native", "technical_ir", "mapping", "coverage"]


@query(f"""WITH p AS {_PRESENT.sql}, w AS (SELECT run_id, document_id, unnest({_KINDS}) AS kind_name FROM {_PEOPLE.sql})
{_all(_checks("representation_missing", "kind_name", "w WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.document_id = w.document_id AND p.kind = w.kind_name)", document="document_id"), _checks("representation_of_another", "kind", "p WHERE own_id <> document_id", document="document_id"))}""")
def document_representations(spark, sf_dir):
    """V7: every document has all its representations, under its own id."""
    return package.representation_failures(_PEOPLE.rows(spark, sf_dir), _PRESENT.rows(spark, sf_dir), _KINDS)


_REPORTS = Frame("orders", "true", run_id=_RUN, document_id="CAST(o_orderkey AS STRING)", report="'coverage'", state="CASE o_orderkey % 20 WHEN 0 THEN 'error' WHEN 1 THEN 'reject' WHEN 2 THEN 'review' WHEN 3 THEN 'secret_required' ELSE 'clear' END")
_MORE = Frame("lineitem", "true", run_id="l_orderkey % 5", document_id="CAST(l_orderkey AS STRING)", report="'access'", state="CASE WHEN l_suppkey % 50 = 0 THEN 'blocked' WHEN l_suppkey % 50 < 5 THEN 'clear_restricted' ELSE 'ok' END")
_GRADED = f"""(SELECT run_id, document_id, max(CASE state WHEN 'error' THEN 3 WHEN 'reject' THEN 2 WHEN 'blocked' THEN 2 WHEN 'review' THEN 1 WHEN 'secret_required' THEN 1 WHEN 'clear_restricted' THEN 1 ELSE 0 END) AS g FROM ({_REPORTS.sql} UNION ALL {_MORE.sql}) GROUP BY 1, 2)"""
_STATE_CHECKS = _all(
    _checks("document_error", "'error'", f"{_GRADED} WHERE g = 3", level="error", kind="quality", document="document_id"), _checks("document_rejected", "'rejected'", f"{_GRADED} WHERE g = 2", package.POLICY, "error", "true", "policy", "document_id"),
    _checks("document_review", "'review'", f"{_GRADED} WHERE g = 1", package.PARTIAL, "warning", "false", "quality", "document_id"),
)


def _reports(spark, sf_dir) -> DataFrame:
    return _REPORTS.rows(spark, sf_dir).unionByName(_MORE.rows(spark, sf_dir))


@query(_STATE_CHECKS)
def document_report_states(spark, sf_dir):
    """The gravest state of a document's reports."""
    return package.state_failures(_reports(spark, sf_dir))


_VIEWS = Frame("orders", "o_orderkey % 6 <> 0", run_id=_RUN, document_id="CAST(o_custkey AS STRING)", profile="CASE WHEN o_orderkey % 5 = 0 THEN 'passthrough' ELSE 'technical_preview' END", status="CASE o_orderkey % 9 WHEN 0 THEN 'unsupported' WHEN 1 THEN 'partial' ELSE 'available' END")
_WANTED = Frame("orders", "true", run_id=_RUN, document_id="CAST(o_custkey AS STRING)", profile="'technical_preview'")
_CUT = Frame("orders", "true", run_id=_RUN, document_id="CAST(o_custkey AS STRING)", n="o_orderkey % 3")
_SHOWN = Frame("orders", "true", run_id=_RUN, document_id="CAST(o_custkey AS STRING)")


@query(f"""WITH v AS {_VIEWS.sql}, w AS (SELECT DISTINCT * FROM {_WANTED.sql})
{_all(_checks("view_missing", "profile", "w WHERE NOT EXISTS (SELECT 1 FROM v WHERE v.run_id = w.run_id AND v.document_id = w.document_id AND v.profile = w.profile)", level="error", kind="rendering", document="document_id"),
_checks("view_unexpected", "profile", "v WHERE NOT EXISTS (SELECT 1 FROM w WHERE v.run_id = w.run_id AND v.document_id = w.document_id AND v.profile = w.profile)", level="error", kind="rendering", document="document_id"),
_checks("view_repeated", "profile", "(SELECT run_id, document_id, profile FROM v GROUP BY 1, 2, 3 HAVING count(*) > 1)", level="error", kind="rendering", document="document_id"), _checks("view_unsupported", "profile", "v WHERE status = 'unsupported'", package.POLICY, "error", "true", "rendering", "document_id"),
_checks("view_required", "document_id", f"{_SHOWN.sql} s WHERE NOT EXISTS (SELECT 1 FROM v WHERE v.run_id = s.run_id AND v.document_id = s.document_id)", package.POLICY, "error", "true", "rendering", "document_id"),
_checks("view_not_assessed", "profile", "v WHERE status = 'partial'", package.PARTIAL, "warning", "false", "rendering", "document_id"), _checks("content_clipped", "n", f"{_CUT.sql} WHERE n > 0", package.PARTIAL, "warning", "false", "rendering", "document_id"))}""")
def rendering_policy_checks(spark, sf_dir):
    """Views against what the policy asks for."""
    return package.rendering_policy_failures(_SHOWN.rows(spark, sf_dir), _VIEWS.rows(spark, sf_dir), _WANTED.rows(spark, sf_dir), "required", _CUT.rows(spark, sf_dir))


_SLOTS = Frame("orders", "true", run_id=_RUN, document_id="CAST(o_custkey AS STRING)", slot="o_orderpriority", state="CASE o_orderkey % 7 WHEN 0 THEN 'odd' WHEN 1 THEN 'failed' WHEN 2 THEN 'blocked' WHEN 3 THEN 'partial' ELSE 'available' END", reference="CASE WHEN o_orderkey % 3 <> 0 THEN 'r' END")


@query(f"""{_checks("slot_state", "slot", f"{_SLOTS.sql} WHERE state = 'odd' OR (state IN ('available', 'partial')) <> (reference IS NOT NULL)", level="error", document="document_id")}""")
def slot_states(spark, sf_dir):
    """A slot holds a reference just where its state says so."""
    return package.slot_failures(_SLOTS.rows(spark, sf_dir))


_MANIFEST = Frame("part", "p_partkey % 3 <> 0", run_id="p_size % 5", path="CASE WHEN p_partkey % 25 = 0 THEN '../' ELSE '' END || p_brand", sha256="p_type", size_bytes="p_size")
_STORED = Frame("part", "p_partkey % 4 = 0", run_id="p_size % 5", path="p_brand", sha256="p_type", size_bytes="p_size")


@query(f"""WITH m AS {_MANIFEST.sql}, f AS {_STORED.sql}, j AS (SELECT m.*, f.sha256 AS actual, f.size_bytes AS actual_size FROM m LEFT JOIN f ON f.run_id = m.run_id AND f.path = m.path)
{_all(_checks("path_not_portable", "path", "m WHERE path LIKE '../%'"), _checks("file_absent", "path", "j WHERE actual IS NULL"), _checks("file_hash", "path", "j WHERE actual <> sha256"), _checks("file_size", "path", "j WHERE actual_size <> size_bytes"),
_checks("path_twice", "path", "(SELECT run_id, lower(path) AS path FROM m GROUP BY 1, 2 HAVING count(*) > 1)"), _checks("file_undeclared", "path", "f WHERE NOT EXISTS (SELECT 1 FROM m WHERE m.run_id = f.run_id AND m.path = f.path)"))}""")
def package_files(spark, sf_dir):
    """V9: a package's manifest against its files."""
    return package.package_file_failures(_MANIFEST.rows(spark, sf_dir), _STORED.rows(spark, sf_dir))


_BOTH = f"({_SECURITY} UNION ALL {_STATE_CHECKS})"
_RESULTS = f"""r AS (SELECT d.run_id, d.document_id, coalesce(s, 0) AS s, coalesce(n, 0) AS n FROM (SELECT DISTINCT CAST(run_id AS VARCHAR) AS run_id, document_id FROM {_DECISIONS.sql}) d LEFT JOIN (SELECT run_id, document_id, count(*) AS n, max(CASE WHEN blocking AND kind IN ('security', 'policy', 'rendering') THEN 2 WHEN blocking THEN 3 WHEN level = 'warning' THEN 1 ELSE 0 END) AS s FROM {_BOTH} GROUP BY 1, 2) k ON k.run_id = d.run_id AND k.document_id = d.document_id)"""


def _both(spark, sf_dir) -> DataFrame:
    return package.security_failures(_DECISIONS.rows(spark, sf_dir)).unionByName(package.state_failures(_reports(spark, sf_dir)))


@query(f"WITH {_RESULTS} SELECT run_id, document_id, ['ok', 'review', 'rejected', 'error'][s + 1] AS status, n AS n_checks, s < 2 AS eligible FROM r")
def draft_documents(spark, sf_dir):
    """Each document's status from its failed checks."""
    return package.document_results(_DECISIONS.rows(spark, sf_dir), _both(spark, sf_dir))


@query(f"""WITH {_RESULTS}, b AS (SELECT run_id, count(*) FILTER (blocking) AS n_blocking, count(*) FILTER (level = 'warning') AS n_warnings, count(*) FILTER (blocking AND kind NOT IN ('security', 'policy', 'rendering')) AS e FROM {_BOTH} GROUP BY 1), q AS (SELECT run_id, count(*) AS n_documents, count(*) FILTER (s = 0) AS n_ok, count(*) FILTER (s = 1) AS n_review, count(*) FILTER (s = 2) AS n_rejected, count(*) FILTER (s = 3) AS n_error FROM r GROUP BY 1)
SELECT run_id, CASE WHEN e > 0 THEN 'error' WHEN n_blocking > 0 THEN 'rejected' WHEN n_warnings > 0 THEN 'review' ELSE 'ok' END AS status, n_documents, n_ok, n_review, n_rejected, n_error, n_blocking, n_warnings, n_blocking = 0 AS eligible FROM q JOIN b USING (run_id)""")
def draft_report(spark, sf_dir):
    """A package's status and whether it may be committed."""
    return package.package_results(_DECISIONS.rows(spark, sf_dir), _both(spark, sf_dir))


@query(f"SELECT run_id, document_id, rule, subject, row_number() OVER (PARTITION BY run_id, document_id, rule ORDER BY subject, code) - 1 AS ordinal FROM {_BOTH}")
def check_ordinals(spark, sf_dir):
    """A check's ordinal within its rule and document."""
    return package.numbered(_both(spark, sf_dir)).select("run_id", "document_id", "rule", "subject", "ordinal")


_LENGTHS = [("o_orderstatus", "enum", ["O", "F"]), ("o_totalprice", "minimum", 2000.0), ("o_totalprice", "maximum", 300000.0), ("o_orderpriority", "pattern", "^[1-4]-"), ("o_orderpriority", "max_length", 8), ("o_orderkey", "absent_unless", ("o_orderstatus", ["O", "F"])), ("o_comment", "present_if", ("o_orderstatus", ["P"])), ("o_comment", "required", None)]


@query("""WITH t AS (SELECT *, CASE WHEN o_orderkey % 4 <> 0 THEN 'c' END AS o_comment FROM orders) SELECT o_orderkey, 'o_orderstatus' AS path, 'enum' AS rule FROM t WHERE o_orderstatus NOT IN ('O', 'F') UNION ALL SELECT o_orderkey, 'o_totalprice', 'minimum' FROM t WHERE o_totalprice < 2000 UNION ALL SELECT o_orderkey, 'o_totalprice', 'maximum' FROM t WHERE o_totalprice > 300000
UNION ALL SELECT o_orderkey, 'o_orderpriority', 'pattern' FROM t WHERE NOT regexp_matches(o_orderpriority, '^[1-4]-') UNION ALL SELECT o_orderkey, 'o_orderpriority', 'max_length' FROM t WHERE length(o_orderpriority) > 8 UNION ALL SELECT o_orderkey, 'o_orderkey', 'absent_unless' FROM t WHERE o_orderstatus NOT IN ('O', 'F')
UNION ALL SELECT o_orderkey, 'o_comment', 'present_if' FROM t WHERE o_orderstatus = 'P' AND o_comment IS NULL UNION ALL SELECT o_orderkey, 'o_comment', 'required' FROM t WHERE o_comment IS NULL""")
def schema_constraints(spark, sf_dir):
    """V1: constraints of a table, all that a row breaks."""
    rows = spark.read.parquet(f"{sf_dir}/orders.parquet").withColumn("o_comment", F.when(F.col("o_orderkey") % 4 != 0, "c"))
    return validate.schema_failures(rows, "o_orderkey", _LENGTHS)


_EDGES = Frame("lineitem", "true", document_id="CAST(l_orderkey AS STRING)", mapping_id="CAST(l_orderkey * 8 + l_linenumber % 6 AS STRING)", relation="CASE WHEN l_suppkey % 20 = 0 THEN 'odd' ELSE 'projects_to' END", source_layer="CASE WHEN l_suppkey % 15 = 0 THEN 'rendered' ELSE 'native' END", source_id="CASE WHEN l_partkey % 30 = 0 THEN '' ELSE CAST(l_partkey AS STRING) END", target_layer="'technical_ir'", target_id="'t' || CAST(l_partkey % 50 AS STRING)", exactness="CASE WHEN l_suppkey % 9 = 0 THEN 'inferred' WHEN l_suppkey % 9 = 1 THEN 'guess' ELSE 'exact' END", confidence="CASE WHEN l_suppkey % 7 = 0 THEN 0.5 ELSE 1.0 END", method="'m'", producer="CASE WHEN l_linenumber = 4 THEN NULL ELSE 'x' END")
_KNOWN = Frame("lineitem", "true", document_id="CAST(l_orderkey AS STRING)", layer="CASE WHEN l_linenumber % 2 = 0 THEN 'native' ELSE 'technical_ir' END", entity_id="CASE WHEN l_linenumber % 2 = 0 THEN CAST(l_partkey AS STRING) ELSE 't' || CAST(l_partkey % 50 AS STRING) END")
_ROW_RULES = {"empty_source": "source_id = ''", "no_producer": "producer IS NULL", "backward": "source_layer = 'rendered'", "unknown_relation": "relation = 'odd'", "source_of_relation": "relation = 'projects_to' AND source_layer <> 'native'", "unknown_exactness": "exactness = 'guess'", "exact_confidence": "exactness = 'exact' AND confidence < 1", "inferred_confidence": "exactness = 'inferred' AND confidence >= 1", "own_id": "true"}


@query(f"""WITH e AS {_EDGES.sql}, k AS {_KNOWN.sql} {_all(*[f"SELECT document_id, mapping_id, '{n}' AS rule FROM e WHERE {c}" for n, c in _ROW_RULES.items()])} UNION ALL SELECT document_id, mapping_id, 'repeated_id' FROM e GROUP BY 1, 2 HAVING count(*) > 1
UNION ALL SELECT document_id, mapping_id, 'unknown_source' FROM e WHERE NOT EXISTS (SELECT 1 FROM k WHERE k.document_id = e.document_id AND k.layer = e.source_layer AND k.entity_id = e.source_id) UNION ALL SELECT document_id, mapping_id, 'unknown_target' FROM e WHERE NOT EXISTS (SELECT 1 FROM k WHERE k.document_id = e.document_id AND k.layer = e.target_layer AND k.entity_id = e.target_id)
UNION ALL SELECT document_id, NULL, 'unmapped_' || layer FROM k WHERE NOT EXISTS (SELECT 1 FROM e WHERE k.document_id = e.document_id AND k.layer = e.target_layer AND k.entity_id = e.target_id)""")
def edge_rules(spark, sf_dir):
    """All rules on edges, and entities without one."""
    edges = _EDGES.rows(spark, sf_dir).withColumn("confidence", F.col("confidence").cast("double"))
    return mapping.edge_failures(edges, _KNOWN.rows(spark, sf_dir))


_OWNERS = Frame("lineitem", "true", owner_id="CAST(l_partkey % 300 AS STRING)")
_LAYERED = Frame("orders", "o_orderkey % 3 <> 0", layer="CASE WHEN o_orderkey % 7 = 0 THEN 'rendered' ELSE 'native' END", entity_id="CAST(o_custkey % 250 AS STRING)")


@query(f"""WITH k AS (SELECT entity_id, min(layer) AS a, max(layer) AS b FROM {_LAYERED.sql} GROUP BY 1) SELECT owner_id, CASE WHEN a = b THEN a END AS layer, CASE WHEN a IS NULL THEN 'unknown_owner' WHEN a <> b THEN 'ambiguous_owner' END AS failure FROM (SELECT DISTINCT owner_id FROM {_OWNERS.sql}) o LEFT JOIN k ON entity_id = owner_id""")
def geometry_owners(spark, sf_dir):
    """The one layer that knows an owner of geometry."""
    return mapping.owner_layers(_OWNERS.rows(spark, sf_dir), _LAYERED.rows(spark, sf_dir))


_NATIVES = Frame("orders", "true", document_id="o_orderkey", native_id="CAST(o_orderkey AS STRING)", part_path="CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_custkey % 40 AS STRING) ELSE '' END", reference="CAST(o_custkey % 8 AS STRING)")
_PARTS = Frame("lineitem", "l_orderkey % 4 <> 0", document_id="l_orderkey", part_id="l_orderkey * 10 + l_linenumber", path="CAST(l_partkey % 40 AS STRING)")
_RELS = Frame("lineitem", "l_orderkey % 5 = 0", document_id="l_orderkey", reference="CAST(l_suppkey % 8 AS STRING)", path="CAST(l_partkey % 40 AS STRING)")


@query(f"""WITH n AS {_NATIVES.sql}, p AS {_PARTS.sql}, a AS (SELECT document_id, path, min(part_id) AS part FROM p GROUP BY 1, 2), b AS (SELECT r.document_id, r.reference, min(part) AS part FROM {_RELS.sql} r JOIN a ON a.document_id = r.document_id AND a.path = r.path GROUP BY 1, 2), s AS (SELECT document_id, count(*) AS c, min_by(part_id, path) AS first FROM (SELECT * FROM p ORDER BY part_id) GROUP BY 1),
j AS (SELECT n.document_id, native_id, a.part AS x, b.part AS y, c, first FROM n LEFT JOIN a ON a.document_id = n.document_id AND a.path = n.part_path LEFT JOIN b ON b.document_id = n.document_id AND b.reference = n.reference LEFT JOIN s ON s.document_id = n.document_id)
SELECT document_id, native_id, CASE WHEN x IS NOT NULL OR y IS NOT NULL OR c = 1 THEN coalesce(x, y, first) END AS part_id, CASE WHEN x IS NOT NULL OR y IS NOT NULL OR c = 1 THEN 'exact' ELSE 'inferred' END AS exactness, CASE WHEN x IS NOT NULL OR y IS NOT NULL OR c = 1 THEN 1.0 ELSE 0.5 END::DOUBLE AS confidence, CASE WHEN x IS NOT NULL THEN 'part_path' WHEN y IS NOT NULL THEN 'relationship' WHEN c = 1 THEN 'single_part' WHEN c > 1 THEN 'container_scope' ELSE 'binary_scope' END AS method FROM j""")
def origin_priorities(spark, sf_dir):
    """Where native units come from, by all five levels."""
    found = mapping.prioritized_origins(_NATIVES.rows(spark, sf_dir), _PARTS.rows(spark, sf_dir), _RELS.rows(spark, sf_dir))
    return found.withColumn("part_id", F.when(F.col("exactness") == "exact", F.col("part_id")))


_MEASURES = Frame("orders", "true", document_id="CAST(o_custkey AS STRING)", feature="CASE WHEN o_orderkey % 5 = 0 THEN 'odd' WHEN o_orderkey % 2 = 0 THEN 'formula' ELSE 'native_style' END", severity="'error'", encountered="o_orderkey % 6", required="o_orderkey % 7", omitted="o_orderkey % 8", preserved="0", projected="0", rendered="0", opaque="0", approximated="0", unsupported="0")
_LOST = Frame("orders", "o_orderkey % 3 = 0", loss_id="'loss_' || CAST(o_orderkey % 50 AS STRING)", document_id="CAST(o_custkey AS STRING)", feature="CASE WHEN o_orderkey % 4 = 0 THEN 'formula' ELSE 'revision' END", kind="'omitted'")
_CHANGES = Frame("lineitem", "true", document_id="CAST(l_orderkey AS STRING)", from_layer="CASE WHEN l_linenumber = 1 THEN 'asset' ELSE 'native' END", to_layer="'rendered'", confidence="l_quantity / 40")
_SCORES = Frame("orders", "true", document_id="CAST(o_custkey AS STRING)", axis="CASE WHEN o_orderkey % 9 = 0 THEN 'odd' ELSE 'visual' END", score="o_totalprice / 200000")


@query(f"""WITH m AS {_MEASURES.sql}, l AS {_LOST.sql}, c AS {_CHANGES.sql}, s AS {_SCORES.sql} SELECT document_id, 'counter_over_encountered' AS rule, feature AS subject FROM m WHERE required > encountered OR omitted > encountered UNION ALL SELECT document_id, 'omitted_over_required', feature FROM m WHERE omitted > required UNION ALL SELECT document_id, 'unknown_feature', feature FROM m WHERE feature = 'odd' UNION ALL SELECT document_id, 'feature_twice', feature FROM m GROUP BY 1, 3 HAVING count(*) > 1
UNION ALL SELECT document_id, 'loss_id', loss_id FROM l UNION ALL SELECT document_id, 'loss_without_measurement', loss_id FROM l WHERE NOT EXISTS (SELECT 1 FROM m WHERE m.document_id = l.document_id AND m.feature = l.feature) UNION ALL SELECT document_id, 'loss_twice', loss_id FROM l GROUP BY 1, 3 HAVING count(*) > 1
UNION ALL SELECT document_id, 'transition_backward', from_layer FROM c WHERE from_layer = 'asset' UNION ALL SELECT document_id, 'transition_confidence', from_layer FROM c WHERE confidence > 1 UNION ALL SELECT document_id, 'unknown_axis', axis FROM s WHERE axis = 'odd' UNION ALL SELECT document_id, 'score_range', axis FROM s WHERE score > 1""")
def quality_rules(spark, sf_dir):
    """V4: counters, losses, transitions and scores that contradict each other."""
    return quality.quality_failures(_MEASURES.rows(spark, sf_dir), _LOST.rows(spark, sf_dir), _CHANGES.rows(spark, sf_dir), _SCORES.rows(spark, sf_dir))


def _set(divisor: int) -> str:
    return f"filter(array('a', 'b', 'c', 'd'), x -> (o_orderkey + ascii(x)) % {divisor} <> 0)"


@query(f"""WITH t AS (SELECT o_orderkey AS surface_id, {', '.join(f"list_filter(['a', 'b', 'c', 'd'], lambda x: (o_orderkey + ascii(x)) % {d} <> 0) AS {n}" for n, d in (("serialized", 5), ("visible", 6), ("clipped", 2), ("geometry", 7)))}, list_filter(['a', 'b', 'c', 'd'], lambda x: (o_orderkey + ascii(x)) % 9 = 0) AS omitted, o_orderkey % 5 AS n_visible FROM orders)
SELECT surface_id, 'visible_not_serialized' AS rule FROM t WHERE len(list_filter(visible, lambda x: NOT list_contains(serialized, x))) > 0 UNION ALL SELECT surface_id, 'clipped_not_visible' FROM t WHERE len(list_filter(clipped, lambda x: NOT list_contains(visible, x))) > 0 UNION ALL SELECT surface_id, 'omitted_serialized' FROM t WHERE list_has_any(omitted, serialized)
UNION ALL SELECT surface_id, 'visible_without_geometry' FROM t WHERE len(list_filter(visible, lambda x: NOT list_contains(geometry, x))) > 0 UNION ALL SELECT surface_id, 'summary' FROM t WHERE len(visible) <> n_visible""")
def rendering_rules(spark, sf_dir):
    """V5: what is visible, clipped, omitted and placed on a surface."""
    sets = {n: _set(d) for n, d in (("serialized", 5), ("visible", 6), ("clipped", 2), ("geometry", 7))} | {"omitted": "filter(array('a', 'b', 'c', 'd'), x -> (o_orderkey + ascii(x)) % 9 = 0)"}
    rows = spark.read.parquet(f"{sf_dir}/orders.parquet").selectExpr("o_orderkey AS surface_id", *[f"{e} AS {n}" for n, e in sets.items()], "o_orderkey % 5 AS n_visible")
    return validate.rendering_failures(rows)


@query("SELECT p_partkey, row_number() OVER (PARTITION BY p_brand ORDER BY p_size, p_partkey % 40, p_partkey) - 1 AS slot FROM part")
def cell_order(spark, sf_dir):
    """O3: cells row by row, then column by column."""
    rows = spark.read.parquet(f"{sf_dir}/part.parquet").select(F.col("p_brand").alias("sheet"), F.col("p_size").alias("row"), (F.col("p_partkey") % 40).alias("column"), F.col("p_partkey").alias("cell_id"))
    return sheets.row_major(rows, ["sheet"]).select(F.col("cell_id").alias("p_partkey"), "slot")


@query("""SELECT s_suppkey, sha256('{"field_update":"disabled","formula_recalculation":"disabled","macros":"disabled","network":"denied","profile":"' || CASE WHEN s_suppkey % 2 = 0 THEN 'passthrough' ELSE 'technical_preview' END || '","renderer_family":"r' || s_suppkey || '","timezone":"UTC"}') AS environment, 'file:' || string_split(s_name, '#')[1] AS locator, replace(s_name, '#', '%23') AS component FROM (SELECT s_suppkey, replace(s_name, ' ', '') AS s_name FROM supplier)""")
def environment_hashes(spark, sf_dir):
    """hashes of rendering environments, locators without folders, quoted path components."""
    name = F.replace("s_name", F.lit(" "), F.lit(""))
    profile = F.when(F.col("s_suppkey") % 2 == 0, "passthrough").otherwise("technical_preview")
    environment = identity.environment_hash(profile, F.concat(F.lit("r"), F.col("s_suppkey").cast("string")), {"timezone": "UTC"})
    locator = scalar.redacted_locator(F.lit("file"), F.concat(F.lit("some/folder/"), F.split(name, "#")[0]))
    return spark.read.parquet(f"{sf_dir}/supplier.parquet").select("s_suppkey", environment.alias("environment"), locator.alias("locator"), scalar.portable_component(name).alias("component"))


@query("""SELECT n_nationkey, CAST(i AS BIGINT) AS position, 'p/' || n_name || i AS path, 'c' || n_regionkey AS contract_id FROM nation, (SELECT unnest([0, 1]) AS i) WHERE i < n_nationkey % 3""")
def json_reference_scan(spark, sf_dir):
    """reference-shaped objects at any depth of a JSON text."""
    one = "concat('{{\"path\":\"p/', n_name, '{i}\",\"sha256\":\"x\",\"schema_id\":\"s\",\"schema_version\":\"2\",\"contract_id\":\"c', n_regionkey, '\"}}')"
    inner = f"concat(CASE WHEN n_nationkey % 3 > 0 THEN {one.format(i=0)} ELSE 'null' END, ',\"y\":[{{\"deep\":', CASE WHEN n_nationkey % 3 > 1 THEN {one.format(i=1)} ELSE '{{\"path\":\"no\"}}' END, '}}]')".replace("{{", "{").replace("}}", "}")
    rows = spark.read.parquet(f"{sf_dir}/nation.parquet").selectExpr("n_nationkey", f"concat('{{\"x\":', {inner}, '}}') AS body".replace("{{", "{").replace("}}", "}"))
    return rows.select("n_nationkey", F.posexplode(scalar.json_references(F.col("body"))).alias("position", "r")).select("n_nationkey", F.col("position").cast("long").alias("position"), "r.path", "r.contract_id")


_IDS = Frame("lineitem", "true", document_id="l_orderkey % 200", feature="CASE l_linenumber % 3 WHEN 0 THEN 'native_core_unit' WHEN 1 THEN 'native_style' ELSE 'rendered_surface' END", stage="CASE WHEN l_linenumber % 3 = 2 THEN 'native_to_rendered' ELSE 'native_to_ir' END", entity_id="l_partkey % 60")
_MEMBERS = Frame("lineitem", "l_suppkey % 3 = 0", document_id="l_orderkey % 200", role="CASE l_suppkey % 4 WHEN 0 THEN 'required' WHEN 1 THEN 'preserved' WHEN 2 THEN 'opaque' ELSE 'unsupported' END", entity_id="l_partkey % 60")
_SIDES = Frame("lineitem", "l_suppkey % 3 = 1", document_id="l_orderkey % 200", side="CASE WHEN l_suppkey % 2 = 0 THEN 'projected' ELSE 'rendered' END", entity_id="l_partkey % 60", exactness="CASE l_partkey % 7 % 3 WHEN 0 THEN 'exact' WHEN 1 THEN 'approximate' ELSE 'inferred' END")
_ID_FACTS = f"""i AS (SELECT DISTINCT * FROM {_IDS.sql}), m AS {_MEMBERS.sql}, e AS {_SIDES.sql},
f AS (SELECT i.*, feature = 'native_core_unit' OR EXISTS (SELECT 1 FROM m WHERE m.document_id = i.document_id AND m.entity_id = i.entity_id AND role = 'required') AS required,
  feature <> 'native_style' OR EXISTS (SELECT 1 FROM m WHERE m.document_id = i.document_id AND m.entity_id = i.entity_id AND role = 'preserved') AS preserved, EXISTS (SELECT 1 FROM m WHERE m.document_id = i.document_id AND m.entity_id = i.entity_id AND role = 'opaque') AS opaque,
  EXISTS (SELECT 1 FROM m WHERE m.document_id = i.document_id AND m.entity_id = i.entity_id AND role = 'unsupported') AS unsupported,
  (SELECT max(CASE exactness WHEN 'exact' THEN 3 WHEN 'approximate' THEN 2 ELSE 1 END) FROM e WHERE e.document_id = i.document_id AND e.entity_id = i.entity_id AND side = 'projected') AS p,
  (SELECT max(CASE exactness WHEN 'exact' THEN 3 WHEN 'approximate' THEN 2 ELSE 1 END) FROM e WHERE e.document_id = i.document_id AND e.entity_id = i.entity_id AND side = 'rendered') AS r FROM i)"""


def _id_facts(spark, sf_dir) -> DataFrame:
    narrows = F.when(F.col("feature") == "native_core_unit", F.array().cast("array<string>")).when(F.col("feature") == "native_style", F.array(F.lit("required"), F.lit("preserved"))).otherwise(F.array(F.lit("required")))
    return quality.id_facts(_IDS.rows(spark, sf_dir).withColumn("narrows", narrows), _MEMBERS.rows(spark, sf_dir), _SIDES.rows(spark, sf_dir))


@query(f"""WITH {_ID_FACTS} SELECT document_id, feature, unnest(list_filter([CASE WHEN required THEN 'required' END, CASE WHEN preserved THEN 'preserved' END, CASE WHEN p IS NOT NULL THEN 'projected' END, CASE WHEN r IS NOT NULL THEN 'rendered' END, CASE WHEN required AND p IS NULL THEN 'omitted' END,
  CASE WHEN coalesce(p < 3, false) OR (stage = 'native_to_rendered' AND coalesce(r < 3, false)) THEN 'approximated' END, CASE WHEN unsupported THEN 'unsupported' END], lambda x: x IS NOT NULL)) AS role, entity_id FROM f""")
def feature_references(spark, sf_dir):
    """Ids that a feature requires, preserves, projects, renders, omits, approximates, doesn't support."""
    return quality.references(_id_facts(spark, sf_dir))


@query(f"""WITH {_ID_FACTS} SELECT document_id, feature, count(*) AS encountered, CAST(sum(required::INT) AS BIGINT) AS required, CAST(sum(preserved::INT) AS BIGINT) AS preserved, count(p) AS projected, count(r) AS rendered, CAST(sum(opaque::INT) AS BIGINT) AS opaque,
  CAST(sum((coalesce(p < 3, false) OR (stage = 'native_to_rendered' AND coalesce(r < 3, false)))::INT) AS BIGINT) AS approximated, CAST(sum(unsupported::INT) AS BIGINT) AS unsupported, CAST(sum((required AND p IS NULL)::INT) AS BIGINT) AS omitted FROM f GROUP BY 1, 2""")
def feature_counters(spark, sf_dir):
    """Counters of features from id sets and edges."""
    return quality.measurements(_id_facts(spark, sf_dir), ["document_id", "feature"], F.col("stage").isin(quality.RENDERING_STAGES)).drop("exact_hits", "approximate_hits")


_NATIVE_KINDS = ["line", "paragraph", "run", "table", "row", "cell", "section", "worksheet", "formula", "slide", "shape", "page", "frame", "storage", "stream", "annotation", "revision", "style", "metadata", "transition"]
_PROFILED = Frame(
    "lineitem", "true", document_id="'d' || CAST(l_orderkey % 100 AS STRING)", unit_id="'u' || CAST(l_orderkey * 8 + l_linenumber AS STRING)", kind=f"CASE l_partkey % {len(_NATIVE_KINDS)} " + " ".join(f"WHEN {i} THEN '{k}'" for i, k in enumerate(_NATIVE_KINDS)) + " END",
    parent_id="CASE WHEN l_linenumber > 1 THEN 'u' || CAST(l_orderkey * 8 + l_linenumber - 1 AS STRING) WHEN l_suppkey % 3 = 0 THEN 'nowhere' END", ordinal="l_linenumber", text="CASE WHEN l_suppkey % 5 = 0 THEN NULL ELSE l_returnflag END",
    cell_at="CASE WHEN l_suppkey % 2 = 0 THEN 'A' || CAST(l_linenumber AS STRING) END", value_kind="CASE l_suppkey % 6 WHEN 0 THEN 'string' WHEN 1 THEN 'formula' WHEN 2 THEN 'error' WHEN 3 THEN 'number' END", kind_of="CASE WHEN l_suppkey % 7 = 0 THEN NULL ELSE lower(l_linestatus) END", visibility="CASE WHEN l_suppkey % 4 = 0 THEN 'hidden' ELSE 'visible' END", hidden="CASE WHEN l_suppkey % 4 = 1 THEN 'true' ELSE 'false' END",
)
_NAMED = {"line": "text_line", "run": "text_span", "row": "table_row", "section": "flow_section", "page": "fixed_page", "frame": "image_frame", "style": "style_definition", "storage": "ole_storage", "stream": "ole_stream"}
_TREE_ID = lambda json: identity.sql_stable_id("ir", f"({json})")
_UNIT_JSON = """'{"document_id":"' || %s || '","kind":"' || %s || '","native_id":"' || %s || '"}'"""
_ROOT_JSON = """'{"document_id":"' || document_id || '","synthetic":"document"}'"""


@query(f"""WITH n AS {_PROFILED.sql},
k AS (SELECT *, CASE {" ".join(f"WHEN kind = '{a}' THEN '{b}'" for a, b in _NAMED.items())} WHEN kind = 'cell' AND cell_at IS NULL THEN 'table_cell' WHEN kind = 'annotation' THEN 'annotation_' || coalesce(kind_of, 'comment') WHEN kind = 'revision' THEN 'revision_' || coalesce(kind_of, 'unknown') WHEN kind = 'shape' AND text IS NULL THEN 'visual_object' WHEN kind = 'shape' THEN 'text_shape' ELSE kind END AS unit_kind,
  kind IN ('formula', 'revision', 'transition', 'animation', 'frame', 'storage', 'stream', 'annotation', 'style', 'metadata') OR coalesce(value_kind = 'formula', false) OR (kind = 'worksheet' AND visibility <> 'visible') OR (kind = 'slide' AND hidden = 'true') AS protected,
  CASE WHEN kind = 'cell' AND cell_at IS NOT NULL AND value_kind IS NOT NULL AND value_kind NOT IN ('string', 'error') THEN NULL ELSE text END AS own_text FROM n)
SELECT k.document_id, {_TREE_ID(_UNIT_JSON % ("k.document_id", "k.unit_kind", "k.unit_id"))} AS unit_id, k.unit_kind AS kind, CASE WHEN p.unit_id IS NULL THEN {_TREE_ID(_ROOT_JSON.replace("document_id ||", "k.document_id ||"))} ELSE {_TREE_ID(_UNIT_JSON % ("k.document_id", "p.unit_kind", "p.unit_id"))} END AS parent_id, CAST(k.ordinal AS BIGINT) AS ordinal, k.unit_id AS native_id, k.own_text AS text, k.protected
FROM k LEFT JOIN (SELECT DISTINCT document_id, unit_id, unit_kind FROM k) p ON p.document_id = k.document_id AND p.unit_id = k.parent_id""")
def ir_projection_profiles(spark, sf_dir):
    """Units of all profiles (fixed pages, frames, compound files, flowing text, sheets, slides) in the tree."""
    rows = _PROFILED.rows(spark, sf_dir)
    properties = F.map_filter(F.create_map(*[x for c in ("cell_at", "value_kind", "kind_of", "visibility", "hidden") for x in (F.lit(c.removeprefix("cell_")), F.col(c))]), lambda k, v: v.isNotNull())
    return ir.project(rows.withColumn("properties", properties)).drop("origin")


_BOOK_CELLS = Frame("lineitem", "true", document_id="l_orderkey % 50", cell_id="l_orderkey * 8 + l_linenumber", code="CASE l_linenumber % 4 WHEN 0 THEN 's' WHEN 1 THEN 's' WHEN 2 THEN 'b' ELSE 'n' END", raw="CASE WHEN l_suppkey % 17 = 0 THEN NULL WHEN l_suppkey % 19 = 0 THEN 'no number' WHEN l_linenumber % 4 = 2 THEN CAST(l_suppkey % 2 AS STRING) ELSE CAST(l_partkey AS STRING) END")
_STRINGS = Frame("part", "p_size % 10 <> 0", document_id="p_partkey % 50", place="p_partkey", text="p_name")


@query(f"""WITH c AS {_BOOK_CELLS.sql}, s AS (SELECT document_id, place, min(text) AS text FROM {_STRINGS.sql} GROUP BY 1, 2)
SELECT c.cell_id, CASE code WHEN 's' THEN coalesce(s.text, raw) WHEN 'b' THEN CASE WHEN raw = '1' THEN 'true' ELSE 'false' END ELSE raw END AS value FROM c LEFT JOIN s ON s.document_id = c.document_id AND code = 's' AND s.place = TRY_CAST(raw AS BIGINT)""")
def shared_strings(spark, sf_dir):
    """cells' shared strings by a join with their book's table of strings."""
    return sheets.with_shared(_BOOK_CELLS.rows(spark, sf_dir), _STRINGS.rows(spark, sf_dir)).select("cell_id", "value")
