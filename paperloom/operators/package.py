"""Validation of runs, documents and packages: rules as filters, anti joins and aggregates over long tables.

Every rule gives rows of one shape: (run_id, document_id, rule, kind, code, level, blocking, subject); ``document_id``
is null for rules on the run as a whole. Nothing is decided row by row in Python, and no rule needs another's result.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.identity import canonical_json, stable_id
from ..functions.ranks import STATUS, gravest, rank, state_of
from ..functions.scalar import is_portable_path
from ..storage import repeated
from .graph import on_cycles_within

CHECK = ["run_id", "document_id", "rule", "kind", "code", "level", "blocking", "subject"]

# Codes, the representations a document has, and how grave states of reports are --------------------------
INTEGRITY, POLICY, PARTIAL = "DS-VAL-001", "DS-VAL-002", "DS-VAL-003"
REPRESENTATIONS = ["access", "container", "coverage", "decode", "geometry", "annotations", "mapping", "metadata", "native", "preservation", "relationships", "resources", "styles", "technical_ir"]
ACCESS_LEVELS = {"clear": "ok", "clear_restricted": "review", "secret_required": "review", "reject": "rejected", "blocked": "rejected"}
NODE_STATES = ["pending", "running", "completed", "partial", "failed", "blocked", "cancelled", "skipped"]
SLOT_STATES = ["available", "partial", "not_available", "not_applicable", "blocked", "failed"]
COMMIT_MARKERS = ["COMMITTED", "PACKAGE_COMPLETE"]


def _found(rows: DataFrame, rule: str | Column, subject: Column, code: str = INTEGRITY, level: str = "critical", blocking: bool = True, kind: str = "integrity", carried: Sequence[str] = ()) -> DataFrame:
    document = F.col("document_id") if "document_id" in rows.columns else F.lit(None).cast("string")
    return rows.select(F.col("run_id").cast("string").alias("run_id"), document.cast("string").alias("document_id"), (F.lit(rule) if isinstance(rule, str) else rule).alias("rule"), F.lit(kind).alias("kind"), F.lit(code).alias("code"), F.lit(level).alias("level"), F.lit(blocking).alias("blocking"), subject.cast("string").alias("subject"), *carried)


def union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def declared_failures(declared: DataFrame, files: DataFrame) -> DataFrame:
    """``declared(run_id, path, sha256, schema_id)`` against ``files(run_id, path, sha256, schema_id, valid)``.

    One failure per declared file, the first of: not portable, absent, another hash, another schema, not valid; and
    one per path that is declared more than once.
    """
    actual = files.select("run_id", "path", F.col("sha256").alias("actual"), F.col("schema_id").alias("actual_schema"), "valid")
    joined = declared.join(actual, ["run_id", "path"], "left")
    rule = (
        F.when(~is_portable_path(F.col("path")), "declared_not_portable")
        .when(F.col("actual").isNull(), "declared_absent")
        .when(F.col("actual") != F.col("sha256"), "declared_hash")
        .when(~F.col("actual_schema").eqNullSafe(F.col("schema_id")), "declared_schema")
        .when(~F.coalesce("valid", F.lit(False)), "declared_invalid")
    )
    bad = joined.withColumn("failed", rule).filter("failed IS NOT NULL")
    twice = declared.groupBy("run_id", "path").agg(F.count("*").alias("n")).filter("n > 1")
    return _found(bad, F.col("failed"), F.col("path")).unionByName(_found(twice, "declared_twice", F.col("path")))


def nested_reference_failures(references: DataFrame, files: DataFrame, declared: DataFrame) -> DataFrame:
    """``references(run_id, owner, path, sha256, contract_id)`` in contracts: resolved, equal in hash and header, declared.

    Files and declarations meet first, so that the references, of which there are most, are shuffled once.
    """
    # of several files of a path the first alone says whether it is declared, which counts once per reference
    number = F.row_number().over(Window.partitionBy("run_id", "path").orderBy(F.lit(1)))
    known = files.select("run_id", "path", F.col("sha256").alias("actual"), F.col("contract_id").alias("actual_contract"), number.alias("number"))
    known = known.join(declared.select("run_id", "path").distinct().withColumn("declared", F.lit(True)), ["run_id", "path"], "full_outer")
    rows = references.join(known, ["run_id", "path"], "left")
    there = F.col("actual").isNotNull()
    once = F.coalesce("number", F.lit(1)) == 1
    rules = F.array_compact(F.array(
        F.when(~there, "reference_unresolved"), F.when(there & (F.col("actual") != F.col("sha256")), "reference_hash"),
        F.when(there & ~F.col("actual_contract").eqNullSafe(F.col("contract_id")), "reference_header"), F.when(once & F.col("declared").isNull(), "reference_undeclared"),
    ))
    return _found(rows.select("run_id", "owner", "path", F.explode(rules).alias("rule")), F.col("rule"), F.concat_ws(" > ", "owner", "path"))


def verified_input_failures(expected: DataFrame, stored: DataFrame, major: str = "2") -> DataFrame:
    """(input_id, failure) of ``expected(input_id, path, sha256, schema_id, document_id)`` that ``stored(path, sha256,
    body)`` doesn't hold: the first of absent, hash, not_json, schema, version (other than ``major``), document.

    The header and the document's id are read from the body; an expectation without a document takes any.
    """
    actual = stored.select("path", F.col("sha256").alias("actual"), F.try_parse_json("body").alias("v"))
    field = lambda p: F.try_variant_get("v", p, "string")
    rows = expected.withColumn("document_id", F.col("document_id").cast("string")).join(actual, "path", "left")
    failure = (
        F.when(F.col("actual").isNull(), "absent")
        .when(F.col("actual") != F.col("sha256"), "hash")
        .when(F.col("v").isNull(), "not_json")
        .when(~field("$.header.schema_id").eqNullSafe(F.col("schema_id")), "schema")
        .when(~F.coalesce(field("$.header.schema_version").rlike(rf"^{major}\.[0-9]+\.[0-9]+$"), F.lit(False)), "version")
        .when(F.col("document_id").isNotNull() & ~field("$.document_id").eqNullSafe(F.col("document_id")), "document")
    )
    return rows.select("input_id", failure.alias("failure")).filter("failure IS NOT NULL")


def cycle_failures(references: DataFrame) -> DataFrame:
    """Owners among ``references(run_id, owner, path)`` that references lead back to."""
    found = on_cycles_within(references.select("run_id", F.col("owner").alias("node"), F.col("path").alias("parent")), "run_id")
    return _found(found.select("run_id", F.col("node").alias("owner")), "reference_cycle", F.col("owner"))


def changed_failures(before: DataFrame, after: DataFrame, rule: str) -> DataFrame:
    """``before`` and ``after`` (run_id, path, sha256): files that were added, removed or changed since."""
    b, a = before.select("run_id", "path", F.col("sha256").alias("old")), after.select("run_id", "path", F.col("sha256").alias("new"))
    joined = b.join(a, ["run_id", "path"], "full_outer").filter(~F.col("old").eqNullSafe(F.col("new")))
    return _found(joined, rule, F.col("path"))


def stage_failures(nodes: DataFrame, runs: DataFrame, stages: list[str]) -> DataFrame:
    """``nodes(run_id, stage, state)``: stages of ``runs(run_id)`` without a completed or partial node; odd and partial states."""
    wanted = runs.select("run_id", F.explode(F.array(*[F.lit(s) for s in stages])).alias("stage"))
    done = nodes.filter(F.col("state").isin("completed", "partial")).select("run_id", "stage")
    lacking = wanted.join(done, ["run_id", "stage"], "left_anti")
    odd = nodes.filter(~F.col("state").isin(NODE_STATES) | F.col("state").isin("failed", "cancelled", "blocked", "running"))
    partial = nodes.filter("state = 'partial'")
    twice = nodes.groupBy("run_id", "stage").agg(F.count("*").alias("n")).filter("n > 1")
    return union([
        _found(lacking, "stage_not_completed", F.col("stage")), _found(odd, "node_state", F.col("stage"), level="error"), _found(twice, "stage_twice", F.col("stage")),
        _found(partial, "node_partial", F.col("stage"), PARTIAL, "warning", False, "quality"),
    ])


def marker_failures(markers: DataFrame, nodes: DataFrame, implications: list[tuple[str, str]]) -> DataFrame:
    """``markers(run_id, marker)``: markers whose stage isn't complete, unknown ones, and signs of an early commit."""
    known = F.array(*[F.struct(F.lit(m).alias("marker"), F.lit(s).alias("stage")) for m, s in implications])
    implied = markers.select("run_id", "marker", F.explode(F.filter(known, lambda k: k["marker"] == F.col("marker"))).alias("k")).select("run_id", "marker", "k.stage")
    done = nodes.filter(F.col("state").isin("completed", "partial")).select("run_id", "stage")
    names = [m for m, _ in implications] + COMMIT_MARKERS
    return union([
        _found(implied.join(done, ["run_id", "stage"], "left_anti"), "marker_without_stage", F.concat_ws(" > ", "marker", "stage")), _found(markers.filter(~F.col("marker").isin(names)), "marker_unknown", F.col("marker"), level="error"),
        _found(markers.filter(F.col("marker").isin(COMMIT_MARKERS)), "premature_commit", F.col("marker")),
    ])


def policy_failures(requested: DataFrame, applied: DataFrame) -> DataFrame:
    """``(run_id, policy_hash)`` as requested and as applied: they must be there and be the same."""
    joined = requested.join(applied.select("run_id", F.col("policy_hash").alias("used")), "run_id", "left").filter(~F.col("policy_hash").eqNullSafe(F.col("used")))
    return _found(joined, "policy_changed", F.col("policy_hash"), kind="policy")


def undeclared_failures(files: DataFrame, declared: DataFrame) -> DataFrame:
    return _found(files.join(declared.select("run_id", "path"), ["run_id", "path"], "left_anti"), "undeclared_contract", F.col("path"), level="error")


def security_failures(decisions: DataFrame) -> DataFrame:
    """``decisions(run_id, document_id, decision)``: blocked documents fail, reviewed and restricted ones warn."""
    blocked, careful = decisions.filter("decision = 'block'"), decisions.filter("decision IN ('review', 'allow_restricted')")
    return _found(blocked, "security_block", F.col("document_id"), POLICY, "critical", True, "security").unionByName(_found(careful, "security_review", F.col("document_id"), PARTIAL, "warning", False, "security"))


def identity_failures(runs: DataFrame, manifests: DataFrame) -> DataFrame:
    return _found(runs.select("run_id").join(manifests.filter("identity_hash IS NOT NULL").select("run_id"), "run_id", "left_anti"), "identity_missing", F.col("run_id"))


def representation_failures(documents: DataFrame, present: DataFrame, kinds: list[str] = REPRESENTATIONS) -> DataFrame:
    """``present(run_id, document_id, kind, own_id)``: each document's representations, once each, under its own id."""
    wanted = documents.select("run_id", "document_id", F.explode(F.array(*[F.lit(k) for k in kinds])).alias("kind_name"))
    have = present.select("run_id", "document_id", F.col("kind").alias("kind_name"), "own_id")
    absent = wanted.join(have, ["run_id", "document_id", "kind_name"], "left_anti")
    foreign = have.filter(~F.col("own_id").eqNullSafe(F.col("document_id")))
    return _found(absent, "representation_missing", F.col("kind_name")).unionByName(_found(foreign, "representation_of_another", F.col("kind_name")))


def document_states(states: DataFrame) -> DataFrame:
    """(run_id, document_id, status) from ``states(run_id, document_id, report, state)``: the gravest of all reports;
    states of access count as ``ACCESS_LEVELS`` says."""
    named = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for p in ACCESS_LEVELS.items() for x in p]), F.col("state")), F.col("state"))
    return states.groupBy("run_id", "document_id").agg(gravest(named, STATUS).alias("status"))


def state_failures(states: DataFrame) -> DataFrame:
    """Errors fail, rejections fail as policy, reviews warn."""
    graded = document_states(states)
    return union([
        _found(graded.filter("status IN ('error', 'cancelled')"), "document_error", F.col("status"), INTEGRITY, "error", True, "quality"), _found(graded.filter("status = 'rejected'"), "document_rejected", F.col("status"), POLICY, "error", True, "policy"),
        _found(graded.filter("status = 'review'"), "document_review", F.col("status"), PARTIAL, "warning", False, "quality"),
    ])


def rendering_policy_failures(documents: DataFrame, views: DataFrame, requested: DataFrame, mode: str, clipped: DataFrame, explicit: bool = True) -> DataFrame:
    """Views against the policy.

    ``views(run_id, document_id, profile, status)``, ``requested(run_id, document_id, profile)``, ``clipped(run_id,
    document_id, n)``. Without rendering no view may be there; else requested profiles are neither missing, repeated
    nor joined by others; a required one that was asked for by name (``explicit``) and isn't supported is against the
    policy; one that isn't supported otherwise, isn't assessed, or is cut off, is a warning.
    """
    if mode == "none":
        return _found(views, "view_without_rendering", F.col("profile"), POLICY, "error", True, "rendering")
    want = requested.select("run_id", "document_id", "profile").distinct()
    missing, extra = want.join(views, ["run_id", "document_id", "profile"], "left_anti"), views.join(want, ["run_id", "document_id", "profile"], "left_anti")
    twice = views.groupBy("run_id", "document_id", "profile").agg(F.count("*").alias("n")).filter("n > 1")
    refused = views.filter("status = 'unsupported'")
    strict = mode == "required" and explicit
    bare = documents.join(views.select("run_id", "document_id"), ["run_id", "document_id"], "left_anti")
    none = bare if mode == "required" else bare.limit(0)
    return union([
        _found(missing, "view_missing", F.col("profile"), level="error", kind="rendering"), _found(extra, "view_unexpected", F.col("profile"), level="error", kind="rendering"), _found(twice, "view_repeated", F.col("profile"), level="error", kind="rendering"),
        _found(refused, "view_unsupported", F.col("profile"), POLICY if strict else PARTIAL, "error" if strict else "warning", strict, "rendering"), _found(none, "view_required", F.col("document_id"), POLICY, "error", True, "rendering"),
        _found(views.filter("status = 'partial'"), "view_not_assessed", F.col("profile"), PARTIAL, "warning", False, "rendering"), _found(clipped.filter("n > 0"), "content_clipped", F.col("n"), PARTIAL, "warning", False, "rendering"),
    ])


def formula_failures(formulas: DataFrame) -> DataFrame:
    """``formulas(run_id, document_id, unit_id, recalculated)``: none may have been calculated."""
    return _found(formulas.filter("coalesce(recalculated, 'false') <> 'false'"), "formula_recalculated", F.col("unit_id"))


def mapping_failures(edges: DataFrame) -> DataFrame:
    """``edges(run_id, document_id, mapping_id)``: unique ids."""
    return _found(repeated(edges, ["run_id", "document_id", "mapping_id"]), "mapping_repeated", F.col("mapping_id"))


def slot_failures(slots: DataFrame) -> DataFrame:
    """``slots(run_id, document_id, slot, state, reference)``: a reference just where the state says that there is one."""
    held = F.col("state").isin("available", "partial")
    bad = slots.filter(~F.col("state").isin(SLOT_STATES) | (held != F.col("reference").isNotNull()))
    return _found(bad, "slot_state", F.col("slot"), level="error")


#: Rows that a row's repetitions are dealt over tasks by, and rows of a block that is crossed with them.
PIECE, BLOCK = 1 << 18, 1 << 8


def _repeated(rows: DataFrame) -> DataFrame:
    """Each of ``rows(..., n)`` n times, as they are: what they say is worked out before, not once a repetition.

    A row's repetitions are dealt over tasks in pieces of PIECE rows. Whole blocks of them come from a product with as
    many rows without columns, which copies a row's bytes at once; a piece's rest is exploded.
    """
    spark, own = rows.sparkSession, [c for c in rows.columns if c != "n"]
    pieces = rows.filter("n > 0").withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), (F.col("n") - 1).cast("long"), F.lit(PIECE).cast("long"))))
    # by number, since pieces have few bytes and would be put together again otherwise
    dealt = pieces.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), *[F.col(c) for c in own], "piece")
    sized = dealt.select(*own, F.least(F.col("n") - F.col("piece"), F.lit(PIECE)).cast("int").alias("n"))
    times = lambda part, n: part.select(*own, F.explode(F.sequence(F.lit(1), n)).alias("__at")).drop("__at")
    blocks = times(sized.filter(F.col("n") >= BLOCK), F.floor(F.col("n") / BLOCK).cast("int"))
    whole = blocks.crossJoin(spark.range(0, BLOCK, 1, 1).select().hint("shuffle_replicate_nl"))
    return whole.unionByName(times(sized.filter(F.col("n") % BLOCK > 0), F.col("n") % BLOCK))


def _differing(manifest: DataFrame, files: DataFrame, value: str) -> DataFrame:
    """(run_id, path, n): the pairs of a row of the manifest and a file that differ in ``value``.

    Pairs aren't made: those of a path are counted, less those that agree.
    """
    keys = ["run_id", "path"]
    count = lambda rows, n: rows.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias(n))
    ours, theirs = count(manifest, "m"), count(files, "f")
    total = lambda rows, n: rows.groupBy(*keys).agg(F.sum(n).alias(f"all_{n}"))
    same = ours.join(theirs, [*keys, value]).groupBy(*keys).agg(F.sum(F.col("m") * F.col("f")).alias("same"))
    pairs = total(ours, "m").join(total(theirs, "f"), keys).join(same, keys, "left")
    return pairs.select(*keys, (F.col("all_m") * F.col("all_f") - F.coalesce("same", F.lit(0))).alias("n"))


def package_file_failures(manifest: DataFrame, files: DataFrame) -> DataFrame:
    """``manifest(run_id, path, sha256, size_bytes)`` of a finished package against ``files`` of the same shape; where
    several rows name a path, each row of the manifest is held against each file."""
    keys = ["run_id", "path"]
    hashed = files.filter("sha256 IS NOT NULL")
    bare = files.filter("sha256 IS NULL").groupBy(*keys).agg(F.count("*").alias("n"))
    unhashed = manifest.groupBy(*keys).agg(F.count("*").alias("m")).join(bare, keys).select(*keys, (F.col("m") * F.col("n")).alias("n"))
    absent = manifest.select(*keys).join(files.select(*keys), keys, "left_anti")
    twice = manifest.groupBy("run_id", F.lower("path").alias("path")).agg(F.count("*").alias("n")).filter("n > 1")
    pairs = lambda rows, rule: _repeated(_found(rows, rule, F.col("path"), carried=["n"]))
    return union([
        _found(manifest.filter(~is_portable_path(F.col("path"))), "path_not_portable", F.col("path")), _found(absent, "file_absent", F.col("path")), pairs(unhashed, "file_absent"), pairs(_differing(manifest, files, "sha256"), "file_hash"),
        pairs(_differing(manifest, hashed, "size_bytes"), "file_size"), _found(twice, "path_twice", F.col("path")), _found(files.join(manifest.select(*keys), keys, "left_anti"), "file_undeclared", F.col("path")),
    ])


def numbered(checks: DataFrame) -> DataFrame:
    """Checks with ``check_id`` and their ordinal among the checks of the same rule and document, in canonical order."""
    order = Window.partitionBy("run_id", "document_id", "rule").orderBy("subject", "code")
    rows = checks.withColumn("ordinal", (F.row_number().over(order) - 1).cast("long"))
    identity = stable_id("check", canonical_json(document_id=F.col("document_id"), ordinal=F.col("ordinal"), rule=F.col("rule"), run_id=F.col("run_id")))
    return rows.select(identity.alias("check_id"), *CHECK, "ordinal")


def document_results(documents: DataFrame, checks: DataFrame) -> DataFrame:
    """(run_id, document_id, status, n_checks, eligible): a document's status from the checks that fail on it."""
    level = F.when(F.col("blocking") & F.col("kind").isin("security", "policy", "rendering"), "rejected").when(F.col("blocking"), "error").when(F.col("level") == "warning", "review").otherwise("ok")
    own = checks.filter("document_id IS NOT NULL").groupBy("run_id", "document_id").agg(F.count("*").alias("n_checks"), F.max(rank(level, STATUS)).alias("r"))
    rows = documents.select(F.col("run_id").cast("string").alias("run_id"), F.col("document_id").cast("string").alias("document_id")).distinct().join(own, ["run_id", "document_id"], "left")
    status = state_of(F.coalesce("r", F.lit(0)), STATUS)
    return rows.select("run_id", "document_id", status.alias("status"), F.coalesce("n_checks", F.lit(0)).alias("n_checks"), status.isin("ok", "review").alias("eligible"))


def package_results(documents: DataFrame, checks: DataFrame) -> DataFrame:
    """(run_id, status, n_documents, n_ok, n_review, n_rejected, n_error, n_blocking, n_warnings, eligible).

    Anything blocking makes a package rejected if it is a matter of security or policy, else an error; without, its
    documents' gravest status counts, and at least review if anything warns. It may be committed if it is ok or under
    review, nothing blocks and every document is eligible.
    """
    found = checks.groupBy("run_id").agg(F.count_if("blocking").alias("n_blocking"), F.count_if(F.col("level") == "warning").alias("n_warnings"), F.count_if(F.col("blocking") & ~F.col("kind").isin("security", "policy", "rendering")).alias("n_errors"))
    own = document_results(documents, checks).groupBy("run_id").agg(F.count("*").alias("n_documents"), *[F.count_if(F.col("status") == n).alias(f"n_{n}") for n in STATUS[:4]], F.max(rank(F.col("status"), STATUS)).alias("r"), F.bool_and("eligible").alias("all_eligible"))
    rows = own.join(found, "run_id", "full_outer").fillna(0, ["n_blocking", "n_warnings", "n_errors", "n_documents", "r", *[f"n_{n}" for n in STATUS[:4]]])
    base = F.greatest(F.col("r"), F.when(F.col("n_warnings") > 0, 1).otherwise(0))
    status = F.when(F.col("n_errors") > 0, "error").when(F.col("n_blocking") > 0, "rejected").otherwise(state_of(base, STATUS))
    eligible = status.isin("ok", "review") & (F.col("n_blocking") == 0) & F.coalesce("all_eligible", F.lit(False))
    return rows.select("run_id", status.alias("status"), "n_documents", *[f"n_{n}" for n in STATUS[:4]], "n_blocking", "n_warnings", eligible.alias("eligible"))
