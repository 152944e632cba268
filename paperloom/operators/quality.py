"""Coverage counters, scores, losses, transitions, round-trip risk and statuses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.identity import canonical_json, stable_id
from ..functions.ranks import EXACTNESS, STATUS, gravest, rank, state_of
from ..functions.scalar import weighted_ratio


def measurements(rows: DataFrame, keys: list[str], rendered_stage: Column | None = None) -> DataFrame:
    """Counters per feature from one row per id: (required, preserved, opaque, unsupported: booleans; projected and
    rendered: best exactness or null). Rendered quality approximates only in stages that render."""
    stage = F.lit(False) if rendered_stage is None else rendered_stage
    weak = lambda c: F.coalesce(F.col(c).isin("approximate", "inferred"), F.lit(False))
    approximated = weak("projected") | (stage & weak("rendered"))
    effective = F.col("required") & F.col("projected").isNotNull()
    return rows.groupBy(*keys).agg(
        F.count("*").alias("encountered"), F.count_if("required").alias("required"), F.count_if("preserved").alias("preserved"), F.count("projected").alias("projected"), F.count("rendered").alias("rendered"),
        F.count_if("opaque").alias("opaque"), F.count_if(approximated).alias("approximated"), F.count_if("unsupported").alias("unsupported"), F.count_if(F.col("required") & F.col("projected").isNull()).alias("omitted"),
        F.count_if(effective & ~approximated).alias("exact_hits"), F.count_if(effective & approximated).alias("approximate_hits"),
    )


ROLES = ["required", "preserved", "projected", "rendered", "omitted", "approximated", "unsupported"]


def id_facts(ids: DataFrame, members: DataFrame, edges: DataFrame) -> DataFrame:
    """Rows for ``measurements`` and ``references``: what is known of each id of a feature, by the algebra of id sets.

    ``ids(document_id, feature, stage, entity_id, narrows)`` are the ids met; ``narrows`` lists the sets that hold only
    some of them (``required``, ``preserved``): a set that a feature doesn't narrow holds all. ``members(document_id,
    role, entity_id)`` are those sets, and ``opaque`` and ``unsupported``, which are empty unless given.
    ``edges(document_id, side, entity_id, exactness)`` are the edges on which an id stands, of the side ``projected`` or
    ``rendered``; the best counts. Sets and edges are aggregated to one row per id before they are joined.
    """
    roles = members.select("document_id", "entity_id", "role", F.lit(None).cast("int").alias("r"))
    sides = edges.select("document_id", "entity_id", F.col("side").alias("role"), rank(F.col("exactness"), EXACTNESS).alias("r"))
    has = lambda name: F.bool_or(F.col("role") == name).alias(f"in_{name}")
    best = lambda name: state_of(F.max(F.when(F.col("role") == name, F.col("r"))), EXACTNESS).alias(name)
    known = roles.unionByName(sides).groupBy("document_id", "entity_id").agg(*[has(n) for n in ("required", "preserved", "opaque", "unsupported")], best("projected"), best("rendered"))
    rows = ids.dropDuplicates(["document_id", "feature", "entity_id"]).join(known, ["document_id", "entity_id"], "left")
    within = lambda name: F.coalesce(F.col(f"in_{name}"), F.lit(False))
    narrowed = lambda name: (within(name) | ~F.array_contains("narrows", name)).alias(name)
    return rows.select("document_id", "feature", "stage", "entity_id", narrowed("required"), narrowed("preserved"), within("opaque").alias("opaque"), within("unsupported").alias("unsupported"), "projected", "rendered")


def references(facts: DataFrame) -> DataFrame:
    """(document_id, feature, role, entity_id): the ids that a measurement refers to, by ROLES; a relation, no lists."""
    weak = lambda c: F.coalesce(F.col(c).isin("approximate", "inferred"), F.lit(False))
    holds = {
        "required": F.col("required"), "preserved": F.col("preserved"), "projected": F.col("projected").isNotNull(), "rendered": F.col("rendered").isNotNull(), "omitted": F.col("required") & F.col("projected").isNull(),
        "approximated": weak("projected") | (F.col("stage").isin(RENDERING_STAGES) & weak("rendered")), "unsupported": F.col("unsupported"),
    }
    own = F.array_compact(F.array(*[F.when(holds[r], r) for r in ROLES]))
    return facts.select("document_id", "feature", F.explode(own).alias("role"), "entity_id")


def axis_scores(measured: DataFrame, keys: list[str]) -> DataFrame:
    """Score per axis over its features: null where nothing is required."""
    total = measured.groupBy(*keys, "axis").agg(F.sum("exact_hits").alias("e"), F.sum("approximate_hits").alias("a"), F.sum("required").alias("t"))
    return total.select(*keys, "axis", weighted_ratio(F.col("e"), F.col("a"), F.col("t")).alias("score"))


def visual_score(surface: Column, visible: Column, geometry: Column) -> Column:
    """Product of the factors that exist; null without an assessed surface."""
    return F.bround(surface * F.coalesce(visible, F.lit(1.0)) * F.coalesce(geometry, F.lit(1.0)), 6)


def losses(measured: DataFrame, keys: list[str]) -> DataFrame:
    """One row per feature and kind of loss that happened."""
    kinds = [("omitted", F.col("omitted")), ("approximated", F.col("approximated")), ("unsupported", F.col("unsupported"))]
    found = F.filter(F.array(*[F.when(n > 0, F.struct(F.lit(k).alias("kind"), n.alias("n"))) for k, n in kinds]), lambda x: x.isNotNull())
    rows = measured.select(*keys, "feature", "severity", F.explode(found).alias("loss")).select(*keys, "feature", "severity", "loss.kind", F.col("loss.n").alias("n_refs"))
    identity = stable_id("loss", canonical_json(feature=F.col("feature"), kind=F.col("kind"), **{k: F.col(k).cast("string") for k in keys}))
    return rows.select(identity.alias("loss_id"), *keys, "feature", "severity", "kind", "n_refs")


def roundtrip(major: Column, minor: Column, legacy: Column, text_only: Column) -> tuple[Column, Column]:
    """(score, risk) of writing a document back."""
    score = F.when(legacy, 0.25).otherwise(1 - F.least(F.lit(0.9), major * 0.2 + minor * 0.05))
    score = F.bround(F.when(text_only, score).otherwise(F.least(score, F.lit(0.95))), 6)
    risk = F.when(score >= 1, "none").when(score >= 0.85, "low").when(score >= 0.6, "medium").otherwise("high")
    return score, risk


def transitions(edges: DataFrame, keys: list[str]) -> DataFrame:
    """Per pair of layers: edges, least confidence, worst exactness and state."""
    order = {"exact": 0, "approximate": 1, "inferred": 2}
    weight = F.when(F.col("exactness") == "exact", 0).when(F.col("exactness") == "approximate", 1).otherwise(2)
    rows = edges.groupBy(*keys, "from_layer", "to_layer").agg(F.count("*").alias("n_edges"), F.min("confidence").alias("confidence"), F.max(weight).alias("w"))
    names = F.array(*[F.lit(k) for k in order])
    state = F.when(F.col("w") == 0, "preserved").otherwise("preserved_with_loss")
    return rows.select(*keys, "from_layer", "to_layer", "n_edges", "confidence", F.element_at(names, F.col("w") + 1).alias("exactness"), state.alias("state"))


def document_status(severities: DataFrame, keys: list[str], major: str = "review", minor: str = "ok") -> DataFrame:
    """Status from loss severities: critical and error act as ``major`` says, warnings as ``minor`` says."""
    state = F.when(F.col("severity").isin("critical", "error"), major).when(F.col("severity") == "warning", minor).otherwise("ok")
    return severities.groupBy(*keys).agg(gravest(state, STATUS).alias("status"))


def package_summary(documents: DataFrame, package: str) -> DataFrame:
    """Counts by status, the package's status and whether it may be committed."""
    n = lambda s: F.count_if(F.col("status") == s)
    eligible = F.bool_and(F.col("status").isin("ok", "review"))
    return documents.groupBy(package).agg(F.count("*").alias("n_documents"), n("ok").alias("n_ok"), n("review").alias("n_review"), n("rejected").alias("n_rejected"), n("error").alias("n_error"), gravest(F.col("status"), STATUS).alias("status"), eligible.alias("eligible"))


def broken_counters(measured: DataFrame, keys: list[str]) -> DataFrame:
    """Measurements whose counters contradict each other."""
    limit = [F.col(c) > F.col("encountered") for c in ("required", "preserved", "projected", "rendered", "opaque", "approximated", "unsupported", "omitted")]
    bad = limit[0]
    for x in limit[1:]:
        bad = bad | x
    return measured.filter(bad | (F.col("omitted") > F.col("required"))).select(*keys)


# --- features of documents ----------------------------------------------------------------------------------------------

# Feature -> (axis, stage, severity), and the features that each axis is made of ----------------------------
FEATURES = {
    "binary_artifact": ("binary", "binary_to_container", "critical"), "container_part": ("structural", "container_to_native", "info"), "container_relationship": ("relationship", "binary_to_container", "info"),
    "native_core_unit": ("structural", "native_to_technical_ir", "error"), "native_style": ("style", "native_to_technical_ir", "warning"), "native_relationship": ("relationship", "native_to_technical_ir", "error"),
    "native_metadata": ("technical_semantic", "native_to_technical_ir", "warning"), "native_annotation": ("technical_semantic", "native_to_technical_ir", "error"), "native_resource": ("technical_semantic", "native_to_technical_ir", "error"),
    "resource_occurrence": ("structural", "native_to_technical_ir", "warning"), "formula": ("computational", "native_to_technical_ir", "critical"), "revision": ("technical_semantic", "native_to_technical_ir", "error"),
    "interactive_content": ("interactive", "native_to_technical_ir", "warning"), "opaque_content": ("roundtrip", "roundtrip", "warning"), "rendered_surface": ("visual", "native_to_rendered", "error"),
    "rendered_native_visibility": ("visual", "native_to_rendered", "error"), "visible_geometry_coverage": ("visual", "native_to_rendered", "error"), "rendered_geometry": ("visual", "native_to_rendered", "error"),
    "derived_asset": ("visual", "rendered_to_asset", "error"), "source_rendering_attempt": ("visual", "native_to_rendered", "error"), "required_source_rendering": ("visual", "native_to_rendered", "error"),
    "legacy_semantic_decode": ("technical_semantic", "native_to_technical_ir", "error"), "technical_ir_projection_warning": ("technical_semantic", "native_to_technical_ir", "warning"),
}
AXES = {
    "binary": ["binary_artifact"], "structural": ["native_core_unit", "resource_occurrence"], "style": ["native_style"], "relationship": ["native_relationship"], "computational": ["formula"], "interactive": ["interactive_content"],
    "technical_semantic": ["native_core_unit", "native_metadata", "native_annotation", "native_resource", "revision", "technical_ir_projection_warning", "legacy_semantic_decode"],
}
VISUAL = ["rendered_surface", "rendered_native_visibility", "visible_geometry_coverage"]
RENDERING_STAGES = ["native_to_rendered", "rendered_to_asset"]


def facts(rows: DataFrame, feature: str | Column, required: Column | bool = True, preserved: Column | bool = True, opaque: Column | bool = False, unsupported: Column | bool = False, projected: Column | None = None, rendered: Column | None = None, severity: Column | None = None) -> DataFrame:
    """Rows for ``measurements`` from ``rows(document_id, ...)``, one for each id of a feature."""
    name = F.lit(feature) if isinstance(feature, str) else feature
    of = lambda i: F.element_at(F.create_map(*[x for k, v in FEATURES.items() for x in (F.lit(k), F.lit(v[i]))]), name)
    given = lambda x: F.lit(x) if isinstance(x, bool) else F.coalesce(x, F.lit(False))
    none = F.lit(None).cast("string")
    return rows.select(
        "document_id", name.alias("feature"), of(0).alias("axis"), of(1).alias("stage"), F.coalesce(severity if severity is not None else none, of(2)).alias("severity"), given(required).alias("required"), given(preserved).alias("preserved"),
        given(opaque).alias("opaque"), given(unsupported).alias("unsupported"), (projected if projected is not None else none).alias("projected"), (rendered if rendered is not None else none).alias("rendered"),
    )


def feature_measurements(rows: DataFrame) -> DataFrame:
    """Counters of every document and feature; only the rendering stages count what rendering approximates."""
    return measurements(rows, ["document_id", "feature", "axis", "stage", "severity"], F.col("stage").isin(RENDERING_STAGES))


def document_scores(measured: DataFrame, lost: DataFrame, formats: DataFrame) -> DataFrame:
    """(document_id, axis, score) of the nine axes; null where nothing is required.

    ``formats(document_id, legacy, text_only)``. The visual score is the product of the factors that exist, null
    without an assessed surface; the round trip follows from what was lost.
    """
    pairs = F.array(*[F.struct(F.lit(a).alias("axis"), F.lit(f).alias("feature")) for a, fs in AXES.items() for f in fs])
    own = measured.withColumn("pair", F.explode(F.filter(pairs, lambda p: p["feature"] == F.col("feature"))))
    plain = axis_scores(own.select("document_id", F.col("pair.axis").alias("axis"), "exact_hits", "approximate_hits", "required"), ["document_id"])
    every = formats.select("document_id", F.explode(F.array(*[F.lit(a) for a in AXES])).alias("axis")).join(plain, ["document_id", "axis"], "left")
    factor = lambda f: F.max(F.when(F.col("feature") == f, weighted_ratio(F.col("exact_hits"), F.col("approximate_hits"), F.col("required"))))
    seen = measured.groupBy("document_id").agg(visual_score(*[factor(f) for f in VISUAL]).alias("score"))
    visual = formats.select("document_id").join(seen, "document_id", "left").select("document_id", F.lit("visual").alias("axis"), "score")
    grave, light = F.col("severity").isin("critical", "error"), F.col("severity") == "warning"
    counts = lost.groupBy("document_id").agg(F.count_if(grave).alias("major"), F.count_if(light).alias("minor"))
    rows = formats.join(counts, "document_id", "left").fillna(0, ["major", "minor"])
    back = rows.select("document_id", F.lit("roundtrip").alias("axis"), roundtrip(F.col("major"), F.col("minor"), F.col("legacy"), F.col("text_only"))[0].alias("score"))
    return every.select("document_id", "axis", "score").unionByName(visual).unionByName(back)


def quality_failures(measured: DataFrame, lost: DataFrame, changes: DataFrame, scores: DataFrame) -> DataFrame:
    """(document_id, rule, subject): counters over what was met, losses with a wrong id or without a measurement, links
    of transitions that don't follow each other, scores out of range or of unknown axes, features that don't exist."""
    of = lambda rows, rule, subject: rows.select("document_id", F.lit(rule).alias("rule"), subject.cast("string").alias("subject"))
    over = F.lit(False)
    for c in ("required", "preserved", "projected", "rendered", "opaque", "approximated", "unsupported", "omitted"):
        over = over | (F.col(c) > F.col("encountered")) | (F.col(c) < 0)
    identity = stable_id("loss", canonical_json(document_id=F.col("document_id").cast("string"), feature=F.col("feature"), kind=F.col("kind")))
    order = F.array(*[F.lit(x) for x in ("binary", "container", "native", "technical_ir", "rendered", "geometry", "asset")])
    twice = measured.groupBy("document_id", "feature").agg(F.count("*").alias("n"), F.count_distinct("severity").alias("s")).filter("n > s").drop("s")
    parts = [
        of(measured.filter(over), "counter_over_encountered", F.col("feature")), of(measured.filter("omitted > required"), "omitted_over_required", F.col("feature")), of(measured.filter(~F.col("feature").isin(list(FEATURES))), "unknown_feature", F.col("feature")), of(twice, "feature_twice", F.col("feature")),
        of(lost.filter(F.col("loss_id") != identity), "loss_id", F.col("loss_id")), of(lost.join(measured, ["document_id", "feature"], "left_anti"), "loss_without_measurement", F.col("loss_id")), of(lost.groupBy("document_id", "loss_id").agg(F.count("*").alias("n")).filter("n > 1"), "loss_twice", F.col("loss_id")),
        of(changes.filter(F.array_position(order, F.col("from_layer")) >= F.array_position(order, F.col("to_layer"))), "transition_backward", F.col("from_layer")), of(changes.filter(~F.col("confidence").between(0, 1)), "transition_confidence", F.col("from_layer")),
        of(scores.filter(~F.col("axis").isin([*AXES, "visual", "roundtrip"])), "unknown_axis", F.col("axis")), of(scores.filter(~F.col("score").between(0, 1)), "score_range", F.col("axis")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
