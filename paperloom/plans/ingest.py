"""The whole ingestion as one dataflow over many documents: artifacts in, relational catalogs out.

Every stage is a function of earlier tables, so that a caller can take a prefix, replace a stage or read a stage back
from storage. ``write`` materializes the stages in order, records each in the run log, and on a later run with the
same request starts after the last stage that is complete.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import storage
from ..functions.identity import bundle_hash, canonical_json, stable_id
from ..functions.ranks import EXACTNESS, rank, state_of
from ..functions.scalar import normal_part_path, property_names
from ..operators import digests, graph, ir, mapping, package, parts, quality, security, surfaces, validate
from ..sources import access, acquire, containers, native, probe
from ..sources.ids import content_hash


@dataclass(frozen=True)
class Policy:
    budget: security.Budget = security.Budget()
    render: str = "none"
    major_loss: str = "review"
    minor_loss: str = "ok"
    reject_encrypted: bool = False
    #: Profiles asked for; without any, rendering gives what a renderer can do best.
    profiles: tuple[str, ...] = ()
    #: Documents whose secret is at hand.
    secrets: tuple[str, ...] = ()


Tables = dict[str, DataFrame]


def documents(t: Tables, policy: Policy) -> DataFrame:
    return probe.probe(t["artifacts"])


def members(t: Tables, policy: Policy) -> DataFrame:
    found = containers.members(t["artifacts"])
    return found.withColumn("kind", parts.part_kind(F.col("path"), F.col("media_type"))).withColumn("flags", parts.security_flags(F.col("path"), F.col("media_type"), F.col("encrypted")))


def part_relationships(t: Tables, policy: Policy) -> DataFrame:
    return containers.part_relationships(t["artifacts"])


def security_findings(t: Tables, policy: Policy) -> DataFrame:
    """Findings of members, and of formats that are unknown or differ from their name."""
    totals = security.package_totals(t["members"].withColumnRenamed("document_id", "package_id"))
    docs = t["documents"]
    odd = F.array(
        F.when(F.col("format_name") == "unknown_binary", F.struct(F.lit("DS-PRB-002").alias("code"), F.lit("warning").alias("severity"), F.lit("review").alias("effect"))),
        F.when(F.col("extension_mismatch"), F.struct(F.lit("DS-PRB-003").alias("code"), F.lit("warning").alias("severity"), F.lit("review").alias("effect"))),
        F.when(~F.col("readable"), F.struct(F.lit("DS-SEC-001").alias("code"), F.lit("critical").alias("severity"), F.lit("block").alias("effect"))),
    )
    more = docs.select(F.col("document_id").alias("package_id"), F.explode(F.filter(odd, lambda x: x.isNotNull())).alias("x")).select("package_id", "x.code", "x.severity", "x.effect")
    return security.findings(totals, policy.budget).unionByName(more).distinct()


def restrictions(t: Tables, policy: Policy) -> DataFrame:
    """(document_id, restriction): what stays closed or unresolved, by members and relationships."""
    rows = t["members"].select("document_id", F.explode(security.member_restrictions(F.col("path"), F.col("flags"), F.col("encrypted"))).alias("restriction"))
    outside = t["part_relationships"].filter("external").select("document_id", F.lit("external_references_not_resolved").alias("restriction"))
    return rows.unionByName(outside).distinct()


def decisions(t: Tables, policy: Policy) -> DataFrame:
    """Encrypted entries are for review; every other restriction restricts."""
    closed = t["restrictions"].filter("restriction = 'encrypted_entries_not_read'").select(F.col("document_id").alias("package_id"), F.lit("DS-SEC-004").alias("code"), F.lit("warning").alias("severity"), F.lit("review").alias("effect"))
    bound = t["restrictions"].groupBy("document_id").agg(F.lit(True).alias("restricted"))
    totals = t["documents"].select("document_id").distinct().join(bound, "document_id", "left").select(F.col("document_id").alias("package_id"), F.coalesce("restricted", F.lit(False)).alias("restricted"))
    return security.decisions(totals, t["security_findings"].unionByName(closed), F.col("restricted")).withColumnRenamed("package_id", "document_id")


def identity(t: Tables, policy: Policy) -> DataFrame:
    """(document_id, identity_hash) of the artifacts that hold a document."""
    have = t["artifacts"].columns
    ordinal = F.col("ordinal") if "ordinal" in have else F.lit(0).cast("long")  # files of a stream have neither
    role = F.col("role") if "role" in have else F.lit("primary")
    rows = t["artifacts"].select("document_id", ordinal.alias("ordinal"), role.alias("role"), "sha256").distinct()
    return rows.groupBy("document_id").agg(bundle_hash(F.collect_list(F.struct("ordinal", "role", "sha256"))).alias("identity_hash"))  # as many as a document has copies


def access_states(t: Tables, policy: Policy) -> DataFrame:
    found = access.inspect(t["artifacts"], t["documents"])
    known = t["artifacts"].filter(F.col("document_id").isin(list(policy.secrets))).select("document_id")
    return access.states(found, t["decisions"], known, policy.reject_encrypted)


def decode_attempts(t: Tables, policy: Policy) -> DataFrame:
    """Units of the documents that are open, failures among them; a document held by several artifacts is decoded once."""
    allowed = t["access_states"].filter("access_state LIKE 'clear%'").select("document_id")
    once = t["artifacts"].join(allowed, "document_id", "left_semi").groupBy("document_id").agg(F.min("artifact_id").alias("artifact_id"))
    return native.attempts(t["artifacts"].join(once, ["document_id", "artifact_id"], "left_semi"), t["documents"])


def native_units(t: Tables, policy: Policy) -> DataFrame:
    return t["decode_attempts"].filter(F.col("kind") != native.FAILURE)


def decode_failures(t: Tables, policy: Policy) -> DataFrame:
    return native.failures(t["decode_attempts"])


def resources(t: Tables, policy: Policy) -> DataFrame:
    """(document_id, resource_id, kind, path, part_id, active): parts that are images, embedded files, macros, fonts and such."""
    kind = parts.resource_kind(F.col("path"), F.col("media_type"), F.col("flags"))
    rows = t["members"].withColumn("kind", kind).filter("kind IS NOT NULL")
    return rows.select("document_id", stable_id("resource", canonical_json(document_id=F.col("document_id"), part_id=F.col("part_id"))).alias("resource_id"), "kind", "path", "part_id", F.col("kind").isin("macro_project", "activex_control").alias("active"))


def occurrences(t: Tables, policy: Policy) -> DataFrame:
    """(document_id, occurrence_id, resource_id, source_path): relationships that lead to a resource."""
    own = t["resources"].select("document_id", F.col("path").alias("target"), "resource_id")
    rows = t["part_relationships"].filter("NOT external").join(own, ["document_id", "target"])
    return rows.select("document_id", stable_id("occurrence", canonical_json(relationship=F.col("relationship_id"), resource=F.col("resource_id"))).alias("occurrence_id"), "resource_id", "source_path")


def styles(t: Tables, policy: Policy) -> DataFrame:
    """(document_id, native_style, name, value): own and inherited properties of every style."""
    own = t["native_units"].filter("kind = 'style' AND properties['native'] IS NOT NULL").select("document_id", F.col("properties")["native"].alias("native_style"), F.element_at("properties", F.lit("based_on")).alias("based_on"), "properties")
    node = lambda c: F.concat_ws("\u001f", "document_id", c)
    values = own.select(node("native_style").alias("node"), F.explode("properties").alias("name", "value")).filter(~F.col("name").isin("native", "based_on", "style_kind"))
    edges = own.filter("based_on IS NOT NULL").select(node("native_style").alias("node"), node("based_on").alias("parent"))
    parts_of = F.split("node", "\u001f")
    found = graph.inherited(values, edges).select(parts_of[0].alias("document_id"), parts_of[1].alias("native_style"), "name", "value")
    return found.join(own.select("document_id", "native_style").distinct(), ["document_id", "native_style"], "left_semi")


def metadata(t: Tables, policy: Policy) -> DataFrame:
    """(document_id, unit_id, namespace, name, canonical_name, value, sensitivity) of all metadata."""
    of = lambda name: F.element_at("properties", F.lit(name))
    rows = t["native_units"].filter("kind = 'metadata'").select("document_id", "unit_id", of("namespace").alias("namespace"), of("name").alias("name"), F.col("text").alias("value"), of("sensitivity").alias("sensitivity"))
    return property_names(rows, "name", "canonical_name")


def ir_units(t: Tables, policy: Policy) -> DataFrame:
    """The uniform tree: native units below the document's root, then relationships and resources in that order."""
    units = t["native_units"]
    base = ir.project(units)
    decoded = units.select("document_id").distinct()
    links = t["part_relationships"].join(decoded, "document_id", "left_semi").select("document_id", F.col("relationship_id").alias("native_id"), F.col("target").alias("text"), "external")
    with_links = base.unionByName(ir.append_catalog(base, links, F.when(F.col("external"), "external_relationship").otherwise("relationship"), F.col("external")))
    kept = t["resources"].join(decoded, "document_id", "left_semi").select("document_id", F.col("resource_id").alias("native_id"), F.col("path").alias("text"), F.col("kind").alias("resource_kind"))
    out = with_links.unionByName(ir.append_catalog(with_links, kept, F.concat(F.lit("resource_"), F.col("resource_kind")), F.lit(True)))
    return ir.roots(decoded).unionByName(out)


def ir_warnings(t: Tables, policy: Policy) -> DataFrame:
    """(document_id, unit_id, warning, reference): styles and resources that units name and nothing defines."""
    units = t["native_units"]
    style = F.element_at("properties", F.lit("style"))
    used = units.filter(F.col("kind").isin("paragraph", "run") & style.isNotNull()).select("document_id", "unit_id", style.alias("reference"))
    defined = units.filter("kind = 'style'").select("document_id", F.col("properties")["native"].alias("reference"))
    missing = used.join(defined, ["document_id", "reference"], "left_anti").select("document_id", "unit_id", F.lit("unresolved_style").alias("warning"), "reference")
    named = units.filter(F.element_at("properties", F.lit("resources")).isNotNull()).select("document_id", "unit_id", F.explode(F.split(F.element_at("properties", F.lit("resources")), ",")).alias("reference"))
    lost = named.join(t["resources"].select("document_id", F.col("path").alias("reference")), ["document_id", "reference"], "left_anti").select("document_id", "unit_id", F.lit("unresolved_resource").alias("warning"), "reference")
    return missing.unionByName(lost)


def marks(t: Tables, policy: Policy) -> DataFrame:
    """Where units show on previews; nothing if rendering is switched off or not asked for."""
    off = policy.render == "none" or (policy.render == "on_demand" and not policy.profiles)
    table_cells = F.when((F.col("kind") == "cell") & F.element_at("properties", F.lit("at")).isNull(), "table_cell").otherwise(F.col("kind"))
    units = t["native_units"].withColumn("kind", table_cells)
    return surfaces.marks(units.limit(0) if off else units)


def surface_table(t: Tables, policy: Policy) -> DataFrame:
    off = policy.render == "none" or (policy.render == "on_demand" and not policy.profiles)
    return surfaces.surfaces(t["marks"], t["native_units"].limit(0) if off else t["native_units"])


def views(t: Tables, policy: Policy) -> DataFrame:
    open_documents = t["documents"].join(t["access_states"].filter("access_state LIKE 'clear%'").select("document_id"), "document_id", "left_semi")
    return surfaces.views(open_documents, t["surfaces"], policy.render, list(policy.profiles))


def _natives(t: Tables) -> DataFrame:
    """(document_id, native_id, kind, address): units, relationships, resources and occurrences of decoded documents."""
    units = t["native_units"].select("document_id", F.col("unit_id").alias("native_id"), "kind", "address")
    decoded = t["native_units"].select("document_id").distinct()
    more = [
        t["part_relationships"].select("document_id", F.col("relationship_id").alias("native_id"), F.lit("native_relationship").alias("kind"), F.col("source_path").alias("address")),
        t["resources"].select("document_id", F.col("resource_id").alias("native_id"), F.lit("native_resource").alias("kind"), F.col("path").alias("address")),
        t["occurrences"].select("document_id", F.col("occurrence_id").alias("native_id"), F.lit("resource_occurrence").alias("kind"), F.col("source_path").alias("address")),
    ]
    for rows in more:
        units = units.unionByName(rows.join(decoded, "document_id", "left_semi"))
    return units


def entities(t: Tables, policy: Policy) -> DataFrame:
    """(document_id, layer, entity_id, kind, address, owner) of all representations."""
    none = F.lit(None).cast("string")
    of = lambda df, layer, entity, kind, address=none, owner=none: df.select("document_id", F.lit(layer).alias("layer"), F.col(entity).alias("entity_id"), (F.lit(kind) if isinstance(kind, str) else kind).alias("kind"), address.alias("address"), owner.alias("owner"))
    return mapping.inventory([
        of(t["artifacts"], "binary", "artifact_id", "artifact", F.col("display_name")), of(t["members"], "container", "part_id", F.col("kind"), F.col("path")), of(_natives(t), "native", "native_id", F.col("kind"), F.col("address")),
        of(t["ir_units"], "technical_ir", "unit_id", F.col("kind"), none, F.col("parent_id")), of(t["surfaces"], "rendered", "surface_id", F.col("surface_kind"), none, F.col("owner_id")), of(t["spaces"], "geometry", "space_id", "coordinate_space", none, F.col("surface_id")),
        of(t["geometry"], "geometry", "geometry_id", "box", none, F.col("unit_id")), of(t["assets"].dropDuplicates(["document_id", "asset_id"]), "asset", "asset_id", F.col("media_type"), F.col("sha256")),
    ])


def edges(t: Tables, policy: Policy) -> DataFrame:
    """All relations between the representations of a document, each edge once."""
    rel, d = mapping.relation, "document_id"
    copies = t["artifacts"].groupBy(d).agg(F.min("artifact_id").alias("artifact_id"), F.count("*").alias("copies"))
    natives, units, ir_rows = _natives(t), t["native_units"], t["ir_units"]
    held = t["members"].select(d, "part_id").join(copies, d)
    one = F.col("copies") == 1
    linked = t["part_relationships"].select(d, F.col("relationship_id").alias("reference"), F.col("target").alias("path"))
    reference = F.when(F.col("kind").isin("native_relationship", "resource_occurrence"), F.col("native_id"))
    origins = mapping.prioritized_origins(natives.select(d, "native_id", normal_part_path(F.coalesce("address", F.lit(""))).alias("part_path"), reference.alias("reference")), t["members"].select(d, "part_id", "path"), linked)
    projected = ir_rows.filter("native_id IS NOT NULL").select(d, "native_id", F.col("unit_id").alias("ir_id"))
    shown_units = units.select(d, F.col("unit_id").alias("native_id"), F.element_at("properties", F.lit("style")).alias("style"), F.element_at("properties", F.lit("resources")).alias("used"), "parent_id").join(projected, [d, "native_id"])
    defined = units.filter("kind = 'style'").select(d, F.coalesce(F.element_at("properties", F.lit("native")), F.col("ordinal").cast("string")).alias("style"), F.col("unit_id").alias("style_id"))
    uses = shown_units.select(d, "ir_id", F.explode(F.split("used", ",")).alias("path")).join(t["resources"].select(d, "path", "resource_id"), [d, "path"])
    roots = ir_rows.filter("origin = 'synthetic'").select(d, F.col("unit_id").alias("root_id"))
    tops = units.filter("parent_id IS NULL").select(d, F.col("unit_id").alias("native_id")).join(roots, d)
    boxes, all_surfaces = t["geometry"], t["surfaces"]
    on_marks = boxes.select(d, F.col("unit_id").alias("native_id"), "surface_id", "geometry_id", "is_clipped")
    on_owner = all_surfaces.filter("owner_id IS NOT NULL").select(d, F.col("owner_id").alias("native_id"), "surface_id", F.col("fidelity") == "not_assessed").toDF(d, "native_id", "surface_id", "blind")
    seen = on_marks.select(d, "native_id", "surface_id", F.lit("approximate").alias("exactness"), F.lit(0.7).alias("confidence")).unionByName(on_owner.select(d, "native_id", "surface_id", F.when(F.col("blind"), "inferred").otherwise("approximate").alias("exactness"), F.when(F.col("blind"), 0.5).otherwise(0.7).alias("confidence")))
    through = seen.join(projected, [d, "native_id"]).groupBy(d, "ir_id", "surface_id").agg(F.max(rank(F.col("exactness"), EXACTNESS)).alias("r"), F.max("confidence").alias("confidence")).withColumn("exactness", state_of(F.col("r"), EXACTNESS))
    made = t["assets"].select(d, "asset_id", "surface_id", "role")
    rows = [
        rel(held, "contains_container_entities", "artifact_id", "part_id", F.when(one, "exact").otherwise("inferred"), F.when(one, 1.0).otherwise(0.8)),
        rel(origins, "decodes_as_native", "part_id", "native_id", F.col("exactness"), F.col("confidence"), F.col("method")),
        rel(origins.filter("part_id IS NULL").join(copies, d), "decoded_as_native", "artifact_id", "native_id", "inferred", 0.5),
        rel(projected, "projects_to", "native_id", "ir_id"), rel(shown_units.join(defined, [d, "style"]), "applies_style_to", "style_id", "ir_id"), rel(uses, "uses_resource_in", "resource_id", "ir_id"), rel(tops, "organizes_under_synthetic_root", "native_id", "root_id"),
        rel(t["occurrences"].join(projected.withColumnRenamed("native_id", "resource_id"), [d, "resource_id"]), "projects_to", "occurrence_id", "ir_id"),
        rel(seen, "renders_on_surface", "native_id", "surface_id", F.col("exactness"), F.col("confidence")), rel(through, "represented_on_surface", "ir_id", "surface_id", F.col("exactness"), F.col("confidence")),
        rel(t["spaces"], "defines_coordinate_space", "surface_id", "space_id"), rel(boxes, "has_geometry", "surface_id", "geometry_id"),
        rel(on_marks, "localized_in_geometry", "native_id", "geometry_id", F.when(F.col("is_clipped"), "approximate").otherwise("exact"), F.when(F.col("is_clipped"), 0.7).otherwise(1.0)),
        rel(made, "materializes_as_asset", "surface_id", "asset_id"), rel(made.filter("role = 'passthrough'").join(copies, d), "derives_asset", "artifact_id", "asset_id"),
    ]
    out = mapping.inventory(rows).groupBy("document_id", "relation", "source_layer", "source_id", "target_layer", "target_id").agg(F.max(F.struct(rank(F.col("exactness"), EXACTNESS).alias("r"), "confidence", "exactness", "method")).alias("best"))
    out = out.select("document_id", "relation", "source_layer", "source_id", "target_layer", "target_id", "best.exactness", "best.confidence", "best.method")
    return out.select(mapping.mapping_id().alias("mapping_id"), "*", F.lit(mapping.PRODUCER).alias("producer"))


def edge_failures(t: Tables, policy: Policy) -> DataFrame:
    return mapping.edge_failures(t["edges"], t["entities"], storage.repeated(t["edges"], ["document_id", "mapping_id"]))


#: Feature of a native unit by its kind; all others are core units.
UNIT_FEATURES = {"style": "native_style", "metadata": "native_metadata", "annotation": "native_annotation", "formula": "formula", "revision": "revision", "transition": "interactive_content", "animation": "interactive_content", "native_relationship": "native_relationship", "native_resource": "native_resource", "resource_occurrence": "resource_occurrence"}


def coverage(t: Tables, policy: Policy) -> DataFrame:
    """Counters per document and feature, from what was found of every entity and the best edge that it has."""
    d, facts, col = "document_id", quality.facts, F.col
    best = t["edges"].groupBy(d, "source_layer", col("source_id").alias("entity_id"), "target_layer").agg(F.max(rank(col("exactness"), EXACTNESS)).alias("r"))
    best = best.select(d, "source_layer", "entity_id", "target_layer", state_of(col("r"), EXACTNESS).alias("exactness"))
    to = lambda source, target, name: best.filter((col("source_layer") == source) & (col("target_layer") == target)).select(d, "entity_id", col("exactness").alias(name))
    # one grouping by unit gives both of its targets, dealt as the units are that it is joined to
    reaches = lambda layer: F.max(F.when(col("target_layer") == layer, rank(col("exactness"), EXACTNESS)))
    both = t["edges"].filter("source_layer = 'native' AND target_layer IN ('technical_ir', 'rendered')").groupBy(d, col("source_id").alias("entity_id")).agg(reaches("technical_ir").alias("p"), reaches("rendered").alias("r"))
    both = both.select(d, "entity_id", state_of(col("p"), EXACTNESS).alias("projected"), state_of(col("r"), EXACTNESS).alias("rendered"))
    names = F.create_map(*[F.lit(x) for pair in UNIT_FEATURES.items() for x in pair])
    own = _natives(t).withColumnRenamed("native_id", "entity_id").join(t["resources"].select(d, col("resource_id").alias("entity_id"), "active"), [d, "entity_id"], "left")
    natives = own.join(both, [d, "entity_id"], "left")
    feature = F.coalesce(F.element_at(names, col("kind")), F.lit("native_core_unit"))
    kept = F.when(feature == "interactive_content", F.lit("exact")).otherwise(col("projected"))  # scored on what is preserved
    unread = col("read_state").isin("failed", "blocked", "not_read")
    container = t["members"].withColumnRenamed("part_id", "entity_id").join(to("container", "native", "projected"), [d, "entity_id"], "left")
    drawn = t["surfaces"].withColumnRenamed("surface_id", "entity_id")
    assessed = col("fidelity").isin("exact", "approximate")
    boxes = t["geometry"].select(d, "surface_id", col("unit_id").alias("entity_id"), "is_clipped", col("geometry_id"))
    seen = t["marks"].groupBy(d, col("unit_id").alias("entity_id")).agg(F.max("is_clipped").alias("clipped"), F.max(F.length("text") > 0).alias("visible"))
    boxed = boxes.groupBy(d, "entity_id").agg(F.lit(True).alias("boxed"))
    localized = t["edges"].filter("relation IN ('localized_in_geometry', 'materializes_as_asset')").select(d, col("target_id").alias("entity_id")).distinct().withColumn("reached", F.lit(True))
    state = lambda c: F.when(c, F.lit("exact"))
    refused = t["views"].filter("status = 'unsupported'")
    legacy = t["documents"].filter("family = 'legacy_ole'").join(t["native_units"].select(d).distinct(), d, "left_semi").select(d).distinct()
    rows = [
        facts(t["artifacts"], "binary_artifact", preserved=col("sha256").isNotNull(), projected=state(col("sha256").isNotNull())),
        facts(container, "container_part", False, col("sha256").isNotNull(), unsupported=unread, projected=col("projected"), severity=F.when(unread, "warning")), facts(t["part_relationships"], "container_relationship", False),
        facts(natives, feature, opaque=F.coalesce(col("active"), F.lit(False)) | (feature == "native_resource"), projected=kept, rendered=col("rendered")),
        facts(own.filter("active"), "interactive_content", opaque=True, projected=F.lit("exact")), facts(own.filter("kind = 'native_resource'"), "opaque_content", False, opaque=True), facts(container.filter(unread), "opaque_content", False, False, True),
        facts(drawn, "rendered_surface", assessed, projected=state(assessed), rendered=col("fidelity")), facts(seen, "rendered_native_visibility", projected=F.when(col("visible"), F.when(col("clipped"), "approximate").otherwise("exact")), rendered=F.when(col("clipped"), "approximate").otherwise("exact")),
        facts(seen.filter("visible").join(boxed, [d, "entity_id"], "left"), "visible_geometry_coverage", projected=state(col("boxed"))), facts(boxes.drop("entity_id").withColumnRenamed("geometry_id", "entity_id").join(localized, [d, "entity_id"], "left"), "rendered_geometry", projected=state(col("reached"))),
        facts(t["assets"].select(d, col("asset_id").alias("entity_id")).distinct().join(localized, [d, "entity_id"], "left"), "derived_asset", projected=state(col("reached"))),
        facts(refused, "required_source_rendering" if policy.render == "required" else "source_rendering_attempt", policy.render == "required", unsupported=True),
        facts(legacy, "legacy_semantic_decode", unsupported=True), facts(t["ir_warnings"], "technical_ir_projection_warning", False, projected=F.lit("approximate")),
    ]
    return quality.feature_measurements(mapping.inventory(rows))


def losses(t: Tables, policy: Policy) -> DataFrame:
    return quality.losses(t["coverage"], ["document_id"]).groupBy("loss_id", "document_id", "feature", "kind").agg(F.max("severity").alias("severity"), F.sum("n_refs").alias("n_refs")).select("loss_id", "document_id", "feature", "severity", "kind", "n_refs")


def scores(t: Tables, policy: Policy) -> DataFrame:
    kinds = t["documents"].groupBy("document_id").agg(F.bool_or(F.col("family") == "legacy_ole").alias("legacy"), F.bool_and(F.col("family") == "plain_text").alias("text_only"))
    return quality.document_scores(t["coverage"], t["losses"], kinds)


def transitions(t: Tables, policy: Policy) -> DataFrame:
    return quality.transitions(t["edges"].withColumnsRenamed({"source_layer": "from_layer", "target_layer": "to_layer"}), ["document_id"])


def quality_failures(t: Tables, policy: Policy) -> DataFrame:
    return quality.quality_failures(t["coverage"], t["losses"], t["transitions"], t["scores"])


def errors(t: Tables, policy: Policy) -> DataFrame:
    """(document_id, code, severity, stage, detail): everything that went wrong, by document."""
    found = t["security_findings"].filter("severity <> 'info'").select(F.col("package_id").alias("document_id"), "code", "severity", F.lit("security").alias("stage"), "effect").toDF("document_id", "code", "severity", "stage", "detail")
    failed = t["decode_failures"].select("document_id", "code", F.lit("error").alias("severity"), F.lit("decode").alias("stage"), F.col("reason").alias("detail"))
    odd = t["ir_warnings"].select("document_id", F.lit("DS-IR-002").alias("code"), F.lit("warning").alias("severity"), F.lit("technical_ir").alias("stage"), F.concat_ws(" ", "warning", "reference").alias("detail"))
    rows = found.unionByName(failed).unionByName(odd)
    return rows.select(stable_id("error", canonical_json(code=F.col("code"), detail=F.col("detail"), document_id=F.col("document_id"), stage=F.col("stage"))).alias("error_id"), "*").dropDuplicates(["error_id"])


RUN = "run"


def checks(t: Tables, policy: Policy) -> DataFrame:
    """Every failed rule of the draft: security, identity, representations, reports' states, rendering, formulas, edges, invariants."""
    run = lambda df: df.withColumn("run_id", F.lit(RUN))
    opened = run(t["native_units"].select("document_id").distinct())
    everyone = run(t["documents"].select("document_id").distinct())
    present = None
    for kind, name in (("access", "access_states"), ("container", "members"), ("coverage", "coverage"), ("native", "native_units"), ("technical_ir", "ir_units"), ("mapping", "edges"), ("preservation", "scores")):
        rows = t[name].select("document_id").distinct().select(F.lit(RUN).alias("run_id"), "document_id", F.lit(kind).alias("kind"), F.col("document_id").alias("own_id"))
        present = rows if present is None else present.unionByName(rows)
    lost = quality.document_status(t["losses"], ["document_id"], policy.major_loss, policy.minor_loss)
    states = t["access_states"].select("document_id", F.lit("access").alias("report"), F.col("access_state").alias("state")).unionByName(lost.select("document_id", F.lit("coverage").alias("report"), F.col("status").alias("state"))).unionByName(t["decode_failures"].select("document_id", F.lit("decode").alias("report"), F.lit("review").alias("state")))
    wanted = run(t["views"].select("document_id", "profile")) if not policy.profiles else opened.select("run_id", "document_id", F.explode(F.array(*[F.lit(p) for p in policy.profiles])).alias("profile"))
    cut = run(t["geometry"].groupBy("document_id").agg(F.count_if("is_clipped").alias("n")))
    broken = lambda rows, kind: rows.select(F.lit(RUN).alias("run_id"), "document_id", "rule", F.lit(kind).alias("kind"), F.lit(package.INTEGRITY).alias("code"), F.lit("critical").alias("level"), F.lit(True).alias("blocking"), F.lit(None).cast("string").alias("subject")).distinct()
    formulas = run(t["native_units"].filter("kind = 'formula'").select("document_id", "unit_id", F.element_at("properties", F.lit("recalculated")).alias("recalculated")))
    found = [
        package.security_failures(run(t["decisions"])), package.identity_failures(everyone.select("run_id").distinct(), run(t["identity"])), package.representation_failures(opened, present, ["access", "container", "coverage", "native", "technical_ir", "mapping", "preservation"]),
        package.state_failures(run(states)), package.rendering_policy_failures(opened, run(t["views"]).join(opened, ["run_id", "document_id"], "left_semi"), wanted.join(opened, ["run_id", "document_id"], "left_semi"), policy.render, cut, bool(policy.profiles)), package.formula_failures(formulas), package.mapping_failures(run(t["edges"])),
        broken(ir.broken_invariants(t["ir_units"]), "integrity"), broken(t["edge_failures"].filter("rule NOT LIKE 'unmapped%'"), "integrity"), broken(t["quality_failures"], "quality"), broken(surfaces.broken_assets(t["assets"], t["artifacts"]), "rendering"),
        broken(t["contract_failures"].select(F.lit(None).cast("string").alias("document_id"), F.concat_ws(":", F.lit("schema"), "contract", "path", "rule").alias("rule")), "integrity"),
    ]
    return package.numbered(package.union(found))


def contract_failures(t: Tables, policy: Policy) -> DataFrame:
    """(contract, id, path, rule): rows that break the constraints of their table."""
    known = lambda name, rules: [r for r in rules if r[0] in t[name].columns]
    found = [validate.schema_failures(t[name], key, known(name, rules)).select(F.lit(name).alias("contract"), F.col(key).alias("id"), "path", "rule") for name, (key, rules) in validate.CONTRACTS.items()]
    return mapping.inventory(found)


def statuses(t: Tables, policy: Policy) -> DataFrame:
    """Each document's status, number of failed checks and whether it may be committed."""
    return package.document_results(t["documents"].withColumn("run_id", F.lit(RUN)), t["checks"]).drop("run_id")


def package_report(t: Tables, policy: Policy) -> DataFrame:
    return package.package_results(t["documents"].withColumn("run_id", F.lit(RUN)), t["checks"])


STAGES: list[tuple[str, Callable[[Tables, Policy], DataFrame]]] = [
    ("documents", documents), ("members", members), ("part_relationships", part_relationships), ("security_findings", security_findings), ("restrictions", restrictions), ("decisions", decisions), ("identity", identity), ("access_states", access_states),
    ("decode_attempts", decode_attempts), ("native_units", native_units), ("decode_failures", decode_failures), ("resources", resources), ("occurrences", occurrences), ("styles", styles), ("metadata", metadata), ("ir_units", ir_units), ("ir_warnings", ir_warnings),
    ("marks", marks), ("surfaces", surface_table), ("spaces", lambda t, p: surfaces.spaces(t["surfaces"])), ("geometry", lambda t, p: surfaces.geometry(t["marks"])),
    ("assets", lambda t, p: surfaces.assets(surfaces.svg(t["marks"], t["surfaces"]), t["surfaces"], t["artifacts"])), ("visibility", lambda t, p: surfaces.visibility(t["marks"], t["native_units"])), ("views", views),
    ("entities", entities), ("edges", edges), ("edge_failures", edge_failures), ("coverage", coverage), ("losses", losses), ("scores", scores), ("transitions", transitions), ("quality_failures", quality_failures), ("errors", errors), ("contract_failures", contract_failures), ("checks", checks),
    ("statuses", statuses), ("package", package_report),
]


#: Stages that several later ones read: kept as tables, so that no plan repeats what comes before.
SHARED = ("artifacts", "documents", "members", "part_relationships", "decisions", "access_states", "decode_attempts", "resources", "ir_units", "marks", "surfaces", "geometry", "assets", "edges", "coverage", "losses", "checks")


def plan(artifacts: DataFrame, policy: Policy = Policy(), until: str | None = None) -> Tables:
    """All stages up to ``until``; those that others share are written to the shared folder, the rest stay lazy."""
    tables: Tables = {"artifacts": storage.kept(artifacts, "artifacts")}
    for name, stage in STAGES:
        found = stage(tables, policy)
        tables[name] = storage.kept(found, name) if name in SHARED else found
        if name == until:
            break
    return tables


def _exists(spark: SparkSession, path: str) -> bool:
    """Whether Spark committed a table there."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    marker = hadoop.Path(f"{path}/_SUCCESS")
    return marker.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(marker)


def artifact_set_hash(artifacts: DataFrame) -> str:
    """One hash of the artifacts, whatever their order and partitions: a tree of hashes over their ids and contents."""
    own = [c for c in ("artifact_id", "locator_id", "ordinal", "display_name", "role") if c in artifacts.columns]
    leaf = F.sha2(F.to_json(F.struct(*own, F.sha2(F.coalesce("content", F.lit(b"")), 256).alias("content"))), 256)
    found = digests.roots(artifacts.select(leaf.alias("leaf")), [], ["leaf"], F.col("leaf")).collect()  # one row
    return found[0].root if found else "none"


def write(spark: SparkSession, source: str | DataFrame, root: str, policy: Policy = Policy(), until: str | None = None, cancelled: Callable[[], bool] = lambda: False) -> Tables:
    """Writes every stage below ``root`` as Parquet, and the run log as ``run_nodes``; resumes after complete stages.

    The request (policy, and the hash of the set of artifacts: their ids, names, places and contents) is hashed into the
    folder, so that neither another policy nor another source, nor a source whose files have changed, resumes this one.
    That takes one pass over the contents before the stages, on a resumed run too.
    """
    artifacts = acquire.files(spark, source) if isinstance(source, str) else source
    request = content_hash({"policy": repr(policy), "source": artifact_set_hash(artifacts)})
    base, nodes, tables = f"{root}/run={request[:16]}", [], {}
    for name, stage in [("artifacts", lambda t, p: artifacts), *STAGES]:
        if cancelled():
            nodes.append((request, name, "cancelled"))
            break
        path, done = f"{base}/{name}", False
        if _exists(spark, path):
            done = True
        else:
            storage.promoted(stage(tables, policy), path)
        tables[name] = spark.read.parquet(path)
        nodes.append((request, name, "resumed" if done else "completed"))
        if name == until:
            break
    log = spark.createDataFrame(nodes, "request_hash string, stage string, state string")
    log.withColumn("finished_at", F.current_timestamp()).write.mode("append").parquet(f"{base}/run_nodes")
    tables["run_nodes"] = spark.read.parquet(f"{base}/run_nodes")
    return tables
