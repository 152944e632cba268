"""Entities of all representations and the edges between them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.identity import canonical_json, stable_id
from ..functions.ranks import EXACTNESS, rank, state_of

# The layers, from bytes to derived assets ----------------------------------------------------------------
LAYERS = ["binary", "container", "native", "technical_ir", "rendered", "geometry", "asset"]


def inventory(sources: list[DataFrame]) -> DataFrame:
    """All entities, as one long table of (layer, entity_id, kind, address, owner)."""
    return reduce(DataFrame.unionByName, sources)


def by_kind(entities: DataFrame) -> DataFrame:
    return entities.groupBy("layer", "kind").agg(F.count_distinct("entity_id").alias("n_entities"), F.min("entity_id").alias("first_id"), F.max("entity_id").alias("last_id"))


def merged(entities: DataFrame) -> DataFrame:
    """One row per (layer, entity_id), with ``conflict`` if its rows disagree on kind, address or owner."""
    several = lambda c: F.coalesce(F.min(c) < F.max(c), F.lit(False))  # noqa: E731  without a distinct
    return entities.groupBy("layer", "entity_id").agg(
        F.min("kind").alias("kind"), F.min("address").alias("address"), F.min("owner").alias("owner"), F.count("*").alias("n_rows"), (several("kind") | several("address") | several("owner")).alias("conflict")
    )


def cardinality(sources: Column, targets: Column) -> Column:
    """Class of an edge from how many entities it joins."""
    return (
        F.when((sources == 0) | (targets == 0), "unresolved")
        .when((sources == 1) & (targets == 1), "one_to_one")
        .when(sources == 1, "one_to_many")
        .when(targets == 1, "many_to_one")
        .otherwise("many_to_many")
    )


def grouped_edges(pairs: DataFrame) -> DataFrame:
    """Edges from ``pairs(source_id, target_id, exactness, confidence, method)``: one per source and manner."""
    keys = ["source_id", "exactness", "confidence", "method"]
    return pairs.groupBy(*keys, "target_id").agg(F.lit(1).alias("one")).groupBy(*keys).agg(F.count("*").alias("n_targets"), F.min("target_id").alias("first_target"), F.max("target_id").alias("last_target"))


def origins(native: DataFrame, parts: DataFrame, single_parts: DataFrame) -> DataFrame:
    """(document_id, native_id, part_id, exactness, confidence, method): where each native unit comes from.

    By its part's path; else from the only part of its document; else from the document's container, inferred.
    """
    by_path = parts.select("document_id", F.col("path").alias("part_path"), F.col("part_id").alias("path_part"))
    found = native.join(by_path, ["document_id", "part_path"], "left").join(single_parts.select("document_id", F.col("part_id").alias("only_part")), "document_id", "left")
    method = F.when(F.col("path_part").isNotNull(), "part_path").when(F.col("only_part").isNotNull(), "single_part").otherwise("container_scope")
    exact = method != "container_scope"
    return found.select("document_id", "native_id", F.coalesce("path_part", "only_part").alias("part_id"), F.when(exact, "exact").otherwise("inferred").alias("exactness"), F.when(exact, 1.0).otherwise(0.5).alias("confidence"), method.alias("method"))


def best_exactness(pairs: DataFrame, key: str) -> DataFrame:
    """(key, exactness): the best exactness of all edges of an entity."""
    return pairs.groupBy(key).agg(F.max(rank(F.col("exactness"), EXACTNESS)).alias("r")).select(key, state_of(F.col("r"), EXACTNESS).alias("exactness"))


def unmapped(entities: DataFrame, pairs: DataFrame, side: str) -> DataFrame:
    """Entities that no edge has on its ``side`` (source_id or target_id)."""
    return entities.join(pairs.select(F.col(side).alias("entity_id")), "entity_id", "left_anti")


def broken_edges(pairs: DataFrame, entities: DataFrame) -> DataFrame:
    """(mapping_id, rule) of edges with repeated ids, unknown ends, or layers that do not follow each other."""
    order = F.array(*[F.lit(x) for x in LAYERS])
    repeated = pairs.groupBy("mapping_id").agg(F.count("*").alias("n")).filter("n > 1").select("mapping_id", F.lit("repeated_id").alias("rule"))
    known = entities.select("layer", "entity_id").distinct()
    ends = []
    for side in ("source", "target"):
        other = known.select(F.col("layer").alias(f"{side}_layer"), F.col("entity_id").alias(f"{side}_id"))
        ends.append(pairs.join(other, [f"{side}_layer", f"{side}_id"], "left_anti").select("mapping_id", F.lit(f"unknown_{side}").alias("rule")))
    backward = pairs.filter(F.array_position(order, F.col("source_layer")) >= F.array_position(order, F.col("target_layer"))).select("mapping_id", F.lit("backward").alias("rule"))
    bad = pairs.filter((F.col("confidence") < 0) | (F.col("confidence") > 1) | ((F.col("exactness") == "exact") & (F.col("confidence") < 1))).select("mapping_id", F.lit("confidence").alias("rule"))
    return reduce(DataFrame.unionByName, [repeated, *ends, backward, bad])


# --- edges of all relations ---------------------------------------------------------------------------------------------

# Relations with the layers they join ----------------------------------------------------------------------
RELATIONS = {
    "contains_container_entities": ("binary", "container"), "decodes_as_native": ("container", "native"), "decoded_as_native": ("binary", "native"), "projects_to": ("native", "technical_ir"),
    "applies_style_to": ("native", "technical_ir"), "uses_resource_in": ("native", "technical_ir"), "organizes_under_synthetic_root": ("native", "technical_ir"), "renders_on_surface": ("native", "rendered"),
    "represented_on_surface": ("technical_ir", "rendered"), "defines_coordinate_space": ("rendered", "geometry"), "has_geometry": ("rendered", "geometry"), "localized_in_geometry": ("native", "geometry"),
    "materializes_as_asset": ("rendered", "asset"), "derives_asset": ("binary", "asset"),
}
EDGE = ["document_id", "relation", "source_layer", "source_id", "target_layer", "target_id", "exactness", "confidence", "method"]
PRODUCER = "paperloom"


def mapping_id() -> Column:
    return stable_id("mapping", canonical_json(**{c: F.col(c) for c in ("document_id", "relation", "source_id", "target_id")}))


def relation(rows: DataFrame, name: str, source: str, target: str, exactness: Column | str = "exact", confidence: Column | float = 1.0, method: Column | str | None = None) -> DataFrame:
    """Edges of a relation from rows with ``document_id`` and the two ends; rows that lack an end give none."""
    a, b = RELATIONS[name]
    given = lambda x: F.lit(x) if isinstance(x, (str, float)) else x
    out = rows.select("document_id", F.lit(name).alias("relation"), F.lit(a).alias("source_layer"), F.col(source).alias("source_id"), F.lit(b).alias("target_layer"), F.col(target).alias("target_id"), given(exactness).alias("exactness"), given(confidence).cast("double").alias("confidence"), given(name if method is None else method).alias("method"))
    return out.filter("source_id IS NOT NULL AND target_id IS NOT NULL")


def prioritized_origins(native: DataFrame, parts: DataFrame, references: DataFrame) -> DataFrame:
    """(document_id, native_id, part_id, exactness, confidence, method) by five levels.

    ``native(document_id, native_id, part_path, reference)``, ``parts(document_id, part_id, path)`` and
    ``references(document_id, reference, path)``: by the part's path, else by the relationship that it names, else by
    the only part; else it is inferred from the document's first part, or from its bytes alone (no part).
    """
    named = parts.groupBy("document_id", F.col("path").alias("part_path")).agg(F.min("part_id").alias("by_path"))
    linked = references.join(named.withColumnRenamed("by_path", "by_reference"), (references.document_id == named.document_id) & (references.path == named.part_path)).select(references.document_id, "reference", "by_reference").groupBy("document_id", "reference").agg(F.min("by_reference").alias("by_reference"))
    scope = parts.groupBy("document_id").agg(F.count("*").alias("n_parts"), F.min_by("part_id", "path").alias("first_part"))
    rows = native.join(named, ["document_id", "part_path"], "left").join(linked, ["document_id", "reference"], "left").join(scope, "document_id", "left")
    only = F.when(F.col("n_parts") == 1, F.col("first_part"))
    method = F.when(F.col("by_path").isNotNull(), "part_path").when(F.col("by_reference").isNotNull(), "relationship").when(only.isNotNull(), "single_part").when(F.col("n_parts").isNotNull(), "container_scope").otherwise("binary_scope")
    exact = ~method.isin("container_scope", "binary_scope")
    return rows.select("document_id", "native_id", F.coalesce("by_path", "by_reference", only, "first_part").alias("part_id"), F.when(exact, "exact").otherwise("inferred").alias("exactness"), F.when(exact, 1.0).otherwise(0.5).alias("confidence"), method.alias("method"))


def edge_failures(edges: DataFrame, entities: DataFrame, repeated: DataFrame | None = None) -> DataFrame:
    """(document_id, mapping_id, rule) of edges that break a rule, and of entities that lack an edge they need.

    ``edges`` are EDGE and ``mapping_id``, ``producer``; ``entities(document_id, layer, entity_id)``. ``repeated`` has the
    (document_id, mapping_id) that several edges share, where that is known.
    """
    col = F.col
    if repeated is None:
        repeated = edges.groupBy("document_id", "mapping_id").agg(F.count("*").alias("n")).filter("n > 1")
    layer = lambda c: F.array_position(F.array(*[F.lit(x) for x in LAYERS]), col(c))
    first, second = (F.element_at(F.create_map(*[x for k, v in RELATIONS.items() for x in (F.lit(k), F.lit(v[i]))]), col("relation")) for i in (0, 1))
    empty = lambda c: col(c).isNull() | (col(c) == "")
    rules = {
        "empty_source": empty("source_id"), "empty_target": empty("target_id"), "empty_method": empty("method"), "no_producer": empty("producer"), "no_document": empty("document_id"),
        "unknown_source_layer": layer("source_layer") == 0, "unknown_target_layer": layer("target_layer") == 0, "backward": layer("source_layer") > layer("target_layer"), "same_layer": layer("source_layer") == layer("target_layer"),
        "unknown_relation": first.isNull(), "source_of_relation": first != col("source_layer"), "target_of_relation": second != col("target_layer"), "unknown_exactness": ~col("exactness").isin(EXACTNESS), "confidence_range": ~col("confidence").between(0, 1),
        "exact_confidence": (col("exactness") == "exact") & (col("confidence") < 1), "inferred_confidence": (col("exactness") == "inferred") & (col("confidence") >= 1), "own_id": col("mapping_id") != mapping_id(),
    }
    # a plain array: filtered as a list, its rules and the ids' hashes are interpreted, and evaluated for an inferred filter too
    broken = F.array(*[F.when(F.coalesce(c, F.lit(False)), n) for n, c in rules.items()])
    found = [edges.select("document_id", "mapping_id", F.explode(broken).alias("rule")).filter("rule IS NOT NULL")]
    found.append(repeated.select("document_id", "mapping_id", F.lit("repeated_id").alias("rule")))
    # both ends of an edge are looked up by one join
    end = lambda side: F.struct(col(f"{side}_layer").alias("layer"), col(f"{side}_id").alias("entity_id"), F.lit(f"unknown_{side}").alias("rule"))
    ends = edges.select("document_id", "mapping_id", F.explode(F.array(end("source"), end("target"))).alias("end")).select("document_id", "mapping_id", "end.*")
    found.append(ends.join(entities, ["document_id", "layer", "entity_id"], "left_anti").select("document_id", "mapping_id", "rule"))
    reached = edges.select("document_id", F.col("target_layer").alias("layer"), F.col("target_id").alias("entity_id"))
    needed = entities.filter(col("layer").isin("native", "technical_ir", "geometry", "asset"))
    found.append(needed.join(reached, ["document_id", "layer", "entity_id"], "left_anti").select("document_id", F.lit(None).cast("string").alias("mapping_id"), F.concat(F.lit("unmapped_"), col("layer")).alias("rule")))
    return reduce(DataFrame.unionByName, found)


def owner_layers(owners: DataFrame, entities: DataFrame) -> DataFrame:
    """(owner_id, layer, failure) of ``owners(owner_id)``: the one layer that knows it; unknown and ambiguous ones fail."""
    known = entities.groupBy(F.col("entity_id").alias("owner_id")).agg(F.min("layer").alias("layer"), F.max("layer").alias("last"))
    rows = owners.select("owner_id").distinct().join(known, "owner_id", "left")
    failure = F.when(F.col("layer").isNull(), "unknown_owner").when(F.col("layer") != F.col("last"), "ambiguous_owner")
    return rows.select("owner_id", F.when(failure.isNull(), F.col("layer")).alias("layer"), failure.alias("failure"))
