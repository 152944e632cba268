"""The uniform tree of units: projections of native profiles, parents, invariants."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.identity import canonical_json, stable_id
from ..functions.windows import numbered
from ..storage import kept
from . import graph

UNIT_COLUMNS = ["document_id", "unit_id", "kind", "parent_id", "ordinal", "origin", "native_id", "text", "protected"]


def _unit_json(document: Column, native: Column, kind: Column) -> Column:
    return canonical_json(document_id=document, kind=kind, native_id=native)


def _root_json(document: Column) -> Column:
    return canonical_json(document_id=document, synthetic=F.lit("document"))


def unit_id(document: Column, native: Column, kind: Column) -> Column:
    return stable_id("ir", _unit_json(document, native, kind), bound=False)


def root_id(document: Column) -> Column:
    return stable_id("ir", _root_json(document), bound=False)


def roots(documents: DataFrame) -> DataFrame:
    """The synthetic root unit of each document."""
    d = F.col("document_id")
    none = F.lit(None).cast("string")
    return documents.select("document_id").distinct().select(d, root_id(d).alias("unit_id"), F.lit("document").alias("kind"), none.alias("parent_id"), F.lit(0).cast("long").alias("ordinal"), F.lit("synthetic").alias("origin"), none.alias("native_id"), none.alias("text"), F.lit(False).alias("protected"))


def _units(rows: DataFrame, kind: Column, parent: Column, native: Column, text: Column, protected: Column, ordinal: Column, *carried: str) -> DataFrame:
    d = F.col("document_id")
    return rows.select(*carried, d, unit_id(d, native, kind).alias("unit_id"), kind.alias("kind"), parent.alias("parent_id"), ordinal.cast("long").alias("ordinal"), F.lit("native_projection").alias("origin"), native.alias("native_id"), text.alias("text"), protected.alias("protected"))


def project_text(lines: DataFrame, *carried: str) -> DataFrame:
    """``lines(document_id, ordinal, unit_id, text)`` as text_line units under the root; columns ``carried`` stay."""
    return _units(lines, F.lit("text_line"), root_id(F.col("document_id")), F.col("unit_id"), F.col("text"), F.lit(False), F.col("ordinal"), *carried)


def project_sheet(cells: DataFrame) -> DataFrame:
    """``cells(document_id, worksheet_id, cell_id, value_kind, value, ordinal)`` as cells under their worksheets.

    Text is kept for strings and errors only; a cell with a formula is protected.
    """
    sheet = unit_id(F.col("document_id"), F.col("worksheet_id"), F.lit("worksheet"))
    text = F.when(F.col("value_kind").isin("string", "error"), F.col("value"))
    return _units(cells, F.lit("cell"), sheet, F.col("cell_id"), text, F.col("value_kind") == "formula", F.col("ordinal"))


def project_slides(shapes: DataFrame) -> DataFrame:
    """``shapes(document_id, slide_id, shape_id, has_text, text, ordinal)`` as shapes under their slides."""
    kind = F.when(F.col("has_text"), "text_shape").otherwise("visual_object")
    return _units(shapes, kind, unit_id(F.col("document_id"), F.col("slide_id"), F.lit("slide")), F.col("shape_id"), F.col("text"), F.lit(False), F.col("ordinal"))


# Kinds of native units by the name that the uniform tree gives them, and those that are not plain content -
KINDS = {"line": "text_line", "run": "text_span", "row": "table_row", "section": "flow_section", "page": "fixed_page", "frame": "image_frame", "style": "style_definition", "storage": "ole_storage", "stream": "ole_stream"}
PROTECTED = ["formula", "revision", "transition", "animation", "frame", "storage", "stream", "annotation", "style", "metadata"]


def project(units: DataFrame) -> DataFrame:
    """Native units of every profile as units of the tree, below their parents or the document's root.

    ``units(document_id, unit_id, kind, parent_id, ordinal, text, properties)``: lines, flowing text and its tables,
    sheets and cells, slides and shapes, fixed pages, image frames, storages and streams of compound files. Cells of
    sheets (those with an address, the property ``at``) keep text only if they hold strings or errors; what isn't plain
    content, or is hidden, is protected.
    """
    of = lambda name: F.element_at("properties", F.lit(name))
    names = F.create_map(*[F.lit(x) for pair in KINDS.items() for x in pair])
    in_table = (F.col("kind") == "cell") & of("at").isNull()
    by_kind = F.when(in_table, "table_cell").when(F.col("kind") == "annotation", F.concat(F.lit("annotation_"), F.coalesce(of("kind_of"), F.lit("comment")))).when(F.col("kind") == "revision", F.concat(F.lit("revision_"), F.coalesce(of("kind_of"), F.lit("unknown"))))
    shape = F.when(F.col("kind") == "shape", F.when(F.col("text").isNotNull(), "text_shape").otherwise("visual_object"))
    kind = F.coalesce(by_kind, F.element_at(names, F.col("kind")), shape, F.col("kind"))
    hidden = (of("value_kind") == "formula") | ((F.col("kind") == "worksheet") & (of("visibility") != "visible")) | ((F.col("kind") == "slide") & (of("hidden") == "true"))
    text = F.when((F.col("kind") == "cell") & of("at").isNotNull() & ~of("value_kind").isin("string", "error"), None).otherwise(F.col("text"))
    d = F.col("document_id")
    named = units.withColumn("unit_kind", kind).withColumn("is_protected", F.col("kind").isin(PROTECTED) | F.coalesce(hidden, F.lit(False))).withColumn("own_text", text)
    ids = named.select("document_id", F.col("unit_id").alias("parent_id"), F.col("unit_kind").alias("parent_kind")).distinct()
    rows = named.join(ids, ["document_id", "parent_id"], "left")
    # one hash of either text: within a branch it would be computed for every part of the id
    parent = stable_id("ir", F.when(F.col("parent_kind").isNull(), _root_json(d)).otherwise(_unit_json(d, F.col("parent_id"), F.col("parent_kind"))), bound=False)
    return _units(rows, F.col("unit_kind"), parent, F.col("unit_id"), F.col("own_text"), F.col("is_protected"), F.col("ordinal"))


def append_catalog(base: DataFrame, rows: DataFrame, kind: Column, protected: Column) -> DataFrame:
    """``rows(document_id, native_id, text)`` as units under the root, with ordinals that continue those of ``base``."""
    counts = base.groupBy("document_id").agg(F.max("ordinal").alias("__last"))
    placed = numbered(rows, ["native_id"], "__place", within=["document_id"]).join(counts, "document_id", "left").withColumn("ordinal", F.coalesce("__last", F.lit(-1)) + 1 + F.col("__place"))
    return _units(placed, kind, root_id(F.col("document_id")), F.col("native_id"), F.col("text"), protected, F.col("ordinal"))


def first_target(annotations: DataFrame, units: DataFrame) -> DataFrame:
    """(annotation_id, unit_id): the first of an annotation's targets that is a unit; null if none is."""
    targets = annotations.select("annotation_id", F.posexplode_outer("targets").alias("pos", "native_id"))
    found = targets.join(units.select("native_id", F.col("unit_id").alias("found")), "native_id", "left")
    return found.groupBy("annotation_id").agg(F.min(F.when(F.col("found").isNotNull(), F.struct("pos", "found"))).alias("first")).select("annotation_id", F.col("first.found").alias("unit_id"))


def on_cycles(units: DataFrame) -> DataFrame:
    """(document_id, unit_id) of units that are their own ancestors, through others.

    Documents whose units have one parent each are followed by doubling pointers; only those in which a repeated id has
    several parents need strongly connected components. Units that are nobody's parent, mostly the greater part, lie on
    no cycle and go first.
    """
    node = lambda c: F.struct("document_id", F.col(c).alias("unit_id"))
    edges = units.filter("document_id IS NOT NULL AND unit_id IS NOT NULL AND parent_id <> unit_id").select("document_id", "unit_id", "parent_id")
    entered = edges.select("document_id", F.col("parent_id").alias("unit_id")).distinct()
    single = edges.groupBy("document_id", "unit_id").agg(F.min("parent_id").alias("parent_id"), F.max("parent_id").alias("last"))
    pointers = kept(single.hint("merge").join(entered.hint("merge"), ["document_id", "unit_id"], "left_semi"), "parents")
    several = kept(pointers.filter("parent_id <> last").select("document_id").distinct(), "several-parents")
    ends = lambda rows: rows.select(node("unit_id").alias("node"), node("parent_id").alias("parent"))
    if several.isEmpty():
        found = graph.pointer_cycles(ends(pointers))
    else:
        found = graph.pointer_cycles(ends(pointers.join(several, "document_id", "left_anti"))).unionByName(graph.strongly_connected(ends(edges.join(several, "document_id", "left_semi"))).select("node"))
    return found.select("node.document_id", "node.unit_id")


def broken_invariants(units: DataFrame) -> DataFrame:
    """(document_id, unit_id, rule): repeated ids, several or no roots, orphans, own parents, cycles of several units,
    sources out of place."""
    repeated = units.groupBy("document_id", "unit_id").agg(F.count("*").alias("n")).filter("n > 1").select("document_id", "unit_id", F.lit("repeated_id").alias("rule"))
    tops = units.groupBy("document_id").agg(F.count_if(F.col("parent_id").isNull()).alias("n")).filter("n <> 1").select("document_id", F.lit(None).cast("string").alias("unit_id"), F.lit("one_root").alias("rule"))
    own = units.filter("unit_id = parent_id").select("document_id", "unit_id", F.lit("own_parent").alias("rule"))
    parents = units.select("document_id", F.col("unit_id").alias("parent_id")).distinct()
    orphans = units.filter("parent_id IS NOT NULL").join(parents, ["document_id", "parent_id"], "left_anti").select("document_id", "unit_id", F.lit("orphan").alias("rule"))
    place = (F.col("origin") == "synthetic") == F.col("native_id").isNotNull()
    sources = units.filter(place).select("document_id", "unit_id", F.lit("source_of_origin").alias("rule"))
    cycles = on_cycles(units).withColumn("rule", F.lit("cycle"))
    return repeated.unionByName(tops).unionByName(own).unionByName(orphans).unionByName(sources).unionByName(cycles)
