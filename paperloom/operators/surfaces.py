"""Rendered surfaces of every kind of document: pages of text, slides, tiles of sheets, fixed pages and frames.

``marks`` say which unit shows where on which surface; surfaces, their coordinate spaces, geometry and assets follow
from them. Identity hashes make every row's id, so that repeated runs agree.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.identity import canonical_json, stable_id
from ..functions.scalar import a1_column, a1_row, xml_escaped
from . import render, sheets

# Profiles by format, and (requested profile, kind of document, priority) of the renderers ----------------
PROFILES = {"txt": "plain_text", "docx": "wordprocessing", "xlsx": "spreadsheet", "pptx": "presentation", "pdf": "fixed_layout", "ole": "legacy_ole"}
CAPABILITIES = [
    ("passthrough", "fixed_layout", 100), ("passthrough", "raster", 100), ("source_reference", "fixed_layout", 75), ("source_reference", "raster", 75),
    ("technical_preview", "plain_text", 50), ("technical_preview", "wordprocessing", 50), ("technical_preview", "spreadsheet", 50), ("technical_preview", "presentation", 50),
]
FLOWING = ["line", "paragraph", "table_cell", "header", "footer", "footnote", "endnote"]
PLACEHOLDER = "[{}]"
MARKS = ["document_id", "surface_kind", "surface_ordinal", "owner_id", "unit_id", "slot", "text", "x", "y", "width", "height", "is_clipped"]


#: Surfaces that one slide or sheet may have: an ordinal is its owner's, times this, and the surface's own.
PLACES = 1_000_000_000


def profile_kind(formats: Column, family: Column) -> Column:
    table = F.create_map(*[F.lit(x) for pair in PROFILES.items() for x in pair])
    return F.when(family == "raster", "raster").otherwise(F.coalesce(F.element_at(table, formats), F.lit("unknown")))


def flow_marks(units: DataFrame) -> DataFrame:
    """Pages of flowing text: lines, paragraphs and stories; runs only where their paragraph isn't shown itself."""
    shown = units.filter(F.col("kind").isin(FLOWING) & F.col("text").isNotNull()).select("document_id", "unit_id", "ordinal", "text")
    runs = units.filter((F.col("kind") == "run") & F.col("text").isNotNull())
    lone = runs.join(shown.select("document_id", F.col("unit_id").alias("parent_id")), ["document_id", "parent_id"], "left_anti")
    boxed = render.boxes(render.paginate_words(shown.unionByName(lone.select("document_id", "unit_id", "ordinal", "text"))))
    return boxed.select("document_id", F.lit("page").alias("surface_kind"), F.col("page").alias("surface_ordinal"), F.lit(None).cast("string").alias("owner_id"), "unit_id", "slot", F.col("segment").alias("text"), "x", "y", "width", "height", F.lit(False).alias("is_clipped"))


def slide_marks(units: DataFrame) -> DataFrame:
    """Slides: the text of their shapes, a placeholder for those without; what runs over goes on a further surface."""
    slides = units.filter("kind = 'slide'").select("document_id", F.col("unit_id").alias("owner_id"), F.col("ordinal").alias("slide"))
    element = F.element_at("properties", F.lit("element"))
    shapes = units.filter("kind = 'shape'").select("document_id", F.col("parent_id").alias("owner_id"), "unit_id", "ordinal", F.coalesce("text", F.concat(F.lit("["), F.coalesce(element, F.lit("shape")), F.lit("]"))).alias("text"))
    rows = shapes.join(slides, ["document_id", "owner_id"])
    own = F.concat_ws("\u001f", "document_id", "owner_id")  # pages start anew on every slide
    boxed = render.boxes(render.paginate_words(rows.select(own.alias("document_id"), "ordinal", "unit_id", "text"), render.SLIDE), render.SLIDE)
    parts = F.split("document_id", "\u001f")
    placed = boxed.select(parts[0].alias("document_id"), parts[1].alias("owner_id"), "unit_id", "page", "slot", F.col("segment").alias("text"), "x", "y", "width", "height").join(slides, ["document_id", "owner_id"])
    return placed.select("document_id", F.lit("slide").alias("surface_kind"), (F.col("slide") * PLACES + F.col("page")).cast("long").alias("surface_ordinal"), "owner_id", "unit_id", "slot", "text", "x", "y", "width", "height", F.lit(False).alias("is_clipped"))


def tile_marks(units: DataFrame) -> DataFrame:
    """Tiles of 26 rows and 12 columns: an equality of two quotients instead of a range join; cells cut to their box."""
    books = units.filter("kind = 'worksheet'").select("document_id", F.col("unit_id").alias("owner_id"), F.col("ordinal").alias("sheet_ordinal"))
    at = F.element_at("properties", F.lit("at"))
    cells = units.filter("kind = 'cell' AND properties['at'] IS NOT NULL").select("document_id", F.col("parent_id").alias("owner_id"), "unit_id", F.coalesce("text", F.lit("")).alias("value"), a1_row(at).alias("row"), a1_column(at).alias("column")).join(books, ["document_id", "owner_id"])
    cells = sheets.tiles(cells.filter("row > 0 AND column > 0"))
    keys = ["document_id", "owner_id", "tile_row", "tile_column"]
    extent = cells.groupBy(*keys).agg((F.max("row") - F.min("row") + 1).alias("rows"), (F.max("column") - F.min("column") + 1).alias("columns"), F.min("row").alias("row0"), F.min("column").alias("column0"))
    width, height = sheets.tile_cells(F.col("rows"), F.col("columns"))
    most = F.greatest(F.floor(F.col("cell_width") / (sheets.FONT * sheets.GLYPH)) - 1, F.lit(1))
    placed = cells.join(extent.withColumn("cell_width", width).withColumn("cell_height", height), keys).withColumn("most", most)
    cut = F.length("value") > F.col("most")
    text = F.when(cut, F.concat(F.expr("substring(value, 1, CAST(most - 1 AS int))"), F.lit("…"))).otherwise(F.col("value"))
    tile = F.col("sheet_ordinal") * PLACES + F.col("tile_row") * 10_000 + F.col("tile_column")
    slot = F.row_number().over(Window.partitionBy(*keys).orderBy("row", "column", "unit_id")) - 1  # row by row
    return placed.select(
        "document_id", F.lit("tile").alias("surface_kind"), tile.cast("long").alias("surface_ordinal"), "owner_id", "unit_id", slot.cast("long").alias("slot"), text.alias("text"),
        (F.lit(float(sheets.TILE_LEFT)) + (F.col("column") - F.col("column0")) * F.col("cell_width")).cast("double").alias("x"), (F.lit(float(sheets.TILE_TOP)) + (F.col("row") - F.col("row0")) * F.col("cell_height")).cast("double").alias("y"),
        F.col("cell_width").cast("double").alias("width"), F.col("cell_height").cast("double").alias("height"), cut.alias("is_clipped"),
    )


def marks(units: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, [flow_marks(units), slide_marks(units), tile_marks(units)])


def surface_id() -> Column:
    return stable_id("surface", canonical_json(document_id=F.col("document_id"), kind=F.col("surface_kind"), ordinal=F.col("surface_ordinal")))


def surfaces(found: DataFrame, units: DataFrame) -> DataFrame:
    """(document_id, surface_id, surface_kind, surface_ordinal, owner_id, width, height, unit, fidelity).

    Surfaces with marks are previews (approximate); sheets and slides without any get an empty one; pages and frames
    have their native size, and nobody has assessed how they look.
    """
    sizes = {"page": render.PAGE[:2], "slide": render.SLIDE[:2], "tile": sheets.TILE_SIZE}
    size = lambda i: F.element_at(F.create_map(*[x for k, v in sizes.items() for x in (F.lit(k), F.lit(float(v[i])))]), F.col("surface_kind"))
    drawn = found.groupBy("document_id", "surface_kind", "surface_ordinal").agg(F.min("owner_id").alias("owner_id"))
    owners = units.filter("kind IN ('worksheet', 'slide')")
    empty = owners.join(drawn.select("document_id", F.col("owner_id").alias("unit_id")), ["document_id", "unit_id"], "left_anti")
    ordinal = F.col("ordinal") * PLACES
    empty = empty.select("document_id", F.when(F.col("kind") == "slide", "slide").otherwise("tile").alias("surface_kind"), ordinal.alias("surface_ordinal"), F.col("unit_id").alias("owner_id"))
    previews = drawn.unionByName(empty).select("*", size(0).alias("width"), size(1).alias("height"), F.lit("px").alias("unit"), F.lit("approximate").alias("fidelity"))
    is_page = F.col("kind") == "page"
    number = lambda a, b: F.element_at("properties", F.when(is_page, a).otherwise(b)).try_cast("double")
    native = units.filter("kind IN ('page', 'frame')").select(
        "document_id", F.when(is_page, "fixed_page").otherwise("frame").alias("surface_kind"), F.col("ordinal").alias("surface_ordinal"), F.col("unit_id").alias("owner_id"),
        number("width_pt", "width_px").alias("width"), number("height_pt", "height_px").alias("height"), F.when(is_page, "pt").otherwise("px").alias("unit"), F.lit("not_assessed").alias("fidelity"),
    )
    return previews.unionByName(native).withColumn("surface_id", surface_id())


def spaces(found: DataFrame) -> DataFrame:
    """(document_id, space_id, surface_id, unit, width, height): the coordinate space of every surface."""
    return found.select("document_id", stable_id("space", canonical_json(surface=F.col("surface_id"))).alias("space_id"), "surface_id", "unit", "width", "height")


def geometry(found: DataFrame) -> DataFrame:
    """(document_id, geometry_id, surface_id, unit_id, x, y, width, height, is_clipped): the box of a unit's marks on a surface."""
    boxes = found.withColumn("surface_id", surface_id()).groupBy("document_id", "surface_id", "unit_id").agg(
        F.min("x").alias("x"), F.min("y").alias("y"), F.max(F.col("x") + F.col("width")).alias("right"), F.max(F.col("y") + F.col("height")).alias("bottom"), F.max("is_clipped").alias("is_clipped")
    )
    identity = stable_id("geometry", canonical_json(surface=F.col("surface_id"), unit=F.col("unit_id")))
    return boxes.select("document_id", identity.alias("geometry_id"), "surface_id", "unit_id", "x", "y", (F.col("right") - F.col("x")).alias("width"), (F.col("bottom") - F.col("y")).alias("height"), "is_clipped")


def svg(found: DataFrame, all_surfaces: DataFrame) -> DataFrame:
    """(document_id, surface_id, svg): a drawing of every preview surface, its marks in order of their slots."""
    node = F.concat(F.lit('<text x="'), F.col("x").cast("int").cast("string"), F.lit('" y="'), (F.col("y") + 14).cast("int").cast("string"), F.lit('" font-family="monospace" xml:space="preserve">'), xml_escaped(F.col("text")), F.lit("</text>"))
    lines = found.select("document_id", surface_id().alias("surface_id"), F.struct("slot", "unit_id", "x", node.alias("node")).alias("line")).groupBy("document_id", "surface_id").agg(F.array_sort(F.collect_list("line")).alias("lines"))  # a surface has a bounded number of slots
    drawn = all_surfaces.filter("fidelity = 'approximate'").join(lines, ["document_id", "surface_id"], "left")
    head = F.format_string('<svg xmlns="http://www.w3.org/2000/svg" width="%d" height="%d">\n', F.col("width").cast("int"), F.col("height").cast("int"))
    return drawn.select("document_id", "surface_id", F.concat(head, F.coalesce(F.array_join(F.transform("lines", lambda x: x["node"]), "\n"), F.lit("")), F.lit("\n</svg>\n")).alias("svg"))


def assets(drawings: DataFrame, native_surfaces: DataFrame, artifacts: DataFrame) -> DataFrame:
    """(document_id, asset_id, surface_id, media_type, role, sha256, size_bytes, payload): drawings by content, once each;
    fixed pages and frames share their document's bytes, which are referred to by hash and not copied."""
    payload = F.encode("svg", "UTF-8")
    made = drawings.select("document_id", "surface_id", F.lit("image/svg+xml").alias("media_type"), F.lit("preview").alias("role"), F.sha2(payload, 256).alias("sha256"), F.octet_length(payload).cast("long").alias("size_bytes"), payload.alias("payload"))
    once = artifacts.groupBy("document_id").agg(F.min("sha256").alias("sha256"), F.min("size_bytes").alias("size_bytes"))
    passed = native_surfaces.filter("fidelity = 'not_assessed'").select("document_id", "surface_id").join(once, "document_id")
    passed = passed.select("document_id", "surface_id", F.lit("application/octet-stream").alias("media_type"), F.lit("passthrough").alias("role"), "sha256", "size_bytes", F.lit(None).cast("binary").alias("payload"))
    identity = stable_id("asset", canonical_json(document_id=F.col("document_id"), sha256=F.col("sha256")))
    return made.unionByName(passed).select("document_id", identity.alias("asset_id"), "surface_id", "media_type", "role", "sha256", "size_bytes", "payload")


def broken_assets(found: DataFrame, artifacts: DataFrame) -> DataFrame:
    """(document_id, asset_id, rule): payloads whose hash or size isn't theirs, passed-through bytes that no artifact has."""
    own = found.filter("payload IS NOT NULL").filter((F.sha2("payload", 256) != F.col("sha256")) | (F.octet_length("payload") != F.col("size_bytes")))
    lost = found.filter("role = 'passthrough'").join(artifacts.select("document_id", "sha256").distinct(), ["document_id", "sha256"], "left_anti")
    return own.select("document_id", "asset_id", F.lit("asset_hash").alias("rule")).unionByName(lost.select("document_id", "asset_id", F.lit("asset_source").alias("rule")))


def views(documents: DataFrame, all_surfaces: DataFrame, mode: str, requested: list[str]) -> DataFrame:
    """(document_id, profile, status): what was asked for and what came of it.

    Mode ``none`` asks for nothing; ``on_demand`` for the requested profiles (none by default); ``required`` for these
    or, without any, for the best that a renderer can do. A repeated profile counts once.
    """
    schema = "kind string, profile string, priority int"
    table = documents.sparkSession.createDataFrame([(k, p, n) for p, k, n in CAPABILITIES], schema)
    kinds = documents.select("document_id", profile_kind(F.col("format_name"), F.col("family")).alias("kind")).distinct()
    if mode == "none" or (mode == "on_demand" and not requested):
        return kinds.select("document_id", F.lit("none").alias("profile"), F.lit("not_requested").alias("status")).limit(0)
    able = render.best(kinds.join(F.broadcast(table), "kind"), ["document_id"], "priority", "profile")  # the table has a fixed number of rows
    if requested:
        wanted = kinds.select("document_id", "kind", F.explode(F.array_distinct(F.array(*[F.lit(p) for p in requested]))).alias("profile"))
        asked = wanted.join(F.broadcast(table.select("kind", "profile", F.lit(True).alias("able"))), ["kind", "profile"], "left")
    else:
        asked = kinds.join(able.select("document_id", "profile", F.lit(True).alias("able")), "document_id", "left").withColumn("profile", F.coalesce("profile", F.lit("technical_preview")))
    seen = all_surfaces.groupBy("document_id").agg(F.bool_and(F.col("fidelity") == "not_assessed").alias("unassessed"))
    status = F.when(F.col("able").isNull() | F.col("unassessed").isNull(), "unsupported").when(F.col("unassessed"), "partial").otherwise("available")
    return asked.join(seen, "document_id", "left").select("document_id", "profile", status.alias("status"))


def visibility(found: DataFrame, units: DataFrame) -> DataFrame:
    """(document_id, surface_id, serialized, visible, clipped, omitted): sorted arrays of the units of a surface.

    A surface holds a bounded number of marks. A unit is visible where its mark has text, and omitted where it has none.
    """
    per = found.withColumn("surface_id", surface_id()).groupBy("document_id", "surface_id", "unit_id").agg(F.max(F.length("text") > 0).alias("seen"), F.max("is_clipped").alias("clipped"))
    pick = lambda c: F.array_sort(F.collect_set(F.when(c, F.col("unit_id"))))
    return per.groupBy("document_id", "surface_id").agg(pick(F.lit(True)).alias("serialized"), pick(F.col("seen")).alias("visible"), pick(F.col("clipped") & F.col("seen")).alias("clipped"), pick(F.lit(False)).alias("omitted"))
