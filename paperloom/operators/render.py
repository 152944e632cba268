"""Text previews: wrapping into visual lines, pages, visibility; choice of a renderer."""

from __future__ import annotations

import textwrap
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed values: (width, height, font, line height, margin, footer room) of surfaces ------------------------------------
PAGE = (794, 1123, 14, 20, 48, 34)
SLIDE = (1280, 720, 14, 20, 48, 34)
GLYPH = 0.68
HEAD = 34
EMPTY_LINE = "⟦empty⟧"


def line_characters(surface=PAGE) -> int:
    width, _, font, _, margin, _ = surface
    return max(1, int((width - 2 * margin) / (font * GLYPH)))


def page_lines(surface=PAGE) -> int:
    _, height, _, line, margin, footer = surface
    return max(1, (height - (margin + HEAD) - margin - footer) // line)


def chunks(text: Column, size: int) -> Column:
    """A line cut into pieces of ``size`` characters; an empty one becomes a placeholder."""
    n = F.greatest(F.ceil(F.length(text) / size), F.lit(1)).cast("int")
    cut = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.substr(text, i * size + 1, F.lit(size)))
    return F.when(text == "", F.array(F.lit(EMPTY_LINE))).otherwise(cut)


def paginate(lines: DataFrame, surface=PAGE) -> DataFrame:
    """(document_id, unit_id, page, slot, segment) of ``lines(document_id, ordinal, unit_id, text)``.

    A line's place follows from how many visual lines precede it in its document: sums over line counts, one row per
    line; only then are lines cut up.
    """
    most, capacity = line_characters(surface), page_lines(surface)
    count = F.greatest(F.ceil(F.length("text") / most), F.lit(1)).cast("long")
    before = Window.partitionBy("document_id").orderBy("ordinal").rowsBetween(Window.unboundedPreceding, -1)
    placed = lines.withColumn("first", F.coalesce(F.sum(count).over(before), F.lit(0).cast("long")))
    rows = placed.select("document_id", "unit_id", "first", F.posexplode(chunks(F.col("text"), most)).alias("pos", "segment"))
    at = F.col("first") + F.col("pos")
    return rows.select("document_id", "unit_id", F.floor(at / capacity).alias("page"), (at % capacity).cast("long").alias("slot"), "segment")


def wrap_words(text: str, size: int) -> list[str]:
    """A text's visual lines: tabs as four columns, broken at spaces where that is possible, placeholders for empty lines."""
    out = []
    for line in text.expandtabs(4).splitlines() or [text]:
        out += textwrap.wrap(line, size, replace_whitespace=False, drop_whitespace=False, break_on_hyphens=False) or [EMPTY_LINE]
    return out


def paginate_words(lines: DataFrame, surface=PAGE) -> DataFrame:
    """As ``paginate``, with lines broken between words."""
    most, capacity = line_characters(surface), page_lines(surface)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cuts = pa.array([wrap_words(t or "", most) for t in batch["text"].to_pylist()], pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([batch["document_id"], batch["ordinal"], batch["unit_id"], cuts], names=["document_id", "ordinal", "unit_id", "cuts"])

    kinds = dict(lines.dtypes)
    schema = f"document_id {kinds['document_id']}, ordinal {kinds['ordinal']}, unit_id {kinds['unit_id']}, cuts array<string>"
    rows = lines.select("document_id", "ordinal", "unit_id", "text").mapInArrow(cut, schema)
    before = Window.partitionBy("document_id").orderBy("ordinal", "unit_id").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("first", F.coalesce(F.sum(F.size("cuts")).over(before), F.lit(0)).cast("long"))
    out = placed.select("document_id", "unit_id", "first", F.posexplode("cuts").alias("pos", "segment"))
    at = F.col("first") + F.col("pos")
    return out.select("document_id", "unit_id", F.floor(at / capacity).alias("page"), (at % capacity).cast("long").alias("slot"), "segment")


def boxes(segments: DataFrame, surface=PAGE) -> DataFrame:
    """Adds x, y, width and height of every visual line on its surface."""
    width, _, font, line, margin, _ = surface
    usable = width - 2 * margin
    estimated = F.least(F.lit(float(usable)), F.greatest(F.lit(font * GLYPH), F.length("segment") * (font * GLYPH)))
    y = F.lit(margin + HEAD - font) + F.col("slot") * line
    return segments.select("*", F.lit(float(margin)).alias("x"), y.cast("double").alias("y"), estimated.alias("width"), F.lit(float(line)).alias("height"))


def visibility(segments: DataFrame) -> DataFrame:
    """Per document: pages, visual lines and distinct units that are visible."""
    units = segments.groupBy("document_id", "unit_id").agg(F.count("*").alias("n"), F.max("page").alias("last"))
    return units.groupBy("document_id").agg((F.max("last") + 1).alias("n_pages"), F.sum("n").alias("n_segments"), F.count("*").alias("n_visible_units"))


def best(candidates: DataFrame, group: list[str], priority: str, tie: str) -> DataFrame:
    """The candidate of highest priority of each group, ties by name: an aggregate, not a sorted window."""
    others = [c for c in candidates.columns if c not in group]
    # smallest of (-priority, name)
    least = F.min(F.struct((-F.col(priority)).alias("__rank"), F.col(tie).alias("__tie"), *[F.col(c) for c in others])).alias("best")
    return candidates.groupBy(*group).agg(least).select(*group, *[F.col(f"best.{c}") for c in others])


def svg_lines(segments: DataFrame, title: Column, surface=PAGE) -> DataFrame:
    """One SVG document per page from boxed segments."""
    from ..functions.scalar import xml_escaped

    width, height, font, _, margin, _ = surface
    node = F.concat(F.lit(f'<text x="{margin}" y="'), (F.col("y") + font).cast("int").cast("string"), F.lit(f'" font-family="monospace" font-size="{font}" xml:space="preserve">'), xml_escaped(F.col("segment")), F.lit("</text>"))
    rows = segments.select("document_id", "page", F.struct("slot", node.alias("node")).alias("line"), title.alias("title"))
    pages = rows.groupBy("document_id", "page").agg(F.array_sort(F.collect_list("line")).alias("lines"), F.first("title").alias("title"))
    head = F.concat(F.lit(f'<svg xmlns="http://www.w3.org/2000/svg" width="{width}" height="{height}" viewBox="0 0 {width} {height}">\n<title>'), xml_escaped(F.col("title")), F.lit("</title>\n"))
    body = F.array_join(F.transform("lines", lambda x: x["node"]), "\n")
    return pages.select("document_id", "page", F.concat(head, body, F.lit("\n</svg>\n")).alias("svg"))
