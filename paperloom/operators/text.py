"""Plain text: lines with byte offsets, newline style, control characters, text probing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.identity import canonical_json, stable_id


def document_id(text: Column, role: str = "primary") -> Column:
    return stable_id("document", canonical_json(role=F.lit(role), sha256=F.sha2(F.encode(text, "UTF-8"), 256)))


#: Where a line ends; CR LF counts as one end.
LINE_ENDS = r"\n\r\x0b\x0c\x1c\x1d\x1e\x{85}\x{2028}\x{2029}"
#: A line with its end; the last of a text may lack one. Possessive, so that every character is looked at once.
LINE = rf"[^{LINE_ENDS}]*+(?:\r\n|[{LINE_ENDS}])|[^{LINE_ENDS}]++"
#: Lines whose lengths are summed up in one go.
BLOCK = 512


def lines(documents: DataFrame, id_column: str = "document_id", text_column: str = "text") -> DataFrame:
    """(document_id, ordinal, unit_id, byte_start, byte_end, text) of every line of UTF-8 texts.

    Lines end as ``LINE_ENDS`` says; a final end opens no further line. CR and LF at the end are not part of a line's
    text, the rarer ends are. All other characters stay, U+0000 too. A null text has no lines. Offsets are bytes.
    """
    pieces = documents.select(F.col(id_column).alias("document_id"), F.regexp_extract_all(F.coalesce(F.col(text_column), F.lit("")), F.lit(LINE), F.lit(0)).alias("pieces"))
    placed = pieces.select("document_id", "pieces", starts_of(F.col("pieces")).alias("starts"))
    rows = placed.select("document_id", F.posexplode(F.arrays_zip("starts", "pieces")).alias("pos", "line"))
    rows = rows.select("document_id", F.col("pos").cast("long").alias("ordinal"), F.col("line.starts").alias("byte_start"), F.rtrim("line.pieces", F.lit("\r\n")).alias("text"))
    unit = stable_id("line", canonical_json(document_id=F.col("document_id"), ordinal=F.col("ordinal"), start=F.col("byte_start")))
    return rows.select("document_id", "ordinal", unit.alias("unit_id"), "byte_start", (F.col("byte_start") + F.octet_length("text")).alias("byte_end"), "text")


def starts_of(pieces: Column, block: int = BLOCK) -> Column:
    """Array with the bytes before each of an array of strings.

    Sums over arrays copy what they have so far at each step. So the strings are dealt into blocks, whose lengths give
    where each block begins; within a block sums begin there, and no copy is longer than a block or the list of blocks.
    """
    bytes_of = lambda own: F.aggregate(own, F.lit(0).cast("long"), lambda a, p: a + F.octet_length(p))
    running = lambda own, first, size: F.aggregate(own, F.array(first), lambda a, p: F.concat(a, F.array(F.element_at(a, -1) + size(p))))
    numbers = F.sequence(F.lit(0), F.greatest(F.ceil(F.size(pieces) / block).cast("int") - 1, F.lit(0)))
    blocks = F.transform(numbers, lambda b: F.slice(pieces, b * block + 1, block))
    sized = F.transform(blocks, lambda own: F.struct(own.alias("own"), bytes_of(own).alias("size")))
    # the blocks are bound to a name once, not computed wherever they are used
    begun = lambda all_: F.zip_with(all_, running(all_, F.lit(0).cast("long"), lambda x: x["size"]), lambda x, at: F.struct(x["own"].alias("own"), at.alias("at")))
    in_blocks = F.element_at(F.transform(F.array(sized), begun), 1)
    within = lambda x: F.slice(running(x["own"], x["at"], F.octet_length), 1, F.size(x["own"]))
    return F.flatten(F.transform(F.filter(in_blocks, lambda x: x["own"].isNotNull()), within))


def newline_style(text: Column) -> Column:
    """lf, crlf or cr if a text has one kind of line end, mixed if several, none without any."""
    crlf = F.regexp_count(text, F.lit("\r\n"))
    lf = F.regexp_count(text, F.lit("\n")) - crlf
    cr = F.regexp_count(text, F.lit("\r")) - crlf
    kinds = (crlf > 0).cast("int") + (lf > 0).cast("int") + (cr > 0).cast("int")
    return F.when(kinds == 0, "none").when(kinds > 1, "mixed").when(crlf > 0, "crlf").when(lf > 0, "lf").otherwise("cr")


def control_findings(text: Column) -> Column:
    """Sorted distinct code points of control characters other than tab, line feed, carriage return and form feed."""
    found = F.array_distinct(F.regexp_extract_all(text, F.lit(r"[\x00-\x08\x0B\x0E-\x1F\x7F-\x{9F}]"), F.lit(0)))
    return F.array_sort(F.transform(found, lambda c: F.concat(F.lit("U+"), F.lpad(F.hex(F.ascii(c)), 4, "0"))))


def text_confidence(text: Column) -> Column:
    """0.98 for UTF-8 text with at most one control character in a hundred, 1 for none at all, else 0."""
    controls = F.regexp_count(text, F.lit(r"[\x00-\x08\x0B\x0E-\x1F]"))
    return F.when(text == "", 1.0).when(controls <= F.length(text) * 0.01, 0.98).otherwise(0.0)
