"""Spreadsheet cells: typing, tiles, clipping, extents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# A tile's rows, columns and characters of a cell --------------------------------------------------------
TILE_ROWS = 26
TILE_COLUMNS = 12
TILE_SIZE = (1123, 794)
TILE_LEFT, TILE_TOP = 36, 70
LEAST_CELL = (65, 22)
MOST_HEIGHT = 30
FONT = 11
GLYPH = 0.68


def value_kind(type_code: Column, raw: Column, has_formula: Column) -> Column:
    """Kind of a cell's value from its type code: s, str, inlineStr, b, e or n."""
    return (
        F.when(has_formula, "formula")
        .when((type_code == "s") & raw.isNull(), "blank")
        .when(type_code.isin("s", "str", "inlineStr"), "string")
        .when(type_code == "b", "boolean")
        .when(type_code == "e", "error")
        .when(raw.isNotNull(), "number")
        .otherwise("blank")
    )


def resolved_value(type_code: Column, raw: Column, shared: Column) -> Column:
    """The value as text: shared strings by index (the index itself where there is none), booleans by name."""
    by_index = F.try_element_at(shared, (raw.try_cast("int") + 1).cast("int"))
    return F.when(type_code == "s", F.coalesce(by_index, raw)).when(type_code == "b", F.when(raw == "1", "true").otherwise("false")).otherwise(raw)


def with_shared(cells: DataFrame, strings: DataFrame, book: str = "document_id") -> DataFrame:
    """``cells(book, code, raw, ...)`` with ``value``: as ``resolved_value``, from a table ``strings(book, place, text)``.

    A join on the book and the place, however many strings a book has; a place that is none, or that no string has,
    leaves what the cell says. Of several strings of one place the smallest counts.
    """
    place = F.when(F.col("code") == "s", F.col("raw").try_cast("bigint"))
    known = strings.groupBy(F.col(book).alias("__book"), F.col("place").alias("__place")).agg(F.min("text").alias("__text"))
    rows = cells.withColumn("__at", place).join(known, (F.col(book) == F.col("__book")) & (F.col("__at") == F.col("__place")), "left")
    value = F.when(F.col("code") == "s", F.coalesce("__text", "raw")).when(F.col("code") == "b", F.when(F.col("raw") == "1", "true").otherwise("false")).otherwise(F.col("raw"))
    return rows.withColumn("value", value).drop("__at", "__book", "__place", "__text")


def tiles(cells: DataFrame) -> DataFrame:
    """Adds tile_row and tile_column to ``cells(sheet, row, column, ...)``: a range join by arithmetic alone."""
    return cells.withColumn("tile_row", F.floor((F.col("row") - 1) / TILE_ROWS)).withColumn("tile_column", F.floor((F.col("column") - 1) / TILE_COLUMNS))


def extents(cells: DataFrame) -> DataFrame:
    return cells.groupBy("sheet").agg(F.max("row").alias("max_row"), F.max("column").alias("max_column"), F.count("*").alias("n_cells"))


def tile_cells(extent_rows: Column, extent_columns: Column) -> tuple[Column, Column]:
    """(width, height) of the cells of a tile with so many rows and columns."""
    usable_width, usable_height = TILE_SIZE[0] - 2 * TILE_LEFT, TILE_SIZE[1] - TILE_TOP - TILE_LEFT
    width = F.greatest(F.lit(LEAST_CELL[0]), F.floor(F.lit(usable_width) / F.greatest(extent_columns, F.lit(1))))
    height = F.least(F.lit(MOST_HEIGHT), F.greatest(F.lit(LEAST_CELL[1]), F.floor(F.lit(usable_height) / F.greatest(extent_rows, F.lit(1)))))
    return width, height


def clipped(cells: DataFrame, most: int = 10) -> DataFrame:
    """Adds shown (at most ``most`` characters, the last an ellipsis) and is_clipped."""
    long = F.length("value") > most
    shown = F.when(long, F.concat(F.substring("value", 1, most - 1), F.lit("…"))).otherwise(F.col("value"))
    return cells.withColumn("shown", shown).withColumn("is_clipped", F.coalesce(long, F.lit(False)))


def row_major(cells: DataFrame, keys: list[str]) -> DataFrame:
    """Adds ``slot``: a cell's place among those of its sheet, row by row, then by column and id."""
    order = Window.partitionBy(*keys).orderBy("row", "column", "cell_id")
    return cells.withColumn("slot", (F.row_number().over(order) - 1).cast("long"))
