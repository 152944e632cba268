"""Scalar functions over names, paths, cell addresses, formulas and texts, as column expressions."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import let

# Fixed values -------------------------------------------------------------------------------------------------------
#: Metadata names that hold personal data.
PERSONAL_METADATA = ["creator", "lastmodifiedby", "company", "manager"]
#: Functions whose result changes without an edit.
VOLATILE_FUNCTIONS = ["NOW", "TODAY", "RAND", "RANDBETWEEN", "OFFSET", "INDIRECT"]
#: Reference pattern of a cell in a formula.
CELL_REFERENCE = r"(?:'[^']+'!)?\$?[A-Z]{1,3}\$?[1-9][0-9]*"
#: Pattern of a property name that is canonical already.
CANONICAL_NAME = r"^[a-z][a-z0-9_.:-]{1,200}$"


def property_name(name: Column, native: Column | None = None) -> Column:
    """Canonical form of a property name; ``native`` is how it was written, where that isn't ``name`` itself.

    Names outside ASCII need their compatible form first: see ``property_names``. Namespaces in braces go, camel case is split, everything else but ``a-z0-9_.:-`` becomes one underscore, and a
    name of more than 201 characters is cut and gets a hash of the native name.
    """
    x = F.regexp_replace(name, r"\{[^}]+\}", "")
    x = F.regexp_replace(x, "([A-Z]+)([A-Z][a-z])", "$1_$2")
    x = F.regexp_replace(x, "([a-z0-9])([A-Z])", "$1_$2")
    x = F.regexp_replace(F.lower(x), "[^a-z0-9_.:-]+", "_")
    x = F.regexp_replace(x, "_+", "_")
    x = F.btrim(x, F.lit("_.:-"))

    def led(x: Column) -> Column:
        return F.when(x.rlike("^[a-z]"), x).otherwise(F.concat(F.lit("property_"), F.when(x == "", "unknown").otherwise(x)))

    def filled(x: Column) -> Column:
        return F.when(F.length(x) < 2, F.concat(x, F.lit("_value"))).otherwise(x)

    def cut(x: Column) -> Column:
        short = F.concat(F.rtrim(F.substring(x, 1, 188), F.lit("_.:-")), F.lit("_"), F.substring(F.sha2(F.encode(name if native is None else native, "UTF-8"), 256), 1, 12))
        return F.when(F.length(x) > 201, short).otherwise(x)

    x = let(let(let(x, led), filled), cut)
    return F.when(name.rlike(CANONICAL_NAME), name).otherwise(x)


def property_names(rows: DataFrame, column: str, to: str) -> DataFrame:
    """``rows`` with the canonical form of the names in ``column`` as ``to``.

    Only distinct names outside ASCII go to Python, which gives their compatible form (NFKC); they are few.
    """

    def compatible(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            forms = pa.array([unicodedata.normalize("NFKC", x) for x in batch["written"].to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([batch["written"], forms], names=["written", "compatible"])

    odd = rows.select(F.col(column).alias("written")).filter(F.length("written") != F.octet_length("written")).distinct()
    named = rows.join(odd.mapInArrow(compatible, "written string, compatible string"), F.col(column) == F.col("written"), "left")
    return named.withColumn(to, property_name(F.coalesce("compatible", column), F.col(column))).drop("written", "compatible")


def a1_column(address: Column) -> Column:
    """Column number (1 for A) of a cell address, base 26."""
    letters = F.upper(F.regexp_extract(address, r"^\$?([A-Za-z]+)", 1))
    return F.aggregate(F.split(letters, ""), F.lit(0).cast("long"), lambda total, c: F.when(c == "", total).otherwise(total * 26 + F.ascii(c) - 64))


def a1_row(address: Column) -> Column:
    return F.regexp_extract(address, r"([0-9]+)$", 1).try_cast("long")


def a1_address(row: Column, column: Column) -> Column:
    """Address of a cell: the column in bijective base 26, for as many letters as a sheet of 2 ** 31 columns needs."""
    letters, left = F.lit(""), column
    for _ in range(7):
        digit = F.pmod(left - 1, F.lit(26))
        letters = F.concat(F.when(left > 0, F.char(F.lit(65) + digit)).otherwise(F.lit("")), letters)
        left = F.when(left > 0, F.floor((left - 1) / 26)).otherwise(F.lit(0))
    return F.concat(letters, row.cast("string"))


def formula_dependencies(source: Column) -> Column:
    return F.array_sort(F.array_distinct(F.regexp_extract_all(source, F.lit(CELL_REFERENCE), F.lit(0))))


def is_volatile(source: Column) -> Column:
    return source.rlike(rf"(?i)\b(?:{'|'.join(VOLATILE_FUNCTIONS)})\s*\(")


def is_portable_path(path: Column) -> Column:
    """Relative, without backslash, and without a part that goes up."""
    return (path != "") & ~path.startswith("/") & ~F.contains(path, F.lit("\\")) & ~F.array_contains(F.split(path, "/"), "..")


def normal_part_path(value: Column) -> Column:
    """A part's path without fragment and leading slashes."""
    return F.ltrim(F.substring_index(value, "#", 1), F.lit("/"))


def rels_source_part(path: Column) -> Column:
    """The part that a relationship file belongs to; null for the package's own and for other files."""
    fits = path.rlike(r"^.+?/_rels/.*\.rels$")
    return F.when(fits, F.concat(F.regexp_extract(path, r"^(.+?)/_rels/", 1), F.lit("/"), F.regexp_extract(path, r"^.+?/_rels/(.*)\.rels$", 1)))


def safe_file_name(name: Column, most: int = 180) -> Column:
    """Other characters than letters, digits, dot, underscore and dash become underscores; cut at ``most``."""
    clean = F.substring(F.regexp_replace(name, "[^A-Za-z0-9._-]+", "_"), 1, most)
    return F.when(clean == "", "unnamed").otherwise(clean)


def sensitivity(name: Column) -> Column:
    return F.when(F.lower(name).isin(PERSONAL_METADATA), "personal").otherwise("public")


def rotation(degrees: Column) -> Column:
    """The multiple of 90 within 0 to 270; other angles count as 0."""
    turned = F.pmod(degrees, F.lit(360))
    return F.when(turned.isin(0, 90, 180, 270), turned).otherwise(0).cast("long")


def xml_escaped(value: Column) -> Column:
    """Text for an XML document: control characters are replaced, markup is escaped."""
    x = F.regexp_replace(value, r"[\x00-\x08\x0B\x0C\x0E-\x1F]", "�")
    return F.replace(F.replace(F.replace(x, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def weighted_ratio(exact: Column, approximate: Column, total: Column) -> Column:
    """(exact + approximate / 2) / total to six decimals, halves to even; null where there is nothing to score."""
    return F.when(total > 0, F.bround((exact + approximate * 0.5) / total, 6))


#: Fixed value: what a path's component keeps besides letters and digits, with the codes that others get.
PATH_SAFE = "()/[]{}@!$&',;=+~"


def portable_component(value: Column) -> Column:
    """A path's component with backslashes turned and all but plain characters as percent codes; "unnamed" if empty."""
    x = F.url_encode(F.replace(value, F.lit("\\"), F.lit("/")))
    x = F.replace(F.replace(x, F.lit("+"), F.lit("%20")), F.lit("*"), F.lit("%2A"))
    for c in PATH_SAFE:
        x = F.replace(x, F.lit(f"%{ord(c):02X}"), F.lit(c))
    return F.when(value == "", "unnamed").otherwise(x)


def redacted_locator(kind: Column, display_name: Column) -> Column:
    """A source's place without its folders."""
    return F.concat(kind, F.lit(":"), F.element_at(F.split(display_name, "/"), -1))


#: Fixed value: fields that make a JSON object a reference to another contract.
REFERENCE_FIELDS = ["path", "sha256", "schema_id", "schema_version", "contract_id"]


def json_references(text: Column) -> Column:
    """Array of (path, sha256, contract_id) of all reference-shaped objects at any depth of a JSON text.

    References hold no further objects, so that the innermost braces find them.
    """
    flat = F.regexp_extract_all(text, F.lit(r'\{(?:[^{}"]|"(?:[^"\\]|\\.)*")*\}'), F.lit(0))
    whole = F.filter(flat, lambda o: F.forall(F.array(*[F.lit(f) for f in REFERENCE_FIELDS]), lambda f: F.contains(o, F.concat(F.lit('"'), f, F.lit('"')))))
    return F.transform(whole, lambda o: F.struct(F.get_json_object(o, "$.path").alias("path"), F.get_json_object(o, "$.sha256").alias("sha256"), F.get_json_object(o, "$.contract_id").alias("contract_id")))
