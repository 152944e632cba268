"""Acquisition: files and injected bytes become artifact rows with hash and size; nothing goes over a network."""

from __future__ import annotations

import os
from urllib.parse import unquote, urlparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.identity import canonical_json, stable_id
from ..functions.scalar import safe_file_name
from ..functions.windows import numbered, running_total

COLUMNS = ["locator_id", "ordinal", "display_name", "role", "sha256", "size_bytes", "content"]
KINDS = ["local_file", "archive", "directory", "bytes", "stream"]


def _artifacts(rows: DataFrame) -> DataFrame:
    rows = rows.select("locator_id", "ordinal", "display_name", "role", F.sha2("content", 256).alias("sha256"), F.octet_length("content").cast("long").alias("size_bytes"), "content")
    artifact = stable_id("artifact", canonical_json(display_name=F.col("display_name"), locator_id=F.col("locator_id"), ordinal=F.col("ordinal")))
    document = stable_id("document", canonical_json(role=F.col("role"), sha256=F.col("sha256")))
    return rows.select(artifact.alias("artifact_id"), document.alias("document_id"), *COLUMNS, F.concat(F.format_string("%06d-", "ordinal"), safe_file_name(F.col("display_name"))).alias("stored_name"))


class SymbolicLink(ValueError):
    """A link among the files to acquire."""


def refuse_links(path: str) -> None:
    """Local folders must hold no symbolic links; other file systems are trusted to have none."""
    parsed = urlparse(path)
    if parsed.scheme not in ("", "file"):
        return
    root = unquote(parsed.path)
    found = [root] if os.path.islink(root) else [os.path.join(at, n) for at, folders, names in os.walk(root) for n in (*folders, *names) if os.path.islink(os.path.join(at, n))]
    if found:
        raise SymbolicLink(f"links are refused: {sorted(found)[0]}")


def files(spark: SparkSession, path: str, locator_id: str = "locator", role: str = "primary", most_bytes: int | None = None) -> DataFrame:
    """Artifacts of a file or of all files below a folder, in order of their paths.

    The ordinal is a rank among paths only, so that contents stay where they were read. With ``most_bytes``, files
    from the one on with which their lengths exceed the budget aren't read at all.
    """
    refuse_links(path)
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    ranked = numbered(found.select("path", "length"), ["path"], "ordinal")
    if most_bytes is not None:
        ranked = running_total(ranked, F.col("length"), "ordinal", "so_far").filter(F.col("so_far") <= most_bytes)
    rows = found.select("path", "content").join(ranked.select("path", "ordinal"), "path")
    return _artifacts(rows.select(F.lit(locator_id).alias("locator_id"), "ordinal", F.element_at(F.split("path", "/"), -1).alias("display_name"), F.lit(role).alias("role"), "content"))


def unexpected(artifacts: DataFrame, expected: DataFrame) -> DataFrame:
    """(locator_id, code) of locators whose bytes aren't those that ``expected(locator_id, expected_sha256)`` claims."""
    joined = artifacts.select("locator_id", "sha256").join(expected, "locator_id")
    return joined.filter(F.col("sha256") != F.lower("expected_sha256")).select("locator_id", F.lit("DS-ACQ-004").alias("code")).distinct()


def injected(spark: SparkSession, bindings: dict[str, bytes], role: str = "primary") -> DataFrame:
    """Artifacts of bytes that the caller hands over by locator."""
    rows = [(k, i, k, role, bytearray(v)) for i, (k, v) in enumerate(sorted(bindings.items()))]
    return _artifacts(spark.createDataFrame(rows, "locator_id string, ordinal long, display_name string, role string, content binary"))


def refusals(locators: DataFrame, bound: list[str] = ()) -> DataFrame:
    """(locator_id, code) of locators that can't be acquired: URLs, unknown kinds, unbound bytes, repeated ids."""
    kind = F.col("kind")
    valid_url = F.col("uri").rlike(r"^https?://[^/\s]+")
    code = (
        F.when((kind == "url") & ~valid_url, "DS-REQ-001")
        .when(kind == "url", "DS-ACQ-003")
        .when(kind.isin("bytes", "stream") & ~F.col("locator_id").isin(list(bound)), "DS-ACQ-002")
        .when(~kind.isin(KINDS), "DS-ACQ-001")
    )
    bad = locators.select("locator_id", code.alias("code")).filter("code IS NOT NULL")
    twice = locators.groupBy("locator_id").agg(F.count("*").alias("n")).filter("n > 1").select("locator_id", F.lit("DS-REQ-001").alias("code"))
    return bad.unionByName(twice).distinct()
