"""Container parts: kinds, security flags, media types, resources and their occurrences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _has(text: Column, *parts: str) -> Column:
    found = F.lit(False)
    for p in parts:
        found = found | F.contains(text, F.lit(p))
    return found


def part_kind(path: Column, media_type: Column) -> Column:
    lower, media = F.lower(path), F.coalesce(media_type, F.lit(""))
    xml = media.endswith("+xml") | media.isin("application/xml", "text/xml") | lower.endswith(".xml")
    return (
        F.when(lower == "[content_types].xml", "content_types")
        .when(lower.endswith(".rels"), "relationships")
        .when(xml, "xml")
        .when(_has(lower, "/media/", "/embeddings/", "vbaproject", "/activex/", "/fonts/"), "resource")
        .otherwise("binary")
    )


def security_flags(path: Column, media_type: Column, encrypted: Column) -> Column:
    """Sorted array of what a part's name and type give away."""
    lower, media = F.lower(path), F.coalesce(media_type, F.lit(""))
    rules = [
        ("activex", _has(lower, "/activex/") | _has(media, "activeX")),
        ("custom_xml", lower.startswith("customxml/")),
        ("digital_signature", lower.startswith("_xmlsignatures/")),
        ("embedded_object", _has(lower, "/embeddings/") | _has(media, "oleObject")),
        ("encrypted_entry", encrypted),
        ("external_link_part", _has(lower, "/externallinks/")),
        ("macro", _has(lower, "vbaproject") | _has(media, "vbaProject")),
    ]
    return F.filter(F.array(*[F.when(rule, name) for name, rule in rules]), lambda f: f.isNotNull())


def media_types(parts: DataFrame, overrides: DataFrame, defaults: DataFrame) -> DataFrame:
    """Adds ``media_type``: the part's override, else its extension's default, else octet-stream.

    ``overrides(path, override)`` and ``defaults(extension, default)`` are a package's content types.
    """
    extension = F.lower(F.regexp_extract("path", r"\.([^./]+)$", 1))
    found = parts.withColumn("__extension", extension).join(overrides, "path", "left").join(defaults.withColumnRenamed("extension", "__extension"), "__extension", "left")
    return found.withColumn("media_type", F.coalesce("override", "default", F.lit("application/octet-stream"))).drop("__extension", "override", "default")


def resource_kind(path: Column, media_type: Column, flags: Column) -> Column:
    """Kind of resource that a part is, null if none."""
    lower, media = F.lower(path), F.coalesce(media_type, F.lit(""))
    return (
        F.when(_has(lower, "/media/") | media.startswith("image/"), "image")
        .when(_has(lower, "/embeddings/") | F.array_contains(flags, "embedded_object"), "embedded_document")
        .when(_has(lower, "vbaproject") | F.array_contains(flags, "macro"), "macro_project")
        .when(_has(lower, "/activex/") | F.array_contains(flags, "activex"), "activex_control")
        .when(_has(lower, "/fonts/") | _has(F.lower(media), "font"), "font")
        .when(lower.startswith("theme/") | _has(lower, "/theme/"), "theme")
    )


def occurrences(relationships: DataFrame, resources: DataFrame) -> DataFrame:
    """Where resources are used: ``relationships(relationship_id, owner_id, target)`` whose target is a resource's path."""
    return relationships.join(resources.select(F.col("path").alias("target"), "resource_id", "kind"), "target")


def unused(resources: DataFrame, found: DataFrame) -> DataFrame:
    return resources.join(found, "resource_id", "left_anti")


def dangling(found: DataFrame, resources: DataFrame) -> DataFrame:
    """Occurrences whose resource nothing defines: what a catalog must not have."""
    return found.join(resources.select("resource_id"), "resource_id", "left_anti")
