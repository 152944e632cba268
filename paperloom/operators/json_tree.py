"""Walks through JSON documents of any shape: level by level over a table, never one document in Python.

A frontier holds one row per object or array that hasn't been opened; a round opens all of them (``variant_explode``)
and keeps those of their members that hold further members. Rounds follow the deepest nesting, whatever the number of
documents; each frontier is written to the shared folder.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import REFERENCE_FIELDS
from ..storage import kept

SCHEMA = "map<string,variant>"


def _object(v: Column) -> Column:
    return F.try_variant_get(v, "$", SCHEMA)


def _list(v: Column) -> Column:
    return F.try_variant_get(v, "$", "array<variant>")


def frontiers(rows: DataFrame, key: str, document: Column) -> list[DataFrame]:
    """Per level a table (key, path, v) of the objects and arrays there; texts that are no JSON have none.

    ``path`` is a JSON pointer: names behind slashes, ``~`` and ``/`` in names as ``~0`` and ``~1``.
    """
    holds = lambda v: _object(v).isNotNull() | _list(v).isNotNull()
    level = rows.select(F.col(key).alias("key"), F.lit("").alias("path"), F.try_parse_json(document).alias("v")).filter(holds(F.col("v")))
    levels, level = [], kept(level, "frontier")
    while not level.isEmpty():
        levels.append(level)
        inner = level.withColumnRenamed("key", "document").lateralJoin(level.sparkSession.tvf.variant_explode(F.col("v").outer())).filter(holds(F.col("value")))
        name = F.coalesce(F.replace(F.replace("key", F.lit("~"), F.lit("~0")), F.lit("/"), F.lit("~1")), F.col("pos").cast("string"))
        level = kept(inner.select(F.col("document").alias("key"), F.concat("path", F.lit("/"), name).alias("path"), F.col("value").alias("v")), "frontier")
    return levels


def _union(parts: list[DataFrame], rows: DataFrame, key: str, schema: str) -> DataFrame:
    if parts:
        return reduce(DataFrame.unionByName, parts).withColumnRenamed("key", key)
    return rows.select(key).limit(0).select(key, *[F.lit(None).cast(t).alias(n) for n, t in (x.split() for x in schema.split(", "))])


def references(rows: DataFrame, key: str, document: Column, fields: list[str] = REFERENCE_FIELDS) -> DataFrame:
    """(key, pointer, fields...) of every object that has all these fields, wherever it lies and whatever else it holds.

    Fields that aren't texts are given as JSON.
    """

    def found(level: DataFrame) -> DataFrame:
        opened = level.select("key", F.col("path").alias("pointer"), _object(F.col("v")).alias("o"))
        whole = opened.filter(reduce(Column.__and__, [F.element_at("o", F.lit(f)).isNotNull() for f in fields]))
        text = lambda f: F.when(F.schema_of_variant(F.element_at("o", F.lit(f))) == "STRING", F.try_variant_get(F.element_at("o", F.lit(f)), "$", "string")).otherwise(F.to_json(F.element_at("o", F.lit(f))))
        return whole.select("key", "pointer", *[text(f).alias(f) for f in fields])

    return _union([found(x) for x in frontiers(rows, key, document)], rows, key, ", ".join(f"{c} string" for c in ("pointer", *fields)))


def string_references(rows: DataFrame, key: str, document: Column, names: list[str]) -> DataFrame:
    """(key, reference), distinct: the texts in arrays that stand under one of these names in any object."""

    def found(level: DataFrame) -> DataFrame:
        members = level.select("key", F.explode(F.map_filter(_object(F.col("v")), lambda k, v: k.isin(names))).alias("name", "member"))
        each = members.select("key", F.explode(_list(F.col("member"))).alias("x")).filter(F.schema_of_variant("x") == "STRING")
        return each.select("key", F.try_variant_get("x", "$", "string").alias("reference"))

    return _union([found(x) for x in frontiers(rows, key, document)], rows, key, "reference string").distinct()
