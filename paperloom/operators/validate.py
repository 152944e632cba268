"""Set comparison, reference integrity and rule checks over contracts and packages."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def profile_differences(requested: DataFrame, observed: DataFrame, key: str) -> DataFrame:
    """(key, profile, difference): requested profiles that are missing, observed ones that are unexpected or repeated."""
    rows = requested.select(key, "profile", F.lit(1).alias("want"), F.lit(0).alias("have")).unionByName(observed.select(key, "profile", F.lit(0).alias("want"), F.lit(1).alias("have")))
    sums = rows.groupBy(key, "profile").agg(F.sum("want").alias("want"), F.sum("have").alias("have"))
    difference = F.when(F.col("have") == 0, "missing").when(F.col("want") == 0, "unexpected").when(F.col("have") > 1, "duplicate")
    return sums.select(key, "profile", difference.alias("difference")).filter("difference IS NOT NULL")


def snapshot_differences(before: DataFrame, after: DataFrame) -> DataFrame:
    """(path, change) between two snapshots (path, hash): added, removed or modified."""
    b, a = before.select("path", F.col("hash").alias("old")), after.select("path", F.col("hash").alias("new"))
    joined = b.join(a, "path", "full_outer")
    change = F.when(F.col("old").isNull(), "added").when(F.col("new").isNull(), "removed").when(F.col("old") != F.col("new"), "modified")
    return joined.select("path", change.alias("change")).filter("change IS NOT NULL")


def reference_failures(references: DataFrame, targets: DataFrame) -> DataFrame:
    """(reference_id, failure) of references (reference_id, path, hash) to targets (path, hash)."""
    found = references.join(targets.select("path", F.col("hash").alias("actual")), "path", "left")
    portable = (F.col("path") != "") & ~F.col("path").startswith("/") & ~F.contains("path", F.lit("\\")) & ~F.array_contains(F.split("path", "/"), "..")
    failure = F.when(~portable, "not_portable").when(F.col("actual").isNull(), "missing").when(F.col("actual") != F.col("hash"), "hash_mismatch")
    return found.select("reference_id", failure.alias("failure")).filter("failure IS NOT NULL")


def undeclared(present: DataFrame, declared: DataFrame) -> DataFrame:
    """(path, side) of files that only one of both has."""
    one = present.join(declared, "path", "left_anti").select("path", F.lit("undeclared").alias("side"))
    two = declared.join(present, "path", "left_anti").select("path", F.lit("absent").alias("side"))
    return one.unionByName(two)


def checks(rows: DataFrame, key: str, rules: list[tuple[str, Column, str]]) -> DataFrame:
    """(key, rule, level) of every rule (name, condition of failure, level) that a row fails: one pass over the rows."""
    failed = [F.when(condition, F.struct(F.lit(name).alias("rule"), F.lit(level).alias("level"))) for name, condition, level in rules]
    out = rows.select(key, F.explode(F.filter(F.array(*failed), lambda f: f.isNotNull())).alias("f"))
    return out.select(key, "f.rule", "f.level")


def implied(nodes: DataFrame, implications: list[tuple[str, str]]) -> DataFrame:
    """(run_id, marker, lacking): markers without the completed node that they imply, for ``nodes(run_id, name)``."""
    own = nodes.groupBy("run_id").agg(F.collect_set("name").alias("names"))  # a run has a fixed number of stages
    rules = F.array(*[F.struct(F.lit(m).alias("marker"), F.lit(n).alias("lacking")) for m, n in implications])
    return own.select("run_id", F.explode(F.filter(rules, lambda r: F.array_contains("names", r["marker"]) & ~F.array_contains("names", r["lacking"]))).alias("r")).select("run_id", "r.marker", "r.lacking")


def rendering_failures(surfaces: DataFrame) -> DataFrame:
    """(surface_id, rule) for arrays of serialized, visible, clipped and omitted ids per surface, where a surface says
    so too for the ids that have ``geometry`` and for its ``n_visible``."""
    rules = [
        ("visible_not_serialized", F.size(F.array_except("visible", "serialized")) > 0),
        ("clipped_not_visible", F.size(F.array_except("clipped", "visible")) > 0),
        ("omitted_serialized", F.size(F.array_intersect("omitted", "serialized")) > 0),
    ]
    if "geometry" in surfaces.columns:
        rules.append(("visible_without_geometry", F.size(F.array_except("visible", "geometry")) > 0))
    if "n_visible" in surfaces.columns:
        rules.append(("summary", F.size(F.array_distinct("visible")) != F.col("n_visible")))
    return reduce(DataFrame.unionByName, [surfaces.filter(c).select("surface_id", F.lit(n).alias("rule")) for n, c in rules])


def schema_failures(rows: DataFrame, key: str, constraints: list[tuple[str, str, object]]) -> DataFrame:
    """(key, path, rule) of every constraint that a row breaks, in order of path and rule.

    A constraint is (column, rule, argument): ``required``, ``enum`` with its values, ``pattern`` with an expression,
    ``minimum`` and ``maximum`` with a number, ``max_length`` with a number, ``absent_unless`` and ``present_if`` with
    (column, values). A null breaks ``required`` and ``present_if`` alone.
    """

    def broken(column: str, rule: str, argument) -> Column:
        c = F.col(column)
        if rule in ("absent_unless", "present_if"):
            holds = F.coalesce(F.col(argument[0]).isin(list(argument[1])), F.lit(False))
            return c.isNotNull() & ~holds if rule == "absent_unless" else c.isNull() & holds
        return {
            "required": lambda: c.isNull(), "enum": lambda: ~c.isin(list(argument)), "pattern": lambda: ~c.rlike(argument), "minimum": lambda: c < argument, "maximum": lambda: c > argument, "max_length": lambda: F.length(c) > argument
        }[rule]()

    found = [F.when(F.coalesce(broken(*x), F.lit(False)), F.struct(F.lit(x[0]).alias("path"), F.lit(x[1]).alias("rule"))) for x in sorted(constraints, key=lambda x: (x[0], x[1]))]
    out = rows.select(key, F.explode(F.filter(F.array(*found), lambda f: f.isNotNull())).alias("f"))
    return out.select(key, "f.path", "f.rule")


# Constraints of the ingestion's tables, by table ----------------------------------------------------------
ID = r"^[a-z][a-z0-9_]{1,31}_[A-Za-z0-9._:-]{4,160}$"
SHA256 = r"^[a-f0-9]{64}$"
CONTRACTS: dict[str, tuple[str, list[tuple[str, str, object]]]] = {
    "artifacts": ("artifact_id", [("artifact_id", "pattern", ID), ("sha256", "required", None), ("sha256", "pattern", SHA256), ("size_bytes", "minimum", 0), ("ordinal", "minimum", 0)]),
    "documents": ("document_id", [("document_id", "pattern", ID), ("format_name", "required", None), ("confidence", "minimum", 0.0), ("confidence", "maximum", 1.0), ("capability", "enum", ["supported", "partial"])]),
    "members": ("part_id", [("part_id", "pattern", ID), ("inflated", "minimum", 0), ("read_state", "enum", ["read", "failed", "blocked", "not_read"]), ("sha256", "pattern", SHA256), ("sha256", "present_if", ("read_state", ["read_file"]))]),
    "ir_units": ("unit_id", [("unit_id", "pattern", ID), ("kind", "required", None), ("ordinal", "minimum", 0), ("origin", "enum", ["native_projection", "synthetic"]), ("native_id", "present_if", ("origin", ["native_projection"])), ("native_id", "absent_unless", ("origin", ["native_projection"]))]),
    "surfaces": ("surface_id", [("surface_id", "pattern", ID), ("width", "minimum", 0.0), ("height", "minimum", 0.0), ("fidelity", "enum", ["exact", "approximate", "not_assessed"]), ("unit", "enum", ["px", "pt"])]),
    "edges": ("mapping_id", [("mapping_id", "pattern", ID), ("source_id", "required", None), ("target_id", "required", None), ("confidence", "minimum", 0.0), ("confidence", "maximum", 1.0), ("exactness", "enum", ["exact", "approximate", "inferred"])]),
    "assets": ("asset_id", [("asset_id", "pattern", ID), ("sha256", "pattern", SHA256), ("size_bytes", "minimum", 0), ("role", "enum", ["preview", "passthrough"]), ("payload", "present_if", ("role", ["preview"]))]),
    "losses": ("loss_id", [("loss_id", "pattern", ID), ("severity", "enum", ["info", "warning", "error", "critical"]), ("n_refs", "minimum", 1)]),
    "scores": ("document_id", [("score", "minimum", 0.0), ("score", "maximum", 1.0)]),
}
