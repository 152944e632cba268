"""Security preflight, access states and acquisition budgets as rule tables over member rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ranks import DECISION, rank, state_of

# Fixed values -------------------------------------------------------------------------------------------------------
#: Name parts of members that hold active content.
ACTIVE_NAMES = ["vbaproject", "activex", "macrosheet", "customui"]
BOMB_RATIO = 200
BOMB_BYTES = 10 * 1024 * 1024


@dataclass(frozen=True)
class Budget:
    source_bytes: int = 2_147_483_648
    decompressed_bytes: int = 8_589_934_592
    parts: int = 100_000


def package_totals(members: DataFrame) -> DataFrame:
    """One row per package from ``members(package_id, path, compressed, inflated)``, aggregated before the shuffle."""
    name = F.lower("path")
    active = F.lit(False)
    for part in ACTIVE_NAMES:
        active = active | F.contains(name, F.lit(part))
    unsafe = F.col("path").startswith("/") | F.contains("path", F.lit("\\")) | F.array_contains(F.split("path", "/"), "..")
    # per name first, so that duplicates are counted without a distinct over all members at once
    named = members.groupBy("package_id", name.alias("name")).agg(
        F.count("*").alias("n"), F.sum("compressed").alias("compressed"), F.sum("inflated").alias("inflated"), F.max(unsafe).alias("unsafe"), F.max(active).alias("active")
    )
    return named.groupBy("package_id").agg(
        F.sum("n").alias("n_parts"), F.sum("compressed").alias("compressed"), F.sum("inflated").alias("inflated"), F.max("unsafe").alias("unsafe"), F.max("active").alias("active"), (F.max("n") > 1).alias("duplicated")
    )


def findings(totals: DataFrame, budget: Budget = Budget()) -> DataFrame:
    """(package_id, code, severity, effect): one row per rule that a package breaks."""
    ratio = F.col("inflated") / F.greatest(F.col("compressed"), F.lit(1))
    rules: list[tuple[Column, str, str, str]] = [
        (F.col("compressed") > budget.source_bytes, "DS-LIM-001", "critical", "block"),
        ((F.col("n_parts") > budget.parts) | (F.col("inflated") > budget.decompressed_bytes), "DS-LIM-001", "critical", "block"),
        ((ratio > BOMB_RATIO) & (F.col("inflated") > BOMB_BYTES), "DS-SEC-002", "critical", "block"),
        (F.col("unsafe") | F.col("duplicated"), "DS-SEC-001", "critical", "block"),
        (F.col("active"), "DS-SEC-003", "warning", "review"),
    ]
    broken = [F.when(c, F.struct(F.lit(code).alias("code"), F.lit(severity).alias("severity"), F.lit(effect).alias("effect"))) for c, code, severity, effect in rules]
    rows = totals.select("package_id", F.explode(F.array_distinct(F.filter(F.array(*broken), lambda f: f.isNotNull()))).alias("f"))
    return rows.select("package_id", "f.code", "f.severity", "f.effect")


def decisions(totals: DataFrame, broken: DataFrame, restricted: Column) -> DataFrame:
    """(package_id, decision, status): the gravest effect of a package's findings and restrictions."""
    gravest = broken.groupBy("package_id").agg(F.max(rank(F.col("effect"), DECISION)).alias("found"))
    base = F.when(restricted, 1).otherwise(0)
    rows = totals.join(gravest, "package_id", "left").select("package_id", F.greatest(base, F.coalesce("found", F.lit(0))).alias("rank"))
    decision = state_of(F.col("rank"), DECISION)
    status = F.when(F.col("rank") == 3, "rejected").when(F.col("rank") == 2, "review").otherwise("ok")
    return rows.select("package_id", decision.alias("decision"), status.alias("status"))


def access_state(blocked: Column, rejected: Column, encrypted: Column, has_secret: Column, restricted: Column) -> Column:
    """The first that applies of blocked, reject, secret_required, clear_restricted and clear."""
    return F.when(blocked, "blocked").when(rejected, "reject").when(encrypted & ~has_secret, "secret_required").when(restricted, "clear_restricted").otherwise("clear")


def member_restrictions(path: Column, flags: Column, encrypted: Column) -> Column:
    """Array of what a member's presence restricts: references out of the package, embedded documents, closed entries."""
    rules = [
        ("external_references_not_resolved", F.lower(path).endswith(".rels") | F.array_contains(flags, "external_link_part")),
        ("embedded_documents_not_opened", F.array_contains(flags, "embedded_object")),
        ("active_content_present_inert", F.array_contains(flags, "macro") | F.array_contains(flags, "activex")),
        ("encrypted_entries_not_read", encrypted),
    ]
    return F.filter(F.array(*[F.when(F.coalesce(c, F.lit(False)), n) for n, c in rules]), lambda x: x.isNotNull())
