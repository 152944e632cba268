"""Ordered state sets. A maximum by rank is a maximum of (rank, state) pairs, which aggregates before the shuffle."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# States from mildest to gravest ------------------------------------------------------------------------
STATUS = ["ok", "review", "rejected", "error", "cancelled"]
DECISION = ["allow", "allow_restricted", "review", "block"]
SEVERITY = ["info", "warning", "error", "critical"]
EXACTNESS = ["inferred", "approximate", "exact"]


def rank(state: Column, order: list[str]) -> Column:
    return F.array_position(F.array(*[F.lit(s) for s in order]), state) - 1


def state_of(rank_column: Column, order: list[str]) -> Column:
    # Spark takes the element of an array without nulls to be never null, whatever the place
    return F.when(rank_column.isNotNull(), F.element_at(F.array(*[F.lit(s) for s in order]), (rank_column + 1).cast("int")))


def gravest(state: Column, order: list[str]) -> Column:
    """Aggregate: the state of highest rank."""
    return state_of(F.max(rank(state, order)), order)
