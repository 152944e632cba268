"""Hashes of sets of any size: a tree of hashes over numbered leaves.

Members are put in order and numbered over the whole table, ``FANOUT`` neighbours of a group are hashed together, then
the hashes of the next level, until each group has one. No task holds more than ``FANOUT`` members of a group, and the
result depends on nothing but the members and their order: not on partitions, nor on how large other groups are.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.windows import numbered
from ..storage import kept

FANOUT = 1024


def roots(members: DataFrame, group: list[str], by: list[str], leaf: Column, fanout: int = FANOUT) -> DataFrame:
    """(group..., n, root): the size and hash of each group's members in order of the columns ``by``.

    ``leaf`` is a member's hex digest. A node is the SHA-256 of its children's digests, each followed by a line feed; a
    level of one node is the last. The root is the SHA-256 of the group's size, a colon and that node.
    Columns ``group`` may be null; a null leaf counts as an empty text. ``by`` must tell a group's members apart.
    """
    if fanout < 2:
        raise ValueError("a node has two children at least")
    names = [F.col(f"`{c}`") for c in group]
    rows = members.select(*names, *[F.col(f"`{c}`") for c in by if c not in group], F.coalesce(leaf, F.lit("")).alias("__digest"))
    nodes = kept(numbered(rows, by, "__no", within=group).select(*names, "__no", "__digest"), "leaves")
    sizes = nodes.groupBy(*names).agg(F.count("*").alias("n"))
    most = sizes.agg(F.max("n")).first()[0] or 0
    while most > 1:
        inner = nodes.groupBy(*names, F.floor(F.col("__no") / fanout).alias("__next")).agg(F.array_sort(F.collect_list(F.struct("__no", "__digest"))).alias("own"))
        text = F.aggregate("own", F.lit(""), lambda a, x: F.concat(a, x["__digest"], F.lit("\n")))
        # number 0 alone is a group's only node, as a group of several has two under its first place: it goes up as it is
        lone = (F.size("own") == 1) & (F.col("__next") == 0)
        nodes = kept(inner.select(*names, F.col("__next").alias("__no"), F.when(lone, F.get("own", F.lit(0))["__digest"]).otherwise(F.sha2(F.encode(text, "UTF-8"), 256)).alias("__digest")), "nodes")
        most = -(-most // fanout)
    same = reduce(Column.__and__, [F.col(f"`{c}`").eqNullSafe(F.col(f"__g{i}")) for i, c in enumerate(group)], F.lit(True))
    joined = nodes.join(sizes.select(*[F.col(f"`{c}`").alias(f"__g{i}") for i, c in enumerate(group)], "n"), same)
    return joined.select(*names, "n", F.sha2(F.encode(F.concat(F.col("n").cast("string"), F.lit(":"), F.col("__digest")), "UTF-8"), 256).alias("root"))
