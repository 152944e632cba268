"""Connected components of an edge table, by alternating large-star and small-star steps.

Every step is a join and an aggregate over the edges; each round is written to the shared folder, which cuts the
lineage. Rounds grow with the logarithm of the longest path. Nothing is gathered on the driver but a count and a
checksum of the edges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import storage


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % (1 << 31))).first()
    return row[0], row[1]


def _large_star(edges: DataFrame) -> DataFrame:
    """Ties each node's larger neighbours to the smallest of the node and its neighbours."""
    near = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return near.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Ties each node and its smaller neighbours to the smallest of these."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    joined = edges.join(least, "u")
    return joined.filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges(u, v)``; the component is its smallest node."""
    oriented = edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    spark = edges.sparkSession
    now, path = storage.staged_at(oriented, "edges")
    before, state = None, _state(now)
    while state != before and state[0]:
        old = path
        now, path = storage.staged_at(_small_star(_large_star(now)), "edges")
        before, state = state, _state(now)
        storage.delete(spark, old)
    stars = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.unionByName(stars.select(F.col("component").alias("node"), "component").distinct())
