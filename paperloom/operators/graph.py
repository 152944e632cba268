"""Recursive work on edge tables: inheritance, nearest ancestors, cycles, strongly connected components.

A node keeps one pointer and what it knows so far, never a list of its ancestors: every round it takes over what the
node at its pointer knows and then points to where that one points, so that a chain of n links takes log2(n) rounds
and the tables stay as large as their result. Cycles and components are searched for over numbers of nodes, whatever
the nodes are; their joins are shuffled, since a table of numbers is small in its files and large once it is broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import kept


def _pointers(edges: DataFrame) -> DataFrame:
    """(node, parent): one parent each, the smallest."""
    known = edges.filter("node IS NOT NULL AND parent IS NOT NULL")
    return kept(known.groupBy("node").agg(F.min("parent").alias("parent")), "pointers")


def _doubled(pointers: DataFrame) -> DataFrame:
    """Every pointer moved on to where the node it points to points; those that reach an end go."""
    ahead = pointers.select(F.col("node").alias("parent"), F.col("parent").alias("next"))
    return kept(pointers.join(ahead, "parent").select("node", F.col("next").alias("parent")), "pointers")


def inherited(values: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, name, value): every property that a node has or inherits; the nearest one wins.

    ``values(node, name, value)`` are own properties, ``edges(node, parent)`` say what a node is based on (one parent;
    of several the smallest counts). Of repeated properties the smallest value counts.
    """
    known = kept(values.groupBy("node", "name").agg(F.min("value").alias("value")).withColumn("depth", F.lit(0).cast("long")), "inherited")
    pointers = _pointers(edges)
    nodes = left = pointers.count()
    reach = 1
    while left and reach <= 2 * nodes:
        above = known.withColumnRenamed("node", "parent").withColumn("depth", F.col("depth") + reach)
        taken = pointers.join(above, "parent").select("node", "name", "value", "depth")
        nearest_first = F.min_by(F.struct("value", "depth"), "depth").alias("best")
        known = kept(known.unionByName(taken).groupBy("node", "name").agg(nearest_first).select("node", "name", "best.value", "best.depth"), "inherited")
        pointers = _doubled(pointers)
        left, reach = pointers.count(), reach * 2
    return known.select("node", "name", "value")


def nearest(addresses: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, address): a node's own address, else that of its nearest ancestor with one; null without any."""
    own = addresses.filter("address IS NOT NULL").select("node", F.lit("address").alias("name"), F.col("address").alias("value"))
    found = inherited(own, edges).select("node", F.col("value").alias("address"))
    return addresses.select("node").distinct().join(found, "node", "left")


def _shuffled(left: DataFrame, right: DataFrame, on: str | list[str], how: str = "inner") -> DataFrame:
    return left.hint("merge").join(right.hint("merge"), on, how)


def _on_cycles(pointers: DataFrame) -> DataFrame:
    """The pointers (node, parent), moved on, of the nodes that lie on cycles.

    Each round drops the nodes whose pointer has ended and those that no pointer leads to. A round that drops none has
    found every node left pointing to another and pointed to: the pointers swap these nodes among themselves, so that
    all of them lie on cycles. That takes as many rounds as the logarithm of the longest chain.
    """
    left, before = pointers.count(), None
    while left and left != before:
        ahead = pointers.select(F.col("node").alias("parent"), F.col("parent").alias("next"))
        entered = pointers.select(F.col("parent").alias("node")).distinct()
        moved = _shuffled(pointers, ahead, "parent").select("node", F.col("next").alias("parent"))
        pointers, before = kept(_shuffled(moved, entered, "node", "left_semi"), "pointers"), left
        left = pointers.count()
    return pointers


def pointer_cycles(pointers: DataFrame) -> DataFrame:
    """(node) of the nodes that lead back to themselves; ``pointers(node, parent)`` has a node once."""
    known = pointers.filter("node IS NOT NULL AND parent IS NOT NULL")
    coded = kept(known.select("node", "parent", F.monotonically_increasing_id().alias("id")), "nodes")
    ends = coded.select(F.col("node").alias("parent"), F.col("id").alias("to"))
    found = _on_cycles(kept(_shuffled(coded, ends, "parent").select(F.col("id").alias("node"), F.col("to").alias("parent")), "pointers"))
    return _shuffled(coded.select("node", "id"), found.select(F.col("node").alias("id")), "id", "left_semi").select("node")


def on_cycles(edges: DataFrame) -> DataFrame:
    """(node) of the nodes that lead back to themselves, where every node has one parent (of several the smallest)."""
    known = edges.filter("node IS NOT NULL AND parent IS NOT NULL")
    return pointer_cycles(known.groupBy("node").agg(F.min("parent").alias("parent")))


def on_cycles_within(edges: DataFrame, group: str) -> DataFrame:
    """(group, node) of the nodes that lead back to themselves; edges (group, node, parent) stay within their group.

    Groups whose nodes have one parent each are followed by doubling pointers; only those in which a node has several
    need strongly connected components.
    """
    within = lambda rows: rows.select(F.struct(group, "node").alias("node"), F.struct(group, F.col("parent").alias("node")).alias("parent"))
    known = edges.filter("node IS NOT NULL AND parent IS NOT NULL").select(group, "node", "parent")
    pointers = kept(known.groupBy(group, "node").agg(F.min("parent").alias("parent"), F.max("parent").alias("last")), "parents")
    several = kept(pointers.filter("parent <> last").select(F.struct(group).alias("several")).distinct(), "several-parents")  # of a struct, so that null is a group
    if several.isEmpty():
        found = pointer_cycles(within(pointers))
    else:
        marked = lambda rows: rows.withColumn("several", F.struct(group))
        single, other = _shuffled(marked(pointers), several, "several", "left_anti"), _shuffled(marked(known), several, "several", "left_semi")
        found = pointer_cycles(within(single)).unionByName(strongly_connected(within(other)).select("node"))
    return found.select("node.*")


def _trimmed(edges: DataFrame) -> DataFrame:
    """The edges from nodes that something leads to, to nodes that lead on: no other lies on a cycle."""
    entered = edges.select(F.col("parent").alias("node")).distinct()
    left = edges.select(F.col("node").alias("parent")).distinct()
    return kept(edges.join(entered, "node", "left_semi").join(left, "parent", "left_semi").select("node", "parent"), "trimmed")


def _further(links: DataFrame, known: DataFrame) -> DataFrame:
    """``known(side, node, best, before)`` with what a node's neighbours know, and what the node that it knows of knew."""
    ahead = links.join(known.select("side", F.col("node").alias("parent"), "best"), ["side", "parent"]).groupBy("side", "node").agg(F.min("best").alias("ahead"))
    taken = known.join(ahead, ["side", "node"], "left").select("side", "node", F.least("best", "ahead").alias("best"), "before")
    further = known.select("side", F.col("node").alias("at"), F.col("best").alias("further"))
    jumped = taken.withColumn("at", F.col("best.at")).join(further, ["side", "at"])
    return jumped.select("side", "node", F.least("best", "further").alias("best"), "before")


def firsts(edges: DataFrame, seed: int = 0) -> DataFrame:
    """(node, to, from): of the nodes that a node leads to, and of those that lead to it (itself included in both), the
    one that comes first in a random order.

    Every round a node takes over what its neighbours know, and what the node that it knows of knows. Since the order
    is random, that node lies about anywhere among the nodes looked at so far, so that these about double every round,
    on long chains too.
    """
    links = kept(edges.select(F.lit(0).alias("side"), "node", "parent").unionByName(edges.select(F.lit(1).alias("side"), F.col("parent").alias("node"), F.col("node").alias("parent"))), "links")
    own = F.struct(F.xxhash64(F.lit(seed), "node").alias("rank"), F.col("node").alias("at")).alias("best")
    nodes = links.select(F.explode(F.array("node", "parent")).alias("node")).distinct()
    known, moved = kept(nodes.select(F.explode(F.array(F.lit(0), F.lit(1))).alias("side"), "node", own), "firsts"), 1
    while moved:
        step = _further(links, _further(links, known.withColumn("before", F.col("best"))))
        step = kept(step.select("side", "node", "best", (F.col("best") < F.col("before")).alias("moved")), "firsts")
        moved, known = step.filter("moved").count(), step.drop("moved")
    return known.groupBy("node").agg(F.max(F.when(F.col("side") == 0, F.col("best.at"))).alias("to"), F.max(F.when(F.col("side") == 1, F.col("best.at"))).alias("from"))


def _cycles(pointers: DataFrame) -> DataFrame:
    """(node, first) of the nodes on cycles of pointers; a cycle's first is its smallest node."""
    own = _on_cycles(pointers).select("node")
    known, moved = kept(_shuffled(pointers, own, "node", "left_semi").select("node", F.col("parent").alias("at"), F.col("node").alias("first")), "cycles"), 1
    while moved:
        ahead = known.select(F.col("node").alias("at"), F.col("at").alias("next"), F.col("first").alias("further"))
        step = _shuffled(known, ahead, "at").select("node", F.col("next").alias("at"), F.least("first", "further").alias("first"), (F.col("further") < F.col("first")).alias("moved"))
        step = kept(step, "cycles")
        moved, known = step.filter("moved").count(), step.drop("moved")
    return known.select("node", "first")


def _contracted(edges: DataFrame) -> tuple[DataFrame, DataFrame | None, tuple | None]:
    """(edges left, components found, what ``_lifted`` needs): nodes with one parent go into the node that their parents
    lead to, the first with none or several.

    Whatever lies on a cycle with such a node lies on one with that parent, so that the others' components stay as they
    are. Nodes that follow single parents round a cycle are a component; those that only lead to it lie on none. While
    any pointer ends at all, each round has some that end: without one, what is left never ends.
    """
    single = edges.groupBy("node").agg(F.min("parent").alias("to"), F.count("*").alias("n")).filter("n = 1").select("node", "to")
    single = kept(single, "single")
    if single.isEmpty():
        return edges, None, None
    inner = single.select(F.col("node").alias("to"), F.lit(False).alias("ends"))
    levels = [kept(_shuffled(single, inner, "to", "left").select("node", "to", F.coalesce("ends", F.lit(True)).alias("ends")), "contracted")]
    active, before = levels[0].filter("NOT ends").count(), None
    while active and active != before:
        last = levels[-1]
        ahead = last.select(F.col("node").alias("to"), F.col("to").alias("next"), F.col("ends").alias("done"))
        moved = _shuffled(last.filter("NOT ends"), ahead, "to").select("node", F.col("next").alias("to"), F.col("done").alias("ends"))
        levels.append(kept(last.filter("ends").unionByName(moved), "contracted"))
        active, before = levels[-1].filter("NOT ends").count(), active
    roots = levels[-1].filter("ends").select(F.col("node").alias("parent"), F.col("to").alias("root"))
    outer = _shuffled(edges, single, "node", "left_anti")
    found = None
    if active:
        endless = levels[-1].filter("NOT ends").select("node")
        found = _cycles(kept(_shuffled(single, endless, "node", "left_semi").select("node", F.col("to").alias("parent")), "pointers"))
        outer = _shuffled(outer, endless.select(F.col("node").alias("parent")), "parent", "left_anti")
    entries = kept(_shuffled(outer, roots, "parent", "left").select("node", "parent", "root"), "entries")
    rest = entries.select("node", F.coalesce("root", "parent").alias("parent")).filter("node <> parent").distinct()
    return kept(rest, "edges"), found, (levels[:-1], entries.filter("root IS NOT NULL"))


def _lifted(found: DataFrame, levels: list[DataFrame], entries: DataFrame) -> DataFrame:
    """``found(node, first)`` with the nodes that went into others: those between a node where their component enters
    the tree of single parents and its root."""
    of = lambda node, first: found.select(F.col("node").alias(node), F.col("first").alias(first))
    known = _shuffled(_shuffled(entries, of("node", "from_first"), "node", "left"), of("root", "root_first"), "root", "left")
    entered = kept(known.filter("node = root OR from_first = root_first").select("parent", "root", "root_first", F.coalesce("root_first", "root").alias("first")), "entered")
    alone = entered.filter("root_first IS NULL").select(F.col("root").alias("node"), "first").distinct()
    marked = entered.select(F.col("parent").alias("node"), "first").distinct()
    for i, level in enumerate(levels, 1):
        ahead = level.filter("NOT ends").select("node", "to")
        marked = _shuffled(marked, ahead, "node", "left").select(F.explode(F.array_compact(F.array("node", "to"))).alias("node"), "first").distinct()
        if i % 4 == 0:
            marked = kept(marked, "marked")
    return kept(found.unionByName(alone).unionByName(marked), "components")


def _split(edges: DataFrame, seed: int) -> tuple[DataFrame, DataFrame]:
    """(edges left, components found) by the first nodes of a random order.

    Where the first node that a node leads to and the first that leads to it are one, that node's component is found;
    nodes of different pairs are never in one component, so that edges between them go.
    """
    pairs = kept(firsts(edges, seed), "pairs")
    own = pairs.filter("to = from")
    groups = own.groupBy(F.col("to").alias("first")).agg(F.count("*").alias("n")).filter("n > 1")
    found = _shuffled(own.select("node", F.col("to").alias("first")), groups, "first", "left_semi").select("node", "first")
    open_ = pairs.filter("to <> from")
    ends = open_.select(F.col("node").alias("parent"), F.col("to").alias("parent_to"), F.col("from").alias("parent_from"))
    inner = edges.join(open_, "node").join(ends, "parent").filter("to = parent_to AND from = parent_from")
    return _trimmed(inner.select("node", "parent")), kept(found, "components")


def strongly_connected(edges: DataFrame) -> DataFrame:
    """(node, component) of every node on a cycle; nodes that lead to each other share a component, named by the smallest.

    ``edges(node, parent)`` may give a node any number of parents; repeated edges and edges of null ends count for
    nothing, an edge to itself is a cycle. Nodes with a single parent, and nodes that are the single child of another's
    (the same, seen backward), are contracted first, which takes long chains in the logarithm of their length; where
    that leaves over half of the edges, a round of ``_split`` follows. What was contracted gets its component at the end.
    """
    known = kept(edges.filter("node IS NOT NULL AND parent IS NOT NULL").select("node", "parent").distinct(), "edges")
    names = kept(known.select("node").distinct().withColumn("id", F.monotonically_increasing_id()), "nodes")
    coded = _shuffled(known, names.select("node", F.col("id").alias("from")), "node").select("parent", "from")
    # what nothing leads on from lies on no cycle
    everything = kept(_shuffled(coded, names.select(F.col("node").alias("parent"), F.col("id").alias("to")), "parent").select(F.col("from").alias("node"), F.col("to").alias("parent")), "edges")
    own = everything.filter("node = parent").select("node", F.col("node").alias("first"))
    found, stack, seed = own.limit(0), [], 0
    rest = _trimmed(everything.filter("node <> parent"))
    left = rest.count()
    turned = lambda df: df.select(F.col("parent").alias("node"), F.col("node").alias("parent"))
    while left:
        for _ in range(2):
            rest, cycles, levels = _contracted(rest)
            rest = turned(rest)
            found = found if cycles is None else found.unionByName(cycles)
            stack += [] if levels is None else [levels]
        rest, before = _trimmed(rest), left
        left = rest.count()
        if 2 * left > before:
            rest, more = _split(rest, seed)
            found, seed, left = found.unionByName(more), seed + 1, rest.count()
    for levels in reversed(stack):
        found = _lifted(found, *levels)
    # an edge to itself may lie in a larger component: that one counts
    one = kept(found.unionByName(_shuffled(own, found, "node", "left_anti")), "components")
    named = kept(_shuffled(names.withColumnRenamed("node", "name"), one.withColumnRenamed("node", "id"), "id").select("name", "first"), "components")
    least = named.groupBy("first").agg(F.min("name").alias("component"))
    return named.join(least, "first").select(F.col("name").alias("node"), "component")
