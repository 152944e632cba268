"""The SimHash operator as a filter (see ``simhash``): of each group of near copies one document stays.

Two documents are near copies if their sets of five-word shingles have a similarity (Jaccard) of 0.8 or more; groups
are the connected components of what the search finds. At that similarity the fingerprints of whole texts differ in
ten bits or so, too many to look up. So the shingles are also dealt by hash into bags of about three, and each of 16
bags gets a fingerprint of its own; most bags of near copies hold the same shingles and have the same fingerprint
(two sets of n shingles at 0.8 differ in 0.22 n of them, a bag of three is the same with a probability of one half, so
that all 16 differ in about one pair of 60,000 at 0.8 and hardly ever above; sets of up to ``SMALL`` shingles have every
shingle as a bag, and any one in common makes them meet). Documents that meet under a bag's
fingerprint are compared with the first and the last of them, which ties most groups together; then all other pairs
that meet and are not in one component yet are searched for by their rarest shingles, and those are compared that no
bound on sizes, places or marks rules out (see ``rest``). What is left is decided by the exact similarity, for which
the texts are read again. Fingerprints of whole texts don't prune: no number of differing bits follows from a similarity.
With ``fingerprints``, documents whose whole fingerprints differ in at most ``simhash.RADIUS`` bits are tied as well, by
the search of ``simhash``; that is how the pipeline calls it.

Documents whose words are the same collapse first, so that the size of a group of copies never matters; no step
gathers a group in one task.

Nulls and odd rows: null, empty and blank texts are copies of each other. Of a group the smallest ``doc_id`` stays (a
null id is larger than all), of rows that share it the one of smaller hash, of fully equal rows one. An empty table
gives no rows. Extra columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import simhash, storage
from .components import connected_components

SHINGLE = 5
SIMILARITY = 0.8
BAGS = 16
BAG_SIZE = 3
#: Words of 64 bits that tell sets apart which differ in too many shingles.
MARKS = 8
#: Sets of up to SMALL shingles, and all that may be like them, have each shingle as a bag of its own.
SMALL = 16
#: Node numbers of classes without an id of their own; should one meet a document's id, both get new numbers.
NO_ID = 1 << 62


def bag_fingerprints(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(tag, fingerprint) of the bags of a set of shingle hashes, for the two bag counts nearest to its size; of a small
    set, all its shingles, since few bags may all differ."""
    level = max(0.0, np.log2(max(len(hashes), 1) / BAG_SIZE))
    tags, fps = [], []
    if len(hashes) <= SMALL / SIMILARITY:
        tags.append(np.full(len(hashes), -1))
        fps.append(np.asarray(hashes, np.uint64).view(np.int64))
    if len(hashes) <= SMALL:
        return tags[0], fps[0]
    for power in {int(np.floor(level)), int(np.ceil(level))}:
        bag = (hashes & np.uint64((1 << power) - 1)).astype(np.int64)
        own = bag < BAGS
        bag, h = bag[own], hashes[own]
        order = np.argsort(bag, kind="stable")
        bag, h = bag[order], h[order]
        if not len(bag):
            continue
        first = np.flatnonzero(np.append(True, bag[1:] != bag[:-1]))
        size = np.diff(np.append(first, len(bag)))
        bits = np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        majority = 2 * np.add.reduceat(bits, first, axis=0, dtype=np.int64) > size[:, None]
        tags.append(power * BAGS + bag[first])
        fps.append(np.packbits(majority, axis=1, bitorder="little").reshape(-1, 8).view("<i8").reshape(-1))
    return (np.concatenate(tags), np.concatenate(fps)) if tags else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def marks(hashes: np.ndarray) -> np.ndarray:
    """MARKS words of which each bit says whether an odd number of the set's hashes falls on it. Two sets differ in as
    many hashes, at least, as their words differ in bits: those they share cancel out."""
    odd = np.bincount((hashes >> np.uint64(32)).astype(np.int64) % (64 * MARKS), minlength=64 * MARKS) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8")


def _signatures(batches: Iterator[pa.RecordBatch], whole_too: bool = False) -> Iterator[pa.RecordBatch]:
    import xxhash

    for batch in batches:
        rows = []
        for doc_id, row_hash, text in zip(*(batch[c].to_pylist() for c in ("doc_id", "row_hash", "text"))):
            words = b" ".join((text or "").encode().lower().split())
            distinct = np.unique(simhash.shingle_hashes(text, SHINGLE))
            tags, fps = bag_fingerprints(distinct)
            whole = xxhash.xxh128_digest(words)
            c1, c2 = np.frombuffer(whole, "<i8").tolist()
            rows.append({"doc_id": doc_id, "row_hash": row_hash, "c1": c1, "c2": c2, "fp": simhash._signed(simhash.fingerprint(simhash.shingle_hashes(text, simhash.SHINGLE))) if whole_too else 0, "n": len(distinct), "marks": marks(distinct).tolist(), "bags": [{"tag": t, "bag_fp": f} for t, f in zip(tags.tolist(), fps.tolist())]})
        yield pa.RecordBatch.from_pylist(rows, pa.schema([*[(c, pa.int64()) for c in ("doc_id", "row_hash", "c1", "c2", "fp", "n")], ("marks", pa.list_(pa.int64())), ("bags", pa.list_(pa.struct([("tag", pa.int64()), ("bag_fp", pa.int64())])))]))


SIGNATURES = "doc_id long, row_hash long, c1 long, c2 long, fp long, n long, marks array<long>, bags array<struct<tag:long,bag_fp:long>>"


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [np.unique(simhash.shingle_hashes(t, SHINGLE)).tobytes() for t in batch["text"].to_pylist()]
        yield pa.RecordBatch.from_arrays([batch["node"], pa.array(sets, pa.binary())], names=["node", "shingles"])


def _compared(similarity: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for a, b in zip(batch["su"].to_pylist(), batch["sv"].to_pylist()):
                a, b = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
                both = len(np.intersect1d(a, b, assume_unique=True))
                keep.append(both >= similarity * (len(a) + len(b) - both) - 1e-9)
            yield pa.RecordBatch.from_arrays([batch["u"], batch["v"]], names=["u", "v"]).filter(pa.array(keep, pa.bool_()))

    return run


def _fitting(left: str, right: str, similarity: float) -> Column:
    """Whether the sizes of two sets allow the similarity."""
    return F.least(f"{left}.n", f"{right}.n") >= F.greatest(f"{left}.n", f"{right}.n") * similarity - 1e-9


def candidates(nodes: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(u, v) of documents and the first or last that they meet under a bag's fingerprint, if their sizes fit."""
    keyed = nodes.select(F.struct("node", "n").alias("own"), F.explode("bags").alias("bag")).select("own", "bag.tag", "bag.bag_fp")
    ends = keyed.groupBy("tag", "bag_fp").agg(F.min("own").alias("first"), F.max("own").alias("last")).filter("first.node < last.node")
    met = keyed.join(ends, ["tag", "bag_fp"]).select("own", F.explode(F.array("first", "last")).alias("other")).filter("own.node <> other.node")
    near = met.filter(_fitting("own", "other", similarity))
    return near.select(F.greatest("own.node", "other.node").alias("u"), F.least("own.node", "other.node").alias("v")).distinct()


def _shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        own = [np.unique(simhash.shingle_hashes(t, SHINGLE)).view(np.int64) for t in batch["text"].to_pylist()]
        nodes = np.repeat(batch["node"].to_numpy(), [len(h) for h in own])
        yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(np.concatenate([*own, np.zeros(0, np.int64)]))], names=["node", "shingle"])


def rest(placed: DataFrame, rows: DataFrame, similarity: float) -> DataFrame:
    """(u, v): every other pair that meets under a bag's fingerprint and may be similar, in different components so far.

    ``placed`` are the nodes with their component. Documents under a key of several components are paired by their
    rarest shingles, in an order common to all. Of two sets that reach the similarity s, the larger (of n shingles) has
    one of its first n - ceil(s * n) + 1 among the first m - ceil(2 * s / (1 + s) * m) + 1 of the smaller (of m), since
    they share s / (1 + s) * (n + m) at least; and a shingle they share at places i and j leaves room for that many, as
    not more than min(i, j) lie up to it in both and min(n - i, m - j) behind it. Pairs whose ``marks`` show that they
    differ in more than (1 - s) / (1 + s) * (n + m) shingles aren't written either. None of these bounds loses a pair.
    """
    keyed = placed.select(F.struct("node", "n", "component", "marks").alias("own"), F.explode("bags").alias("bag")).select("own", "bag.tag", "bag.bag_fp")
    mixed = keyed.groupBy("tag", "bag_fp").agg(F.min("own.component").alias("low"), F.max("own.component").alias("high")).filter("low < high").drop("low", "high")
    many = storage.staged(keyed.join(mixed, ["tag", "bag_fp"]).select("own.*").distinct(), "copy-open")
    wanted = placed.select("node", "doc_id", "row_hash").join(many.select("node"), "node", "left_semi")
    shingles = storage.staged(storage.in_arrow(_texts(rows, wanted), _shingles, "node long, shingle long").distinct(), "copy-shingles")
    counted = shingles.join(shingles.groupBy("shingle").agg(F.count("*").alias("holders")), "shingle")
    ranked = counted.select("node", "shingle", "holders", F.row_number().over(Window.partitionBy("node").orderBy("holders", "shingle")).alias("place"))
    least = lambda share: F.col("n") - F.ceil(F.round(F.col("n") * F.lit(share), 6)) + 1
    first = ranked.filter("holders > 1").join(many, "node").filter(F.col("place") <= least(similarity))
    prefixes = first.select("shingle", F.struct("node", "n", "component", "place", "marks", (F.col("place") <= least(2 * similarity / (1 + similarity))).alias("inner")).alias("own"))
    mixed = prefixes.groupBy("shingle").agg(F.min("own.component").alias("low"), F.max("own.component").alias("high")).filter("low < high").select("shingle")
    prefixes = storage.staged(prefixes.join(mixed, "shingle"), "copy-prefixes")
    a, b = prefixes.select("shingle", F.col("own").alias("a")), prefixes.filter("own.inner").select("shingle", F.col("own").alias("b"))
    larger = F.struct("a.n", "a.node") > F.struct("b.n", "b.node")
    room = F.least("a.place", "b.place") + F.least(F.col("a.n") - F.col("a.place"), F.col("b.n") - F.col("b.place"))
    needed = F.ceil(F.round((F.col("a.n") + F.col("b.n")) * F.lit(similarity / (1 + similarity)), 6))
    differ = reduce(Column.__add__, [F.bit_count(F.col("a.marks")[i].bitwiseXOR(F.col("b.marks")[i])) for i in range(MARKS)])
    few = differ <= (F.col("a.n") + F.col("b.n")) * F.lit((1 - similarity) / (1 + similarity)) + 1e-6
    met = a.join(b, "shingle").filter(larger & (F.col("a.component") != F.col("b.component")) & (room >= needed) & few).filter(_fitting("a", "b", similarity))
    return met.select(F.greatest("a.node", "b.node").alias("u"), F.least("a.node", "b.node").alias("v")).distinct()


def _texts(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, text) of ``wanted(node, doc_id, row_hash)``; equal rows may give a node more than once."""
    wanted = wanted.select("node", F.col("doc_id").alias("want_doc"), F.col("row_hash").alias("want_row"))
    return rows.join(wanted, (F.col("row_hash") == F.col("want_row")) & F.col("doc_id").eqNullSafe(F.col("want_doc"))).select("node", "text")


def similar(pairs: DataFrame, nodes: DataFrame, rows: DataFrame, similarity: float) -> DataFrame:
    """The pairs (u, v) that reach the similarity."""
    wanted = pairs.select(F.col("u").alias("node")).unionByName(pairs.select(F.col("v").alias("node"))).distinct()
    texts = _texts(rows, nodes.join(wanted, "node").select("node", "doc_id", "row_hash"))
    # a table by node: the joins below then read plain exchanges, whose large partitions Spark splits (a group's first
    # and last documents meet all others)
    sets = storage.staged(storage.in_arrow(texts, _sets, "node long, shingles binary").dropDuplicates(["node"]), "copy-sets")
    full = pairs.join(sets.select(F.col("node").alias("u"), F.col("shingles").alias("su")), "u").join(sets.select(F.col("node").alias("v"), F.col("shingles").alias("sv")), "v")
    return storage.staged(storage.in_arrow(full.select("u", "v", "su", "sv"), _compared(similarity), "u long, v long"), "copy-links")


def fingerprint_links(nodes: DataFrame) -> DataFrame:
    """(u, v) that tie just the documents ``nodes(node, fp)`` which whole fingerprints within the radius tie."""
    holders = storage.staged(nodes.groupBy("fp").agg(F.min("node").alias("holder")), "copy-fingerprints")
    same = nodes.join(holders, "fp").filter("node <> holder").select(F.col("node").alias("u"), F.col("holder").alias("v"))
    near = simhash.links(holders.select(F.col("fp").alias("node"), "fp"))
    near = near.join(holders.select(F.col("fp").alias("u"), F.col("holder").alias("a")), "u").join(holders.select(F.col("fp").alias("v"), F.col("holder").alias("b")), "v")
    return storage.staged(same.unionByName(near.select(F.col("a").alias("u"), F.col("b").alias("v"))), "copy-links")


def grouped(docs: DataFrame, similarity: float = SIMILARITY, fingerprints: bool = False) -> DataFrame:
    """(doc_id, row_hash, component) of every row; equal rows may come more than once."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("doc_id", "text").alias("row_hash"), "text")
    signed = storage.staged(storage.in_arrow(rows, partial(_signatures, whole_too=fingerprints), SIGNATURES), "copy-signatures")
    surrogate = F.lit(NO_ID) + F.pmod(F.xxhash64("c1", "c2"), F.lit(NO_ID))
    nodes = signed.groupBy("c1", "c2").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row_hash")).alias("least"), F.first("fp").alias("fp"), F.first("n").alias("n"), F.first("marks").alias("marks"), F.first("bags").alias("bags"))
    nodes = storage.staged(nodes.select("c1", "c2", F.col("least.doc_id").alias("doc_id"), F.col("least.row_hash").alias("row_hash"), F.coalesce("least.doc_id", surrogate).alias("node"), "fp", "n", "marks", "bags"), "copy-nodes")
    # rows of one id may differ in their words: each class needs a number of its own
    twice = nodes.groupBy("node").agg(F.count("*").alias("n")).filter("n > 1").select("node")
    if not twice.isEmpty():
        alone = nodes.join(twice, "node", "left_anti").select(*nodes.columns)
        shared = nodes.join(twice, "node", "left_semi").select(*[surrogate.alias("node") if c == "node" else F.col(c) for c in nodes.columns])
        nodes = storage.staged(alone.unionByName(shared), "copy-nodes")
    links = similar(storage.staged(candidates(nodes, similarity), "copy-candidates"), nodes, rows, similarity)
    if fingerprints:
        links = links.unionByName(fingerprint_links(nodes.select("node", "fp")))
    # most of a group is now one component, and only pairs across components are left to look at
    parts = connected_components(links)
    placed = nodes.join(parts, "node", "left").withColumn("component", F.coalesce("component", "node"))
    more = storage.staged(rest(placed, rows, similarity), "copy-candidates")
    if not more.isEmpty():
        parts = connected_components(links.unionByName(similar(more, nodes, rows, similarity)))
    named = nodes.join(parts, "node", "left").select("c1", "c2", F.coalesce("component", "node").alias("component"))
    return signed.select("doc_id", "row_hash", "c1", "c2").join(named, ["c1", "c2"]).select("doc_id", "row_hash", "component")


def distinct_documents(docs: DataFrame, similarity: float = SIMILARITY, fingerprints: bool = False) -> DataFrame:
    """``docs`` with one row of each group of near copies."""
    least = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_hash"))
    kept = grouped(docs, similarity, fingerprints).groupBy("component").agg(least.alias("least"))
    kept = storage.staged(kept.select(F.col("least.doc_id").alias("keep_doc"), F.col("least.row_hash").alias("keep_row")), "copies-kept")
    own = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("own"), F.col("doc_id").cast("long").alias("doc"), F.xxhash64("doc_id", "text").alias("row"))
    found = own.join(kept, (F.col("row") == F.col("keep_row")) & F.col("doc").eqNullSafe(F.col("keep_doc")), "left_semi")
    one = found.withColumn("number", F.row_number().over(Window.partitionBy("row", "doc").orderBy(F.lit(1)))).filter("number = 1")
    return one.select(*[F.col(f"own.`{c}`").alias(c) for c in docs.columns])
