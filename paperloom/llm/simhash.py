"""SimHash near-duplicates with pigeonring filtering.

Fingerprints: 64 bits, each set where over half of a text's word shingles hash with that bit set (XXH64, seed 42).
Links: two fingerprints with ``radius`` (2) or fewer differing bits. The bits are dealt into a ring of six segments.
The pigeonring principle says that two such fingerprints have a chain of consecutive segments, from some start, whose
differences over the first k segments stay within k * radius / 6 for every k: its first two segments agree, and of
the next three at most one bit differs, so that two of those three agree too. A chain's four agreeing segments are
the join key; all chains together have fifteen such keys of 42 to 44 bits. Candidates that meet under a key must pass
the chain test before the full Hamming distance is computed.

Copies first collapse into one row per fingerprint, so a group's size never matters, and a key under which few
fingerprints meet is joined pair by pair. A key under which many meet is handled exactly without pairs: two of its
fingerprints are linked if and only if they share a neighbour that differs from each by at most one of the key's
remaining bits, so every fingerprint is listed under those (22 at most, and itself) and each list is tied together.

Components are those of all links; the smallest ``doc_id`` names them.

Nulls and odd rows: a null, empty or blank text has fingerprint zero and is linked like any other. A row of null
``doc_id`` belongs to its component but never names it, unless the component has no ids at all (then it is null).
Any 64-bit number may be an id. Repeated rows are kept. An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import storage
from .components import connected_components

SHINGLE = 3
RADIUS = 2
#: First bit and length of the ring's segments.
SEGMENTS = [(0, 11), (11, 11), (22, 11), (33, 11), (44, 10), (54, 10)]
#: A key with more fingerprints is handled by shared neighbours instead of pairs.
PAIRED = 32


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def segment_masks() -> list[int]:
    return [((1 << n) - 1) << a for a, n in SEGMENTS]


def chain_keys() -> list[int]:
    """Masks of the bits on which a viable chain must agree, for every start and every place of its one odd segment."""
    masks, found = segment_masks(), set()
    for start in range(6):
        first, second, *rest = [(start + i) % 6 for i in range(5)]
        for odd in rest:
            found.add(sum(masks[i] for i in {first, second, *rest} - {odd}))
    return sorted(found)


def shingle_hashes(text: str | None, size: int) -> np.ndarray:
    """XXH64 of every run of ``size`` words; a shorter text is one run, one without words none."""
    import xxhash

    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined, n = b" ".join(words), len(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    size = min(size, n)
    h = xxhash.xxh64_intdigest
    return np.array([h(joined[a:b], 42) for a, b in zip(starts[: n - size + 1].tolist(), ends[size - 1 :].tolist())], np.uint64)


def fingerprint(hashes: np.ndarray) -> int:
    """The majority of each bit, as an unsigned number."""
    counts, n = np.zeros(64, np.int64), len(hashes)
    for a in range(0, n, 1 << 16):
        part = hashes[a : a + (1 << 16)].astype("<u8")
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > n, bitorder="little").tobytes(), "little") if n else 0


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp): each document's fingerprint as a signed 64-bit number."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [_signed(fingerprint(shingle_hashes(t.as_py(), shingle))) for t in batch["text"]]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(fps, pa.int64())], names=["doc_id", "fp"])

    return storage.in_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), compute, "doc_id long, fp long")


def _chain_viable(difference: Column, radius: int) -> Column:
    """Whether some chain's running differences stay within their share of the radius."""
    parts = [F.bit_count(difference.bitwiseAND(F.lit(_signed(m)))) for m in segment_masks()]
    viable = None
    for start in range(6):
        total, ok = None, None
        for k in range(6):
            total = parts[(start + k) % 6] if total is None else total + parts[(start + k) % 6]
            within = total <= (k + 1) * radius // 6
            ok = within if ok is None else ok & within
        viable = ok if viable is None else viable | ok
    return viable


def links(nodes: DataFrame, paired: int = PAIRED) -> DataFrame:
    """(u, v): links that connect just what fingerprints ``nodes(node, fp)`` within RADIUS connect. ``fp`` is distinct."""
    keys = F.array(*[F.struct(F.lit(i).alias("k"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("agree")) for i, m in enumerate(chain_keys())])
    keyed = nodes.select("node", "fp", F.explode(keys).alias("key")).select("node", "fp", "key.k", "key.agree")
    sizes = keyed.groupBy("k", "agree").agg(F.count("*").alias("n")).filter("n > 1")
    met = storage.staged(keyed.join(sizes, ["k", "agree"]), "simhash-candidates")
    few = met.filter(F.col("n") <= paired)
    a = few.select("k", "agree", F.col("node").alias("u"), F.col("fp").alias("fu"))
    b = few.select("k", "agree", F.col("node").alias("v"), F.col("fp").alias("fv"))
    difference = F.col("fu").bitwiseXOR(F.col("fv"))
    pairs = a.join(b, ["k", "agree"]).filter("u > v").filter(_chain_viable(difference, RADIUS)).filter(F.bit_count(difference) <= RADIUS).select("u", "v")

    bits = [F.array(F.lit(0).cast("long"), *[F.lit(_signed(1 << j)) for j in range(64) if not m >> j & 1]) for m in chain_keys()]
    flips = F.element_at(F.array(*bits), F.col("k") + 1)
    many = met.filter(F.col("n") > paired).select("k", "agree", "node", F.explode(F.transform(flips, lambda x: F.col("fp").bitwiseXOR(x))).alias("near"))
    tied = many.groupBy("k", "agree", "near").agg(F.collect_set("node").alias("own")).filter("size(own) > 1")
    stars = tied.select(F.explode("own").alias("u"), F.array_min("own").alias("v")).filter("u > v")
    return pairs.unionByName(stars).distinct()


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp, component_id) of every document."""
    rows = storage.staged(fingerprints(docs, shingle), "fingerprints")
    nodes = storage.staged(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-nodes")
    parts = connected_components(links(nodes.select(F.col("fp").alias("node"), "fp")))
    placed = nodes.join(parts, nodes.fp == parts.node, "left").select("fp", "least", F.coalesce("component", "fp").alias("component"))
    names = placed.groupBy("component").agg(F.min("least").alias("component_id"))
    return rows.join(placed.join(names, "component").select("fp", "component_id"), "fp").select("doc_id", "fp", "component_id")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op8: every document's fingerprint and component."""
    found = near_duplicates(storage.documents(spark, sf_dir))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")

