"""Benchmark decontamination by size-partitioned MinHash containment search.

Words are runs of letters and digits, lower-cased; shingles are runs of five words. An item of fewer words is one
shingle as long as it is, and one without words has none; of documents, the runs of such lengths count as well as those
of five words. A document is contaminated by an item if it holds 0.8 or more of the item's distinct shingles, however
long the document is. ``clean`` takes items of ``LEAST_WORDS`` words at least for this; shorter ones, which almost any
text holds, make it drop a document only if it is nothing else.

Search: items are partitioned by the number of their shingles, and every item of a partition keeps the sketch of its
k smallest shingle hashes, where k = (the partition's largest size) - ceil(0.8 * that size) + 1. A document that lacks
all k of them lacks too many to reach 0.8, so that the search misses nothing; the documents probe the sketches with
all their shingles, and never need a sketch of their own, whose resemblance to a short item would vanish with their
length. Verification: the documents of the candidate pairs are read again, and the items' shingles, as text, are
counted in them.

Only DataFrame functions are used. The sketches, and the items' shingles, are broadcast only while they take at most
``BROADCAST_BYTES``; beyond that they are joined by shuffle.

Nulls and odd rows: null texts hold no shingles. Rows of null ids are compared like any other. Rows are documents;
equal rows give equal results, once. Items of equal text are separate items. Empty tables give no rows. Extra columns
pass through ``clean`` and are ignored by the search.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import storage

SHINGLE = 5
#: Words from which on an item within a longer document is a reason to drop it.
LEAST_WORDS = 3
CONTAINMENT = 0.8
#: Bytes of sketches, or of the items' shingles as text, up to which they are broadcast, and what a row takes besides.
BROADCAST_BYTES = 64 << 20
ROW_BYTES = 48


def word_list(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def _runs(words: Column, of, shorter: list[int] = ()) -> Column:
    """``of(list of columns)`` for every shingle of ``words``: the runs of five, or all of them if they are fewer; and
    the runs of the lengths ``shorter``."""
    none = F.array().cast("array<string>") if of is _text else F.array().cast("array<bigint>")
    run = lambda n: F.transform(F.sequence(F.lit(0), F.size(words) - n), lambda i: of([F.get(words, i + j) for j in range(n)]))
    whole = F.when(F.size(words) == 0, none)
    for n in range(1, SHINGLE):
        whole = whole.when(F.size(words) == n, F.array(of([F.get(words, F.lit(j)) for j in range(n)])))
    parts = [whole.otherwise(run(SHINGLE)), *[F.when(F.size(words) > n, run(n)).otherwise(none) for n in shorter]]
    return F.concat(*parts) if shorter else parts[0]


def _text(parts: list[Column]) -> Column:
    return F.concat_ws(" ", *parts)


def _hash(parts: list[Column]) -> Column:
    return F.xxhash64(*parts)


def _sized(df: DataFrame) -> DataFrame:
    """The frame, marked for broadcast if its rows are few enough in bytes."""
    width = F.lit(ROW_BYTES)
    for name, kind in df.dtypes:
        width = width + (F.coalesce(F.octet_length(name), F.lit(0)) if kind == "string" else F.lit(8))
    total = df.agg(F.sum(width.cast("long"))).first()[0] or 0
    return F.broadcast(df) if total <= BROADCAST_BYTES else df


def sketches(items: DataFrame, containment: float = CONTAINMENT) -> DataFrame:
    """(item_id, item_hash, n, size_class, sketch) of the items with words, a row per item and hash of its sketch."""
    rows = items.select("item_id", F.xxhash64("item_id", "text").alias("item_hash"), word_list(F.col("text")).alias("words")).filter("size(words) > 0")
    rows = rows.select("item_id", "item_hash", F.array_sort(F.array_distinct(_runs(F.col("words"), _hash))).alias("hashes"))
    rows = rows.withColumn("n", F.size("hashes")).withColumn("size_class", F.floor(F.log2("n")).cast("int"))
    largest = (F.pow(F.lit(2), F.col("size_class") + 1) - 1).cast("int")
    k = (largest - F.ceil(F.round(largest * F.lit(containment), 6)) + 1).cast("int")
    return rows.select("item_id", "item_hash", "n", "size_class", F.explode(F.slice("hashes", F.lit(1), F.least("n", k))).alias("sketch"))


def short_lengths(items: DataFrame) -> list[int]:
    """The numbers of words below five that items have: four at most."""
    sizes = items.select(F.size(word_list(F.col("text"))).alias("n")).filter(F.col("n").between(1, SHINGLE - 1))
    return sorted(r.n for r in sizes.distinct().collect())


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").alias("doc_id"), F.xxhash64("doc_id", "text").alias("row_hash"), "text")


def candidates(docs: DataFrame, items: DataFrame, containment: float = CONTAINMENT, shorter: list[int] = ()) -> DataFrame:
    """(doc_id, row_hash, item_hash) of every pair that may reach the containment."""
    probe = _sized(storage.staged(sketches(items, containment).select("sketch", "item_hash"), "sketches"))
    words = _keyed(docs).select("doc_id", "row_hash", word_list(F.col("text")).alias("words"))
    shingles = words.select("doc_id", "row_hash", F.explode(_runs(F.col("words"), _hash, shorter)).alias("sketch"))
    return shingles.join(probe, "sketch").select("doc_id", "row_hash", "item_hash").distinct()


def contained(docs: DataFrame, items: DataFrame, containment: float = CONTAINMENT) -> DataFrame:
    """(doc_id, row_hash, item_id, n_shingles, n_matched, containment) of the pairs that reach it."""
    shorter = short_lengths(items)
    found = storage.staged(candidates(docs, items, containment, shorter).groupBy("doc_id", "row_hash").agg(F.collect_set("item_hash").alias("wanted")), "leak-candidates")
    own = _keyed(docs).alias("d")
    wanted = found.alias("w")
    again = own.join(wanted, (F.col("d.row_hash") == F.col("w.row_hash")) & F.col("d.doc_id").eqNullSafe(F.col("w.doc_id"))).select("d.doc_id", "d.row_hash", "wanted", word_list(F.col("d.text")).alias("words"))
    again = again.select("doc_id", "row_hash", "wanted", F.explode(F.array_distinct(_runs(F.col("words"), _text, shorter))).alias("shingle"))
    full = items.select("item_id", F.xxhash64("item_id", "text").alias("item_hash"), word_list(F.col("text")).alias("words")).filter("size(words) > 0").distinct()
    full = full.select("item_id", "item_hash", F.array_distinct(_runs(F.col("words"), _text)).alias("shingles"))
    full = full.select("item_id", "item_hash", F.size("shingles").cast("long").alias("n_shingles"), F.explode("shingles").alias("shingle"))
    full = _sized(storage.staged(full, "item-shingles"))
    hits = again.join(full, "shingle").filter(F.array_contains("wanted", F.col("item_hash")))
    counted = hits.groupBy("doc_id", "row_hash", "item_id", "item_hash", "n_shingles").agg(F.count_distinct("shingle").alias("n_matched"))
    return counted.withColumn("containment", F.col("n_matched") / F.col("n_shingles")).filter(F.col("containment") >= containment).drop("item_hash")


def clean(docs: DataFrame, items: DataFrame, containment: float = CONTAINMENT, least_words: int = LEAST_WORDS) -> DataFrame:
    """The documents that no item contaminates; of items below ``least_words`` words, those that aren't all of one."""
    size = F.size(word_list(F.col("text")))
    leaks = contained(docs, items.filter(size >= least_words), containment).select(F.col("doc_id").alias("leak_doc"), F.col("row_hash").alias("leak_row"))
    tiny = storage.staged(items.filter(size.between(1, least_words - 1)).select(F.array_join(word_list(F.col("text")), " ").alias("whole")).distinct(), "tiny-items")
    if not tiny.isEmpty():
        alone = _keyed(docs).select("doc_id", "row_hash", word_list(F.col("text")).alias("words")).filter(F.size("words") < least_words)
        leaks = leaks.unionByName(alone.withColumn("whole", F.array_join("words", " ")).join(tiny, "whole", "left_semi").select(F.col("doc_id").alias("leak_doc"), F.col("row_hash").alias("leak_row")))
    leaks = storage.staged(leaks.distinct(), "leaks")
    own = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("own"), F.xxhash64("doc_id", "text").alias("row_hash"))
    kept = own.join(leaks, (F.col("row_hash") == F.col("leak_row")) & F.col("own.doc_id").eqNullSafe(F.col("leak_doc")), "left_anti")
    return kept.select(*[F.col(f"own.`{c}`").alias(c) for c in docs.columns])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op7: the benchmark items that each document holds."""
    return contained(storage.documents(spark, sf_dir), storage.documents(spark, sf_dir, "benchmark")).drop("row_hash")


ORACLE = r"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w FROM documents),
b AS (SELECT item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w FROM benchmark),
ds AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM d
  UNION SELECT doc_id, unnest(list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(w[i:i+n-1], ' '))) FROM d, (SELECT DISTINCT len(w) AS n FROM b WHERE len(w) BETWEEN 1 AND 4) WHERE len(w) > n),
bs AS (SELECT DISTINCT item_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM b),
n AS (SELECT item_id, count(*) AS n_shingles FROM bs GROUP BY 1)
SELECT doc_id, item_id, n_shingles, count(*) AS n_matched, count(*) / n_shingles AS containment
FROM ds JOIN bs USING (s) JOIN n USING (item_id)
GROUP BY doc_id, item_id, n_shingles HAVING count(*) / n_shingles >= 0.8
"""
