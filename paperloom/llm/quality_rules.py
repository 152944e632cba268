"""Quality rules: a log-likelihood ratio of hashed n-grams between trusted documents and the whole corpus.

Two multinomials over ``1 << BITS`` buckets of hashed n-grams (of ``NGRAMS`` bytes of the words, joined by single
spaces) are counted, one over every document, one over the trusted ones (label of quality 1). A document's score is the
mean of the log ratio of the two over its n-grams, so that it doesn't depend on the length. The threshold is chosen on
labelled documents that were not counted as trusted (those whose crc32 of the id leaves 2 divided by 4): every document
gets its verdict from the same score and threshold, whatever else is in its partition. Base rules that need no corpus
(``BASE``) come first.

Counting all documents takes one pass without a shuffle of texts; a task sends its counts in at most
``(1 << BITS) / SLAB`` rows. Only the
join that finds the trusted documents moves texts, and beyond Spark's threshold its Bloom filter leaves out the others
before. What reaches the driver are the sums of the buckets and of the calibration's score bins, both of fixed number;
the ratios (512 kB) are broadcast.

Nulls and odd rows: a null text has no words and fails the base rules; its score is 0. Labels of a null ``doc_id`` or
quality count for nothing; of several labels of one document the worst counts. Rows of equal ``doc_id`` are documents of
their own. Without trusted labels all scores are 0 and nothing is rejected but by the base rules; without poor ones in
the calibration ``FALLBACK`` is the threshold. An empty table gives no rows. Extra columns pass through ``scored``
unless they carry its output's names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import storage

BITS = 16
NGRAMS = (2, 3, 4)
WINDOW = 5
LEAST_WORDS = 10
MOST_REPEATED = 20  # percent of the words
SYMBOLS = b"#*$%&|<>"
WHITE = b" \t\n\x0b\x0c\r"
#: Added to each bucket's count in both multinomials.
PRIOR = 1.0
#: Bins of the calibration: scores from -LIMIT to LIMIT; the ends take what lies beyond.
BIN, LIMIT = 1 / 256, 8
#: A rejected trusted document weighs as much as so many kept poor ones.
WEIGHT = 10
FALLBACK = -0.25
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
FIELDS = [*BASE, "score", "base_failed"]
#: Buckets of which a task sends the counts in one row, a column each.
SLAB = 64
COUNTS = [f"n{i}" for i in range(SLAB)]
#: Bytes of a text that are hashed at once, and n-grams that are counted at once.
BLOCK, COUNTED = 1 << 20, 1 << 22


def ngram_buckets(words: list[bytes]) -> Iterator[np.ndarray]:
    """The buckets of the n-grams of the words' text, block by block."""
    flat = np.frombuffer(b" " + b" ".join(words) + b" ", np.uint8) if words else np.zeros(0, np.uint8)
    for at in range(0, len(flat), BLOCK):
        part = flat[at : at + BLOCK + max(NGRAMS) - 1].astype(np.uint64)
        run = np.zeros(len(part), np.uint64)
        for n in range(1, min(max(NGRAMS), len(part)) + 1):
            run = run[: len(part) - n + 1] * np.uint64(257) + part[n - 1 :]
            if n in NGRAMS:
                yield ((run[:BLOCK] + np.uint64(n << 40)) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - BITS)).astype(np.int64)


def repeated_words(words: list[bytes], width: int = WINDOW) -> int:
    """Words that lie in a window of ``width`` words found twice or more. Windows are compared as numbers, exactly."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))
    keys, bound = ids[:n], len(known)
    for i in range(1, width):
        if bound * len(known) >= 1 << 63:
            keys = np.unique(keys, return_inverse=True)[1]
            bound = int(keys.max()) + 1
        keys, bound = keys * len(known) + ids[i : n + i], bound * len(known)
    order = np.argsort(keys, kind="stable")
    same = keys[order[1:]] == keys[order[:-1]]
    if not same.any():
        return 0
    again = np.zeros(len(words) + 1, np.int64)
    again[order[1:][same]] = again[order[:-1][same]] = 1
    before = np.concatenate([[0], np.cumsum(again)])
    at = np.arange(len(words))
    return int((before[at + 1] > before[np.maximum(at - width + 1, 0)]).sum())


def base_counts(text: str, words: list[bytes]) -> tuple[int, int, int, int, int]:
    """The numbers of ``BASE``."""
    raw = text.encode()
    white = len(raw) - len(raw.translate(None, WHITE))
    lines = [line for line in raw.split(b"\n") if line.strip()]
    return len(words), len(text) - white, len(raw) - len(raw.translate(None, SYMBOLS)), len(lines) - len(set(lines)), repeated_words(words)


def _counted(texts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(slab, n0, n1, ...) of a task's texts: the counts of the slab's buckets."""
    total, held, size = np.zeros(1 << BITS, np.int64), [], 0
    for batch in texts:
        for text in batch["text"]:
            for part in ngram_buckets((text.as_py() or "").encode().split()):
                held.append(part)
                size += len(part)
            if size >= COUNTED:
                total += np.bincount(np.concatenate(held), minlength=1 << BITS)
                held, size = [], 0
    if held:
        total += np.bincount(np.concatenate(held), minlength=1 << BITS)
    slabs = total.reshape(-1, SLAB)
    own = np.flatnonzero(slabs.any(axis=1))
    yield pa.RecordBatch.from_arrays([pa.array(own), *(pa.array(c) for c in slabs[own].T)], names=["slab", *COUNTS])


def judgements(labels: DataFrame) -> DataFrame:
    """(doc_id, quality, calibrates) of the labelled documents, one row each."""
    known = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    return known.agg(F.min("quality").alias("quality")).withColumn("calibrates", F.expr("crc32(CAST(doc_id AS string)) % 4 = 2"))


def log_ratios(docs: DataFrame, labels: DataFrame) -> np.ndarray:
    """The log ratio of trusted documents to all, by bucket; zeros where none is trusted."""
    trusted = judgements(labels).filter("quality = 1 AND NOT calibrates").select("doc_id")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    counted = lambda df, row: storage.in_arrow(df.select("text"), _counted, "slab long," + ",".join(f"{c} long" for c in COUNTS)).withColumn("row", F.lit(row))
    # the ids are hashed, not sorted: the texts are shuffled, but never sorted
    own = texts.join(trusted.hint("shuffle_hash"), "doc_id", "left_semi")
    counts = np.zeros((2, (1 << BITS) // SLAB, SLAB))
    for r in counted(own, 0).unionByName(counted(texts, 1)).groupBy("row", "slab").agg(*[F.sum(c).alias(c) for c in COUNTS]).collect():
        counts[r.row, r.slab] = r[2:]
    counts = counts.reshape(2, -1)
    if not counts[0].any():
        return np.zeros(1 << BITS)
    counts += PRIOR
    logs = np.log(counts) - np.log(counts.sum(axis=1, keepdims=True))
    return logs[0] - logs[1]


def measured(text: Column, ratios, spark: SparkSession) -> Column:
    """Struct of ``BASE`` and ``score``."""
    storage.bound_batches(spark)
    shared = spark.sparkContext.broadcast(ratios)

    @F.arrow_udf("struct<" + ",".join(f"{c}:long" for c in BASE) + ",score:double>")
    def run(texts: pa.Array) -> pa.Array:
        found: list[tuple] = []
        for text in texts:
            text = text.as_py()
            words = text.encode().split()
            total, size = 0.0, 0
            for part in ngram_buckets(words):
                total, size = total + float(shared.value[part].sum()), size + len(part)
            found.append((*base_counts(text, words), total / size if size else 0.0))
        columns = list(zip(*found)) if found else [[]] * (len(BASE) + 1)
        kinds = [*[pa.int64()] * len(BASE), pa.float64()]
        return pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=[*BASE, "score"])

    return run(F.coalesce(text, F.lit("")))


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def scored(docs: DataFrame, ratios: np.ndarray) -> DataFrame:
    """``docs`` with the columns ``FIELDS``; columns of those names are replaced."""
    own = [c for c in docs.columns if c not in FIELDS]
    made = docs.select(F.struct(*[F.col(f"`{c}`") for c in own]).alias("own"), measured(F.col("text"), ratios, docs.sparkSession).alias("made"))
    found = made.select("own", "made.*").withColumn("base_failed", base_failed())
    return found.select(*[F.col(f"own.`{c}`").alias(c) for c in own], *FIELDS)


def threshold(scores: DataFrame, labels: DataFrame) -> float:
    """The score that parts trusted from poor documents best, from ``scores(doc_id, base_failed, score)``."""
    known = judgements(labels).filter("calibrates")
    place = F.greatest(F.lit(-LIMIT / BIN), F.least(F.lit(LIMIT / BIN - 1), F.floor(F.col("score") / BIN))).cast("int")
    met = scores.filter(~F.col("base_failed")).select(F.col("doc_id").cast("long").alias("doc_id"), place.alias("bin")).join(known, "doc_id")
    rows = met.groupBy("bin").agg(F.sum((F.col("quality") == 1).cast("long")).alias("good"), F.sum((F.col("quality") != 1).cast("long")).alias("poor")).collect()
    n = round(LIMIT / BIN)
    counts = np.zeros((2, 2 * n))
    for r in rows:
        counts[:, r.bin + n] = r.good, r.poor
    good, poor = counts.sum(axis=1)
    if not good or not poor:
        return FALLBACK
    lost = np.concatenate([[0], np.cumsum(counts[0])]) / good
    kept = 1 - np.concatenate([[0], np.cumsum(counts[1])]) / poor
    cost = np.round(WEIGHT * lost + kept, 12)
    best = np.flatnonzero(cost == cost.min())
    run = max(np.split(best, np.flatnonzero(np.diff(best) > 1) + 1), key=len)
    return float((run[len(run) // 2] - n) * BIN)


def judged(scores: DataFrame, least: float) -> DataFrame:
    """``scores`` with ``kept``: the base rules' verdict and the score's."""
    return scores.withColumn("kept", ~F.col("base_failed") & (F.col("score") >= least))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op13: every document's counts, score and verdict."""
    docs, labels = storage.documents(spark, sf_dir).select("doc_id", "text"), storage.documents(spark, sf_dir, "labels")
    scores = storage.staged(scored(docs, log_ratios(docs, labels)).drop("text"), "quality-scores")
    return judged(scores, threshold(scores, labels)).select("doc_id", *BASE, "base_failed", "kept", "score")
