"""The corpus pipeline: from raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next
stage's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.llm import decontamination, line_dedup, packing, simhash_dedup, storage, toxicity


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents below the toxicity threshold of their language."""
    model = toxicity.fit(docs, storage.documents(spark, sf_dir, "labels"))
    return toxicity.without_toxic(docs, model)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps a line that many documents share in the largest of them only; ``n_chars`` follows the text."""
    others = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("own"), "doc_id", "text")
    kept = line_dedup.dedup(others)
    changed = {"text": F.when(F.col("n_dropped") > 0, F.col("kept_text")).otherwise(F.col("text")), "n_chars": F.when(F.col("n_dropped") > 0, F.length("kept_text").cast("long")).otherwise(F.col("own.n_chars"))}
    return kept.select(*[changed.get(c, F.col(f"own.`{c}`")).alias(c) for c in docs.columns])


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies, by SimHash fingerprints of whole texts and by shared shingles."""
    return simhash_dedup.distinct_documents(docs, fingerprints=True)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents that hold no benchmark item."""
    return decontamination.clean(docs, storage.documents(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The kept documents' token ids, packed into sequences."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_lines),
    ("simhash", drop_copies),
    ("decontamination", drop_leaks),
    ("packing", pack),
]
#: A trained classifier and a tokenizer decide; tests hold the stages against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each result but the last is written to the shared folder and read again."""
    docs = storage.documents(spark, sf_dir)
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = storage.staged(docs, f"stage-{name}")
    return docs
