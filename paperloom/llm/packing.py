"""Packing of documents into training sequences along a space-filling curve.

Each document's token ids are hashed into a vector and projected to ``DIMENSIONS`` numbers; their Hilbert index is the
document's place on a curve that keeps like documents near each other. Documents are range-partitioned and sorted by
that key, ties by id (so a large group of equal documents is spread over partitions), and every partition cuts its
stream of ids into sequences of ``length`` ids. Only a partition's last sequence can fall short; it is cut into
powers of two, which need no padding. Nothing depends on the number of documents, and a task holds one batch and one
open sequence.

Nulls: a null text is an empty one and packs as its end id. Rows with equal or null ids are packed one by one. An
empty table gives no pieces. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import storage
from .tokenization import encoder, slices, with_end

DIMENSIONS = 4
BITS = 15
#: Hash buckets of a document vector.
BUCKETS = 1 << 12
#: Spread of a mean of random signs over a text's tokens; only scales the curve's grid.
SPREAD = 0.15
SEED = 42
PIECES = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


def projection() -> np.ndarray:
    """The fixed random directions of the hash buckets."""
    return np.random.default_rng(SEED).standard_normal((BUCKETS, DIMENSIONS)).astype(np.float32)


def document_vectors(ids: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Mean direction of each document's hashed ids; every document holds one id at least."""
    bucket = (ids.astype(np.uint32) * np.uint32(2654435761)) >> np.uint32(32 - 12)
    sums = np.empty((len(offsets) - 1, table.shape[1]))
    for d in range(table.shape[1]):
        sums[:, d] = np.add.reduceat(table[bucket, d], offsets[:-1], dtype=np.float64) if len(sums) else 0
    return sums / np.diff(offsets)[:, None]


def hilbert_key(vectors: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Hilbert index of points whose coordinates are squashed to a grid of 2**bits steps (Skilling's transform)."""
    top = (1 << bits) - 1
    x = np.clip((np.tanh(vectors / SPREAD) + 1) / 2 * top, 0, top).astype(np.int64).T.copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(n):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(high, x[0] ^ p, x[0]) ^ swap
            x[i] = x[i] ^ swap if i else x[i]
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        t = np.where((x[n - 1] & q) != 0, t ^ (q - 1), t)
        q >>= 1
    x ^= t
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


def id_width(tokenizer_path: str, end_id: int) -> int:
    """Bytes that hold any id."""
    return 2 if max(encoder(tokenizer_path).tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16 else 4


def tokenized(docs: DataFrame, tokenizer_path: str, end_id: int) -> DataFrame:
    """(doc_id, curve, ids): each document's ids, of ``id_width`` bytes, and its key on the curve."""
    width = id_width(tokenizer_path, end_id)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, table = encoder(tokenizer_path), projection()
        for batch in (part for whole in batches for part in slices(whole)):
            ids, offsets = with_end(*words.encode(batch["text"]), end_id)
            curve = hilbert_key(document_vectors(ids, offsets, table))
            raw, ends = ids.astype(f"<u{width}").tobytes(), (offsets * width).tolist()
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(curve, pa.int64()), pa.array([raw[a:b] for a, b in zip(ends, ends[1:])], pa.binary())], names=["doc_id", "curve", "ids"])

    return storage.in_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), storage.text_or_empty().alias("text")), encode, "doc_id long, curve long, ids binary")


def powers(n: int) -> list[int]:
    """n as a sum of distinct powers of two, largest first."""
    return [1 << b for b in range(n.bit_length() - 1, -1, -1) if n >> b & 1]


def _cut_again(pieces: list[dict], filled: int, sequence: int) -> list[dict]:
    """The pieces of an unfilled sequence, cut so that they fill sequences of powers of two."""
    out, sizes, used = [], powers(filled), 0
    for p in pieces:
        done = 0
        while done < p["length"]:
            take = min(p["length"] - done, sizes[0] - used)
            out.append(p | {"start": p["start"] + done, "length": take, "sequence_id": sequence, "offset": used, "ids": p["ids"][4 * done : 4 * (done + take)]})
            done, used = done + take, used + take
            if used == sizes[0]:
                sizes, used, sequence = sizes[1:], 0, sequence + 1
    return out


def pack(docs: DataFrame, tokenizer_path: str, end_id: int = 1, length: int = 2048) -> DataFrame:
    """Pieces of ``docs(doc_id, text)``: where each run of a document's ids lies, and the ids (unsigned 32-bit)."""
    rows = storage.staged(tokenized(docs, tokenizer_path, end_id), "packing-tokens")
    width = id_width(tokenizer_path, end_id)
    schema = pa.schema([(n, pa.binary() if n == "ids" else pa.int64()) for n in (c.split()[0] for c in PIECES.split(", "))])

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sequence, filled, opened, full = TaskContext.get().partitionId() << 40, 0, [], []
        for batch in batches:
            for doc_id, ids in zip(batch["doc_id"].to_pylist(), batch["ids"].to_pylist()):
                ids = np.frombuffer(ids, f"<u{width}").astype("<u4").tobytes()
                start, total = 0, len(ids) // 4
                while start < total:
                    take = min(total - start, length - filled)
                    opened.append({"doc_id": doc_id, "start": start, "length": take, "doc_tokens": total, "sequence_id": sequence, "offset": filled, "ids": ids[4 * start : 4 * (start + take)]})
                    start, filled = start + take, filled + take
                    if filled == length:
                        full += opened
                        sequence, filled, opened = sequence + 1, 0, []
                        if len(full) > 2000:
                            yield pa.RecordBatch.from_pylist(full, schema)
                            full = []
        full += _cut_again(opened, filled, sequence)
        if full:
            yield pa.RecordBatch.from_pylist(full, schema)

    return storage.in_arrow(rows.repartitionByRange("curve", "doc_id").sortWithinPartitions("curve", "doc_id").select("doc_id", "ids"), fill, PIECES)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op5: packs every document; the ids of each piece as a checksum."""
    import public_tokenizers

    pieces = pack(storage.documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
