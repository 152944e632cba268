"""Token-id archive: one zstandard frame per document, a shared dictionary, an offset index.

A folder holds ``dictionary-<sha256>.zdict`` and, per shard, a data file of compressed documents and an index file.
Documents lie in ascending ``doc_id`` order over all shards (a null id comes first, equal ids keep together). Ids are
little-endian unsigned 16-bit where the vocabulary allows, else 32-bit. The index holds the dictionary's SHA-256, so
that a shard can only be read with the dictionary that made it, and offsets by which a single document is read
without touching the rest of its shard.

Nulls: a null text is an empty one; its document holds the end id alone. Repeated rows are all kept. An empty table
gives an archive without shards. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import storage
from .tokenization import encoder, slices, with_end

MAGIC = b"PLTOKIX1"
#: Documents whose ids train the shared dictionary, those of the smallest hash; it bears on size alone, never on ids.
DICTIONARY_DOCUMENTS = 400
DICTIONARY_BYTES = 64 << 10
#: Compressed bytes after which a shard ends.
SHARD_BYTES = 256 << 20
LEVEL = 3
MANIFEST = "part long, shard long, file string, n_docs long, n_tokens long, n_bytes long"


@dataclass(frozen=True)
class Archive:
    path: str
    dictionary_hash: str
    width: int
    manifest: DataFrame


def _train(samples: list[bytes]) -> bytes:
    """A dictionary; with too little to learn from, the samples' own bytes serve as one."""
    import zstandard

    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:DICTIONARY_BYTES] or bytes(8)


def _index_bytes(dictionary_hash: str, width: int, doc_ids: list, offsets: list[int], counts: list[int]) -> bytes:
    null = np.array([d is None for d in doc_ids], np.uint8)
    ids = np.array([0 if d is None else d for d in doc_ids], "<i8")
    head = MAGIC + struct.pack("<IQ", width, len(doc_ids)) + bytes.fromhex(dictionary_hash)
    return head + null.tobytes() + ids.tobytes() + np.array(offsets, "<u8").tobytes() + np.array(counts, "<u8").tobytes()


def read_index(data: bytes, dictionary_hash: str) -> tuple[int, list, np.ndarray, np.ndarray]:
    """(id width, doc ids, offsets, token counts) of a shard; refuses another dictionary."""
    width, n = struct.unpack_from("<IQ", data, 8)
    if data[:8] != MAGIC or data[20:52].hex() != dictionary_hash:
        raise ValueError("not an index of this archive's dictionary")
    at = 52
    null = np.frombuffer(data, np.uint8, n, at)
    ids = np.frombuffer(data, "<i8", n, at + n)
    offsets = np.frombuffer(data, "<u8", n + 1, at + 9 * n)
    counts = np.frombuffer(data, "<u8", n, at + 17 * n + 8)
    return width, [None if z else int(d) for z, d in zip(null, ids)], offsets.astype(np.int64), counts.astype(np.int64)


def write(docs: DataFrame, path: str, tokenizer_path: str, end_id: int) -> Archive:
    """Encodes ``docs(doc_id, text)`` into an archive at ``path``."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), storage.text_or_empty().alias("text"))
    sample = storage.smallest_hashes(rows, "doc_id", DICTIONARY_DOCUMENTS, rows.count()).collect()
    enc = encoder(tokenizer_path)
    width = 2 if max(enc.tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16 else 4
    kind = f"<u{width}"
    samples = []
    for r in sample:
        ids, _ = enc.encode(pa.array([r.text]))
        samples.append(np.append(ids, end_id).astype(kind).tobytes())
    dictionary = _train(samples)
    digest = hashlib.sha256(dictionary).hexdigest()
    with storage.open_new(f"{path}/dictionary-{digest}.zdict") as f:
        f.write(dictionary)

    def write_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        press = zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(dictionary), write_content_size=True, write_dict_id=False)
        words, part, shard, out = encoder(tokenizer_path), TaskContext.get().partitionId(), 0, None
        doc_ids, offsets, counts, name = [], [0], [], ""

        def finish() -> pa.RecordBatch:
            out.close()
            with storage.open_new(f"{path}/{name}.idx") as f:
                f.write(_index_bytes(digest, width, doc_ids, offsets, counts))
            return pa.RecordBatch.from_pylist([{"part": part, "shard": shard, "file": name, "n_docs": len(doc_ids), "n_tokens": sum(counts), "n_bytes": offsets[-1]}])

        for batch in (part for whole in batches for part in slices(whole)):
            flat, ends = with_end(*words.encode(batch["text"]), end_id)
            data, ends = flat.astype(kind).tobytes(), (ends * width).tolist()
            for doc_id, a, b in zip(batch["doc_id"].to_pylist(), ends, ends[1:]):
                if out is None:
                    name = f"tokens-{part:06d}-{shard:04d}-{uuid.uuid4().hex[:12]}"
                    out = storage.open_new(f"{path}/{name}.bin")
                    doc_ids, offsets, counts = [], [0], []
                frame = press.compress(data[a:b])
                out.write(frame)
                doc_ids.append(doc_id)
                offsets.append(offsets[-1] + len(frame))
                counts.append((b - a) // width)
                if offsets[-1] >= SHARD_BYTES:
                    yield finish()
                    out, shard = None, shard + 1
        if out is not None:
            yield finish()

    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    manifest = storage.staged(storage.in_arrow(ordered, write_shards, MANIFEST), "token-manifest")
    return Archive(path, digest, width, manifest)


def _frames(archive_path: str, dictionary_hash: str):
    import zstandard

    dictionary = storage.read_all(f"{archive_path}/dictionary-{dictionary_hash}.zdict")
    if hashlib.sha256(dictionary).hexdigest() != dictionary_hash:
        raise ValueError("the dictionary file is not the one that the archive names")
    return zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary))


def read(archive: Archive) -> DataFrame:
    """(doc_id, start, n_tokens, ids): each document's ids, and the number of ids in all documents before it.

    ``ids`` are little-endian unsigned 32-bit integers.
    """
    path, digest = archive.path, archive.dictionary_hash
    before = Window.orderBy("part", "shard").rowsBetween(Window.unboundedPreceding, -1)  # one row per shard
    shards = archive.manifest.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0).cast("long")))

    def read_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = _frames(path, digest)
        for batch in batches:
            for name, base in zip(batch["file"].to_pylist(), batch["base"].to_pylist()):
                width, doc_ids, offsets, counts = read_index(storage.read_all(f"{path}/{name}.idx"), digest)
                starts = base + np.cumsum(counts) - counts
                with storage.open_at(f"{path}/{name}.bin") as f:
                    a = 0
                    while a < len(doc_ids):
                        b = max(a + 1, min(int(np.searchsorted(offsets, offsets[a] + (2 << 20), "right")) - 1, a + 5000))
                        data = f.read(int(offsets[b] - offsets[a]))
                        ids = []
                        for i in range(a, b):
                            raw = press.decompress(data[offsets[i] - offsets[a] : offsets[i + 1] - offsets[a]])
                            ids.append(np.frombuffer(raw, f"<u{width}").astype("<u4").tobytes())
                        yield pa.RecordBatch.from_arrays([pa.array(doc_ids[a:b], pa.int64()), pa.array(starts[a:b], pa.int64()), pa.array(counts[a:b], pa.int64()), pa.array(ids, pa.binary())], names=["doc_id", "start", "n_tokens", "ids"])
                        a = b

    return storage.in_arrow(shards.repartition(int(archive.manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))), read_shards, "doc_id long, start long, n_tokens long, ids binary")


def read_document(archive: Archive, doc_id: int) -> list[np.ndarray]:
    """The ids of the documents with this id, by the index alone: one seek and one short read each."""
    press, found = _frames(archive.path, archive.dictionary_hash), []
    for row in archive.manifest.orderBy("part", "shard").toLocalIterator():
        width, doc_ids, offsets, _ = read_index(storage.read_all(f"{archive.path}/{row.file}.idx"), archive.dictionary_hash)
        for i in (i for i, d in enumerate(doc_ids) if d == doc_id):
            with storage.open_at(f"{archive.path}/{row.file}.bin") as f:
                f.seek(int(offsets[i]))
                found.append(np.frombuffer(press.decompress(f.read(int(offsets[i + 1] - offsets[i]))), f"<u{width}"))
    return found


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op1: writes every document's ids, reads the files back, and digests what they hold."""
    import public_tokenizers

    archive = write(storage.documents(spark, sf_dir), storage.fresh_path(spark, "tokens"), public_tokenizers.path("word_bpe_49k.json"), 2)
    return read(archive).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
