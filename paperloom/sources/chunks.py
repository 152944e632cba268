"""Files of any size, read in pieces: a data source that never holds more than one piece of a file.

``spark.read.format("file_chunks")`` gives (path, chunk, start, bytes) of every file below a folder; with the option
``mode`` set to ``hashes`` it gives one row per file, (path, size_bytes, sha256), folded over the pieces as they are
read. A file is a partition of the scan, so that one task reads it from its beginning to its end once: that is what a
hash of it takes. Options: ``path``, ``chunk_bytes`` (1 MiB), ``suffix`` (only files whose names end so).

Paths may have any scheme that pyarrow's file systems know; links are left to ``acquire.refuse_links``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import unquote, urlparse

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

CHUNK_BYTES = 1 << 20
#: Bytes of pieces in one batch to the JVM.
BATCH_BYTES = 8 << 20
CHUNKS = "path string, chunk long, start long, bytes binary"
HASHES = "path string, size_bytes long, sha256 string"


@dataclass
class FilePartition(InputPartition):
    path: str


def _files(uri: str):
    """(file system, path, prefix that makes a path of this system an URI)."""
    from pyarrow import fs

    parsed = urlparse(uri)
    if parsed.scheme in ("", "file"):
        return fs.LocalFileSystem(), unquote(parsed.path), "file:"
    system, path = fs.FileSystem.from_uri(uri)
    return system, path, f"{parsed.scheme}://{parsed.netloc}" if parsed.netloc else f"{parsed.scheme}:"


def pieces(path: str, size: int) -> Iterator[bytes]:
    """A file's bytes in order, ``size`` at a time."""
    system, inner, _ = _files(path)
    with system.open_input_stream(inner) as stream:
        while piece := stream.read(size):
            yield piece


class ChunkReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.root = options["path"]
        self.size = int(options.get("chunk_bytes", CHUNK_BYTES))
        self.suffix = options.get("suffix", "")
        self.hashes = options.get("mode", "chunks") == "hashes"
        if self.size < 1:
            raise ValueError("a piece has one byte at least")

    def partitions(self) -> list[FilePartition]:
        from pyarrow import fs

        system, path, scheme = _files(self.root)
        found = system.get_file_info(fs.FileSelector(path, recursive=True)) if system.get_file_info(path).type == fs.FileType.Directory else [system.get_file_info(path)]
        if found and found[0].type == fs.FileType.NotFound:
            raise FileNotFoundError(self.root)
        return [FilePartition(f"{scheme}{f.path}") for f in sorted(found, key=lambda f: f.path) if f.type == fs.FileType.File and f.path.endswith(self.suffix)]

    def read(self, partition: FilePartition | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # no files
            return
        if self.hashes:
            digest, size = hashlib.sha256(), 0
            for piece in pieces(partition.path, self.size):
                digest.update(piece)
                size += len(piece)
            yield pa.RecordBatch.from_pydict({"path": [partition.path], "size_bytes": pa.array([size], pa.int64()), "sha256": [digest.hexdigest()]})
            return
        held: list[bytes] = []
        first, start, size = 0, 0, 0

        def batch() -> pa.RecordBatch:
            starts, at = [], start
            for piece in held:
                starts.append(at)
                at += len(piece)
            return pa.RecordBatch.from_arrays([pa.array([partition.path] * len(held)), pa.array(range(first, first + len(held)), pa.int64()), pa.array(starts, pa.int64()), pa.array(held, pa.binary())], names=["path", "chunk", "start", "bytes"])

        for piece in pieces(partition.path, self.size):
            held.append(piece)
            size += len(piece)
            if size >= BATCH_BYTES:
                yield batch()
                first, start, held, size = first + len(held), start + size, [], 0
        if held:
            yield batch()


class ChunkSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "file_chunks"

    def schema(self) -> str:
        return HASHES if self.options.get("mode", "chunks") == "hashes" else CHUNKS

    def reader(self, schema) -> ChunkReader:
        return ChunkReader(dict(self.options))


def _read(spark: SparkSession, path: str, **options) -> DataFrame:
    spark.dataSource.register(ChunkSource)
    return spark.read.format("file_chunks").options(path=path, **options).load()


def chunks(spark: SparkSession, path: str, chunk_bytes: int = CHUNK_BYTES, suffix: str = "") -> DataFrame:
    """(path, chunk, start, bytes) of a file or of all files below a folder."""
    return _read(spark, path, chunk_bytes=str(chunk_bytes), suffix=suffix)


def hashes(spark: SparkSession, path: str, chunk_bytes: int = CHUNK_BYTES, suffix: str = "") -> DataFrame:
    """(path, size_bytes, sha256) of a file or of all files below a folder, whatever their sizes."""
    return _read(spark, path, chunk_bytes=str(chunk_bytes), suffix=suffix, mode="hashes")
