"""Containers: members and relationships of ZIP packages, entries of compound files, single parts."""

from __future__ import annotations

import hashlib
import io
import lzma
import posixpath
import struct
import zipfile
import zlib
from collections.abc import Iterator
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ids import stable

MAX_XML = 64 << 20
RELS_SUFFIX = ".rels"
MEMBERS = "document_id string, path string, compressed long, inflated long, method string, encrypted boolean, sha256 string, media_type string, part_id string, read_state string"
RELATIONSHIPS = "document_id string, relationship_id string, native_id string, source_path string, type string, target string, external boolean"


class ContainerError(ValueError):
    """A container that can't be read as what it says it is."""


def parse_xml(data: bytes) -> ElementTree.Element:
    """The root of an XML part; declarations of types and entities are refused, as is anything over MAX_XML."""
    upper = data.upper()
    if len(data) > MAX_XML or b"<!DOCTYPE" in upper or b"<!ENTITY" in upper:
        raise ContainerError("document types, entities and oversized parts are refused")
    try:
        return ElementTree.fromstring(data)
    except (ElementTree.ParseError, ValueError, LookupError) as error:  # the last two: encodings that don't exist
        raise ContainerError(f"broken XML: {error}") from error


def local(tag: str) -> str:
    return tag.rsplit("}", 1)[-1]


def open_zip(content: bytes) -> zipfile.ZipFile:
    try:
        return zipfile.ZipFile(io.BytesIO(content))
    except (*DAMAGE, struct.error) as error:
        raise ContainerError(f"unreadable package: {error}") from error


#: What reading a damaged, cut, encrypted or oddly compressed member raises.
DAMAGE = (zipfile.BadZipFile, zipfile.LargeZipFile, zlib.error, lzma.LZMAError, EOFError, KeyError, NotImplementedError, OSError, OverflowError, RuntimeError, ValueError)


def read_member(archive: zipfile.ZipFile, name: str | zipfile.ZipInfo) -> bytes:
    """A member's bytes; every kind of damage is a ContainerError."""
    try:
        return archive.read(name)
    except (*DAMAGE, struct.error, MemoryError) as error:
        raise ContainerError(f"unreadable member: {error}") from error


def content_types(archive: zipfile.ZipFile) -> tuple[dict[str, str], dict[str, str]]:
    """(overrides by path, defaults by extension)."""
    overrides, defaults = {}, {}
    if "[Content_Types].xml" in archive.namelist():
        for node in parse_xml(read_member(archive, "[Content_Types].xml")):
            if local(node.tag) == "Override":
                overrides[node.get("PartName", "").lstrip("/")] = node.get("ContentType", "")
            elif local(node.tag) == "Default":
                defaults[node.get("Extension", "").lower()] = node.get("ContentType", "")
    return overrides, defaults


def zip_members(document_id: str, content: bytes, most_bytes: int = 8 << 30) -> Iterator[dict]:
    """A row per member; inflation stops at ``most_bytes`` in all, and is never by name."""
    archive = open_zip(content)
    try:
        overrides, defaults = content_types(archive)
    except ContainerError:
        overrides, defaults = {}, {}  # its own row says that it can't be read, unless only its XML is broken
    methods = {zipfile.ZIP_STORED: "stored", zipfile.ZIP_DEFLATED: "deflate", zipfile.ZIP_BZIP2: "bzip2", zipfile.ZIP_LZMA: "lzma"}
    left = most_bytes
    for info in archive.infolist():
        if info.is_dir():
            continue
        digest, state = None, "read"
        if info.flag_bits & 1:
            state = "blocked"
        elif info.file_size > left:
            state = "not_read"
        else:
            try:
                data = read_member(archive, info)
                left -= len(data)
                digest = hashlib.sha256(data).hexdigest()
            except ContainerError:
                state = "failed"
        extension = posixpath.splitext(info.filename)[1].lstrip(".").lower()
        yield {
            "document_id": document_id, "path": info.filename, "compressed": info.compress_size, "inflated": info.file_size, "method": methods.get(info.compress_type, f"method_{info.compress_type}"),
            "encrypted": bool(info.flag_bits & 1), "sha256": digest, "media_type": overrides.get(info.filename) or defaults.get(extension) or "application/octet-stream",
            "part_id": stable("part", document_id=document_id, path=info.filename, sha256=digest), "read_state": state,
        }


def relationships(archive: zipfile.ZipFile, rels_path: str) -> dict[str, tuple[str, str, bool]]:
    """native id -> (target path, type, external) of one relationship file."""
    if rels_path not in archive.namelist():
        return {}
    base = posixpath.dirname(posixpath.dirname(rels_path))
    out = {}
    for node in parse_xml(read_member(archive, rels_path)):
        external = node.get("TargetMode") == "External"
        target = node.get("Target", "")
        if not external:
            target = posixpath.normpath(posixpath.join("/" + base, target)).lstrip("/")
        out[node.get("Id", "")] = (target, node.get("Type", ""), external)
    return out


def zip_relationships(document_id: str, content: bytes) -> Iterator[dict]:
    archive = open_zip(content)
    for name in archive.namelist():
        if name.endswith(RELS_SUFFIX):
            folder, file = posixpath.split(name)
            owner = posixpath.join(posixpath.dirname(folder), file[: -len(RELS_SUFFIX)]) if file != RELS_SUFFIX else None
            try:
                found = relationships(archive, name)
            except ContainerError:
                continue  # the member's row carries the failure
            for native, (target, kind, external) in found.items():
                yield {"document_id": document_id, "relationship_id": stable("relationship", document_id=document_id, rels=name, id=native), "native_id": native, "source_path": owner, "type": kind, "target": target, "external": external}


class CompoundFile:
    """Directory and streams of a compound file (sectors, allocation chains, red-black directory)."""

    NONE = 0xFFFFFFFA  # and above: no sector

    def __init__(self, data: bytes, most_entries: int = 100_000):
        if len(data) < 512 or data[:8] != bytes.fromhex("D0CF11E0A1B11AE1") or data[28:30] != b"\xfe\xff":
            raise ContainerError("not a compound file")
        self.data = data
        shift, mini_shift = struct.unpack_from("<HH", data, 30)
        if shift not in (9, 12) or mini_shift != 6:
            raise ContainerError("odd sector sizes")
        self.size = 1 << shift
        n_fat, self.directory_start = struct.unpack_from("<II", data, 44)
        self.cutoff, mini_start, n_mini, difat_start, n_difat = struct.unpack_from("<IIIII", data, 56)
        sectors = [s for s in struct.unpack_from("<109I", data, 76) if s < self.NONE]
        at, seen = difat_start, set()
        for _ in range(n_difat):
            if at in seen or at >= self.NONE:
                raise ContainerError("broken allocation list")
            seen.add(at)
            *own, at = struct.unpack(f"<{self.size // 4}I", self.sector(at))
            sectors += [s for s in own if s < self.NONE]
        if len(sectors) < n_fat:
            raise ContainerError("allocation table cut short")
        self.table = [x for s in sectors[:n_fat] for x in struct.unpack(f"<{self.size // 4}I", self.sector(s))]
        raw = self.regular(self.directory_start)
        self.entries = []
        for i in range(0, len(raw) - 127, 128):
            e = raw[i : i + 128]
            length, kind = struct.unpack_from("<HB", e, 64)
            left, right, child = struct.unpack_from("<III", e, 68)
            start, size = struct.unpack_from("<IQ", e, 116)
            if kind not in (0, 1, 2, 5):
                raise ContainerError("broken directory")
            self.entries.append({"name": e[: max(0, length - 2)].decode("utf-16le", "replace"), "kind": kind, "left": left, "right": right, "child": child, "start": start, "size": size if self.size == 4096 else size & 0xFFFFFFFF})
        if len(self.entries) > most_entries:
            raise ContainerError("too many entries")
        mini = self.regular(mini_start) if n_mini else b""
        self.mini_table = list(struct.unpack(f"<{len(mini) // 4}I", mini))
        root = next((e for e in self.entries if e["kind"] == 5), None)
        self.mini_data = self.regular(root["start"])[: root["size"]] if root and root["size"] else b""

    def sector(self, number: int) -> bytes:
        a = (number + 1) * self.size
        if number >= self.NONE or a + self.size > len(self.data):
            raise ContainerError("sector out of the file")
        return self.data[a : a + self.size]

    def chain(self, start: int, table: list[int]) -> Iterator[int]:
        seen: set[int] = set()
        while start < self.NONE:
            if start in seen or start >= len(table):
                raise ContainerError("broken chain")
            seen.add(start)
            yield start
            start = table[start]

    def regular(self, start: int) -> bytes:
        return b"".join(self.sector(s) for s in self.chain(start, self.table)) if start < self.NONE else b""

    def stream(self, entry: dict) -> bytes:
        if entry["size"] >= self.cutoff:
            return self.regular(entry["start"])[: entry["size"]]
        return b"".join(self.mini_data[64 * s : 64 * s + 64] for s in self.chain(entry["start"], self.mini_table))[: entry["size"]]

    def walk(self) -> Iterator[tuple[int, str, int | None]]:
        """(index, path, parent index) of the entries in the tree, then of those outside it."""
        seen: set[int] = set()
        roots = [i for i, e in enumerate(self.entries) if e["kind"] == 5][:1]
        stack = [(i, "", None) for i in roots]
        while stack:
            i, above, parent = stack.pop()
            if i >= len(self.entries) or i in seen or not self.entries[i]["kind"]:
                continue
            seen.add(i)
            e = self.entries[i]
            path = f"{above}/{e['name']}" if above else e["name"]
            yield i, path, parent
            if parent is not None:
                stack += [(e["right"], above, parent), (e["left"], above, parent)]
            if e["kind"] in (1, 5):
                stack.append((e["child"], path, i))
        for i, e in enumerate(self.entries):
            if e["kind"] and i not in seen:
                yield i, f"orphan/{i}/{e['name']}", None


def compound_members(document_id: str, content: bytes) -> Iterator[dict]:
    file = CompoundFile(content)
    for i, path, _ in file.walk():
        entry, digest, state = file.entries[i], None, "read"
        if entry["kind"] == 2:
            try:
                digest = hashlib.sha256(file.stream(entry)).hexdigest()
            except ContainerError:
                state = "failed"
        yield {
            "document_id": document_id, "path": path, "compressed": entry["size"], "inflated": entry["size"], "method": {1: "storage", 2: "stored", 5: "root"}[entry["kind"]], "encrypted": False, "sha256": digest,
            "media_type": "application/octet-stream", "part_id": stable("part", document_id=document_id, ole_index=i, path=path), "read_state": state,
        }


def _arrow(schema: str) -> pa.Schema:
    kinds = {"string": pa.string(), "long": pa.int64(), "boolean": pa.bool_(), "double": pa.float64(), "map<string,string>": pa.map_(pa.string(), pa.string())}
    return pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in schema.split(", ")])


def byte_bound(artifacts: DataFrame) -> None:
    """Bounds the batches of contents that go to Python in bytes, where the session sets no bound of its own."""
    conf = artifacts.sparkSession.conf
    if conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None) is None:
        conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))


def per_document(artifacts: DataFrame, function, schema: str) -> DataFrame:
    """Rows of ``function(document_id, content)`` for every artifact; a container that can't be read gives no more."""
    byte_bound(artifacts)
    arrow = _arrow(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for document_id, content in zip(batch["document_id"].to_pylist(), batch["content"]):
                rows = []
                try:
                    for row in function(document_id, content.as_py() or b""):
                        rows.append(row)
                        if len(rows) == 2000:
                            yield pa.RecordBatch.from_pylist(rows, arrow)
                            rows = []
                except (ContainerError, struct.error):
                    pass
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, arrow)

    return artifacts.select("document_id", "content").mapInArrow(run, schema)


def archive_members(document_id: str, content: bytes) -> Iterator[dict]:
    yield from compound_members(document_id, content) if content[:4] == b"\xd0\xcf\x11\xe0" else zip_members(document_id, content)


def members(artifacts: DataFrame) -> DataFrame:
    """Parts of all artifacts by what their first bytes say: ZIP members, compound entries, or the file itself."""
    archive = F.hex(F.substring("content", 1, 4)).isin("504B0304", "D0CF11E0")
    single = artifacts.filter(~archive).select(
        "document_id", F.col("display_name").alias("path"), F.col("size_bytes").alias("compressed"), F.col("size_bytes").alias("inflated"), F.lit("stored").alias("method"), F.lit(False).alias("encrypted"), "sha256",
        F.lit("application/octet-stream").alias("media_type"), F.concat(F.lit("part_"), F.substring("sha256", 1, 26)).alias("part_id"), F.lit("read").alias("read_state"),
    )
    return per_document(artifacts.filter(archive), archive_members, MEMBERS).unionByName(single)


def part_relationships(artifacts: DataFrame) -> DataFrame:
    return per_document(artifacts.filter(F.hex(F.substring("content", 1, 4)) == "504B0304"), zip_relationships, RELATIONSHIPS)
