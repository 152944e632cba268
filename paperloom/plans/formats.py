"""Queries over documents of binary formats: rows of the tables are packed into files, then probed, inventoried and decoded.

The files are made by fixed writers (no clock, no compression level that could change), so that every run gives the
same bytes, hashes and ids.
"""

from __future__ import annotations

import io
import struct
import zipfile
import zlib
from collections.abc import Callable, Iterable, Iterator
from functools import partial
from xml.sax.saxutils import escape

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.identity import canonical_json, stable_id
from ..sources import containers, native, probe
from ..sources.containers import byte_bound

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

W = "http://schemas.openxmlformats.org/wordprocessingml/2006/main"
S = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
P = "http://schemas.openxmlformats.org/presentationml/2006/main"
A = "http://schemas.openxmlformats.org/drawingml/2006/main"
R = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
RELS = "http://schemas.openxmlformats.org/package/2006/relationships"
TYPES = "http://schemas.openxmlformats.org/package/2006/content-types"


def _safe(text: str) -> str:
    return escape("".join(c for c in text or "" if c in "\t\n\r" or ord(c) >= 32))


def package(files: dict[str, str | bytes]) -> bytes:
    """A ZIP of these members, stored under a fixed time."""
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for name, data in files.items():
            z.writestr(zipfile.ZipInfo(name, (2026, 1, 1, 0, 0, 0)), data, zipfile.ZIP_DEFLATED)
    return out.getvalue()


def types(**overrides: str) -> str:
    own = "".join(f'<Override PartName="/{k}" ContentType="{v}"/>' for k, v in overrides.items())
    return f'<Types xmlns="{TYPES}"><Default Extension="xml" ContentType="application/xml"/><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>{own}</Types>'


def rels(*links: tuple[str, str, str]) -> str:
    own = "".join(f'<Relationship Id="{i}" Type="{R}/{kind}" Target="{target}"/>' for i, kind, target in links)
    return f'<Relationships xmlns="{RELS}">{own}</Relationships>'


def docx(text: str, author: str = "nobody") -> bytes:
    """Each line a paragraph; the last one a table of one cell; a style, a header and metadata."""
    lines = (text or "").split("\n")
    para = lambda t: f'<w:p><w:pPr><w:pStyle w:val="Body"/></w:pPr><w:r><w:t>{_safe(t)}</w:t></w:r></w:p>'
    body = "".join(map(para, lines[:-1])) + f"<w:tbl><w:tr><w:tc>{para(lines[-1])}</w:tc></w:tr></w:tbl><w:sectPr><w:pgSz w:w=\"100\"/></w:sectPr>"
    return package({
        "[Content_Types].xml": types(**{"word/document.xml": "application/vnd.openxmlformats-officedocument.wordprocessingml.document.main+xml"}),
        "_rels/.rels": rels(("r1", "officeDocument", "word/document.xml")),
        "word/document.xml": f'<w:document xmlns:w="{W}"><w:body>{body}</w:body></w:document>',
        "word/styles.xml": f'<w:styles xmlns:w="{W}"><w:style w:styleId="Base" w:type="paragraph"><w:name w:val="Base"/><w:rPr><w:b/></w:rPr></w:style><w:style w:styleId="Body" w:type="paragraph"><w:name w:val="Body"/><w:basedOn w:val="Base"/></w:style></w:styles>',
        "word/header1.xml": f'<w:hdr xmlns:w="{W}"><w:p><w:r><w:t>{_safe(author)}</w:t></w:r></w:p></w:hdr>',
        "docProps/core.xml": f"<core><creator>{_safe(author)}</creator><title>{len(lines)}</title></core>",
    })


def xlsx(cells: Iterable[tuple[str, str]], formula: str | None = None) -> bytes:
    """Inline strings at their addresses, and one formula with a cached value."""
    own = "".join(f'<c r="{a}" t="inlineStr"><is><t>{_safe(v)}</t></is></c>' for a, v in cells)
    own += f'<c r="ZZ1"><f>{_safe(formula)}</f><v>30</v></c>' if formula else ""
    return package({
        "[Content_Types].xml": types(**{"xl/workbook.xml": "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"}),
        "xl/workbook.xml": f'<workbook xmlns="{S}" xmlns:r="{R}"><sheets><sheet name="One" sheetId="1" r:id="r1"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels": rels(("r1", "worksheet", "worksheets/sheet1.xml")),
        "xl/worksheets/sheet1.xml": f'<worksheet xmlns="{S}"><sheetData><row>{own}</row></sheetData></worksheet>',
    })


def pptx(texts: list[str]) -> bytes:
    """One slide per text, each with a text shape and a picture frame."""
    files = {
        "[Content_Types].xml": types(**{"ppt/presentation.xml": "application/vnd.openxmlformats-officedocument.presentationml.presentation.main+xml"}),
        "ppt/presentation.xml": f'<p:presentation xmlns:p="{P}" xmlns:r="{R}"><p:sldIdLst>' + "".join(f'<p:sldId id="{i}" r:id="r{i}"/>' for i in range(len(texts))) + "</p:sldIdLst></p:presentation>",
        "ppt/_rels/presentation.xml.rels": rels(*[(f"r{i}", "slide", f"slides/slide{i}.xml") for i in range(len(texts))]),
    }
    for i, t in enumerate(texts):
        files[f"ppt/slides/slide{i}.xml"] = (
            f'<p:sld xmlns:p="{P}" xmlns:a="{A}" xmlns:r="{R}"><p:cSld><p:spTree><p:sp><p:nvSpPr><p:cNvPr id="2" name="t"/></p:nvSpPr><p:txBody><a:p><a:r><a:t>{_safe(t)}</a:t></a:r></a:p></p:txBody></p:sp>'
            f'<p:pic><p:nvPicPr><p:cNvPr id="3" name="p"/></p:nvPicPr></p:pic></p:spTree></p:cSld>{"<p:transition/>" if i % 2 else ""}</p:sld>'
        )
    return package(files)


def pdf(pages: int, width: int, height: int, turn: int, title: str) -> bytes:
    objects = ["<< /Type /Catalog /Pages 2 0 R >>", f"<< /Type /Pages /Count {pages} >>"]
    objects += [f"<< /Type /Page /MediaBox [0 0 {width} {height}] /Rotate {turn} /Annots [<< /Subtype /Text >>] >>{' ' * 9000}" for _ in range(pages)]
    body = "%PDF-1.7\n" + "".join(f"{i} 0 obj\n{o}\nendobj\n" for i, o in enumerate(objects, 1)) + f"<< /Title ({title}) >>\n"
    return (body + "trailer\nstartxref\n0\n%%EOF\n").encode("latin-1", "replace")


#: The longest side of an image by format: two bytes in GIF, four (held to be signed) in the others.
WIDEST = {"gif": (1 << 16) - 1, "png": (1 << 31) - 1, "bmp": (1 << 31) - 1, "tiff": (1 << 31) - 1}


def folded(kind: str, width: int, height: int) -> tuple[int, int]:
    """A size that the format can hold: by how often a width is too long, the height grows, so that widths stay apart."""
    most = WIDEST[kind]
    more, width = divmod(width - 1, most)
    return width + 1, (height - 1 + more) % most + 1


def raster(kind: str, width: int, height: int, frames: int) -> bytes:
    width, height = folded(kind, width, height)
    if kind == "png":
        chunk = lambda name, data: struct.pack(">I", len(data)) + name + data + struct.pack(">I", zlib.crc32(name + data))
        return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0)) + chunk(b"IEND", b"")
    if kind == "gif":
        return b"GIF89a" + struct.pack("<HH", width, height) + b"\0\0\0" + b"\x21\xf9\x04\0\x05\0\0\0\x2c" * frames + b"\x3b"
    if kind == "bmp":
        return b"BM" + struct.pack("<IIIIii", 26, 0, 26, 40, width, height) + bytes(8)
    out = b"II*\0" + struct.pack("<I", 8)
    # a side is a field of two bytes, of four where it is longer
    field = lambda tag, side: struct.pack("<HHIHH", tag, 3, 1, side, 0) if side < 1 << 16 else struct.pack("<HHII", tag, 4, 1, side)
    for i in range(frames):
        after = 8 + (i + 1) * 30
        out += struct.pack("<H", 2) + field(256, width) + field(257, height) + struct.pack("<I", after if i + 1 < frames else 0)
    return out


def compound(stream: bytes) -> bytes:
    """A compound file of 512-byte sectors with one stream WordDocument."""
    stream = stream.ljust(4096, b"\0")
    n = -(-len(stream) // 512)
    fat = [0xFFFFFFFD, 0xFFFFFFFE, *[i + 3 for i in range(n - 1)], 0xFFFFFFFE]
    n_fat = 1
    if len(fat) > 128:
        raise ValueError("a stream of 64 KiB at most")
    fat += [0xFFFFFFFF] * (128 - len(fat))

    def entry(name: str, kind: int, child: int, start: int, size: int) -> bytes:
        raw = name.encode("utf-16le")
        return raw.ljust(64, b"\0") + struct.pack("<HBB", len(raw) + 2, kind, 1) + struct.pack("<III", 0xFFFFFFFF, 0xFFFFFFFF, child) + bytes(36) + struct.pack("<IQ", start, size)

    directory = entry("Root Entry", 5, 1, 0xFFFFFFFE, 0) + entry("WordDocument", 2, 0xFFFFFFFF, 2, len(stream)) + bytes(256)
    head = bytes.fromhex("D0CF11E0A1B11AE1") + bytes(16) + struct.pack("<HHHHH", 0x3E, 3, 0xFFFE, 9, 6) + bytes(10) + struct.pack("<II", n_fat, 1) + bytes(4) + struct.pack("<IIIII", 4096, 0xFFFFFFFE, 0, 0xFFFFFFFE, 0)
    head += struct.pack("<I", 0) + b"\xff" * 4 * 108
    return head + struct.pack("<128I", *fat) + directory + stream.ljust(n * 512, b"\0")


#: Bytes of built files that a task holds before it hands them on.
FILE_BYTES = 1 << 20


def built(build: Callable[[dict], bytes], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The files that ``build`` makes of rows; neither all rows of a batch nor all its files are held at once."""
    for batch in batches:
        ids, made, size = [], [], 0
        for i in range(len(batch)):
            row = batch.slice(i, 1).to_pylist()[0]
            ids.append(row["id"])
            made.append(build(row))
            del row
            size += len(made[-1])
            if size >= FILE_BYTES or i + 1 == len(batch):
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(made, pa.binary())], names=["id", "content"])
                ids, made, size = [], [], 0


def artifacts(rows: DataFrame, build: Callable[[dict], bytes], name: str) -> DataFrame:
    """Artifact rows whose bytes ``build`` makes of each row; ``rows`` has an ``id``."""
    fields = rows.columns
    byte_bound(rows)
    made = rows.select(*fields).mapInArrow(partial(built, build), "id long, content binary")
    made = made.select("id", "content", F.sha2("content", 256).alias("sha256"), F.octet_length("content").cast("long").alias("size_bytes"), F.concat(F.col("id").cast("string"), F.lit("." + name)).alias("display_name"))
    document = stable_id("document", canonical_json(role=F.lit("primary"), sha256=F.col("sha256")))
    return made.select(F.concat(F.lit("artifact_"), F.col("id").cast("string")).alias("artifact_id"), document.alias("document_id"), "display_name", "sha256", "size_bytes", "content")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_files(spark, sf_dir) -> DataFrame:
    return artifacts(_table(spark, sf_dir, "conversations").select(F.xxhash64("conv_id", "turn", "role").alias("id"), "text"), lambda r: (r["text"] or "").encode(), "txt")


def word_files(spark, sf_dir) -> DataFrame:
    return artifacts(_table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("id"), "text"), lambda r: docx(r["text"], f"author {r['id']}"), "docx")


def sheet_files(spark, sf_dir) -> DataFrame:
    rows = _table(spark, sf_dir, "part").groupBy(F.crc32(F.encode("p_brand", "UTF-8")).alias("id")).agg(F.array_sort(F.collect_list(F.struct("p_partkey", "p_name"))).alias("cells"))
    return artifacts(rows, lambda r: xlsx(((f"A{c['p_partkey'] + 1}", c["p_name"]) for c in r["cells"]), "SUM(A1:A9)*NOW()"), "xlsx")


def slide_files(spark, sf_dir) -> DataFrame:
    rows = _table(spark, sf_dir, "conversations").groupBy(F.col("conv_id").alias("id")).agg(F.array_sort(F.collect_list(F.struct("turn", "text"))).alias("turns"))
    return artifacts(rows, lambda r: pptx([t["text"] for t in r["turns"]]), "pptx")


def page_files(spark, sf_dir) -> DataFrame:
    rows = _table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("id"), "n_name", F.col("n_regionkey").cast("long").alias("region"))
    return artifacts(rows, lambda r: pdf(r["id"] % 3 + 1, 595, 842 + r["id"], 90 * r["region"], r["n_name"]), "pdf")


def image_files(spark, sf_dir) -> DataFrame:
    rows = _table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"))
    return artifacts(rows, lambda r: raster(("png", "gif", "bmp", "tiff")[r["id"] % 4], 2 + r["id"], 3, r["id"] % 5 + 1), "png")


def compound_files(spark, sf_dir) -> DataFrame:
    rows = _table(spark, sf_dir, "region").select(F.col("r_regionkey").cast("long").alias("id"), "r_name")
    return artifacts(rows, lambda r: compound(r["r_name"].encode() * 50), "doc")


FILES = {"txt": text_files, "docx": word_files, "xlsx": sheet_files, "pptx": slide_files, "pdf": page_files, "raster": image_files, "ole": compound_files}


def _units(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        files = FILES[name](spark, sf_dir)
        units = native.decode(files, files.select("artifact_id", F.lit(name).alias("format_name"), F.lit(None).cast("string").alias("family")))
        flat = F.array_join(F.array_sort(F.transform(F.map_entries("properties"), lambda e: F.concat_ws("=", e["key"], e["value"]))), ";")
        return units.withColumn("properties", flat)

    run.__doc__ = f"Native units of {name} documents."
    return run


QUERIES |= {f"{name}_units": _units(name) for name in FILES}


def container_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts of all containers."""
    out = None
    for name in ("docx", "xlsx", "pptx", "ole", "pdf"):
        found = containers.members(FILES[name](spark, sf_dir))
        out = found if out is None else out.unionByName(found)
    return out


def container_relationships(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Relationships of packages."""
    return containers.part_relationships(word_files(spark, sf_dir)).unionByName(containers.part_relationships(slide_files(spark, sf_dir)))


def probed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every file's format."""
    out = None
    for name, files in FILES.items():
        found = probe.probe(files(spark, sf_dir)).withColumn("made_as", F.lit(name))
        out = found if out is None else out.unionByName(found)
    return out


def ingested_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the built files: each document's format, number of units and status."""
    from . import ingest

    files = None
    for make in FILES.values():
        files = make(spark, sf_dir) if files is None else files.unionByName(make(spark, sf_dir))
    t = ingest.plan(files)
    n = t["ir_units"].groupBy("document_id").agg(F.count("*").alias("n_units"))
    names = t["documents"].groupBy("document_id").agg(F.min("format_name").alias("format_name"))
    return t["statuses"].join(names, "document_id", "left").join(n, "document_id", "left")


QUERIES |= {"ingested_status": ingested_status, "container_members": container_members, "container_relationships": container_relationships, "probed_files": probed_files}
