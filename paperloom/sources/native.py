"""Native formats: one long table of units per document, whatever the format.

A unit is (document_id, unit_id, kind, parent_id, ordinal, address, text, properties). Formulas are kept as they are
written, with the value that the file caches; nothing is calculated, executed or fetched.
"""

from __future__ import annotations

import pickle
import re
import struct
import unicodedata
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .containers import CompoundFile, ContainerError, _arrow, byte_bound, local, open_zip, parse_xml, read_member, relationships
from .ids import stable

UNITS = "document_id string, unit_id string, kind string, parent_id string, ordinal long, address string, text string, properties map<string,string>"

# Namespaces, and element names with the kinds they stand for ---------------------------------------------
W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
S = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
P = "{http://schemas.openxmlformats.org/presentationml/2006/main}"
R = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
REVISIONS = {"ins": "insert", "del": "delete", "moveFrom": "move_from", "moveTo": "move_to"}
SHAPES = ("sp", "pic", "graphicFrame", "grpSp", "cxnSp")
STORIES = [("header", r"word/header.*\.xml$"), ("footer", r"word/footer.*\.xml$"), ("footnote", r"word/footnotes\.xml.*"), ("endnote", r"word/endnotes\.xml.*")]
METADATA = [("docProps/core.xml", "core"), ("docProps/app.xml", "extended"), ("docProps/custom.xml", "custom")]
PERSONAL = {"creator", "lastmodifiedby", "company", "manager", "author"}
PDF_INFO = ["Title", "Author", "Subject", "Keywords", "Creator", "Producer"]
PDF_ANNOTATIONS = {"Text", "Link", "Highlight", "Underline", "StrikeOut", "FileAttachment", "Widget"}
#: Bytes before and after a page's mark in which its box and rotation are looked for.
PDF_WINDOW = (4096, 8192)
BOMS = [(b"\xef\xbb\xbf", "utf-8"), (b"\xff\xfe\x00\x00", "utf-32-le"), (b"\x00\x00\xfe\xff", "utf-32-be"), (b"\xff\xfe", "utf-16-le"), (b"\xfe\xff", "utf-16-be")]
JPEG_SIZES = set(range(0xC0, 0xD0)) - {0xC4, 0xC8, 0xCC}


#: Units that are handed on at once.
PACKED = 2000


class Packed:
    """Rows that are only added and read in order, kept as bytes, which take far less memory than dictionaries."""

    def __init__(self):
        self.parts, self.last = [], []

    def append(self, row: dict) -> None:
        self.last.append(row)
        if len(self.last) == PACKED:
            self.parts.append(pickle.dumps(self.last, -1))
            self.last = []

    def lists(self) -> Iterator[list[dict]]:
        """The rows by PACKED at a time."""
        yield from map(pickle.loads, self.parts)
        if self.last:
            yield self.last

    def __iter__(self) -> Iterator[dict]:
        return (row for part in self.lists() for row in part)


class Units:
    """Collects a document's units; ids hash what the caller says identifies the unit."""

    def __init__(self, document_id: str, rows: list | Packed | None = None):
        self.document_id, self.rows = document_id, [] if rows is None else rows

    def add(self, kind: str, parent: str | None, ordinal: int, address: str, text: str | None = None, prefix: str | None = None, seed: dict | None = None, **properties) -> str:
        unit = stable(prefix or kind, document_id=self.document_id, **(seed or {"address": address}))
        known = {k: str(v) for k, v in properties.items() if v is not None}
        self.rows.append({"document_id": self.document_id, "unit_id": unit, "kind": kind, "parent_id": parent, "ordinal": ordinal, "address": address, "text": text, "properties": known})
        return unit


def _value(element, name: str = "val") -> str | None:
    """An attribute by local name."""
    if element is None:
        return None
    return next((v for k, v in element.attrib.items() if local(k) == name), None)


def _flow_text(element) -> str:
    """The text below an element, tabs and breaks included."""
    marks = {"tab": "\t", "br": "\n", "cr": "\n"}
    return "".join((e.text or "") if local(e.tag) in ("t", "delText", "instrText") else marks.get(local(e.tag), "") for e in element.iter())


def _flags(element, scope: str) -> dict[str, str]:
    """Attributes of an element's children as properties."""
    out = {}
    for child in element if element is not None else ():
        own = {local(k): v for k, v in child.attrib.items()}
        for k, v in (own or {"": "true"}).items():
            out[f"{scope}.{local(child.tag)}" + (f".{k}" if k and k != "val" else "")] = v
    return out


def _metadata(units: Units, archive, names: set[str]) -> None:
    for path, namespace in METADATA:
        if path in names:
            for i, e in enumerate(parse_xml(read_member(archive, path))):
                name, inner = local(e.tag), next(iter(e), None)
                text = (inner.text if inner is not None else e.text) or ""
                units.add("metadata", None, i, f"{path}#/{name}[{i + 1}]", text, seed={"index": i, "name": name, "path": path}, namespace=namespace, name=name, sensitivity="personal" if name.lower() in PERSONAL else "public")


def decode_text(data: bytes) -> tuple[str, str, float, int]:
    """(text, encoding, confidence, length of the byte order mark)."""
    for mark, encoding in BOMS:
        if data.startswith(mark):
            try:
                return data[len(mark) :].decode(encoding), encoding, 1.0, len(mark)
            except UnicodeDecodeError:
                return data.decode("utf-8", "replace"), "utf-8-replacement", 0.25, len(mark)
    for encoding, confidence in (("utf-8", 1.0), ("cp1252", 0.85), ("latin-1", 0.70)):
        try:
            return data.decode(encoding), encoding, confidence, 0
        except UnicodeDecodeError:
            continue
    raise AssertionError("latin-1 takes any byte")


def text_units(document_id: str, data: bytes) -> Iterator[dict]:
    text, encoding, confidence, at = decode_text(data)
    controls = sorted({f"U+{ord(c):04X}" for c in set(text) if unicodedata.category(c) == "Cc" and c not in "\t\n\r\f"})
    units = Units(document_id)
    crlf = text.count("\r\n")
    styles = [n for n, k in (("crlf", crlf), ("lf", text.count("\n") - crlf), ("cr", text.count("\r") - crlf)) if k]
    units.add("profile", None, 0, "text:profile", seed={"profile": "plain_text"}, encoding=encoding, confidence=confidence, newline_style=styles[0] if len(styles) == 1 else "mixed" if styles else "none", controls=",".join(controls))
    codec = encoding.removesuffix("-replacement")
    for i, raw in enumerate(text.splitlines(keepends=True)):
        line, size = raw.rstrip("\r\n"), len(raw.encode(codec, "replace"))
        units.add("line", None, i, f"text:line[{i}]", line, seed={"ordinal": i, "start": at}, byte_start=at, byte_end=at + len(line.encode(codec, "replace")))
        at += size
    yield from units.rows


def docx_units(document_id: str, data: bytes) -> Iterator[dict]:
    archive = open_zip(data)
    names = set(archive.namelist())
    if "word/document.xml" not in names:
        raise ContainerError("no main document")
    units = Units(document_id)
    main = "word/document.xml#/document/body"
    if "word/styles.xml" in names:
        for i, e in enumerate(parse_xml(read_member(archive, "word/styles.xml")).findall(f"{W}style")):
            native = _value(e, "styleId") or f"anonymous-{i}"
            own = {k: v for c in e if local(c.tag) in ("pPr", "rPr", "tblPr", "tcPr") for k, v in _flags(c, local(c.tag).lower()).items()}
            units.add("style", None, i, f"word/styles.xml#/styles/style[{i + 1}]", _value(e.find(f"{W}name")) or native, seed={"native": native}, native=native, based_on=_value(e.find(f"{W}basedOn")), style_kind=_value(e, "type") or "unknown", **own)
    section = units.add("section", None, 0, main, seed={"ordinal": 0})
    body = parse_xml(read_member(archive, "word/document.xml")).find(f"{W}body")

    def run(element, parent: str, ordinal: int, address: str) -> str:
        look = element.find(f"{W}rPr")
        style = _value(look.find(f"{W}rStyle")) if look is not None else None
        return units.add("run", parent, ordinal, address, _flow_text(element), style=style, **_flags(look, "run"))

    def paragraph(element, parent: str, ordinal: int, address: str) -> None:
        look = element.find(f"{W}pPr")
        style = _value(look.find(f"{W}pStyle")) if look is not None else None
        own = units.add("paragraph", parent, ordinal, address, _flow_text(element), style=style, **_flags(look, "paragraph"))
        count = 0
        for i, child in enumerate(element, 1):
            name = local(child.tag)
            if name == "r":
                run(child, own, count, f"{address}/r[{i}]")
                count += 1
            elif name in REVISIONS:
                place, targets = f"{address}/{name}[{i}]", []
                for j, inner in enumerate(child.findall(f"{W}r"), 1):
                    targets.append(run(inner, own, count, f"{place}/r[{j}]"))
                    count += 1
                if targets:
                    units.add("revision", own, i, place, kind_of=REVISIONS[name], author=_value(child, "author"), date=_value(child, "date"), targets=",".join(targets))

    count = 0
    for i, child in enumerate(body if body is not None else (), 1):
        name = local(child.tag)
        if name == "p":
            paragraph(child, section, count, f"{main}/p[{i}]")
        elif name == "tbl":
            table = units.add("table", section, count, f"{main}/tbl[{i}]", seed={"index": i - 1})
            for r, tr in enumerate(child.findall(f"{W}tr")):
                row = units.add("row", table, r, f"{main}/tbl[{i}]/tr[{r + 1}]", seed={"index": r, "table": table})
                for c, tc in enumerate(tr.findall(f"{W}tc")):
                    place = f"{main}/tbl[{i}]/tr[{r + 1}]/tc[{c + 1}]"
                    cell = units.add("cell", row, c, place, _flow_text(tc), seed={"index": c, "row": row})
                    for k, p in enumerate(tc.findall(f"{W}p")):
                        paragraph(p, cell, k, f"{place}/p[{k + 1}]")
        else:
            if name == "sectPr":
                units.rows[next(k for k, u in enumerate(units.rows) if u["unit_id"] == section)]["properties"] |= _flags(child, "section")
            continue
        count += 1
    for kind, pattern in STORIES:
        for name in sorted(n for n in names if re.match(pattern, n)):
            units.add(kind, section, len(units.rows), name, _flow_text(parse_xml(read_member(archive, name))), seed={"part": name})
    if "word/comments.xml" in names:
        first = next((u["unit_id"] for u in units.rows if u["kind"] == "paragraph"), None)
        for i, e in enumerate(parse_xml(read_member(archive, "word/comments.xml")).findall(f"{W}comment")):
            units.add("annotation", first, i, f"word/comments.xml#/comments/comment[{i + 1}]", _flow_text(e), seed={"comment": _value(e, "id") or str(i)}, author=_value(e, "author"), date=_value(e, "date"))
    _metadata(units, archive, names)
    yield from units.rows


def xlsx_units(document_id: str, data: bytes) -> Iterator[dict]:
    archive = open_zip(data)
    names = set(archive.namelist())
    if "xl/workbook.xml" not in names:
        raise ContainerError("no workbook")
    units = Units(document_id, Packed())  # a sheet's cells are many
    if "xl/styles.xml" in names:
        formats = parse_xml(read_member(archive, "xl/styles.xml")).find(f"{S}cellXfs")
        for i, e in enumerate(formats if formats is not None else ()):
            units.add("style", None, i, f"xl/styles.xml#/styleSheet/cellXfs/xf[{i + 1}]", seed={"cell_xf": i}, **{f"xf.{local(k)}": v for k, v in e.attrib.items()})
    shared = []
    if "xl/sharedStrings.xml" in names:
        shared = ["".join(t.text or "" for t in e.iter() if local(t.tag) == "t") for e in parse_xml(read_member(archive, "xl/sharedStrings.xml")).findall(f"{S}si")]
    book = parse_xml(read_member(archive, "xl/workbook.xml"))
    links = relationships(archive, "xl/_rels/workbook.xml.rels")
    sheets = book.find(f"{S}sheets")
    for number, e in enumerate(sheets if sheets is not None else ()):
        path = links.get(e.get(f"{R}id", ""), (f"xl/worksheets/sheet{number + 1}.xml", "", False))[0]
        if path not in names:
            continue
        root = parse_xml(read_member(archive, path))
        used = root.find(f"{S}dimension")
        sheet = units.add("worksheet", None, number, path, e.get("name", ""), seed={"ordinal": number, "path": path}, visibility=e.get("state", "visible"), used_range=used.get("ref") if used is not None else None)
        for i, c in enumerate(root.iter(f"{S}c")):
            address, code, raw = c.get("r") or f"A{i + 1}", c.get("t", "n"), c.findtext(f"{S}v")
            inline, formula = c.find(f"{S}is"), c.find(f"{S}f")
            kind, value = "blank", raw
            if code == "s" and raw is not None:
                kind, value = "string", shared[int(raw)] if raw.isdigit() and int(raw) < len(shared) else raw
            elif code in ("str", "inlineStr"):
                kind = "string"
                value = "".join(t.text or "" for t in inline.iter() if local(t.tag) == "t") if inline is not None else raw
            elif code == "b":
                kind, value = "boolean", "true" if raw == "1" else "false"
            elif code == "e":
                kind = "error"
            elif raw is not None:
                kind = "number"
            place = f"{path}#/worksheet/sheetData/c[{i + 1}]"
            cell = units.add("cell", sheet, i, place, value, seed={"address": address, "worksheet": sheet}, at=address.replace("$", ""), value_kind="formula" if formula is not None else kind, style=c.get("s"))
            if formula is not None:
                native = formula.get("t", "normal")
                units.add("formula", cell, i, place + "/f", formula.text or "", seed={"cell": cell}, kind_of=native if native in ("normal", "shared", "array", "data_table") else "normal", cached=value, recalculated="false")
            c.clear()  # what is read of the tree is freed
    _metadata(units, archive, names)
    yield from units.rows


def pptx_units(document_id: str, data: bytes) -> Iterator[dict]:
    archive = open_zip(data)
    names = set(archive.namelist())
    if "ppt/presentation.xml" not in names:
        raise ContainerError("no presentation")
    units = Units(document_id)
    links = relationships(archive, "ppt/_rels/presentation.xml.rels")
    listed = parse_xml(read_member(archive, "ppt/presentation.xml")).find(f"{P}sldIdLst")
    for number, e in enumerate(listed if listed is not None else ()):
        path = links.get(e.get(f"{R}id", ""), (f"ppt/slides/slide{number + 1}.xml", "", False))[0]
        if path not in names:
            continue
        root = parse_xml(read_member(archive, path))
        folder, file = path.rsplit("/", 1)
        own = relationships(archive, f"{folder}/_rels/{file}.rels")
        refs = {kind: next((t for t, how, out in own.values() if not out and how.endswith(end)), None) for kind, end in (("layout", "/slideLayout"), ("master", "/slideMaster"), ("notes", "/notesSlide"))}
        slide = units.add("slide", None, number, path, seed={"ordinal": number, "path": path}, hidden=str(_value(e, "show") == "0").lower(), **refs)
        tree = root.find(f".//{P}spTree")
        shapes = [x for x in (tree if tree is not None else ()) if local(x.tag) in SHAPES]
        for i, x in enumerate(shapes):
            mark = next((n for n in x.iter() if local(n.tag) == "cNvPr"), None)
            native = _value(mark, "id") if mark is not None else str(i)
            text = "".join(n.text or "" for n in x.iter() if local(n.tag) == "t")
            used = [own[k][0] for n in x.iter() for k in (n.get(f"{R}embed"), n.get(f"{R}link")) if k in own]
            units.add("shape", slide, i, f"{path}#/sld/cSld/spTree/{local(x.tag)}[{i + 1}]", text or None, seed={"native": native, "slide": slide}, element=local(x.tag), resources=",".join(used) or None)
        change, timing = root.find(f"{P}transition"), root.find(f"{P}timing")
        if change is not None:
            inner = next(iter(change), None)
            length = _value(change, "dur")
            units.add("transition", slide, number, f"{path}#/sld/transition", prefix="event", seed={"kind": "transition", "slide": slide}, kind_of=local(inner.tag) if inner is not None else "unknown", trigger="automatic" if _value(change, "advTm") else "on_click", duration_ms=length if length and length.isdigit() else None)
        if timing is not None:
            units.add("animation", slide, number, f"{path}#/sld/timing", prefix="event", seed={"kind": "timing", "slide": slide}, kind_of="timing_tree", trigger="unknown")
    _metadata(units, archive, names)
    yield from units.rows


def pdf_units(document_id: str, data: bytes) -> Iterator[dict]:
    units = Units(document_id)
    number = rb"([-+0-9.]+)"
    ended = b"startxref" in data[-4096:] and data.rstrip().endswith(b"%%EOF")
    units.add("profile", None, 0, "pdf:profile", seed={"profile": "fixed_layout"}, repaired=str(not ended).lower(), encrypted=str(b"/Encrypt" in data).lower())
    for i, match in enumerate(re.finditer(rb"/Type\s*/Page(?!s)\b", data)):
        near = data[max(0, match.start() - PDF_WINDOW[0]) : match.end() + PDF_WINDOW[1]]
        box, turn = re.search(rb"/MediaBox\s*\[\s*" + rb"\s+".join([number] * 4) + rb"\s*\]", near), re.search(rb"/Rotate\s+(-?\d+)", near)
        width, height = 612.0, 792.0
        if box:
            try:
                a, b, c, d = map(float, box.groups())
                width, height = abs(c - a), abs(d - b)
            except ValueError:
                pass
        angle = int(turn[1]) % 360 if turn else 0
        units.add("page", None, i, f"pdf:page[{i}]", seed={"ordinal": i}, width_pt=width, height_pt=height, rotation=angle if angle % 90 == 0 else 0)
    for i, name in enumerate(PDF_INFO):
        found = re.search(rb"/" + name.encode() + rb"\s*\(([^)]*)\)", data)
        if found:
            units.add("metadata", None, i, f"pdf:info/{name}", found[1].decode("latin-1"), seed={"name": name}, namespace="pdf.info", name=name.lower(), sensitivity="personal" if name == "Author" else "public")
    for i, kind in enumerate(re.findall(rb"/Subtype\s*/([A-Za-z0-9]+)", data)):
        if kind.decode() in PDF_ANNOTATIONS:
            units.add("annotation", None, i, f"pdf:annotation[{i}]", seed={"index": i, "kind": kind.decode()}, kind_of=kind.decode().lower())
    yield from units.rows


def _tiff(data: bytes) -> tuple[int, int, int]:
    order = "<" if data[:2] == b"II" else ">"
    if struct.unpack_from(order + "H", data, 2)[0] != 42:
        raise ContainerError("big TIFF")
    at, seen, size = struct.unpack_from(order + "I", data, 4)[0], set(), {}
    while at and at not in seen and at + 2 <= len(data):
        seen.add(at)
        n = struct.unpack_from(order + "H", data, at)[0]
        for k in range(n):
            if at + 14 + 12 * k > len(data):
                break
            tag, kind, count = struct.unpack_from(order + "HHI", data, at + 2 + 12 * k)
            if tag in (256, 257) and kind in (3, 4) and count == 1 and len(seen) == 1:
                size[tag] = struct.unpack_from(order + ("H" if kind == 3 else "I"), data, at + 10 + 12 * k)[0]
        end = at + 2 + 12 * n
        at = struct.unpack_from(order + "I", data, end)[0] if end + 4 <= len(data) else 0
    return size.get(256, 0), size.get(257, 0), len(seen)


def _jpeg(data: bytes) -> tuple[int, int, int]:
    at = 2
    while at + 9 < len(data):
        if data[at] != 0xFF:
            at += 1
            continue
        marker, at = data[at + 1], at + 2
        if marker in JPEG_SIZES:
            height, width = struct.unpack_from(">HH", data, at + 3)
            return width, height, 1
        if marker not in (0xD8, 0xD9):
            at += max(2, struct.unpack_from(">H", data, at)[0])
    return 0, 0, 0


def _webp(data: bytes) -> tuple[int, int, int]:
    at = data.find(b"VP8X")
    if at < 0 or at + 18 > len(data):
        return 0, 0, 0
    return *(1 + int.from_bytes(data[at + k : at + k + 3], "little") for k in (12, 15)), max(1, data.count(b"ANMF"))


def _jp2(data: bytes) -> tuple[int, int, int]:
    at = data.find(b"ihdr")
    return (*struct.unpack_from(">II", data, at + 4)[::-1], 1) if 4 <= at <= len(data) - 12 else (0, 0, 0)


#: Format by its first bytes, with what gives (width, height, frames).
RASTERS: list[tuple[str, Callable[[bytes], bool], Callable[[bytes], tuple[int, int, int]]]] = [
    ("png", lambda d: d.startswith(b"\x89PNG\r\n\x1a\n"), lambda d: (*struct.unpack_from(">II", d, 16), 1)),
    ("gif", lambda d: d[:6] in (b"GIF87a", b"GIF89a"), lambda d: (*struct.unpack_from("<HH", d, 6), max(1, d.count(b"\x2c")))),
    ("jpeg", lambda d: d.startswith(b"\xff\xd8\xff"), _jpeg),
    ("tiff", lambda d: d[:2] in (b"II", b"MM") and d[2:4] in (b"*\0", b"\0*", b"+\0", b"\0+"), _tiff),
    ("webp", lambda d: d[:4] == b"RIFF" and d[8:12] == b"WEBP", _webp),
    ("jpeg2000", lambda d: d[4:12] == b"jP  \r\n\x87\n", _jp2),
    ("bmp", lambda d: d.startswith(b"BM") and len(d) >= 14, lambda d: (*map(abs, struct.unpack_from("<ii", d, 18)), 1)),
]


def raster_units(document_id: str, data: bytes) -> Iterator[dict]:
    name, size = next(((n, s) for n, fits, s in RASTERS if fits(data)), (None, None))
    try:
        width, height, frames = size(data) if size else (0, 0, 0)
    except struct.error as error:
        raise ContainerError(str(error)) from error
    if not width or not height:
        raise ContainerError("no dimensions")
    delays = [struct.unpack("<H", d)[0] * 10 for d in re.findall(rb"\x21\xf9\x04.(..)", data, re.S)] if name == "gif" else []
    units = Units(document_id)
    animated = name in ("gif", "webp") and frames > 1
    units.add("profile", None, 0, "image:profile", seed={"profile": "raster"}, format=name, animated=str(animated).lower(), surfaces="one_surface_per_frame" if name == "tiff" and frames > 1 else "single_surface")
    for i in range(frames):
        units.add("frame", None, i, f"image:frame[{i}]", seed={"ordinal": i}, width_px=width, height_px=height, duration_ms=delays[i] if i < len(delays) else None)
    yield from units.rows


def ole_units(document_id: str, data: bytes) -> Iterator[dict]:
    file, units, ids = CompoundFile(data), Units(document_id), {}
    for i, path, parent in file.walk():
        entry = file.entries[i]
        kind = "stream" if entry["kind"] == 2 else "storage"
        ids[i] = units.add(kind, ids.get(parent), i, path, seed={"ole_index": i, "path": path}, prefix="part", size_bytes=entry["size"])
    yield from units.rows


DECODERS = {"txt": text_units, "docx": docx_units, "xlsx": xlsx_units, "pptx": pptx_units, "pdf": pdf_units, "raster": raster_units, "ole": ole_units}


#: Kind of the row that stands for a document whose decoder refused or failed; its text says why.
FAILURE = "failure"


def decoded(decoder: str, document_id: str, content: bytes) -> list[dict]:
    """All units of a document, or one row of kind FAILURE: a hostile document never stops the job."""
    return list(packed(decoder, document_id, content))


def packed(decoder: str, document_id: str, content: bytes) -> Packed:
    """``decoded``, in little memory."""
    units = Packed()
    try:
        for row in DECODERS[decoder](document_id, content):
            units.append(row)
    except Exception as error:  # noqa: BLE001  whatever a damaged file makes a parser raise
        reason = str(error) if isinstance(error, ContainerError) else f"{type(error).__name__}: {error}"
        units = Packed()
        units.append({"document_id": document_id, "unit_id": stable("failure", document_id=document_id), "kind": FAILURE, "parent_id": None, "ordinal": 0, "address": decoder, "text": reason[:1000], "properties": {"code": "DS-DEC-001"}})
    return units


def attempts(artifacts: DataFrame, formats: DataFrame) -> DataFrame:
    """Units of all artifacts and the failures among them, in one pass over the contents.

    ``formats(artifact_id, format_name, family)`` comes from the probe; formats without decoder give no rows.
    """
    chosen = F.when(F.col("family") == "raster", "raster").otherwise(F.col("format_name"))
    named = formats.select("artifact_id", chosen.alias("decoder")).filter(F.col("decoder").isin(*DECODERS))
    rows = artifacts.join(named, "artifact_id").select("document_id", "decoder", "content")
    byte_bound(artifacts)
    arrow = _arrow(UNITS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []  # units of small documents are handed on together
            for document_id, decoder, content in zip(batch["document_id"].to_pylist(), batch["decoder"].to_pylist(), batch["content"]):
                for units in packed(decoder, document_id, content.as_py() or b"").lists():
                    rows += units
                    if len(rows) >= PACKED:
                        yield pa.RecordBatch.from_pylist(rows, arrow)
                        rows = []
            if rows:
                yield pa.RecordBatch.from_pylist(rows, arrow)

    return rows.mapInArrow(run, UNITS)


def decode(artifacts: DataFrame, formats: DataFrame) -> DataFrame:
    """Units of all artifacts that their decoder accepts."""
    return attempts(artifacts, formats).filter(F.col("kind") != FAILURE)


def failures(tried: DataFrame) -> DataFrame:
    """(document_id, code, decoder, reason) of the failures among ``attempts``."""
    return tried.filter(F.col("kind") == FAILURE).select("document_id", F.element_at("properties", "code").alias("code"), F.col("address").alias("decoder"), F.col("text").alias("reason"))
