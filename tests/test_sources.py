import io
import random
import struct
import zipfile

import pytest
from pyspark.sql import functions as F

from paperloom.plans import formats, ingest
from paperloom.sources import acquire, containers, native, probe
from paperloom.streaming import arrival


def kinds(rows):
    out = {}
    for r in rows:
        out.setdefault(r["kind"], []).append(r)
    return out


def test_docx():
    found = kinds(native.docx_units("d", formats.docx("one\ntwo", "me")))
    assert [u["text"] for u in found["paragraph"]] == ["one", "two"] and [u["text"] for u in found["run"]] == ["one", "two"]
    assert len(found["table"]) == len(found["row"]) == len(found["cell"]) == 1 and found["header"][0]["text"] == "me"
    assert found["paragraph"][1]["parent_id"] == found["cell"][0]["unit_id"]
    assert found["style"][1]["properties"]["based_on"] == "Base" and found["metadata"][0]["properties"]["sensitivity"] == "personal"
    assert len({u["unit_id"] for us in found.values() for u in us}) == sum(map(len, found.values()))


def test_docx_revisions_and_comments():
    w = formats.W
    body = f'<w:document xmlns:w="{w}"><w:body><w:p><w:ins w:author="x"><w:r><w:t>new</w:t></w:r></w:ins><w:del><w:r><w:delText>old</w:delText></w:r></w:del></w:p></w:body></w:document>'
    data = formats.package({"word/document.xml": body, "word/comments.xml": f'<w:comments xmlns:w="{w}"><w:comment w:id="7"><w:p><w:r><w:t>why</w:t></w:r></w:p></w:comment></w:comments>'})
    found = kinds(native.docx_units("d", data))
    assert [u["properties"]["kind_of"] for u in found["revision"]] == ["insert", "delete"] and found["annotation"][0]["text"] == "why"
    assert found["annotation"][0]["parent_id"] == found["paragraph"][0]["unit_id"]


def test_xlsx_keeps_formulas_uncalculated():
    found = kinds(native.xlsx_units("d", formats.xlsx([("A1", "x"), ("B2", "y")], "SUM(B2:B3)")))
    assert [u["properties"]["at"] for u in found["cell"]] == ["A1", "B2", "ZZ1"]
    assert found["formula"][0]["text"] == "SUM(B2:B3)" and found["formula"][0]["properties"] == {"kind_of": "normal", "cached": "30", "recalculated": "false"}


def test_pptx():
    found = kinds(native.pptx_units("d", formats.pptx(["hello", "bye"])))
    assert len(found["slide"]) == 2 and [u["text"] for u in found["shape"]] == ["hello", None, "bye", None] and len(found["transition"]) == 1


def test_pdf():
    found = kinds(native.pdf_units("d", formats.pdf(2, 595, 842, 90, "T")))
    assert [(u["properties"]["width_pt"], u["properties"]["rotation"]) for u in found["page"]] == [("595.0", "90")] * 2
    assert found["profile"][0]["properties"]["repaired"] == "false" and len(found["annotation"]) == 2


@pytest.mark.parametrize(("kind", "frames", "want"), [("png", 1, 1), ("gif", 2, 2), ("bmp", 1, 1), ("tiff", 2, 2)])
def test_raster(kind, frames, want):
    found = kinds(native.raster_units("d", formats.raster(kind, 2, 3, frames)))
    assert len(found["frame"]) == want and found["frame"][0]["properties"]["width_px"] == "2" and found["frame"][0]["properties"]["height_px"] == "3"


def test_compound_file():
    data = formats.compound(b"stream data")
    rows = list(containers.compound_members("d", data))
    assert [r["path"] for r in rows] == ["Root Entry", "Root Entry/WordDocument"] and rows[1]["sha256"]
    with pytest.raises(containers.ContainerError):
        containers.CompoundFile(data[:600])


def test_text_encodings():
    assert native.decode_text("é\n".encode("utf-16"))[1] == "utf-16-le" and native.decode_text("é".encode("cp1252"))[1:3] == ("cp1252", 0.85)
    assert native.decode_text(b"\x81")[1:3] == ("latin-1", 0.70)
    found = kinds(native.text_units("d", b"\xef\xbb\xbfalpha\nbeta\n"))
    assert [(u["text"], u["properties"]["byte_start"]) for u in found["line"]] == [("alpha", "3"), ("beta", "9")]


def test_declarations_are_refused():
    with pytest.raises(containers.ContainerError):
        containers.parse_xml(b'<!DOCTYPE x [<!ENTITY a "b">]><x/>')
    with pytest.raises(containers.ContainerError):
        list(native.docx_units("d", b"PK\x03\x04 broken"))


@pytest.fixture
def bundle(spark):
    bomb = formats.package({"a.xml": b"\0" * (12 << 20)})
    files = {
        "a.txt": b"alpha\nbeta\n", "b.docx": formats.docx("x\ny"), "c.xlsx": formats.xlsx([("A1", "v")], "A1"), "d.pptx": formats.pptx(["t"]), "e.pdf": formats.pdf(1, 595, 842, 0, "T"), "f.png": formats.raster("png", 2, 3, 1),
        "g.doc": formats.compound(b"w"), "h.bin": bytes([0, 255, 1, 2]) * 100, "i.zip": formats.package({"../up": "x"}), "j.zip": bomb, "k.docx": formats.package({"word/document.xml": "<x/>", "word/vbaProject.bin": b"m"}), "l.pdf": b"plain text", "m.docx": b"PK\x03\x04broken",
    }
    return acquire.injected(spark, files)


def test_probe(bundle):
    got = {r.artifact_id: r for r in probe.probe(bundle).collect()}
    names = {r.display_name: got[r.artifact_id] for r in bundle.select("display_name", "artifact_id").collect()}
    want = {"a.txt": "txt", "b.docx": "docx", "c.xlsx": "xlsx", "d.pptx": "pptx", "e.pdf": "pdf", "f.png": "png", "g.doc": "ole", "h.bin": "unknown_binary", "i.zip": "zip", "k.docx": "docx", "l.pdf": "txt"}
    assert {n: names[n].format_name for n in want} == want
    assert names["l.pdf"].extension_mismatch and not names["b.docx"].extension_mismatch and names["e.pdf"].media_type == "application/pdf" and names["m.docx"].readable is False


def test_other_encodings(spark):
    files = {"a.txt": "text é\n".encode("utf-16"), "b.txt": ("text" * 9).encode("utf-16-le"), "c.txt": "caf\u00e9 au lait".encode("latin-1"), "d.txt": bytes([0, 255, 1, 2]) * 100, "e.txt": b"\xff\xfe\x00", "f.txt": "x".encode("utf-32"), "g.txt": b"\xe9\x01\x02", "h.txt": b""}
    bundle = acquire.injected(spark, files)
    got = {r.display_name: r for r in bundle.select("artifact_id", "display_name").join(probe.probe(bundle).drop("display_name"), "artifact_id").collect()}
    assert {n: (r.format_name, r.confidence) for n, r in got.items()} == {
        "a.txt": ("txt", 0.98), "b.txt": ("txt", 0.85), "c.txt": ("txt", 0.70), "d.txt": ("unknown_binary", 1.0), "e.txt": ("unknown_binary", 1.0), "f.txt": ("txt", 0.98), "g.txt": ("unknown_binary", 1.0), "h.txt": ("txt", 1.0)
    }


MADE = {"docx": lambda: formats.docx("one\ntwo", "me"), "xlsx": lambda: formats.xlsx([("A1", "x"), ("B2", "y")], "SUM(B2:B3)"), "pptx": lambda: formats.pptx(["hello", "bye"]), "ole": lambda: formats.compound(b"stream data"), "pdf": lambda: formats.pdf(2, 595, 842, 90, "T"), "raster": lambda: formats.raster("tiff", 2, 3, 2)}


@pytest.mark.parametrize("name", sorted(MADE))
def test_damaged_files_give_units_or_one_failure(name):
    rng, whole, failed = random.Random(name), MADE[name](), 0
    for _ in range(400):
        data = bytearray(whole)
        for _ in range(rng.randint(1, 6)):
            data[rng.randrange(len(data))] = rng.randrange(256)
        if rng.random() < 0.3:
            del data[rng.randrange(len(data)) :]
        rows = native.decoded(name, "d", bytes(data))
        kinds = {r["kind"] for r in rows}
        assert native.FAILURE not in kinds or len(rows) == 1
        failed += native.FAILURE in kinds
        for read in (containers.archive_members, containers.zip_relationships):
            try:
                assert all(r["document_id"] == "d" for r in read("d", bytes(data)))
            except (containers.ContainerError, struct.error):
                pass
    assert name == "pdf" or failed > 20


def _encrypted(data: bytes) -> bytes:
    """The package with every member marked as encrypted, in both headers."""
    data = bytearray(data)
    for mark, at in ((b"PK\x03\x04", 6), (b"PK\x01\x02", 8)):
        place = data.find(mark)
        while place >= 0:
            data[place + at] |= 1
            place = data.find(mark, place + 4)
    return bytes(data)


def test_damaged_packages_do_not_stop_the_job(spark):
    good = formats.docx("x")
    at = zipfile.ZipFile(io.BytesIO(good)).getinfo("word/document.xml").header_offset + 30 + len("word/document.xml") + 10
    files = {"good.docx": good, "crc.docx": good[:at] + bytes([good[at] ^ 255]) + good[at + 1 :], "cut.docx": good[: len(good) // 2], "locked.docx": _encrypted(good), "types.docx": formats.package({"[Content_Types].xml": "<broken", "word/document.xml": "<x/>"})}
    t = ingest.plan(acquire.injected(spark, files))
    names = {r.document_id: r.display_name for r in t["artifacts"].select("document_id", "display_name").collect()}
    failures = {names[r.document_id]: r.code for r in t["decode_failures"].collect()}
    assert failures == {"crc.docx": "DS-DEC-001", "locked.docx": "DS-DEC-001"}
    status = {names[r.document_id]: r.status for r in t["statuses"].collect()}
    assert status["cut.docx"] == "rejected" and status["crc.docx"] in ("review", "error") and set(status) == set(files)
    states = {(names[r.document_id], r.path): r.read_state for r in t["members"].collect()}
    assert states["crc.docx", "word/document.xml"] == "failed" and states["locked.docx", "word/document.xml"] == "blocked"


def test_access(spark):
    files = {"a.pdf": b"%PDF-1.7 /Encrypt /Sig /ByteRange /JS (x) /Launch", "b.pdf": b"%PDF-1.7 plain", "c.docx": formats.package({"word/document.xml": "<x/>", "word/settings.xml": "<documentProtection/>", "_xmlsignatures/s.xml": "<s/>"}), "d.doc": formats.compound("EncryptedPackage VBA".encode("utf-16le")), "e.txt": b"x"}
    t = ingest.plan(acquire.injected(spark, files), until="native_units")
    names = {r.document_id: r.display_name for r in t["artifacts"].select("document_id", "display_name").collect()}
    got = {names[r.document_id]: (r.access_state, r.signature, list(r.restrictions)) for r in t["access_states"].collect()}
    assert got["a.pdf"] == ("secret_required", "present_unverified", ["javascript_present_inert", "launch_action_present_inert"]) and got["b.pdf"] == ("clear", "absent", [])
    assert got["c.docx"] == ("clear_restricted", "present_unverified", ["native_editing_restriction_present"]) and got["d.doc"][0] == "secret_required" and got["e.txt"][0] == "clear"
    assert not {names[r.document_id] for r in t["native_units"].collect()} & {"a.pdf", "d.doc"}


def test_ingest(spark, bundle, tmp_path):
    t = ingest.plan(bundle)
    ids = {r.document_id: r.display_name for r in bundle.select("document_id", "display_name").collect()}
    decision = {ids[r.document_id]: r.decision for r in t["decisions"].collect()}
    assert decision["i.zip"] == decision["j.zip"] == decision["m.docx"] == "block"
    assert decision["h.bin"] == decision["k.docx"] == decision["l.pdf"] == "review" and decision["b.docx"] == "allow_restricted" and decision["a.txt"] == "allow"
    units = {ids[r.document_id]: r.n for r in t["ir_units"].groupBy("document_id").agg(F.count("*").alias("n")).collect()}
    assert units["a.txt"] == 4 and not {"i.zip", "j.zip"} & set(units)
    from paperloom.operators.ir import broken_invariants

    assert broken_invariants(t["ir_units"]).count() == 0
    scores = {(ids[r.document_id], r.axis): r.score for r in t["scores"].collect()}
    assert scores["a.txt", "structural"] == 1.0 and scores["c.xlsx", "computational"] == 1.0
    status = {ids[r.document_id]: r.status for r in t["statuses"].collect()}
    assert status["a.txt"] == "ok" and status["i.zip"] == "rejected"
    assert t["package"].first().eligible is False


def test_resume_and_cancel(spark, bundle, tmp_path):
    few = bundle.filter("display_name IN ('a.txt', 'b.docx')")
    calls = iter([False, False, False, True])
    first = ingest.write(spark, few, str(tmp_path), cancelled=lambda: next(calls))
    assert [r.state for r in first["run_nodes"].collect()].count("completed") == 3
    second = ingest.write(spark, few, str(tmp_path), until="decisions")
    states = [r.state for r in second["run_nodes"].collect()]
    assert states.count("resumed") == 3 and second["decisions"].count() == 2


def test_files_and_refusals(spark, tmp_path):
    (tmp_path / "in" / "sub").mkdir(parents=True)
    (tmp_path / "in" / "b.txt").write_bytes(b"b")
    (tmp_path / "in" / "sub" / "a.txt").write_bytes(b"a")
    rows = acquire.files(spark, str(tmp_path / "in")).orderBy("ordinal").collect()
    assert [r.display_name for r in rows] == ["b.txt", "a.txt"] and rows[0].size_bytes == 1 and len({r.document_id for r in rows}) == 2
    locators = spark.createDataFrame([("1", "url", "https://x/y"), ("2", "url", "nope"), ("3", "bytes", ""), ("4", "bytes", ""), ("5", "embedded", ""), ("6", "local_file", "x"), ("6", "local_file", "x")], "locator_id string, kind string, uri string")
    assert {(r.locator_id, r.code) for r in acquire.refusals(locators, ["3"]).collect()} == {("1", "DS-ACQ-003"), ("2", "DS-REQ-001"), ("4", "DS-ACQ-002"), ("5", "DS-ACQ-001"), ("6", "DS-REQ-001")}


def test_links_budgets_and_expected_hashes(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    for i in range(5):
        (folder / f"{i}.txt").write_bytes(b"x" * 10 * (i + 1))
    assert [(r.ordinal, r.size_bytes) for r in acquire.files(spark, str(folder), most_bytes=60).orderBy("ordinal").collect()] == [(0, 10), (1, 20), (2, 30)]
    rows = acquire.files(spark, str(folder)).filter("ordinal = 0")
    expected = spark.createDataFrame([("locator", "0" * 64)], "locator_id string, expected_sha256 string")
    assert [r.code for r in acquire.unexpected(rows, expected).collect()] == ["DS-ACQ-004"]
    (folder / "link").symlink_to(folder / "0.txt")
    with pytest.raises(acquire.SymbolicLink):
        acquire.files(spark, str(folder))


def test_rendering_of_all_kinds(spark):
    cells = [(f"{chr(65 + c)}{r}", f"cell {r} {c}") for r in range(1, 41) for c in range(20)]
    files = {"a.txt": b"A" * 12_000 + b"\nsecond line", "b.xlsx": formats.xlsx([(a, v * (8 if a == "A1" else 1)) for a, v in cells], "SUM(A1:A2)"), "c.pptx": formats.pptx(["hello", "bye"]), "d.png": formats.raster("png", 2, 3, 1)}
    t = ingest.plan(acquire.injected(spark, files), ingest.Policy(render="required"), until="package")
    names = {r.document_id: r.display_name for r in t["artifacts"].select("document_id", "display_name").collect()}
    surfaces = {}
    for r in t["surfaces"].collect():
        surfaces.setdefault(names[r.document_id], []).append(r)
    assert len(surfaces["a.txt"]) >= 2 and len(surfaces["b.xlsx"]) >= 4 and len(surfaces["c.pptx"]) == 2 and [(r.width, r.fidelity) for r in surfaces["d.png"]] == [(2.0, "not_assessed")]
    shown = {(names[r.document_id], r.is_clipped) for r in t["geometry"].select("document_id", "is_clipped").distinct().collect()}
    assert ("b.xlsx", True) in shown and ("a.txt", True) not in shown
    visual = {names[r.document_id]: r.score for r in t["scores"].filter("axis = 'visual'").collect()}
    assert visual["a.txt"] == 0.5 and 0 < visual["b.xlsx"] < 0.5 and visual["d.png"] is None
    assets = {(names[r.document_id], r.role) for r in t["assets"].collect()}
    assert ("a.txt", "preview") in assets and ("d.png", "passthrough") in assets
    assert t["edge_failures"].count() == t["quality_failures"].count() == t["contract_failures"].count() == 0
    status = {names[r.document_id]: r.status for r in t["statuses"].collect()}
    assert status["a.txt"] == "review" and t["package"].first().eligible


def test_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_bytes(b"one\ntwo\n")
    start = lambda: arrival.ingest_stream(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "check"), tables=("documents", "native_units")).awaitTermination()
    start()
    (tmp_path / "in" / "b.docx").write_bytes(formats.docx("x"))
    start()
    got = spark.read.parquet(str(tmp_path / "out" / "documents"))
    assert sorted(r.format_name for r in got.collect()) == ["docx", "txt"] and got.select("batch").distinct().count() == 2


def test_archives_are_fixed():
    assert formats.docx("a") == formats.docx("a") and zipfile.ZipFile
