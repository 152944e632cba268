"""Access inspection: encryption, signatures and restrictions by tokens, without opening anything.

PDF and compound files are searched as bytes by column expressions; of a package only member names and three settings
parts count.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.security import access_state
from .containers import open_zip, per_document

PDF_BYTES = 16 << 20
OLE_BYTES = 32 << 20
PART_BYTES = 4 << 20

# Parts with protection settings, and the tokens that say so -----------------------------------------------
SETTINGS = ("word/settings.xml", "xl/workbook.xml", "ppt/presentation.xml")
PROTECTION = (b"documentProtection", b"workbookProtection", b"modifyVerifier", b"readOnlyRecommended")


def _holds(data: Column, token: str, encoding: str = "latin-1") -> Column:
    return F.contains(data, F.lit(bytearray(token.encode(encoding))))


def _listed(**rules: Column) -> Column:
    return F.array_sort(F.filter(F.array(*[F.when(c, n) for n, c in rules.items()]), lambda x: x.isNotNull()))


def pdf(content: Column) -> Column:
    """Struct of (encrypted, signature, restrictions) of a PDF's first bytes."""
    data = F.substring(content, 1, PDF_BYTES)
    script = F.regexp_like(F.decode(data, "ISO-8859-1"), F.lit(r"/JavaScript\b|/JS\b"))
    signed = _holds(data, "/ByteRange") & _holds(data, "/Sig")
    return F.struct(_holds(data, "/Encrypt").alias("encrypted"), F.when(signed, "present_unverified").otherwise("absent").alias("signature"), _listed(javascript_present_inert=script, launch_action_present_inert=_holds(data, "/Launch")).alias("restrictions"))


def compound(content: Column) -> Column:
    data = F.substring(content, 1, OLE_BYTES)
    encrypted = _holds(data, "EncryptedPackage", "utf-16le") | _holds(data, "EncryptionInfo", "utf-16le")
    return F.struct(encrypted.alias("encrypted"), F.lit("unknown").alias("signature"), _listed(active_content_present_inert=_holds(data, "VBA", "utf-16le"), legacy_ole_partial_inspection=F.lit(True)).alias("restrictions"))


def _package(document_id: str, content: bytes) -> Iterator[dict]:
    archive = open_zip(content)
    names = archive.namelist()
    lower = [n.lower() for n in names]
    guarded = False
    for name, low in zip(names, lower):
        if low in SETTINGS:
            with archive.open(name) as part:
                head = part.read(PART_BYTES)
            guarded = guarded or any(t in head for t in PROTECTION)
    found = {
        "native_editing_restriction_present": guarded,
        "external_references_not_resolved": any("externallinks" in n or n.endswith(".rels") for n in lower),
        "active_content_present_inert": any("vbaproject" in n or "activex" in n for n in lower),
    }
    signed = any(n.startswith("_xmlsignatures/") for n in lower)
    yield {"document_id": document_id, "signature": "present_unverified" if signed else "absent", "restrictions": ",".join(sorted(k for k, v in found.items() if v))}


def inspect(artifacts: DataFrame, documents: DataFrame) -> DataFrame:
    """(document_id, encrypted, signature, restrictions) of every document."""
    rows = artifacts.join(documents.select("artifact_id", "container"), "artifact_id")
    packages = per_document(rows.filter("container = 'ooxml_zip'"), _package, "document_id string, signature string, restrictions string")
    split = F.filter(F.split("restrictions", ","), lambda x: x != "")
    packages = packages.select("document_id", F.lit(False).alias("encrypted"), "signature", split.alias("restrictions"))
    plain = F.struct(F.lit(False).alias("encrypted"), F.lit("absent").alias("signature"), F.lit([]).cast("array<string>").alias("restrictions"))
    others = rows.filter("container <> 'ooxml_zip'").select("document_id", F.when(F.col("container") == "pdf", pdf(F.col("content"))).when(F.col("container") == "ole_cfb", compound(F.col("content"))).otherwise(plain).alias("x"))
    return packages.unionByName(others.select("document_id", "x.encrypted", "x.signature", "x.restrictions")).dropDuplicates(["document_id"])


def states(inspected: DataFrame, decisions: DataFrame, secrets: DataFrame, reject_encrypted: bool = False) -> DataFrame:
    """(document_id, access_state, status): ``secrets(document_id)`` are documents with a secret at hand."""
    rows = inspected.join(decisions.select("document_id", "decision"), "document_id").join(secrets.select("document_id", F.lit(True).alias("has_secret")).distinct(), "document_id", "left")
    state = access_state(F.col("decision") == "block", F.col("encrypted") & F.lit(reject_encrypted), F.col("encrypted"), F.lit(False), (F.size("restrictions") > 0) | (F.col("decision") != "allow"))
    status = F.when(state.isin("blocked", "reject"), "rejected").when(state.isin("secret_required", "clear_restricted"), "review").otherwise("ok")
    return rows.select("document_id", state.alias("access_state"), status.alias("status"), F.coalesce("has_secret", F.lit(False)).alias("has_secret"), "signature", "restrictions")
