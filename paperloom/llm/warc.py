"""WARC archives of pages: written with an index first, read by coalesced byte ranges of the selected records.

Writing: each record is a gzip member of its own in ``.warc.gz`` files, and the index row of a record (file, offset,
length, page, url, digest, type) is committed with it. Pages whose payloads are equal and of ``MIN_REVISIT_BYTES`` at
least are stored once, under the largest page id; the others are revisit records that name it. Reading: the index
rows of the wanted records are sorted by place, neighbouring ones joined into one range, and each range is read once.

Skew: copies of one payload are found by a pre-aggregated digest table, and joined with a salt, so that a payload that
holds a third of all pages is written by many tasks.

Nulls: null html is an empty payload; a null url leaves out the target header; a page of null id is a response unless
it copies a page that has an id. Rows that repeat the kept page's id are responses too. An empty table gives no
records. Extra columns are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import storage

MIN_REVISIT_BYTES = 1000
SALTS = 32
#: A file ends after so many compressed bytes.
FILE_BYTES = 256 << 20
#: Records further apart than this are read by separate ranges, and a range is no longer than RANGE_BYTES and a record.
GAP_BYTES = 64 << 10
RANGE_BYTES = 4 << 20
DATE = "2026-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX = "file string, offset long, length long, page_id long, url string, payload_digest string, record_type string"
RECORDS = "page_id long, url string, record_type string, refers_to long, payload_digest string, payload_bytes long, payload binary"


def classified(pages: DataFrame) -> DataFrame:
    """The pages with digest, record type and the page that a revisit refers to."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload"))
    rows = rows.withColumn("payload_digest", F.sha1("payload")).withColumn("long_enough", F.octet_length("payload") >= MIN_REVISIT_BYTES)
    narrow = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload")).filter(F.octet_length("payload") >= MIN_REVISIT_BYTES)
    kept = narrow.groupBy(F.sha1("payload").alias("payload_digest")).agg(F.max("page_id").alias("keeper"), F.max_by("url", "page_id").alias("keeper_url"), F.count("*").alias("n"))
    kept = kept.filter("n > 1 AND keeper IS NOT NULL").select("payload_digest", "keeper", "keeper_url", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int"))
    joined = salted.join(kept, ["payload_digest", "salt"], "left")
    revisit = F.col("long_enough") & F.col("keeper").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("keeper"))
    return joined.select("page_id", "url", "payload", "payload_digest", F.when(revisit, F.col("keeper")).alias("refers_to"), F.when(revisit, F.col("keeper_url")).alias("refers_url"))


def _uri(page_id: int | None) -> str:
    return f"<urn:x-page:{page_id if page_id is not None else 'none-' + uuid.uuid4().hex}>"


def _target(url: str) -> str:
    return quote(url, safe="!#$%&'()*+,/:;=?@[]~")


def record_bytes(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, refers_url: str | None) -> bytes:
    """One WARC/1.1 record, not yet compressed."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {_uri(page_id)}", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {_target(url)}")
    head.append(f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}")
    if refers_to is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_uri(refers_to)}"]
        if refers_url is not None:
            head.append(f"WARC-Refers-To-Target-URI: {_target(refers_url)}")
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _page_of(uri: str) -> int | None:
    value = uri.strip("<>").removeprefix("urn:x-page:")
    return None if value.startswith("none-") else int(value)


def parse_record(data: bytes) -> dict:
    """What one record says; a response's payload is held against its digest."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(next(x for x in http.split(b"\r\n") if x.startswith(b"Content-Length: "))[16:])
    digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    response = fields["WARC-Type"] == "response"
    if response and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"the payload of {fields['WARC-Record-ID']} doesn't match its digest")
    return {"page_id": _page_of(fields["WARC-Record-ID"]), "record_type": fields["WARC-Type"], "refers_to": None if response else _page_of(fields["WARC-Refers-To"]), "payload_digest": digest, "payload_bytes": size, "payload": payload if response else None}


def write(pages: DataFrame, path: str) -> DataFrame:
    """Writes an archive of ``pages(page_id, url, html)`` under ``path``; returns its index."""
    schema = pa.schema([(x.split()[0], pa.string() if x.endswith("string") else pa.int64()) for x in INDEX.split(", ")])

    def write_files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, out, name, at, rows = TaskContext.get().partitionId(), 0, None, "", 0, []
        for batch in batches:
            for r in batch.to_pylist():
                if out is None:
                    name, at = f"pages-{part:06d}-{number:04d}-{uuid.uuid4().hex[:12]}.warc.gz", 0
                    out = storage.open_new(f"{path}/{name}")
                data = gzip.compress(record_bytes(r["page_id"], r["url"], r["payload"], r["payload_digest"], r["refers_to"], r["refers_url"]), 6, mtime=0)
                out.write(data)
                rows.append({"file": name, "offset": at, "length": len(data), "page_id": r["page_id"], "url": r["url"], "payload_digest": r["payload_digest"], "record_type": "response" if r["refers_to"] is None else "revisit"})
                at += len(data)
                if at >= FILE_BYTES:
                    out.close()
                    out, number = None, number + 1
            yield pa.RecordBatch.from_pylist(rows, schema)
            rows = []
        if out is not None:
            out.close()

    return storage.staged(storage.in_arrow(classified(pages), write_files, INDEX), "warc-index")


def ranges(index: DataFrame) -> DataFrame:
    """(file, first, last, records): the byte ranges to read for these index rows, each with the records in it."""
    by_place = Window.partitionBy("file").orderBy("offset")
    end = F.col("offset") + F.col("length")
    far = (F.col("offset") - F.lag(end).over(by_place) > GAP_BYTES) | (F.floor(F.col("offset") / RANGE_BYTES) != F.floor(F.lag("offset").over(by_place) / RANGE_BYTES))
    marked = index.withColumn("begins", F.coalesce(far, F.lit(True)).cast("int"))
    numbered = marked.withColumn("range_no", F.sum("begins").over(by_place.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy("file", "range_no").agg(F.min("offset").alias("first"), F.max(end).alias("last"), F.array_sort(F.collect_list(F.struct("offset", "length", "url"))).alias("records"))


def read(index: DataFrame, path: str) -> DataFrame:
    """The records of these index rows. Select rows of the index first; only their bytes (and small gaps) are read."""
    schema = pa.schema([(x.split()[0], {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}[x.split()[1]]) for x in RECORDS.split(", ")])

    def read_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in zip(*(batch[c].to_pylist() for c in ("file", "first", "last", "records"))):
                name, first, last, records = r
                with storage.open_at(f"{path}/{name}") as f:
                    f.seek(first)
                    data = f.read(last - first)
                found = []
                for x in records:
                    a = x["offset"] - first
                    found.append(parse_record(zlib.decompress(data[a : a + x["length"]], 31)) | {"url": x["url"]})
                yield pa.RecordBatch.from_pylist(found, schema)

    return storage.in_arrow(ranges(index).select("file", "first", "last", "records"), read_ranges, RECORDS)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op2: writes every page, reads every record back by its index."""
    path = storage.fresh_path(spark, "warc")
    index = write(storage.documents(spark, sf_dir, "pages"), path)
    return read(index, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
d AS (SELECT page_id, CAST(strlen(body) AS BIGINT) AS payload_bytes, sha1(body) AS payload_digest FROM p),
k AS (SELECT payload_digest AS kd, max(page_id) AS keeper FROM d WHERE payload_bytes >= 1000 GROUP BY 1)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN keeper IS NULL OR page_id = keeper THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN keeper IS NULL OR page_id = keeper THEN NULL ELSE keeper END AS refers_to
FROM d LEFT JOIN k ON kd = payload_digest AND payload_bytes >= 1000
"""
